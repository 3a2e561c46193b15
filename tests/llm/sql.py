"""Rows of a query and of its SQL, comparable whatever the order."""

from civicflow.llm.queries import ORACLE_SQL, QUERIES
from tools.oracle_check import duck


def same_rows(spark, key, path):
    df = QUERIES[key](spark, path)
    names = sorted(df.columns)
    got = sorted(map(tuple, df.select(*names).collect()), key=repr)
    cursor = duck(path).execute(ORACLE_SQL[key])
    at = [[c[0] for c in cursor.description].index(name) for name in names]
    assert len(cursor.description) == len(names)
    want = sorted((tuple(row[i] for i in at) for row in cursor.fetchall()), key=repr)
    assert got and got == want
