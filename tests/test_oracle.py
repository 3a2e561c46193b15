"""The correctness gate: every key with oracle SQL equals DuckDB on sf0.01."""

import pytest

import __spark_entry__ as entry
from civicflow.oracle import ORACLE_SQL as ORACLES
from civicflow.queries import QUERIES
from tools.oracle_check import duck, duck_pdf, frame_digest, spark_pdf


def test_every_key_has_a_query():
    assert set(ORACLES) == set(QUERIES)


@pytest.fixture(scope="module")
def con(sf01):
    return duck(sf01)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_key_matches_oracle(spark, sf01, con, key):
    got = frame_digest(spark_pdf(QUERIES[key](spark, sf01)))
    want = frame_digest(duck_pdf(con, ORACLES[key]))
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["aggregation_name", "position", "key", "count", "record_count"]
    assert df.count() > 0
