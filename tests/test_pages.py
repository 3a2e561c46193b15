"""Page samples by rank selection: same rows as numbering the whole table, with fewer rows moved."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from civicflow.fixtures import read_table
from civicflow.operators import pages
from civicflow.operators.pages import page_sample


def expected(rows, way, page, stride, cap):
    """Ranks by a sort in Python; nulls first ascending, last descending."""

    def place(r):
        a, b = r
        first = (0, 0) if a is None else (1, a)
        if way == "desc":
            first = (1, 0) if a is None else (0, -a)
        return first, b

    ranked = enumerate(sorted(rows, key=place))
    return sorted((b, i) for i, (_, b) in ranked if i % stride < page and (cap is None or i - i % stride < cap))


@pytest.mark.parametrize("way", ["asc", "desc"])
@pytest.mark.parametrize("cap", [None, 900])
def test_equals_a_sort_with_a_hot_value_nulls_and_extremes(spark, way, cap):
    rng = random.Random(5)
    rows = [(7 if i % 3 == 0 else rng.randint(-50, 50), i) for i in range(2500)]
    rows += [(None, 3000 + i) for i in range(300)] + [(2**63 - 1, 4000), (-(2**63) + 1, 4001)]
    df = spark.createDataFrame(rows, "a long, b long").withColumn("extra", F.lit("x")).repartition(5)
    got = page_sample(df, [("a", way), ("b", "asc")], 20, 150, cap)
    assert got.columns == ["a", "b", "extra", "rank"]
    assert sorted((r.b, r.rank) for r in got.collect()) == expected(rows, way, 20, 150, cap)


def test_too_many_pages_are_sorted_instead(spark, monkeypatch):
    rows = [(i % 10, i) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b long")
    for cells in (64, 400):  # refused by the number of pages, then by the number of cells
        monkeypatch.setattr(pages, "CELLS", cells)
        got = page_sample(df, [("a", "asc"), ("b", "asc")], 2, 25)
        assert sorted((r.b, r.rank) for r in got.collect()) == expected(rows, "asc", 2, 25, None)


def test_empty_equal_and_unsuitable(spark):
    df = spark.createDataFrame([], "a date, b int")
    assert page_sample(df, [("a", "desc"), ("b", "asc")], 2, 5).collect() == []
    same = spark.createDataFrame([(dt.date(2024, 1, 1), 1)] * 40, "a date, b int")
    assert sorted(r.rank for r in page_sample(same, [("a", "asc"), ("b", "asc")], 2, 10).collect()) == [
        0, 1, 10, 11, 20, 21, 30, 31]
    with pytest.raises(TypeError):
        page_sample(spark.createDataFrame([], "a string"), [("a", "asc")], 1, 2)
    with pytest.raises(ValueError):
        page_sample(df, [("b", "asc")], 3, 2)


def test_only_rows_of_pages_are_numbered(spark, sf01):
    events = read_table(spark, sf01, "events").select("event_id", "ts")
    order = [("ts", "desc"), ("event_id", "asc")]
    rows, met = pages._cells_of_pages(
        events, [pages._whole_number(events, c, w) for c, w in order], [True, False], 100, 1000, None
    )
    moved = rows.join(met.select("_cell_path"), "_cell_path", "left_semi").count()
    assert page_sample(events, order, 100, 1000).count() == 1000 <= moved <= 1600
    plan = page_sample(events, order, 100, 1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "rangepartitioning" not in plan
