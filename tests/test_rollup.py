"""Maintained counts: replays, compaction, and replacement that readers do not notice."""

import pytest
from pyspark.sql import functions as F

from civicflow.operators.aggregate import slice_rollup
from civicflow.plans.rollup import Rollup, merged, rollup_answers
from civicflow.plans.tables import clean_store
from civicflow.session import scratch_path
from civicflow.sources.versions import Versions


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def parts(spark, sf001):
    clean = clean_store(spark, sf001).cache()
    return clean, [clean.where(F.pmod("seq", F.lit(4)) == k) for k in range(4)]


def test_batches_replays_and_compaction(spark, parts):
    clean, batches = parts
    rollup = Rollup(scratch_path(spark, "t-rollup"))
    assert rows(rollup.read(spark)) == []
    rollup.compact(spark)  # nothing to merge yet
    for k, b in enumerate(batches):
        rollup.add(b, k)
    want = rows(slice_rollup(clean).select("borough", "complaint_type", "count"))
    slices = lambda: rows(merged(rollup.read(spark), "borough", "complaint_type"))
    assert slices() == want
    rollup.add(batches[3], 3)
    assert slices() == want
    for _ in range(2):
        rollup.compact(spark)
        assert slices() == want
    rollup.add(batches[3], 3)  # the newest may be replayed after compaction, too
    assert slices() == want
    with pytest.raises(ValueError):
        rollup.add(batches[0], 0)
    rollup.release_old(spark)
    assert slices() == want
    plan = rollup_answers(rollup.read(spark))._jdf.queryExecution().executedPlan().toString()
    assert "unique_key" not in plan and "created_date" not in plan


def test_a_compaction_that_dies_changes_nothing(spark, parts, monkeypatch):
    clean, batches = parts
    rollup = Rollup(scratch_path(spark, "t-dies"))
    for k, b in enumerate(batches):
        rollup.add(b, k)
    want = rows(rollup.read(spark))

    def die(*args, **kwargs):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(Versions, "publish", die)
        with pytest.raises(RuntimeError):
            rollup.compact(spark)
    assert rows(rollup.read(spark)) == want
    rollup.compact(spark)
    assert rows(rollup.read(spark)) == want


def test_a_replacement_that_dies_leaves_the_old_rows(spark):
    table = Versions(scratch_path(spark, "t-versions"))
    schema = spark.range(0).schema
    assert table.read(spark, schema).count() == 0
    table.replace(spark.range(5))
    fail = F.udf(lambda x: 1 // 0, "long")
    with pytest.raises(Exception):
        table.replace(spark.range(9).select(fail("id").alias("id")))  # fails while files are written
    assert table.read(spark, schema).count() == 5
    reader = table.read(spark, schema)
    table.replace(spark.range(7))
    assert reader.count() == 5 and table.read(spark, schema).count() == 7
    table.release(spark, 1)
    assert table.read(spark, schema).count() == 7
