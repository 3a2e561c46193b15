"""The bucketed clean store: exact, reads only the buckets in question, replays."""

import re

import pytest
from pyspark.sql import functions as F

from civicflow.fixtures import raw_requests
from civicflow.operators.keyfilter import BUCKET, KeySpace, drop_known, key_bitmaps, maybe_known
from civicflow.plans.clean import clean_rows, parse_requests
from civicflow.plans.store import CleanStore
from civicflow.session import scratch_path
from civicflow.sources.sinks import read_clean


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _keys(spark, lo, hi):
    return spark.range(lo, hi).select(F.concat(F.lit("k"), F.col("id")).alias("unique_key"))


def test_bitmaps_forget_no_key_and_find_few_others(spark):
    space = KeySpace(buckets=4, slots=8)
    known = _keys(spark, 0, 20_000)
    filters = key_bitmaps(known.where("unique_key < 'k5'"), "unique_key", space).unionByName(
        key_bitmaps(known.where("unique_key >= 'k5'"), "unique_key", space)
    )
    assert maybe_known(known, filters, "unique_key", space).count() == 20_000
    false_hits = maybe_known(_keys(spark, 50_000, 60_000), filters, "unique_key", space).count()
    assert false_hits < 10_000 * 20_000 / (4 * 8 * 32768) * 1.3


def test_only_buckets_in_question_are_read(spark):
    space = KeySpace(buckets=16, slots=8)
    store = _keys(spark, 0, 4000).withColumn(BUCKET, space.bucket("unique_key"))
    path = scratch_path(spark, "t-buckets")
    store.write.partitionBy(BUCKET).parquet(path)
    stored = spark.read.schema(store.schema).parquet(path)
    filters = key_bitmaps(stored, "unique_key", space).cache()
    # of 200 keys two are known, in two buckets
    (a,) = stored.where("bucket = 3").limit(1).collect()
    (b,) = stored.where("bucket = 9").limit(1).collect()
    fresh = _keys(spark, 100_000, 100_400).join(maybe_known(_keys(spark, 100_000, 100_400), filters, "unique_key", space), "unique_key", "left_anti")
    batch = fresh.unionByName(spark.createDataFrame([(a.unique_key,), (b.unique_key,)], "unique_key string")).cache()
    new = drop_known(batch, stored, filters, "unique_key", space)
    assert re.search(r"PartitionFilters: \[bucket#\d+ IN \(3,9\)\]", plan(new))
    assert sorted(new.collect()) == sorted(fresh.collect())
    # a batch of new keys reads no bucket at all
    assert drop_known(fresh, stored, filters, "unique_key", space) is fresh


def test_what_a_batch_reads_does_not_grow_with_the_number_of_batches(spark):
    space = KeySpace(buckets=8, slots=16)
    filters = key_bitmaps(_keys(spark, 0, 500), "unique_key", space)
    late = filters
    for n in range(1, 20):
        late = late.unionByName(key_bitmaps(_keys(spark, 500 * n, 500 * (n + 1)), "unique_key", space))
    batch = _keys(spark, 10**6, 10**6 + 300)
    found = [maybe_known(batch, f, "unique_key", space).count() for f in (filters, late)]
    assert found[1] <= 10  # of 300 keys, in a store twenty times as large


@pytest.mark.parametrize("parts", [2, 5])
def test_first_written_wins_and_replays_change_nothing(spark, sf001, parts):
    raw = raw_requests(spark, sf001)
    store = CleanStore(scratch_path(spark, "t-store"))
    order = list(range(parts))
    for batch_id in [*order, order[-1]]:
        # batches by remainder: the duplicates of a key come in different batches
        store.add(clean_rows(parse_requests(raw.where(F.col("seq") % parts == batch_id))), batch_id)
    got = {r.unique_key: r.seq for r in read_clean(spark, store.path).collect()}
    want = {}
    for r in sorted(parse_requests(raw).where("agency is not null and created_date is not null").collect(), key=lambda r: (r.seq % parts, r.seq)):
        want.setdefault(r.unique_key, r.seq)
    assert got == want
    assert read_clean(spark, store.path).count() == len(want)
