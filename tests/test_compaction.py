"""Compaction of what arrives batch by batch: same rows, counts and progress; replays; a compaction that dies."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators.keyfilter import merged_bitmaps
from civicflow.plans.clean import parse_requests
from civicflow.plans.rollup import Rollup
from civicflow.plans.store import CleanStore
from civicflow.schema import BATCH, RAW_SCHEMA
from civicflow.session import scratch_path
from civicflow.sources.batches import BatchTable
from civicflow.streaming.ingest import IngestPaths, _write_batch, compact_ingest, read_progress, read_rejects, release_ingest, run_ingest

NUMBERS = T.StructType([T.StructField("n", T.LongType()), T.StructField(BATCH, T.LongType())])


@pytest.fixture
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _add(spark, table, batch_id, lo, hi):
    table.ensure(spark)
    table.write(spark.range(lo, hi, 1, 1).select(F.col("id").alias("n"), F.lit(batch_id).cast("long").alias(BATCH)))


def _rows(spark, table):
    return sorted(map(tuple, table.read(spark).select("n", BATCH).collect()))


def _batch_folders(path):
    return [p.name for p in Path(path.removeprefix("file:")).glob(f"{BATCH}=*")]


def test_few_runs_for_many_batches(spark, one_partition):
    table = BatchTable(scratch_path(spark, "t-runs"), NUMBERS)
    want = []
    for batch_id in range(24):
        _add(spark, table, batch_id, 10 * batch_id, 10 * batch_id + 10)
        want += [(n, batch_id) for n in range(10 * batch_id, 10 * batch_id + 10)]
        if batch_id % 3 == 2:
            assert table.compact(spark)
            assert _rows(spark, table) == want
    now = table.manifest(spark)
    assert now.version == 8 and now.through == 22 and sum(rows for _, rows in now.runs) == 230
    assert len(now.runs) <= 3
    assert len(_batch_folders(table.tail(now.version))) == 1
    table.release_old(spark)
    assert _rows(spark, table) == want
    assert not _batch_folders(table.tail(now.version - 1))
    assert not table.compact(spark)  # only the newest is left


def test_a_compaction_that_dies_changes_nothing(spark, one_partition, monkeypatch):
    table = BatchTable(scratch_path(spark, "t-dies"), NUMBERS)
    for batch_id in range(4):
        _add(spark, table, batch_id, batch_id, batch_id + 2)
    want = _rows(spark, table)
    reader = table.read(spark)
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.compact(spark)
    assert table.manifest(spark).version == 0 and _rows(spark, table) == want
    _add(spark, table, 4, 4, 6)  # the next batch still comes, and the folders left over are written anew
    table.compact(spark)
    # a reader that listed its files before goes on with those
    assert sorted(map(tuple, reader.select("n", BATCH).collect())) == want
    assert _rows(spark, table) == want + [(4, 4), (5, 4)]


def test_newest_batch_can_come_again_and_merged_ones_are_known(spark, one_partition):
    table = BatchTable(scratch_path(spark, "t-again"), NUMBERS)
    for batch_id in range(3):
        _add(spark, table, batch_id, 0, 2)
    table.compact(spark)
    assert [table.has_merged(spark, k) for k in range(4)] == [True, True, False, False]
    _add(spark, table, 2, 0, 2)
    assert _rows(spark, table) == [(n, k) for n in range(2) for k in range(3)]


def test_ingest_of_batches_with_compaction(spark, one_partition):
    full = dict(agency="A", complaint_type="C", channel_type="O", status="Open", created_date="2026-05-01T10:00:00")
    none = dict.fromkeys(RAW_SCHEMA.fieldNames())
    # a file holds a new key, one of the file before, and a bad row
    files = [
        [
            {**none, **full, "seq": 3 * k, "unique_key": str(k), "borough": f"B{k % 3}"},
            {**none, **full, "seq": 3 * k + 1, "unique_key": str(max(0, k - 1)), "borough": "LATER"},
            {**none, "seq": 3 * k + 2, "unique_key": f"bad{k}"},
        ]
        for k in range(8)
    ]
    root = scratch_path(spark, "t-compacted")
    paths = IngestPaths(f"{root}/landing", f"{root}/clean", f"{root}/quarantine", f"{root}/_ckpt")
    rows = [{**r, "file": k} for k, file in enumerate(files) for r in file]
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField("file", T.LongType())])
    spark.createDataFrame(rows, schema).repartitionByRange(8, "file").sortWithinPartitions("seq").drop("file").write.json(paths.landing)
    run_ingest(spark, paths, max_files_per_trigger=1, compact_every=3)

    def state():
        clean = CleanStore(paths.clean).read(spark).select("unique_key", "borough", BATCH).collect()
        return (
            sorted(map(tuple, clean)), sorted(map(tuple, read_progress(spark, paths).collect())),
            sorted((r.batch_id, r.original_record) for r in read_rejects(spark, paths).collect()),
            sorted(map(str, Rollup(paths.rollup).read(spark).collect())),
        )

    first = state()
    batches = len(first[1])
    assert len(first[0]) == len({k for k, _, _ in first[0]}) == 8 and len(first[2]) == 8
    assert sum(p[1] for p in first[1]) == 24 and sum(p[4] for p in first[1]) == 8
    assert CleanStore(paths.clean).rows.manifest(spark).version >= 2
    compact_ingest(spark, paths)
    release_ingest(spark, paths)
    assert state() == first
    for table in (CleanStore(paths.clean).rows, paths.progress_table, paths.quarantine_table):
        assert len(_batch_folders(table.tail(table.manifest(spark).version))) == 1 < batches
    # the newest batch and a merged one come again
    write = _write_batch(paths)
    number = {key: batch for key, _, batch in first[0]}
    for k in (7, 2):
        again = [r for file in files for r in file if r["unique_key"] in (str(k), f"bad{k}") and r["borough"] != "LATER"]
        again += [r for r in files[k] if r["borough"] == "LATER"]
        write(parse_requests(spark.createDataFrame(again, RAW_SCHEMA)), number[str(k)])
        assert state()[0] == first[0] and state()[1:] == first[1:]
    # keys of merged batches are still known to a new batch
    late = [{**none, **full, "seq": 100 + k, "unique_key": str(k), "borough": "LATE"} for k in (0, 4, 7, 99)]
    write(parse_requests(spark.createDataFrame(late, RAW_SCHEMA)), batches)
    assert state()[0] == sorted([*first[0], ("99", "LATE", batches)])
    bitmaps = merged_bitmaps(CleanStore(paths.clean).read_filters(spark))
    assert bitmaps.agg(F.sum(F.bitmap_count("bits"))).first()[0] == 9


def test_a_rollup_compaction_that_dies_counts_nothing_twice(spark, one_partition, monkeypatch):
    rollup = Rollup(scratch_path(spark, "t-rollup-dies"))
    rows = spark.sql("select 'B' borough, 'C' complaint_type, 'O' channel_type, timestamp_ntz'2026-05-01 10:00:00' created_date")
    for batch_id in range(3):
        rollup.add(rows, batch_id)
    with monkeypatch.context() as m:
        m.setattr("civicflow.sources.versions.Versions.publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            rollup.compact(spark)
    rollup.add(rows, 3)
    rollup.compact(spark)
    assert [r["count"] for r in rollup.read(spark).collect()] == [4]
