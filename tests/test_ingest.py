"""Resumable ingest: arrivals, restart, replay, progress; feeds as they are published."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from civicflow.fixtures import raw_requests
from civicflow.operators.profile import null_ranking
from civicflow.operators.validate import is_valid
from civicflow.plans.batch import run_batch
from civicflow.plans.clean import clean_rows, parse_requests, quarantine_rows, slim_requests
from civicflow.queries import _cross_batch, _halves_united
from civicflow.schema import QUARANTINE_SCHEMA, RAW_LINE, RAW_SCHEMA
from civicflow.session import scratch_path
from civicflow.sources.jsonl import arrival_bounds, land_arrival, read_jsonl, write_jsonl
from civicflow.sources.sinks import ensure_table, land_raw, read_clean, read_quarantine, read_raw
from civicflow.streaming.ingest import PROGRESS_SCHEMA, STORE_SCHEMA, IngestPaths, _write_batch, read_progress, run_ingest


def _paths(spark):
    root = scratch_path(spark, "t-ingest")
    return IngestPaths(f"{root}/landing", f"{root}/clean", f"{root}/quarantine", f"{root}/_ckpt")


def test_ingest_in_arrivals_equals_batch_clean_and_resumes(spark, sf001):
    raw = raw_requests(spark, sf001)
    paths = _paths(spark)
    for lo, hi in arrival_bounds(raw, 3):
        land_arrival(raw, paths.landing, lo, hi)
        run_ingest(spark, paths)
    expected = clean_rows(parse_requests(raw))
    got = read_clean(spark, paths.clean)
    assert got.count() == expected.count()
    assert got.exceptAll(expected.select(*got.columns)).count() == 0
    progress = read_progress(spark, paths).collect()
    assert len(progress) == 3
    assert sum(p.rows for p in progress) == raw.count()
    assert sum(p.bad for p in progress) == read_quarantine(spark, paths.quarantine).count()
    assert sum(p.written for p in progress) == got.count()
    # a restart over the same files reads and writes nothing
    run_ingest(spark, paths)
    assert read_progress(spark, paths).count() == 3
    assert read_clean(spark, paths.clean).count() == expected.count()


def test_replayed_batch_writes_the_same_again(spark, sf001):
    raw = raw_requests(spark, sf001)
    paths = _paths(spark)
    for path, schema in ((paths.clean, STORE_SCHEMA), (paths.quarantine, QUARANTINE_SCHEMA), (paths.progress, PROGRESS_SCHEMA)):
        ensure_table(spark, path, schema, "batch_id")
    write = _write_batch(paths)
    state = lambda: (
        read_clean(spark, paths.clean).count(), read_quarantine(spark, paths.quarantine).count(),
        sorted(map(tuple, read_progress(spark, paths).collect())),
    )
    write(parse_requests(raw.where("seq < 600")), 0)
    write(parse_requests(raw.where("seq >= 600")), 1)
    first = state()
    write(parse_requests(raw.where("seq >= 600")), 1)  # as after a failure before the commit
    assert state() == first


def test_progress_of_more_than_a_hundred_batches(spark):
    paths = _paths(spark)
    rows = [{**dict.fromkeys(RAW_SCHEMA.fieldNames()), "seq": k, "unique_key": str(k)} for k in range(208)]
    spark.createDataFrame(rows, RAW_SCHEMA).repartition(104).write.json(paths.landing)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        run_ingest(spark, paths, max_files_per_trigger=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    progress = read_progress(spark, paths).collect()
    assert len(progress) > 100 and sum(p.rows for p in progress) == 208 == sum(p.bad for p in progress)


def test_feed_without_numbers_keeps_the_first_in_the_file(spark):
    path = scratch_path(spark, "t-unnumbered")
    full = dict(unique_key="k1", agency="A", complaint_type="C", channel_type="O", borough="B", created_date="2026-05-01")
    lines = [json.dumps({**full, "status": f"S{k}", "extra": k}) for k in range(50)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    raw = read_jsonl(spark, path)
    (kept,) = clean_rows(parse_requests(raw)).collect()
    assert kept.status == "s0" and kept.seq is None
    union = _halves_united(clean_rows(parse_requests(raw)))
    assert union.count() == 1 and _cross_batch(spark, raw).count() == 1


def test_undeclared_fields_reach_landing_profile_and_quarantine(spark):
    path = scratch_path(spark, "t-extra")
    line = '{"unique_key": "9", "colour": "red", "nested": {"a": [1, 2]}}'
    spark.createDataFrame([(line,)], "value string").write.text(path)
    raw = read_jsonl(spark, path)
    out = scratch_path(spark, "t-extra-out")
    land_raw(raw, out)
    landed = read_raw(spark, out, raw.schema)
    assert landed.first()[RAW_LINE] == line
    (bad,) = quarantine_rows(parse_requests(landed)).collect()
    assert bad.original_record == line and bad.quarantined_at is not None
    names = {r.column_name: r.nulls for r in null_ranking(landed, top=50).collect()}
    assert names["colour"] == 0 == names["nested"] and names["agency"] == 1
    assert not {RAW_LINE, "_corrupt_record", "_place", "seq"} & set(names)


def test_malformed_json_lines_are_quarantined(spark, sf001):
    path = scratch_path(spark, "t-jsonl")
    write_jsonl(raw_requests(spark, sf001).limit(3), path, mode="overwrite")
    bad = scratch_path(spark, "t-bad")
    spark.createDataFrame([("{not json",)], "value string").write.text(bad)
    parsed = parse_requests(read_jsonl(spark, [path, bad]))
    q = quarantine_rows(parsed).where(F.col("original_record") == "{not json").collect()
    assert len(q) == 1 and q[0].record_id == "unknown"


def test_profile_source_falls_back_to_the_file(spark, sf001):
    from civicflow.sources.jsonl import first_non_empty

    empty = spark.createDataFrame([], RAW_SCHEMA)
    path = scratch_path(spark, "t-fallback")
    write_jsonl(raw_requests(spark, sf001), path, mode="overwrite")
    chosen = first_non_empty(empty, read_jsonl(spark, path))
    assert chosen is not None and chosen.count() == 1000
    assert first_non_empty(empty, None) is None


def test_progress_key_invariants(spark, sf001):
    from civicflow.queries import ingest_progress, ingest_resumable

    progress = ingest_progress(spark, sf001).collect()
    assert len(progress) == 4
    assert all(p.valid == p.written + p.duplicates and p.duplicates >= 0 for p in progress)
    assert sum(p.written for p in progress) == ingest_resumable(spark, sf001).count()


def test_whole_batch_flow_can_be_run_again(spark, sf001):
    out = scratch_path(spark, "t-batch")
    raw = raw_requests(spark, sf001)
    expected = clean_rows(parse_requests(raw)).count()
    for _ in range(2):
        reports = run_batch(spark, raw, out)
        assert read_clean(spark, f"{out}/clean").count() == expected
        assert spark.read.parquet(f"{out}/raw").count() == raw.count()
        assert reports.raw_shape.first().rows == raw.count()
        assert reports.summary.count() == 4
        report = reports.scan_report.collect()
        assert {r.layout for r in report} == {"flat", "hive", "clustered"} and all(r.rows_returned > 0 for r in report)
        quarantined = read_quarantine(spark, f"{out}/quarantine").count()
        assert sum(r["count"] for r in reports.quarantine_by_type.collect()) == quarantined
        assert spark.read.csv(f"{out}/csv", header=True).count() == expected
    assert quarantined == quarantine_rows(parse_requests(raw)).count()


def test_an_arrival_is_landed_by_all_cores(spark, monkeypatch):
    """An arrival stands in a quarter of the input: its part of the input is split as finely as the whole was."""
    from civicflow.plans import tables
    from civicflow.session import SPLITS_CONF

    folder = scratch_path(spark, "t-arrivals")
    events = spark.range(40_000).selectExpr(
        "id as event_id", "timestamp'2026-05-01 10:00:00' as ts", "id % 50 as user_id", "'view' as event_type",
        "1.0D as value", "uuid() as props",
    )
    small_groups = {"parquet.block.size": 4096, "parquet.page.size.row.check.max": 100, "compression": "none"}
    events.coalesce(1).write.options(**small_groups).parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(tables, "run_ingest", lambda *args: None)
    before = spark.conf.get(SPLITS_CONF, None)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        landing = tables.ingest_store(spark, folder).landing
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert spark.conf.get(SPLITS_CONF, None) == before
    files = [p for p in Path(landing.removeprefix("file:")).glob("*.json") if p.stat().st_size]
    assert len(files) >= (tables.ARRIVALS - 1) * spark.sparkContext.defaultParallelism
    assert read_jsonl(spark, landing).agg(F.count_distinct("seq"), F.count("seq")).first()[:] == (40_000, 40_000)


def test_kept_rows_have_their_original_only_if_rejected(spark, sf001):
    parsed = parse_requests(raw_requests(spark, sf001))
    slim = slim_requests(parsed)
    kept = slim.where(F.col("_original").isNotNull() | F.col("_record_id").isNotNull())
    assert kept.count() == quarantine_rows(parsed).count() == kept.where(~is_valid()).count()
    columns = ("record_id", "error_fields", "original_record")
    assert quarantine_rows(slim).select(*columns).exceptAll(quarantine_rows(parsed).select(*columns)).isEmpty()
    assert clean_rows(slim).exceptAll(clean_rows(parsed)).isEmpty()


def test_first_batch_is_not_kept(spark, sf001, monkeypatch):
    """Only rows that are compared with a store are read twice."""
    from civicflow.plans.store import CleanStore

    kept = []
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.persist", lambda df, *a: kept.append(1) or df)
    raw, store = raw_requests(spark, sf001), CleanStore(scratch_path(spark, "t-first"))
    store.add(clean_rows(parse_requests(raw.where("seq < 600"))), 0)
    assert not kept
    store.add(clean_rows(parse_requests(raw.where("seq >= 600"))), 1)
    assert kept and store.read_clean(spark).exceptAll(clean_rows(parse_requests(raw))).isEmpty()
