"""One callable per operator key: ``f(spark, sf_dir) -> DataFrame``.

Inputs are the driver's tables (``events`` -> raw feed) or tables Spark derives from
them (the clean store).  Keys that exercise a sink or a layout write under the
session's shared checkpoint folder and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.fixtures import RAW_FIXTURE_COLUMNS, raw_requests, read_table, typed_lines, write_public_feed
from civicflow.operators import aggregate as agg
from civicflow.operators.pages import page_sample
from civicflow.operators.profile import feed_schema, health_check, null_ranking
from civicflow.operators.sample import head_sample
from civicflow.operators.summary import explode_records, summary_answers, summary_records
from civicflow.operators.validate import validity_flag
from civicflow.plans import layout
from civicflow.plans.batch import Outputs, clean_batch
from civicflow.plans.clean import clean_rows, parse_requests, project_requests, quarantine_rows
from civicflow.plans.rollup import Rollup, rollup_answers
from civicflow.plans.scanstats import Within, equals, matches
from civicflow.plans.store import CleanStore
from civicflow.plans.tables import (
    clean_store,
    ingest_store,
    layout_store,
    public_feed_store,
    quarantine_store,
    raw_store,
    run_clean_job,
)
from civicflow.schema import CLEAN_SCHEMA, CORRUPT_RECORD, RAW_LINE, RAW_SCHEMA, SEQ
from civicflow.session import scratch_path
from civicflow.sources.jsonl import arrival_bounds, first_non_empty, in_arrival, read_jsonl, read_lines, strict_fields, write_jsonl
from civicflow.sources.sinks import (
    export_csv,
    land_raw,
    read_clean,
    read_csv,
    read_parquet,
    read_quarantine,
    read_raw,
    write_summary,
)
from civicflow.streaming.ingest import read_progress

# The demo slice and borough of the layout comparison.
SLICE_BOROUGH = "BROOKLYN"
SLICE_TYPE = "click-1"
# A range of dates that the feed has at every size.
SLICE_DATES = (datetime(2024, 1, 3), datetime(2024, 1, 4))
# Head sample size; systematic sample: page, stride (no cap: the whole table).
HEAD_N = 1000
PAGE, STRIDE = 100, 1000
Query = Callable[[SparkSession, str], DataFrame]


# ---- sources, samples, sinks --------------------------------------------------------

def src_jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    write_jsonl(raw_requests(spark, sf_dir), path, mode="overwrite")
    return read_jsonl(spark, path).select(*RAW_SCHEMA.fieldNames(), CORRUPT_RECORD)


def land_raw_q(spark, sf_dir):
    return read_parquet(spark, raw_store(spark, sf_dir)).select(*RAW_FIXTURE_COLUMNS)


def scan_drop(spark, sf_dir):
    return read_parquet(spark, raw_store(spark, sf_dir)).drop(SEQ, "batch_id")


def sample_head(spark, sf_dir):
    return head_sample(raw_requests(spark, sf_dir).select("unique_key", SEQ), HEAD_N)


def sample_systematic(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id", "ts")
    return page_sample(events, [("ts", "desc"), ("event_id", "asc")], PAGE, STRIDE).select("event_id", "rank")


def pick_slice(spark, sf_dir):
    return agg.pick_slice(clean_store(spark, sf_dir))


def clean_requests(spark, sf_dir):
    root = scratch_path(spark, "clean-run")
    clean_path, _ = run_clean_job(raw_requests(spark, sf_dir), root)
    return read_clean(spark, clean_path)


def quarantine(spark, sf_dir):
    q = quarantine_store(spark, sf_dir)
    return q.withColumn("error_fields", F.array_join("error_fields", ",")).drop("quarantined_at")


def quarantine_by_type(spark, sf_dir):
    q = quarantine_store(spark, sf_dir)
    return q.groupBy("error_type", F.array_join("error_fields", ",").alias("error_fields")).agg(agg.count_rows())


def summary_publish(spark, sf_dir):
    path = scratch_path(spark, "summary")
    write_summary(summary_records(summary_answers(clean_store(spark, sf_dir))), path)
    return explode_records(spark.read.parquet(path))


def export_csv_q(spark, sf_dir):
    path = scratch_path(spark, "csv")
    export_csv(clean_store(spark, sf_dir), path)
    return read_csv(spark, path, CLEAN_SCHEMA)


# ---- validation and projection ------------------------------------------------------

def _parsed(spark, sf_dir):
    """The bare projection: each key below reads and parses its own columns only."""
    return project_requests(raw_requests(spark, sf_dir))


def clean_alias(spark, sf_dir):
    return _parsed(spark, sf_dir).select(SEQ, "channel_type", "zip_code")


def clean_timestamp(spark, sf_dir):
    return _parsed(spark, sf_dir).select(SEQ, "created_date")


def clean_coords(spark, sf_dir):
    return _parsed(spark, sf_dir).select(SEQ, "latitude", "longitude")


def clean_defaults(spark, sf_dir):
    return _parsed(spark, sf_dir).select(SEQ, "zip_code", "latitude", "longitude")


def clean_case(spark, sf_dir):
    return _parsed(spark, sf_dir).select(SEQ, "borough", "status")


def validate_split(spark, sf_dir):
    return validity_flag(_parsed(spark, sf_dir))


def dedup_keep_first(spark, sf_dir):
    return clean_rows(parse_requests(raw_requests(spark, sf_dir)))


def dedup_cross_batch(spark, sf_dir):
    """Two arrivals split on seq: the second only adds keys the store does not hold yet."""
    return _cross_batch(spark, raw_requests(spark, sf_dir))


def _cross_batch(spark, raw):
    store = CleanStore(scratch_path(spark, "cross-batch"))
    for batch_id, (lo, hi) in enumerate(arrival_bounds(raw, 2)):
        store.add(clean_rows(parse_requests(raw.where(in_arrival(lo, hi)))), batch_id)
    return store.read_clean(spark)


# ---- the feed as published: whole lines, undeclared fields, no record numbers --------

def feed_landing(spark, sf_dir):
    raw = read_jsonl(spark, public_feed_store(spark, sf_dir))
    path = scratch_path(spark, "feed-raw")
    land_raw(raw, path)
    land_raw(raw, path)  # landing a batch again changes nothing
    landed = read_raw(spark, path, raw.schema)
    return landed.select("unique_key", *[F.get_json_object(RAW_LINE, f"$.{f}").alias(f) for f in ("request_ref", "agency_name")])


def feed_profile(spark, sf_dir):
    return null_ranking(read_jsonl(spark, public_feed_store(spark, sf_dir)), top=15)


def feed_schema_q(spark, sf_dir):
    """Keys that are numbers in some lines and texts in others, and explicit nulls."""
    return feed_schema(_typed_lines(spark, sf_dir))


def raw_fallback(spark, sf_dir):
    """The raw source: the store if it has rows, else the file, else nothing."""
    feed = read_jsonl(spark, public_feed_store(spark, sf_dir))
    path, empty = scratch_path(spark, "fallback"), scratch_path(spark, "fallback-empty")
    land_raw(feed.where(F.get_json_object(RAW_LINE, "$.request_ref").endswith("7")), path)
    land_raw(feed.limit(0), empty)
    store, nothing = read_raw(spark, path, feed.schema), read_raw(spark, empty, feed.schema)
    chosen = {"store": (store, feed), "file": (nothing, feed), "nothing": (nothing, None)}
    parts = []
    for name, candidates in chosen.items():
        found = first_non_empty(*candidates)
        rows = (nothing if found is None else found).agg(agg.count_rows(), F.count_distinct("unique_key").alias("keys"))
        parts.append(rows.withColumn("source", F.lit(name)))
    return agg.union_frames(parts)


def feed_quarantine(spark, sf_dir):
    bad = quarantine_rows(parse_requests(read_jsonl(spark, public_feed_store(spark, sf_dir))))
    return bad.select(
        "record_id",
        F.array_join("error_fields", ",").alias("error_fields"),
        *[F.get_json_object("original_record", f"$.{f}").alias(f) for f in ("request_ref", "agency_name", "created_date")],
    )


def feed_dedup(spark, sf_dir):
    """First in the order of the file: nothing numbers these records."""
    return clean_rows(parse_requests(read_jsonl(spark, public_feed_store(spark, sf_dir)))).drop(SEQ)


def batch_two_runs(spark, sf_dir):
    """Two landed batches; of a key the first batch's row stays, whatever its file is called."""
    root = scratch_path(spark, "two-runs")
    out = Outputs(f"{root}/out")
    for batch_id, (folder, part) in enumerate((("z", "event_id % 2 = 1"), ("a", "event_id % 2 = 0"))):
        write_public_feed(spark, sf_dir, f"{root}/{folder}", part)
        clean_batch(spark, read_jsonl(spark, f"{root}/{folder}"), out, batch_id)
    details = ["status", "borough", "zip_code", "created_date"]
    kept = read_clean(spark, out.clean).select(
        F.lit("clean").alias("table_name"), F.lit(-1).cast("long").alias("batch_id"), F.col("unique_key").alias("record_id"),
        F.lit("").alias("error_fields"), *details,
    )
    bad = read_quarantine(spark, out.quarantine).select(
        F.lit("quarantine").alias("table_name"), "batch_id", "record_id", F.array_join("error_fields", ",").alias("error_fields"),
        *[F.lit(None).cast(kept.schema[c].dataType).alias(c) for c in details],
    )
    return kept.unionByName(bad)


# ---- strict reading: JSON types, absent against null ---------------------------------

def _typed_lines(spark, sf_dir):
    path = scratch_path(spark, "typed-lines")
    typed_lines(read_table(spark, sf_dir, "events")).write.text(path)
    return read_lines(spark, path)


def _typed(spark, sf_dir):
    return strict_fields(_typed_lines(spark, sf_dir))


def clean_strict(spark, sf_dir):
    return clean_rows(parse_requests(_typed(spark, sf_dir)))


def validate_strict(spark, sf_dir):
    return validity_flag(project_requests(_typed(spark, sf_dir)))


# ---- aggregations -------------------------------------------------------------------

def q1_region_volume(spark, sf_dir):
    return agg.region_volume(clean_store(spark, sf_dir))


def q2_top_types(spark, sf_dir):
    return agg.top_types(clean_store(spark, sf_dir), 5)


def q3_hourly(spark, sf_dir):
    return agg.hourly(clean_store(spark, sf_dir))


def q4_channels(spark, sf_dir):
    return agg.channels(clean_store(spark, sf_dir))


def q4_channel_share(spark, sf_dir):
    return agg.channel_share(clean_store(spark, sf_dir))


def table_count(spark, sf_dir):
    return agg.table_count(clean_store(spark, sf_dir))


def slice_count(spark, sf_dir):
    return agg.slice_count(clean_store(spark, sf_dir), SLICE_BOROUGH, SLICE_TYPE)


def slice_rollup(spark, sf_dir):
    path = scratch_path(spark, "rollup")
    agg.slice_rollup(clean_store(spark, sf_dir)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def region_distinct(spark, sf_dir):
    return agg.distinct_regions(clean_store(spark, sf_dir))


def union_frames(spark, sf_dir):
    return _halves_united(clean_store(spark, sf_dir))


def _halves_united(clean):
    half = F.pmod(F.xxhash64("unique_key"), F.lit(2))
    return agg.union_frames([clean.where(half == 0), clean.where(half == 1)])


# ---- profiles -----------------------------------------------------------------------

def profile_raw_nulls(spark, sf_dir):
    return null_ranking(raw_requests(spark, sf_dir), top=15)


def profile_clean(spark, sf_dir):
    return health_check(clean_store(spark, sf_dir)).drop("data_type")


# ---- layouts ------------------------------------------------------------------------

def layout_flat_count(spark, sf_dir):
    return layout.borough_count(spark, layout_store(spark, sf_dir, "flat"), SLICE_BOROUGH)


def layout_hive_count(spark, sf_dir):
    return layout.borough_count(spark, layout_store(spark, sf_dir, "hive"), SLICE_BOROUGH)


def layout_equivalence(spark, sf_dir):
    flat, hive = layout_store(spark, sf_dir, "flat"), layout_store(spark, sf_dir, "hive")
    return layout.equivalence(spark, flat, hive, SLICE_BOROUGH)


def layout_clustered_slice(spark, sf_dir):
    return layout.slice_count(spark, layout_store(spark, sf_dir, "clustered"), SLICE_BOROUGH, SLICE_TYPE)


def layout_hash_spread(spark, sf_dir):
    return layout.spread_counts(spark, layout_store(spark, sf_dir, "spread"))


def layout_scan_report(spark, sf_dir):
    """Rows returned and rows that must be examined, of layouts whose files are fixed."""
    flat, hive, clustered = (layout_store(spark, sf_dir, k) for k in ("arrival", "hive", "ranked"))
    b, s = [equals("borough", SLICE_BOROUGH)], [equals("borough", SLICE_BOROUGH), equals("complaint_type", SLICE_TYPE)]
    probes = [("flat", flat, b), ("hive", hive, b), ("flat", flat, s), ("clustered", clustered, s)]
    return layout.scan_report(spark, probes).drop("files_with_rows", "bytes_examined")


def layout_curve_slices(spark, sf_dir):
    """Slices by type alone and by date alone, from the layout along the curve."""
    table = layout.read_layout(spark, layout_store(spark, sf_dir, "curve"))
    probes = [equals("complaint_type", SLICE_TYPE)], [Within("created_date", *SLICE_DATES)]
    return agg.union_frames(
        [table.where(matches(p)).groupBy("borough").agg(agg.count_rows()).withColumn("filter", F.lit(p[0].column)) for p in probes]
    )


# ---- incremental ingest -------------------------------------------------------------

def ingest_resumable(spark, sf_dir):
    return CleanStore(ingest_store(spark, sf_dir).clean).read_clean(spark)


def ingest_progress(spark, sf_dir):
    return read_progress(spark, ingest_store(spark, sf_dir))


def ingest_compacted(spark, sf_dir):
    """The clean store after arrivals with compactions between them; the newest and a merged batch come again."""
    raw = raw_requests(spark, sf_dir)
    store = CleanStore(scratch_path(spark, "compacted"))
    arrivals = list(enumerate(arrival_bounds(raw, 5)))
    for batch_id, (lo, hi) in [*arrivals, arrivals[-1], arrivals[1]]:
        store.add(clean_rows(parse_requests(raw.where(in_arrival(lo, hi)))), batch_id)
        if batch_id in (2, 4):
            store.compact(spark)
    return store.read_clean(spark)


def rollup_maintained(spark, sf_dir):
    """The published answers and all slices from the counts that the ingest kept, one batch replayed, then compacted."""
    paths = ingest_store(spark, sf_dir)
    store, kept, rollup = CleanStore(paths.clean).read(spark), Rollup(paths.rollup), Rollup(scratch_path(spark, "rollup-replayed"))
    newest = store.agg(F.max("batch_id")).first()[0]
    rollup.add(store.where(F.col("batch_id") < newest), newest - 1)
    for _ in range(2):
        rollup.add(store.where(F.col("batch_id") == newest), newest)
    rollup.compact(spark)
    return rollup_answers(kept.read(spark)).withColumn("replayed", F.lit(False)).unionByName(
        rollup_answers(rollup.read(spark)).withColumn("replayed", F.lit(True))
    )


QUERIES: dict[str, Query] = {
    "src_jsonl": src_jsonl,
    "land_raw": land_raw_q,
    "scan_drop": scan_drop,
    "sample_head": sample_head,
    "sample_systematic": sample_systematic,
    "pick_slice": pick_slice,
    "clean_requests": clean_requests,
    "quarantine": quarantine,
    "summary_publish": summary_publish,
    "export_csv": export_csv_q,
    "clean_alias": clean_alias,
    "clean_timestamp": clean_timestamp,
    "clean_coords": clean_coords,
    "clean_defaults": clean_defaults,
    "clean_case": clean_case,
    "validate_split": validate_split,
    "dedup_keep_first": dedup_keep_first,
    "dedup_cross_batch": dedup_cross_batch,
    "feed_landing": feed_landing,
    "feed_profile": feed_profile,
    "feed_schema": feed_schema_q,
    "raw_fallback": raw_fallback,
    "feed_quarantine": feed_quarantine,
    "feed_dedup": feed_dedup,
    "batch_two_runs": batch_two_runs,
    "clean_strict": clean_strict,
    "validate_strict": validate_strict,
    "q1_region_volume": q1_region_volume,
    "q2_top_types": q2_top_types,
    "q3_hourly": q3_hourly,
    "q4_channels": q4_channels,
    "q4_channel_share": q4_channel_share,
    "table_count": table_count,
    "slice_count": slice_count,
    "slice_rollup": slice_rollup,
    "region_distinct": region_distinct,
    "quarantine_by_type": quarantine_by_type,
    "union_frames": union_frames,
    "profile_raw_nulls": profile_raw_nulls,
    "profile_clean": profile_clean,
    "layout_flat_count": layout_flat_count,
    "layout_hive_count": layout_hive_count,
    "layout_equivalence": layout_equivalence,
    "layout_clustered_slice": layout_clustered_slice,
    "layout_hash_spread": layout_hash_spread,
    "layout_scan_report": layout_scan_report,
    "layout_curve_slices": layout_curve_slices,
    "ingest_resumable": ingest_resumable,
    "ingest_progress": ingest_progress,
    "ingest_compacted": ingest_compacted,
    "rollup_maintained": rollup_maintained,
}
