"""The stored layers, each built once per session and input folder.

raw feed -> raw store (landing) ; raw feed -> clean store + quarantine ; clean store ->
layouts (flat, hive, clustered, hash-spread).  Queries read these *tables* (Parquet,
column-pruned, partition-pruned) instead of re-running the plans that produced them --
the raw / clean / summary layering of the pipeline.  Everything is written under the
session's shared checkpoint folder.
"""

from __future__ import annotations

import threading
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.fixtures import raw_requests, write_public_feed
from civicflow.plans import layout
from civicflow.plans.clean import clean_rows, quarantine_rows, stage_requests
from civicflow.session import checkpoint_root, finer_splits, scratch_path
from civicflow.sources.jsonl import arrival_bounds, land_arrival
from civicflow.sources.sinks import land_raw, read_clean, read_quarantine, write_clean, write_quarantine
from civicflow.streaming.ingest import IngestPaths, run_ingest

_BUILT: dict[tuple[str, str, str], str] = {}
_DERIVED: dict[tuple[str, str, str, str], str] = {}
_LOCK = threading.RLock()  # layouts are built from the clean store under the same lock


def run_clean_job(raw: DataFrame, root: str, batch_id: int = 0) -> tuple[str, str]:
    """Fresh clean run: parse once into a stage, overwrite the clean store, write the batch's quarantine."""
    parsed = stage_requests(raw, f"{root}/stage")
    clean_path, quarantine_path = f"{root}/clean", f"{root}/quarantine"
    write_clean(clean_rows(parsed), clean_path, fresh=True)
    write_quarantine(quarantine_rows(parsed, batch_id), quarantine_path)
    return clean_path, quarantine_path


def _state(spark: SparkSession, sf_dir: str) -> str:
    """What the input files are now: changed files give new stores.

    One row per file, from the listing; contents are not read.  Paths differ, so the hashes of two files
    cannot cancel out in the sum.
    """
    files = spark.read.format("binaryFile").load(f"{sf_dir.rstrip('/')}/events.parquet").select("path", "length", "modificationTime")
    hashes = F.xxhash64(*files.columns).cast("decimal(38,0)")
    return str(files.agg(F.count(F.lit(1)), F.sum("length"), F.sum(hashes)).first())


def _root_for(spark: SparkSession, sf_dir: str) -> str:
    key = (checkpoint_root(spark), sf_dir, _state(spark, sf_dir))
    with _LOCK:
        if key not in _BUILT:
            root = scratch_path(spark, "store")
            run_clean_job(raw_requests(spark, sf_dir), root)
            _BUILT[key] = root
        return _BUILT[key]


def clean_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_clean(spark, f"{_root_for(spark, sf_dir)}/clean")


def quarantine_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_quarantine(spark, f"{_root_for(spark, sf_dir)}/quarantine")


def _derived(spark: SparkSession, sf_dir: str, kind: str, build) -> str:
    key = (checkpoint_root(spark), sf_dir, _state(spark, sf_dir), kind)
    with _LOCK:
        if key not in _DERIVED:
            path = scratch_path(spark, kind)
            build(path)
            _DERIVED[key] = path
        return _DERIVED[key]


def raw_store(spark: SparkSession, sf_dir: str) -> str:
    """Path of the landed raw store (Parquet)."""
    return _derived(spark, sf_dir, "raw", lambda p: land_raw(raw_requests(spark, sf_dir), p))


def public_feed_store(spark: SparkSession, sf_dir: str) -> str:
    """Path of the feed as published: JSON lines without record numbers, with undeclared fields."""
    return _derived(spark, sf_dir, "public-feed", lambda p: write_public_feed(spark, sf_dir, p))


# Rows of a file in the layouts that are compared file by file.
FILE_ROWS = 1000
_LAYOUT_WRITERS = {
    "flat": layout.write_flat,
    "hive": layout.write_partitioned,
    "clustered": layout.write_clustered,
    "arrival": lambda df, path: layout.write_ranked(df, path, ("seq",), FILE_ROWS),
    "ranked": lambda df, path: layout.write_ranked(df, path, ("borough", "complaint_type", "unique_key"), FILE_ROWS),
    "curve": partial(layout.write_curve, file_rows=FILE_ROWS),
    # A bucket that the check's SQL can compute as well.
    "spread": partial(layout.write_hash_spread, bucket_of=layout.md5_bucket),
}


def layout_store(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Path of one storage layout of the clean store (written on first use)."""
    write = _LAYOUT_WRITERS[kind]
    return _derived(spark, sf_dir, f"layout-{kind}", lambda p: write(clean_store(spark, sf_dir), p))


# Arrivals of the resumable ingest.
ARRIVALS = 4


def ingest_store(spark: SparkSession, sf_dir: str) -> IngestPaths:
    """Tables of an ingest that was stopped and resumed after each of ``ARRIVALS`` arrivals."""

    def build(root: str) -> None:
        raw = raw_requests(spark, sf_dir)
        for lo, hi in arrival_bounds(raw, ARRIVALS):
            with finer_splits(spark, ARRIVALS):  # one arrival is one part of the input
                land_arrival(raw, ingest_paths(root).landing, lo, hi)
            run_ingest(spark, ingest_paths(root))

    return ingest_paths(_derived(spark, sf_dir, "ingest", build))


def ingest_paths(root: str) -> IngestPaths:
    return IngestPaths(f"{root}/landing", f"{root}/clean", f"{root}/quarantine", f"{root}/_checkpoint")
