"""The whole batch flow, end to end: what the source system's entry point runs.

    raw feed ─ land raw store ─ raw profile
             └ clean + quarantine ─ health check ─ summary (Q1–Q4) ─ layouts + scan report ─ CSV export

Every step is a Spark job over tables; only small reports (one row per column, per
answer, per layout probe) are returned to the caller.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.operators.aggregate import distinct_regions, pick_slice
from civicflow.operators.profile import frame_shape, health_check, null_ranking
from civicflow.operators.summary import summary_answers, summary_records
from civicflow.plans import layout
from civicflow.plans.clean import clean_rows, quarantine_rows, stage_requests
from civicflow.plans.scanstats import equals
from civicflow.schema import BATCH
from civicflow.sources.jsonl import first_non_empty
from civicflow.sources.sinks import (
    export_csv,
    land_raw,
    read_clean,
    read_quarantine,
    read_raw,
    write_clean,
    write_quarantine,
    write_summary,
)


@dataclass(frozen=True)
class Outputs:
    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


@dataclass
class Reports:
    raw_shape: DataFrame
    raw_profile: DataFrame
    health: DataFrame
    summary: DataFrame
    quarantine_by_type: DataFrame
    scan_report: DataFrame


def clean_batch(spark: SparkSession, raw: DataFrame, out: Outputs, batch_id: int = 0) -> DataFrame:
    """Land one batch, then clean all landed ones: of a key the row of the earliest batch stays, and every
    rejected row stands in the quarantine once, with the batch it came with.  Gives the landed rows."""
    land_raw(raw, out.raw, batch_id)
    stored_raw = first_non_empty(read_raw(spark, out.raw, raw.schema), raw)
    if stored_raw is None:
        stored_raw = raw  # an empty feed: every table comes out empty
    parsed = stage_requests(stored_raw, out.stage)
    write_clean(clean_rows(parsed), out.clean, fresh=True)
    origin = F.col(BATCH) if BATCH in parsed.columns else batch_id
    write_quarantine(quarantine_rows(parsed, origin), out.quarantine, whole=True)
    return stored_raw


def run_batch(
    spark: SparkSession,
    raw: DataFrame,
    out_root: str,
    slice_borough: str | None = None,
    slice_type: str | None = None,
    batch_id: int = 0,
) -> Reports:
    """Land, profile, clean, publish and lay out ``raw``; every table goes under ``out_root``.

    Running it again, with the same batch or another, replaces what a run replaces: the batch's
    landing, and the tables derived from all landed batches.  Without a slice the least
    (borough, complaint type) pair is taken.  The layouts need at least two boroughs to be
    compared; with fewer the scan report is empty.
    """
    out = Outputs(out_root)
    stored_raw = clean_batch(spark, raw, out, batch_id)
    clean = read_clean(spark, out.clean)

    write_summary(summary_records(summary_answers(clean)), out.summary)

    layout.write_flat(clean, out.flat)
    layout.write_partitioned(clean, out.hive)
    layout.write_clustered(clean, out.clustered)
    if slice_borough is None or slice_type is None:
        slice_borough, slice_type = pick_slice(clean).first() or ("", "")
    b, s = [equals("borough", slice_borough)], [equals("borough", slice_borough), equals("complaint_type", slice_type)]
    probes = [("flat", out.flat, b), ("hive", out.hive, b), ("flat", out.flat, s), ("clustered", out.clustered, s)]
    comparable = distinct_regions(clean).limit(2).count() == 2
    report = layout.scan_report(spark, probes)
    export_csv(clean, out.csv)

    quarantined = read_quarantine(spark, out.quarantine)
    return Reports(
        raw_shape=frame_shape(stored_raw),
        raw_profile=null_ranking(stored_raw),
        health=health_check(clean),
        summary=spark.read.parquet(out.summary),
        quarantine_by_type=quarantined.groupBy("error_type", "error_fields").count(),
        scan_report=report if comparable else report.limit(0),
    )
