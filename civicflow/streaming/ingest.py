"""Resumable ingest with Structured Streaming.

    readStream(landing lines) - foreachBatch: parse
        valid - keep_first(unique_key, ingest order) - not in other batches - clean partition, key bitmaps
            what was written - counts of the batch in the maintained rollup
        invalid - quarantine partition
        counts - progress partition

The checkpoint location records which files were consumed, so a restarted query skips done work
and a second run over the same files writes nothing.  All three tables are partitioned by
``batch_id`` and a batch replaces its own partition; uniqueness is checked against the other
batches only, by the store's key bitmaps (``plans/store.py``).  So a replayed micro-batch writes the same rows and the same counts again, and the
progress table holds one row for every batch that ever ran, whatever became of the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators.validate import is_valid
from civicflow.plans.clean import clean_rows, parse_requests, quarantine_rows, slim_requests
from civicflow.plans.rollup import Rollup
from civicflow.plans.store import STORE_SCHEMA, CleanStore
from civicflow.schema import QUARANTINE_SCHEMA
from civicflow.sources.batches import BatchTable
from civicflow.sources.jsonl import lenient_fields, placed, stream_lines, strict_fields
from civicflow.sources.sinks import BATCH

PROGRESS_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("rows", "bad", "valid", "written", "duplicates", BATCH)]
)


@dataclass(frozen=True)
class IngestPaths:
    landing: str
    clean: str
    quarantine: str
    checkpoint: str

    @property
    def progress(self) -> str:
        return f"{self.clean}-progress"

    @property
    def progress_table(self) -> BatchTable:
        return BatchTable(self.progress, PROGRESS_SCHEMA)

    @property
    def quarantine_table(self) -> BatchTable:
        return BatchTable(self.quarantine, QUARANTINE_SCHEMA)

    @property
    def rollup(self) -> str:
        return f"{self.clean}-rollup"


def _write_batch(paths: IngestPaths, compact_every: int | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        number = F.lit(batch_id).cast("long").alias(BATCH)
        spark = batch.sparkSession
        if compact_every and batch_id and batch_id % compact_every == 0:
            compact_ingest(spark, paths)
        batch = slim_requests(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            written = CleanStore(paths.clean).add(clean_rows(batch), batch_id)
            rollup = Rollup(paths.rollup)
            if not rollup.has_merged(spark, batch_id) and not written.isEmpty():
                rollup.add(written, batch_id)
            if not paths.quarantine_table.has_merged(spark, batch_id):
                paths.quarantine_table.write(quarantine_rows(batch, batch_id))
            counts = batch.agg(
                F.count(F.lit(1)).alias("rows"), F.count_if(~is_valid()).alias("bad"), F.lit(0).alias("written")
            ).unionByName(
                written.agg(F.lit(0).alias("rows"), F.lit(0).alias("bad"), F.count(F.lit(1)).alias("written"))
            )
            one = counts.agg(*[F.sum(c).alias(c) for c in ("rows", "bad", "written")])
            valid = F.col("rows") - F.col("bad")
            one = one.select("rows", "bad", valid.alias("valid"), "written", (valid - F.col("written")).alias("duplicates"), number)
            if not paths.progress_table.has_merged(spark, batch_id):
                paths.progress_table.write(one.where("rows > 0"))
        finally:
            batch.unpersist()

    return write


def start_ingest(
    spark: SparkSession,
    paths: IngestPaths,
    max_files_per_trigger: int | None = None,
    strict: bool = False,
    compact_every: int | None = None,
):
    """Process every file not yet consumed, in micro-batches, then stop (availableNow).

    ``strict`` reads JSON types and absent-vs-null (see ``read_jsonl_strict``).  ``compact_every`` merges the
    folders of older batches after so many batches; all batches before the running one are committed then.
    """
    CleanStore(paths.clean).ensure(spark)
    paths.quarantine_table.ensure(spark)
    paths.progress_table.ensure(spark)
    write = _write_batch(paths, compact_every)
    fields = strict_fields if strict else lenient_fields
    return (
        stream_lines(spark, paths.landing, max_files_per_trigger)
        .writeStream.foreachBatch(lambda lines, batch_id: write(parse_requests(fields(placed(lines))), batch_id))
        .option("checkpointLocation", paths.checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_ingest(spark: SparkSession, paths: IngestPaths, **kwargs) -> None:
    """Run until the landing folder is drained."""
    start_ingest(spark, paths, **kwargs).awaitTermination()


def compact_ingest(spark: SparkSession, paths: IngestPaths) -> None:
    """Merges the folders of all batches but the newest, table by table; rows, counts and progress stay the same."""
    CleanStore(paths.clean).compact(spark)
    Rollup(paths.rollup).compact(spark)
    paths.quarantine_table.compact(spark)
    paths.progress_table.compact(spark)


def release_ingest(spark: SparkSession, paths: IngestPaths) -> None:
    """Empties what was merged, once nobody reads it."""
    CleanStore(paths.clean).release_old(spark)
    Rollup(paths.rollup).release_old(spark)
    paths.quarantine_table.release_old(spark)
    paths.progress_table.release_old(spark)


def read_rejects(spark: SparkSession, paths: IngestPaths) -> DataFrame:
    return paths.quarantine_table.read(spark).select(*QUARANTINE_SCHEMA.fieldNames())


def read_progress(spark: SparkSession, paths: IngestPaths) -> DataFrame:
    """batch_id, rows, bad, valid, written, duplicates of every micro-batch that read something."""
    names = [BATCH, *PROGRESS_SCHEMA.fieldNames()[:-1]]
    return paths.progress_table.read(spark).select(*names)
