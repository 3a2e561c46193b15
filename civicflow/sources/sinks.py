"""Table sinks: raw landing, clean store, quarantine, summary, CSV export.

All are plain DataFrame writes, so Spark's commit protocol makes each one atomic per
job and a retried task or a lost executor never leaves half a table behind.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.schema import BATCH, CLEAN_SCHEMA, QUARANTINE_SCHEMA


def write_batch(df: DataFrame, path: str, *within: str, whole: bool = False) -> None:
    """Partitioned by ``batch_id`` (and ``within`` it); a repeated batch replaces its own partitions and no other.

    With ``whole`` the rows replace the table, also batches that an earlier writer left there.
    """
    mode = "static" if whole else "dynamic"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BATCH, *within).parquet(path)


def land_raw(raw: DataFrame, path: str, batch_id: int = 0) -> None:
    """Land a raw batch, whole lines included; landing the same batch again changes nothing."""
    write_batch(raw.withColumn(BATCH, F.lit(batch_id).cast("long")), path)


def read_raw(spark: SparkSession, path: str, raw: T.StructType) -> DataFrame:
    """The landed batches: the columns of the raw frame, and the batch of each row."""
    return spark.read.schema(T.StructType([*raw.fields, T.StructField(BATCH, T.LongType())])).parquet(path)


def write_clean(clean: DataFrame, path: str, fresh: bool = True) -> None:
    """Fresh run replaces the clean store; a resumed run appends (after ``drop_existing``)."""
    clean.write.mode("overwrite" if fresh else "append").parquet(path)


def write_quarantine(quarantine: DataFrame, path: str, whole: bool = False) -> None:
    """The batches that ``quarantine`` has are replaced; with ``whole`` it replaces all batches."""
    if whole:
        quarantine.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BATCH).parquet(path)
    else:
        write_batch(quarantine, path)


def write_summary(records: DataFrame, path: str) -> None:
    """A fresh summary replaces the previous one (the answers are recomputed whole)."""
    records.write.mode("overwrite").parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, *partition: str) -> None:
    """Create an empty Parquet table if none exists, so readers never see a missing path."""
    try:
        spark.read.schema(schema).parquet(path)  # resolves the path only; runs no job
    except AnalysisException:
        empty = spark.createDataFrame([], schema).write.mode("append")
        (empty.partitionBy(*partition) if partition else empty).parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, CLEAN_SCHEMA).select(*CLEAN_SCHEMA.fieldNames())


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(path).select(*QUARANTINE_SCHEMA.fieldNames())


def export_csv(df: DataFrame, path: str, file_rows: int = 1_000_000) -> None:
    """BI export: header row, quotes escaped by doubling, nulls as empty fields.

    Files hold at most ``file_rows`` rows: text may span lines, so a reader takes a file whole.
    """
    (
        df.write.mode("overwrite")
        .option("maxRecordsPerFile", file_rows)
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an export back with its schema (a zip like 00000 must stay text).

    Free text may hold line breaks inside quotes, so records may span lines
    (``multiLine``): each file is then read by one task, and the export writes one file
    per task, so reads stay parallel across files.  The export writes null as an empty
    field and the empty string as ``""``; reading with a null marker that never occurs
    keeps the two apart (the default marker '' would turn both into null).
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("nullValue", "\u0000")
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .option("mode", "FAILFAST")
        .csv(path)
    )
