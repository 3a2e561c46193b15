"""Storage layouts for slice queries, and what each one saves.

* flat: one table, filters pushed into the Parquet scan (row-group min/max).
* hive: ``partitionBy("borough")``: a borough filter becomes a ``PartitionFilter`` and
  whole directories are skipped.  Written through a REBALANCE hint, so AQE splits a
  hot borough over several tasks/files instead of one huge task.
* clustered: range-partitioned on (borough, complaint_type, unique_key) and sorted, so
  each file covers a narrow key range and min/max statistics skip the rest; a Parquet
  bloom filter on complaint_type helps equality probes.  The unique_key tie-break in
  the range key lets a hot (borough, type) pair span several files.
* ranked: files of a fixed number of rows in a global order, each row's file known beforehand.
* curve: (borough, complaint type, date) interleaved bit by bit on a Morton curve of quantile
  ranks, so that a filter on any one of them skips files, not only one on the borough.
* hash spread: (borough, bucket) with bucket = xxhash64(unique_key) mod n spreads a
  borough's rows evenly -- the shard key {borough, hashed unique_key}.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators.aggregate import count_rows, slice_filter
from civicflow.operators.sample import global_rank
from civicflow.plans.scanstats import Within, examined, matches, row_groups
from civicflow.schema import CLEAN_SCHEMA

FILE = "file"


def write_flat(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str = "borough") -> None:
    _replace(df.hint("rebalance", by), by).parquet(path)


def _replace(df: DataFrame, *by: str) -> DataFrameWriter:
    """A whole new layout: partitions of the old one that have no rows any more go too."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by)


def write_clustered(
    df: DataFrame,
    path: str,
    keys: tuple[str, ...] = ("borough", "complaint_type"),
    tiebreak: str = "unique_key",
    bloom_column: str = "complaint_type",
) -> None:
    (
        df.repartitionByRange(*keys, tiebreak)
        .sortWithinPartitions(*keys, tiebreak)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{bloom_column}", "true")
        .parquet(path)
    )


def write_ranked(df: DataFrame, path: str, order: tuple[str, ...], file_rows: int) -> None:
    """Files of ``file_rows`` consecutive rows in ``order`` (a total order), whatever the partitioning was."""
    placed = global_rank(df, [F.col(c).asc() for c in order], "_rank")
    placed = placed.withColumn(FILE, F.floor(F.col("_rank") / file_rows)).drop("_rank")
    _replace(placed.repartition(FILE).sortWithinPartitions(FILE, *order), FILE).parquet(path)


def quantile_ranks(df: DataFrame, columns: tuple[str, ...], bits: int, sample: int = 10_000) -> dict[str, Column]:
    """Rank 0 .. 2^bits - 1 of each column's value among its quantiles, those of about ``sample`` rows.

    The sampled values reach the driver; they decide where rows are put, and never which.  Null has rank 0.
    """
    fraction = min(1.0, sample / max(1, df.count()))
    rows = df.select(*columns).sample(fraction, seed=1).collect()
    ranks = {}
    for c in columns:
        values = sorted(r[c] for r in rows if r[c] is not None)
        ends = [values[len(values) * k // 2**bits] for k in range(1, 2**bits)] if values else []
        ranks[c] = _rank(F.col(c), F.array(*[F.lit(x) for x in ends]).cast(T.ArrayType(df.schema[c].dataType)))
    return ranks


def _rank(value: Column, ends: Column) -> Column:
    return F.when(value.isNull(), F.lit(0)).otherwise(F.size(F.filter(ends, lambda end: end < value)))


def morton_code(ranks: list[Column], bits: int) -> Column:
    """The ranks' bits interleaved, highest first."""
    n = len(ranks)
    parts = [
        F.shiftleft(F.shiftright(rank, i).bitwiseAND(F.lit(1)).cast("long"), i * n + n - 1 - d)
        for i in range(bits)
        for d, rank in enumerate(ranks)
    ]
    return reduce(lambda a, b: a + b, parts)


def write_curve(
    df: DataFrame,
    path: str,
    keys: tuple[str, ...] = ("borough", "complaint_type", "created_date"),
    tiebreak: str = "unique_key",
    bits: int = 6,
    file_rows: int = 1_000_000,
) -> None:
    """Range-partitioned and sorted along the curve, in files of at most ``file_rows`` rows."""
    ranks = quantile_ranks(df, keys, bits)
    coded = df.withColumn("_code", morton_code([ranks[c] for c in keys], bits))
    along = coded.repartitionByRange("_code", tiebreak).sortWithinPartitions("_code", tiebreak).drop("_code")
    along.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)


def hash_bucket(key: str | Column, buckets: int) -> Column:
    """Stable bucket of a key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def md5_bucket(key: str | Column, buckets: int) -> Column:
    """A bucket that other engines can compute too: first 32 bits of the MD5, mod ``buckets``."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def write_hash_spread(
    df: DataFrame, path: str, buckets: int = 4, by: str = "borough", key: str = "unique_key", bucket_of=hash_bucket
) -> None:
    spread = df.withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", by, "bucket")
    _replace(spread, by, "bucket").parquet(path)


def read_layout(spark: SparkSession, path: str, extra: T.StructType | None = None) -> DataFrame:
    """Read back with the clean schema, so partition values keep their types (zip, borough)."""
    schema = CLEAN_SCHEMA if extra is None else T.StructType(CLEAN_SCHEMA.fields + extra.fields)
    return spark.read.schema(schema).parquet(path)


def borough_count(spark: SparkSession, path: str, borough: str) -> DataFrame:
    return read_layout(spark, path).where(F.col("borough") == borough).agg(count_rows())


def slice_count(spark: SparkSession, path: str, borough: str, complaint_type: str) -> DataFrame:
    return read_layout(spark, path).where(slice_filter(borough, complaint_type)).agg(
        F.lit(borough).alias("borough"), F.lit(complaint_type).alias("complaint_type"), count_rows()
    )


def equivalence(spark: SparkSession, flat_path: str, hive_path: str, borough: str) -> DataFrame:
    """Both layouts' counts for one borough in one job (union, no join), and whether they agree."""
    tag = lambda p, name: read_layout(spark, p).where(F.col("borough") == borough).select(
        F.lit(name).alias("layout")
    )
    both = tag(flat_path, "flat").unionByName(tag(hive_path, "hive"))
    counts = both.agg(
        F.count_if(F.col("layout") == "flat").alias("flat_n"),
        F.count_if(F.col("layout") == "hive").alias("hive_n"),
    )
    return counts.withColumn("same", F.col("flat_n") == F.col("hive_n"))


def spread_counts(spark: SparkSession, path: str) -> DataFrame:
    bucket = T.StructType([T.StructField("bucket", T.IntegerType())])
    return read_layout(spark, path, bucket).groupBy("borough", "bucket").agg(count_rows())


# ---- scan report -------------------------------------------------------------------


def scan_probe(spark: SparkSession, layout: str, path: str, filters: list[Within]) -> DataFrame:
    """Rows a filter returns from one layout, in how many files they stand, and what must be examined for them.

    ``ratio`` is rows examined for a row returned; null if none is.
    """
    table = read_layout(spark, path)
    rows = table.select("*", F.col("_metadata.file_path").alias("_file")).where(matches(filters))
    returned = rows.agg(F.count(F.lit(1)).alias("rows_returned"), F.count_distinct("_file").alias("files_with_rows"))
    groups = row_groups(spark, path, [f.column for f in filters])
    read = examined(groups, filters, table.schema)
    both = returned.withColumn("_one", F.lit(1)).join(read.withColumn("_one", F.lit(1)), "_one")  # a row each
    return both.select(
        F.lit(layout).alias("layout"),
        F.lit(" AND ".join(f.text() for f in filters)).alias("filter"),
        "rows_returned",
        "files_with_rows",
        "rows_examined",
        "bytes_examined",
        F.expr("try_divide(rows_examined, rows_returned)").alias("ratio"),
    )


def scan_report(spark: SparkSession, probes: list[tuple[str, str, list[Within]]]) -> DataFrame:
    """One row per probe (layout, path, filters): the same filter over different layouts."""
    return reduce(DataFrame.unionByName, [scan_probe(spark, *p) for p in probes])
