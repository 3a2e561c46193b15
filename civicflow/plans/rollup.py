"""Summaries that are maintained: counts kept batch by batch, merged when they are read.

    v<n> / base      counts of all batches up to ``through``, merged
    v<n> / batches   batch_id / counts of one batch

Counts are kept by (borough, complaint type, channel, hour); every published answer and every slice is a sum over
them, so answers read the rollup and never the clean store.  A replayed batch replaces its own counts.  ``compact``
merges all batches but the newest, which may still be replayed, into a new version (``sources/versions.py``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators.aggregate import COUNT, count_by, ranked_desc
from civicflow.operators.summary import BOROUGH_VOLUME, COMPLAINTS_BY_HOUR, REPORTING_CHANNELS, TOP_COMPLAINT_TYPES
from civicflow.schema import BATCH
from civicflow.sources.sinks import ensure_table, write_batch
from civicflow.sources.versions import Versions

DIMENSIONS = ("borough", "complaint_type", "channel_type", "hour")
COUNTS = T.StructType(
    [T.StructField(d, T.IntegerType() if d == "hour" else T.StringType()) for d in DIMENSIONS] + [T.StructField(COUNT, T.LongType())]
)
BATCH_COUNTS = T.StructType([*COUNTS.fields, T.StructField(BATCH, T.LongType())])
SLICES = "slices"


def counts_of(clean: DataFrame) -> DataFrame:
    """The counts that a set of clean rows adds."""
    return count_by(clean.withColumn("hour", F.hour("created_date")), *DIMENSIONS)


def merged(counts: DataFrame, *dimensions: str) -> DataFrame:
    return counts.groupBy(*(dimensions or DIMENSIONS)).agg(F.sum(COUNT).alias(COUNT))


@dataclass(frozen=True)
class Rollup:
    path: str

    @property
    def versions(self) -> Versions:
        return Versions(self.path)

    def _tables(self, spark: SparkSession, version: int) -> tuple[DataFrame, DataFrame]:
        folder = self.versions.folder(version)
        ensure_table(spark, f"{folder}/base", COUNTS)
        ensure_table(spark, f"{folder}/batches", BATCH_COUNTS, BATCH)
        return spark.read.schema(COUNTS).parquet(f"{folder}/base"), spark.read.schema(BATCH_COUNTS).parquet(f"{folder}/batches")

    def has_merged(self, spark: SparkSession, batch_id: int) -> bool:
        return batch_id <= self.versions.current(spark)[1]

    def add(self, clean: DataFrame, batch_id: int) -> None:
        """Counts of the rows that a batch wrote; the same batch again replaces them."""
        spark = clean.sparkSession
        version, through = self.versions.current(spark)
        if batch_id <= through:
            raise ValueError(f"batch {batch_id} has been merged (all up to {through}); only a newer one can be replayed")
        self._tables(spark, version)
        counts = counts_of(clean).withColumn(BATCH, F.lit(batch_id).cast("long"))
        write_batch(counts.coalesce(1), f"{self.versions.folder(version)}/batches")

    def read(self, spark: SparkSession) -> DataFrame:
        base, batches = self._tables(spark, self.versions.current(spark)[0])
        return merged(base.unionByName(batches.drop(BATCH)))

    def compact(self, spark: SparkSession) -> None:
        """Merges all batches but the newest.  Readers see the old version until the pointer names the new one."""
        version, _ = self.versions.current(spark)
        base, batches = self._tables(spark, version)
        newest = batches.agg(F.max(BATCH)).first()[0]
        if newest is None:
            return
        folder = self.versions.folder(version + 1)
        older = batches.where(F.col(BATCH) < newest).drop(BATCH)
        merged(base.unionByName(older)).write.mode("overwrite").parquet(f"{folder}/base")
        write_batch(batches.where(F.col(BATCH) == newest), f"{folder}/batches", whole=True)
        self.versions.publish(spark, version + 1, newest - 1)

    def release_old(self, spark: SparkSession) -> None:
        """Empties the version before the current one, once its readers are done."""
        version, _ = self.versions.current(spark)
        if version:
            self.versions.release(spark, version - 1, "base", "batches")


def rollup_answers(counts: DataFrame, top_k: int = 5) -> DataFrame:
    """aggregation_name, key, other_key, count: the four published answers, and every slice."""
    one = lambda name, rows, key: rows.select(
        F.lit(name).alias("aggregation_name"), F.col(key).cast("string").alias("key"), F.lit(None).cast("string").alias("other_key"), COUNT
    )
    types = ranked_desc(merged(counts, "complaint_type"), "complaint_type").limit(top_k)
    parts = [one(TOP_COMPLAINT_TYPES, types, "complaint_type")]
    for name, key in ((BOROUGH_VOLUME, "borough"), (COMPLAINTS_BY_HOUR, "hour"), (REPORTING_CHANNELS, "channel_type")):
        parts.append(one(name, merged(counts, key), key))
    slices = merged(counts, "borough", "complaint_type")
    parts.append(slices.select(F.lit(SLICES).alias("aggregation_name"), F.col("borough").alias("key"), F.col("complaint_type").alias("other_key"), COUNT))
    return reduce(DataFrame.unionByName, parts)
