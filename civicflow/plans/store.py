"""The clean store that batches are added to: first written wins, whatever is replayed.

    store     batch_id / bucket / rows        bucket = hash of unique_key
    filters   batch_id / bitmaps of the batch's keys

Both are partitioned by batch, and a repeated batch replaces what it wrote; ``compact`` merges older batches
(``sources/batches.py``).  A batch is compared with the other
batches only, and of those only with the buckets that its keys may be in (``operators/keyfilter.py``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators.keyfilter import BUCKET, FILTER_SCHEMA, KeySpace, drop_known, key_bitmaps
from civicflow.schema import BATCH, CLEAN_SCHEMA
from civicflow.sources.batches import BatchTable

KEY = "unique_key"
STORE_SCHEMA = T.StructType(
    [*CLEAN_SCHEMA.fields, T.StructField(BATCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
)


@dataclass(frozen=True)
class CleanStore:
    path: str
    space: KeySpace = KeySpace()

    @property
    def rows(self) -> BatchTable:
        return BatchTable(self.path, STORE_SCHEMA, (BUCKET,))

    @property
    def filters(self) -> BatchTable:
        return BatchTable(f"{self.path}-filters", FILTER_SCHEMA, combine=_one_bitmap)

    def ensure(self, spark: SparkSession) -> None:
        self.rows.ensure(spark)
        self.filters.ensure(spark)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.rows.read(spark)

    def read_clean(self, spark: SparkSession) -> DataFrame:
        return self.read(spark).select(*CLEAN_SCHEMA.fieldNames())

    def read_filters(self, spark: SparkSession) -> DataFrame:
        return self.filters.read(spark)

    def add(self, winners: DataFrame, batch_id: int) -> DataFrame:
        """Writes the rows of ``winners`` (one per key) whose key no other batch has; gives what the store has of the batch.

        Rows first, then their bitmaps: a run that ends in between is replayed, and both are replaced.  A batch that
        has been merged is written for good; if it comes again, nothing changes.
        """
        spark = winners.sparkSession
        self.ensure(spark)
        others = F.col(BATCH) != batch_id
        number = F.lit(batch_id).cast("long").alias(BATCH)
        if self.rows.has_merged(spark, batch_id):
            return self.read(spark).where(~others)
        filters = self.read_filters(spark).where(others)
        first = filters.isEmpty()
        if not first:  # the first batch is compared with nothing, and so read once
            winners.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            new = winners if first else drop_known(winners, self.read(spark).where(others), filters, KEY, self.space)
            bucketed = new.select(*CLEAN_SCHEMA.fieldNames(), number, self.space.bucket(KEY).alias(BUCKET))
            self.rows.write(bucketed.hint("rebalance", BUCKET))
        finally:
            if not first:
                winners.unpersist()
        written = self.rows.recent(spark).where(~others)
        if not written.isEmpty():
            self.filters.write(key_bitmaps(written, KEY, self.space).select("*", number))
        return written

    def compact(self, spark: SparkSession) -> None:
        """Merges batch folders, rows first: a batch whose rows are merged is not compared any more."""
        self.rows.compact(spark)
        self.filters.compact(spark)

    def release_old(self, spark: SparkSession) -> None:
        self.rows.release_old(spark)
        self.filters.release_old(spark)


def _one_bitmap(filters: DataFrame) -> DataFrame:
    """One bitmap per bucket and slot, as of the newest batch in it."""
    return filters.groupBy(BUCKET, "slot").agg(F.bitmap_or_agg("bits").alias("bits"), F.max(BATCH).alias(BATCH))
