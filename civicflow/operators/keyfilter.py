"""Which keys a store may hold, so that a batch need not be compared with all of them.

A store is bucketed by the hash of its key.  Beside it stand bitmaps: every key sets one bit, at a place that a
second hash gives, in the bitmaps (``slots`` of ``WORD`` bits) of its bucket.  Each batch adds its own bitmaps,
and or-ing them gives those of the whole store, so a replayed batch replaces what it added.

A key of a new batch whose bit is not set is certainly new.  Only the buckets of the other keys are read, by a
partition filter, and compared exactly; for a batch of new keys that is nothing but the few buckets that share a
bit by chance.  The bitmaps of a batch's slots are what grows with the store: at ``slots * WORD`` = 16 bits a key
two bytes for every key, and 1 key in 16 looked up in vain.  All of it is built-in expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.operators.dedup import drop_existing
from civicflow.schema import BATCH

BUCKET = "bucket"
#: Bits of a bitmap, as Spark's bitmap aggregates have them.
WORD = 32768
FILTER_SCHEMA = T.StructType(
    [
        T.StructField(BUCKET, T.IntegerType()),
        T.StructField("slot", T.IntegerType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField(BATCH, T.LongType()),
    ]
)


@dataclass(frozen=True)
class KeySpace:
    """How many buckets a store has, and how many bitmaps a bucket; fixed for the life of a store.

    For n keys about n / 10^6 buckets, of 512 slots for 16 bits a key.
    """

    buckets: int = 8
    slots: int = 16

    def bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def place(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(1), F.col(key)), F.lit(self.slots * WORD)).cast("int")

    def places(self, keys: DataFrame, key: str) -> DataFrame:
        """key, bucket, slot, bit."""
        place = self.place(key)
        return keys.select(
            key, self.bucket(key).alias(BUCKET), (place / WORD).cast("int").alias("slot"), (place % WORD).alias("bit")
        )


def key_bitmaps(keys: DataFrame, key: str, space: KeySpace) -> DataFrame:
    """bucket, slot, bits of a set of keys."""
    return space.places(keys, key).groupBy(BUCKET, "slot").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged_bitmaps(filters: DataFrame) -> DataFrame:
    """One bitmap per bucket and slot, of all batches."""
    return filters.groupBy(BUCKET, "slot").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_known(keys: DataFrame, filters: DataFrame, key: str, space: KeySpace) -> DataFrame:
    """key, bucket of the keys whose bit is set; all others are new."""
    octet = F.conv(F.hex(F.substring(F.col("bits"), (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(octet / F.pow(F.lit(2), F.col("bit") % 8)).cast("int") % 2 == 1
    return space.places(keys, key).join(merged_bitmaps(filters), [BUCKET, "slot"]).where(is_set).select(key, BUCKET)


def drop_known(batch: DataFrame, store: DataFrame, filters: DataFrame, key: str, space: KeySpace) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``store``, of which only the buckets in question are read.

    What reaches the driver are numbers of buckets.  ``batch`` is read twice and should be stored or cached.
    """
    if filters.isEmpty():
        return batch
    touched = [r[0] for r in maybe_known(batch, filters, key, space).select(BUCKET).distinct().collect()]
    if not touched:
        return batch
    return drop_existing(batch, store.where(F.col(BUCKET).isin(sorted(touched))), key)
