"""One row per key.

``keep_first``: smallest ``order`` wins inside a batch.  Planned as
``row_number() = 1`` over ``partitionBy(key)``; Catalyst inserts a partial
``WindowGroupLimit`` *before* the shuffle, so a key holding a third of all rows still
ships at most one row per map partition.

``drop_existing``: cross-batch uniqueness (first written wins).  The store is reduced to the keys
that the batch has, then the batch is anti-joined with those.  No hint and no row limit: Spark
sees the size of the batch's keys at run time and broadcasts them if they are small enough, so
a small batch never shuffles the store, and a large one is joined by an exchange on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def drop_existing(batch: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key is not yet in ``existing``."""
    already = existing.select(key).join(batch.select(key), key, "left_semi")
    return batch.join(already, key, "left_anti")
