"""Samples: a bounded head, and a systematic page sample over a global order.

A global ``row_number()`` without ``partitionBy`` runs in one task.  ``global_rank``
instead range-partitions on the order, sorts inside each partition, numbers rows
locally, and adds each partition's offset (a running sum over one count per
partition, broadcast back -- its size is the partition count, not the data size).
The partitioned, numbered rows are cut from their lineage with a reliable
``checkpoint()`` (in ``spark.checkpoint.dir``) so the counts and the numbering see the
same partitions even if range bounds would be re-sampled or an executor is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow.schema import SEQ
from civicflow.session import checkpoint_root

_LOCAL_BITS = 33  # monotonically_increasing_id(): partition index in the upper 31 bits


def head_sample(df: DataFrame, n: int, order: Sequence[str | Column] = (SEQ,)) -> DataFrame:
    """The first ``n`` rows in ingest order (top-n per partition, then merged)."""
    return df.orderBy(*order).limit(n)


def global_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """0-based dense position of every row in ``order`` (which must be a total order)."""
    checkpoint_root(df.sparkSession)
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn(
            "_local",
            F.monotonically_increasing_id() - F.col("_pid").cast("long") * F.lit(1 << _LOCAL_BITS),
        )
        .checkpoint(eager=True)
    )
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        numbered.join(F.broadcast(offsets), "_pid")
        .withColumn(rank_col, F.col("_offset") + F.col("_local"))
        .drop("_pid", "_local", "_offset")
    )


def systematic_sample(
    df: DataFrame,
    order: Sequence[Column],
    page: int,
    stride: int,
    cap: int | None = None,
    rank_col: str = "rank",
) -> DataFrame:
    """Pages of ``page`` rows at every ``stride``-th position, page starts below ``cap``."""
    ranked = global_rank(df, order, rank_col)
    keep = (F.col(rank_col) % stride) < page
    if cap is not None:
        keep = keep & ((F.floor(F.col(rank_col) / stride) * stride) < cap)
    return ranked.where(keep)
