"""Volume, top-k, hour-of-day, channel and slice answers over the clean table.

Every count is a ``HashAggregate(partial) -> Exchange -> HashAggregate(final)``: map-side
combine first, so a hot group (a borough with a third of all rows) costs one partial
row per map task, never a skewed reduce task.  Sorts carry a tie-break on the group key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COUNT = "count"


def count_rows() -> Column:
    return F.count(F.lit(1)).alias(COUNT)


def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(count_rows())


def ranked_desc(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(F.col(COUNT).desc(), F.col(key).asc())


def region_volume(clean: DataFrame) -> DataFrame:
    """Q1: requests per borough, most first."""
    return ranked_desc(count_by(clean, "borough"), "borough")


def top_types(clean: DataFrame, k: int = 5) -> DataFrame:
    """Q2: the k most frequent complaint types (TakeOrderedAndProject, no global sort)."""
    return ranked_desc(count_by(clean, "complaint_type"), "complaint_type").limit(k)


def hourly(clean: DataFrame) -> DataFrame:
    """Q3: requests per hour of day; hours without requests stay absent."""
    return count_by(clean, F.hour("created_date").alias("hour")).orderBy("hour")


def channels(clean: DataFrame) -> DataFrame:
    """Q4: requests per reporting channel, most first."""
    return ranked_desc(count_by(clean, "channel_type"), "channel_type")


def channel_share(clean: DataFrame, digits: int = 1) -> DataFrame:
    """Q4 share: percent of all requests per channel, rounded like the pie labels.

    The total is a window over the already-aggregated rows (one per channel), so
    only that handful of rows meets in one task.
    """
    total = F.sum(COUNT).over(Window.partitionBy())
    shares = count_by(clean, "channel_type").withColumn(
        "pct", F.round(F.lit(100) * F.col(COUNT).cast("double") / total, digits)
    )
    return ranked_desc(shares, "channel_type")  # sorts inside the window's single partition


def table_count(df: DataFrame) -> DataFrame:
    return df.agg(count_rows())


def slice_filter(borough: str, complaint_type: str) -> Column:
    return (F.col("borough") == F.lit(borough)) & (F.col("complaint_type") == F.lit(complaint_type))


def slice_count(clean: DataFrame, borough: str, complaint_type: str) -> DataFrame:
    """Rows of one (borough, complaint type) slice; both predicates reach the scan."""
    return clean.where(slice_filter(borough, complaint_type)).agg(
        F.lit(borough).alias("borough"), F.lit(complaint_type).alias("complaint_type"), count_rows()
    )


def slice_rollup(clean: DataFrame) -> DataFrame:
    """Per-(borough, complaint type) counts: any slice becomes a lookup, not a scan."""
    return count_by(clean, "borough", "complaint_type")


def slice_from_rollup(rollup: DataFrame, borough: str, complaint_type: str) -> DataFrame:
    return rollup.where(slice_filter(borough, complaint_type)).agg(
        F.lit(borough).alias("borough"),
        F.lit(complaint_type).alias("complaint_type"),
        F.coalesce(F.sum(COUNT), F.lit(0)).cast("long").alias(COUNT),
    )


def pick_slice(clean: DataFrame) -> DataFrame:
    """A real (borough, complaint type) pair: the smallest one having both fields."""
    return (
        clean.where(F.col("borough").isNotNull() & F.col("complaint_type").isNotNull())
        .select("borough", "complaint_type")
        .orderBy("borough", "complaint_type")
        .limit(1)
    )


def distinct_regions(clean: DataFrame) -> DataFrame:
    """Distinct non-null boroughs (partial distinct before the shuffle)."""
    return clean.select("borough").na.drop(subset=["borough"]).distinct()


def union_frames(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union with a strict schema: every part must have the same columns."""
    return reduce(lambda a, b: a.unionByName(b), parts)
