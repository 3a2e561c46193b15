"""The four published answers, and their nested summary records.

The three answers over bounded lists (boroughs, hours, channels) come from one scan with GROUPING
SETS.  Complaint types are counted by themselves and cut to the top k by an ordered limit, so the
list of all types is never ranked in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicflow.operators.aggregate import COUNT, count_rows, top_types

# --- fixed values: aggregation names and descriptions of the summary records ---
BOROUGH_VOLUME = "borough_volume"
TOP_COMPLAINT_TYPES = "top_complaint_types"
COMPLAINTS_BY_HOUR = "complaints_by_hour"
REPORTING_CHANNELS = "reporting_channels"
DESCRIPTIONS = {
    BOROUGH_VOLUME: "Total complaints by borough - shows which areas have highest service request volume",
    TOP_COMPLAINT_TYPES: "Top 5 most frequent complaint types - identifies priority service areas",
    COMPLAINTS_BY_HOUR: "Complaint volume by hour of day - shows peak reporting times for resource planning",
    REPORTING_CHANNELS: "Distribution of reporting methods - shows preferred channels for citizen engagement",
}
# --- end of fixed values ---

_DIMS = ("borough", "hour", "channel_type")
# grouping_id() of a set holding only dimension i (first column = highest bit).
_GID = {d: (1 << len(_DIMS)) - 1 - (1 << (len(_DIMS) - 1 - i)) for i, d in enumerate(_DIMS)}
_NAME = {
    "borough": BOROUGH_VOLUME,
    "hour": COMPLAINTS_BY_HOUR,
    "channel_type": REPORTING_CHANNELS,
}


def summary_answers(clean: DataFrame, top_k: int = 5) -> DataFrame:
    """Long form: aggregation_name, position (1-based, the answer's order), key, count, record_count."""
    dims = clean.select("borough", F.hour("created_date").alias("hour"), "channel_type")
    agg = dims.groupingSets([[d] for d in _DIMS], *_DIMS).agg(count_rows(), F.grouping_id().alias("_gid"))
    name = F.lit(None).cast("string")
    key = F.lit(None).cast("string")
    for d in reversed(_DIMS):
        name = F.when(F.col("_gid") == _GID[d], F.lit(_NAME[d])).otherwise(name)
        key = F.when(F.col("_gid") == _GID[d], F.col(d).cast("string")).otherwise(key)
    listed = agg.select(name.alias("aggregation_name"), key.alias("key"), F.col(COUNT), F.col("hour"))
    top = top_types(clean, top_k).select(
        F.lit(TOP_COMPLAINT_TYPES).alias("aggregation_name"),
        F.col("complaint_type").alias("key"),
        COUNT,
        F.lit(None).cast("int").alias("hour"),
    )
    is_hour = F.col("aggregation_name") == COMPLAINTS_BY_HOUR
    by_name = Window.partitionBy("aggregation_name")
    order = by_name.orderBy(
        F.when(is_hour, F.col("hour")).asc_nulls_last(),
        F.when(~is_hour, F.col(COUNT)).desc_nulls_last(),
        F.col("key").asc(),
    )
    return listed.unionByName(top).select(
        "aggregation_name",
        F.row_number().over(order).alias("position"),
        "key",
        COUNT,
        F.count(F.lit(1)).over(by_name).cast("int").alias("record_count"),
    )


def summary_records(answers: DataFrame) -> DataFrame:
    """One nested record per answer: data = [{key, count}] in answer order."""
    descriptions = F.create_map(*[x for kv in DESCRIPTIONS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    nested = answers.groupBy("aggregation_name").agg(
        F.sort_array(F.collect_list(F.struct("position", "key", COUNT))).alias("_entries")
    )
    data = F.transform("_entries", lambda e: F.struct(e["key"].alias("key"), e[COUNT].alias(COUNT)))
    return nested.select(
        "aggregation_name",
        descriptions[F.col("aggregation_name")].alias("description"),
        data.alias("data"),
        F.size("_entries").alias("record_count"),
        F.current_timestamp().alias("computed_at"),
    )


def explode_records(records: DataFrame) -> DataFrame:
    """Nested summary records back to the long form (for checks and BI)."""
    return records.select(
        "aggregation_name",
        "record_count",
        F.posexplode("data").alias("_pos", "_entry"),
    ).select(
        "aggregation_name",
        (F.col("_pos") + 1).cast("int").alias("position"),
        F.col("_entry.key").alias("key"),
        F.col(f"_entry.{COUNT}").alias(COUNT),
        "record_count",
    )
