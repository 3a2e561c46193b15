"""The raw service-request feed derived from the driver's ``events`` table.

Every raw row is one event, so the feed grows with ``events``.  The rules (FIXTURES.md
section 3) inject the defects the cleaner must handle: 2 % duplicate keys, missing
agencies, the channel under its alias or its own name, missing zips, unparseable
coordinates, two date formats and unparseable dates.  Pure projection: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.schema import SEQ

RAW_FIXTURE_COLUMNS = (
    SEQ,
    "unique_key",
    "agency",
    "complaint_type",
    "descriptor",
    "open_data_channel_type",
    "channel_type",
    "status",
    "borough",
    "incident_zip",
    "latitude",
    "longitude",
    "created_date",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def raw_from_events(events: DataFrame) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    channel = (
        F.when(u % 3 == 0, F.lit("PHONE")).when(u % 3 == 1, F.lit("ONLINE")).otherwise(F.lit("MOBILE"))
    )
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    us = F.date_format("ts", "MM/dd/yyyy hh:mm:ss a")
    coord = lambda prefix: F.concat(F.lit(prefix), _s(100 + e % 900))
    return events.select(
        e.alias(SEQ),
        _s(F.when(e % 50 == 49, e - 1).otherwise(e)).alias("unique_key"),
        F.when(e % 97 != 0, F.concat(F.lit("AG"), _s(u % 7))).alias("agency"),
        F.concat(F.col("event_type"), F.lit("-"), _s(u % 4)).alias("complaint_type"),
        F.when(e % 3 != 0, F.col("props")).alias("descriptor"),
        F.when(e % 17 != 0, channel).alias("open_data_channel_type"),
        F.when(e % 17 == 0, channel).alias("channel_type"),
        F.when(e % 2 == 0, F.lit("Closed")).otherwise(F.lit("OPEN")).alias("status"),
        F.element_at(
            F.array(*[F.lit(b) for b in ("Bronx", "BROOKLYN", "manhattan", "Queens", "Staten Island")]),
            (u % 5 + 1).cast("int"),
        ).alias("borough"),
        F.when(e % 11 != 0, _s(10000 + u)).alias("incident_zip"),
        F.when(e % 13 == 0, F.lit("N/A")).when(e % 13 == 1, F.lit(""))
        .when(e % 13 == 2, F.lit(None)).otherwise(coord("40.")).alias("latitude"),
        F.when(e % 13 == 3, F.lit("N/A")).when(e % 13 == 4, F.lit(""))
        .when(e % 13 == 5, F.lit(None)).otherwise(coord("-73.")).alias("longitude"),
        F.when(e % 101 == 0, F.lit("invalid-date-format")).when(e % 10 == 0, us)
        .otherwise(iso).alias("created_date"),
    )


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_events(read_table(spark, sf_dir, "events"))


def public_feed(events: DataFrame) -> DataFrame:
    """The feed as a city publishes it: no record numbers, and fields that no schema declares."""
    raw = raw_from_events(events)
    e = F.col(SEQ)
    return raw.select(
        *[c for c in raw.columns if c != SEQ],
        F.concat(F.lit("R"), e.cast("string")).alias("request_ref"),
        F.when(e % 5 != 0, F.concat(F.lit("Agency of "), F.col("borough"))).alias("agency_name"),
        e.alias("_at"),
    )


def write_public_feed(spark: SparkSession, sf_dir: str, path: str, condition: str = "true") -> None:
    """JSON lines in the order of the events: files by name, lines from front to back."""
    feed = public_feed(read_table(spark, sf_dir, "events").where(condition))
    feed.repartitionByRange("_at").sortWithinPartitions("_at").drop("_at").write.mode("overwrite").json(path)


def typed_lines(events: DataFrame) -> DataFrame:
    """JSON lines (``value``) with what only a strict reader sees: numeric keys, aliases that are null."""
    raw = raw_from_events(events)
    e = F.col(SEQ)
    numeric, null_alias = e % 19 == 0, e % 23 == 0
    shaped = raw.withColumns(
        {
            "channel_type": F.when(null_alias, F.lit("PHONE")).otherwise(F.col("channel_type")),
            "open_data_channel_type": F.when(~null_alias, F.col("open_data_channel_type")),
        }
    )
    fields = [c for c in shaped.columns if c != "unique_key"]
    rest = F.to_json(F.struct(*fields, F.when(~numeric, F.col("unique_key")).alias("unique_key")))
    head = F.concat(
        F.lit("{"),
        F.when(numeric, F.concat(F.lit('"unique_key":'), F.col("unique_key"), F.lit(","))).otherwise(F.lit("")),
        F.when(null_alias, F.lit('"open_data_channel_type":null,')).otherwise(F.lit("")),
    )
    return shaped.select(F.concat(head, F.substring(rest, 2, 1_000_000_000)).alias("value"))
