"""Data profiles computed in one aggregate pass.

Each profile is a single global ``agg`` with one ``count_if`` per column: every task
emits one partial row, one tiny exchange merges them, and the one-row result is turned
into one row per column with ``explode``.  No sampling is needed at any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.schema import INTERNAL_COLUMNS, RAW_LINE, SEQ
from civicflow.sources.jsonl import json_kind, undeclared_keys

# Types whose zeros are counted ("unknown" coordinates are stored as 0.0).
ZERO_COUNTED_TYPES = (T.DoubleType, T.LongType)


def _percent(n, total, digits: int = 2):
    """round(100 * n / total, digits); null on an empty input."""
    return F.when(total > 0, F.round((F.lit(100) * n).cast("double") / total, digits))


def _long_form(one_row: DataFrame, entries: Sequence[F.Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def bounded(df: DataFrame, sample_size: int | None, order: Sequence[str] = (SEQ,)) -> DataFrame:
    """The first ``sample_size`` rows in ingest order (``None`` = the whole table)."""
    if sample_size is None:
        return df
    keys = [c for c in order if c in df.columns]
    return (df.orderBy(*keys) if keys else df).limit(sample_size)


def null_ranking(
    df: DataFrame, top: int = 15, exclude: Sequence[str] = INTERNAL_COLUMNS, sample_size: int | None = None
) -> DataFrame:
    """Columns ranked by null count (ties keep column order), first ``top``; with row total.

    A frame with whole lines also ranks the keys that no schema declares, in alphabetical order
    after the declared ones; a row without the key counts as null.  ``sample_size`` profiles a
    bounded head instead of the whole table.
    """
    df = bounded(df, sample_size)
    cols = [c for c in df.columns if c not in exclude]
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(i).alias("ordinal"),
            F.col(f"_n{i}").alias("nulls"),
            F.col("_rows").alias("rows"),
        )
        for i, c in enumerate(cols)
    ]
    ranked = _long_form(one, entries)
    if RAW_LINE in df.columns:
        ranked = ranked.unionByName(_undeclared_ranking(df, top, len(cols)))
    return ranked.orderBy(F.col("nulls").desc(), F.col("ordinal")).limit(top)


def _undeclared_ranking(df: DataFrame, top: int, first: int) -> DataFrame:
    """The ``top`` undeclared keys with most nulls; ``ordinal`` is their place in the alphabet, from ``first``.

    However many keys there are: an ordered limit picks them, and only their places are counted.
    """
    counted = undeclared_keys(df).withColumn("_one", F.lit(1))
    total = counted.where("column_name is null").select("_one", F.col("filled").alias("rows"))  # one row
    named = counted.where("column_name is not null")
    picked = (
        named.join(F.broadcast(total), "_one")
        .select("column_name", (F.col("rows") - F.col("filled")).alias("nulls"), "rows")
        .orderBy(F.col("nulls").desc(), "column_name")
        .limit(top)
    )
    later = picked.select(F.col("column_name").alias("_later"))  # ``top`` rows
    before = named.select(F.col("column_name").alias("_other")).join(F.broadcast(later), F.col("_other") < F.col("_later"))
    place = before.groupBy(F.col("_later").alias("column_name")).agg(F.count(F.lit(1)).alias("_before"))
    ordinal = (F.coalesce("_before", F.lit(0)) + first).cast("int")
    return picked.join(place, "column_name", "left").select("column_name", ordinal.alias("ordinal"), "nulls", "rows")


def feed_schema(lines: DataFrame) -> DataFrame:
    """Every key of the records, declared or not: JSON types seen, merged type, rows with a value, null and absent.

    Types merge as they are aggregated (numbers widen, others that disagree become VARIANT, nested objects field by
    field), so each task sends one row per key.  Lines that are no JSON object have no keys and count as absent.
    """
    values = lines.select(F.try_parse_json(RAW_LINE).alias("_record"))
    fields = values.lateralJoin(values.sparkSession.tvf.variant_explode(F.col("_record").outer()))
    seen = fields.where(F.col("key").isNotNull()).select("key", "value", json_kind(F.col("value")).alias("kind"))
    keys = seen.groupBy(F.col("key").alias("column_name")).agg(
        F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("types"),
        F.schema_of_variant_agg("value").alias("merged_type"),
        F.count_if(F.col("kind") != "null").alias("filled"),
        F.count_if(F.col("kind") == "null").alias("nulls"),
        F.lit(1).alias("_one"),
    )
    total = lines.agg(F.count(F.lit(1)).alias("rows"), F.lit(1).alias("_one"))  # one row
    return keys.join(F.broadcast(total), "_one").select(
        "column_name", "types", "merged_type", "filled", "nulls", (F.col("rows") - F.col("filled") - F.col("nulls")).alias("absent")
    )


def frame_shape(df: DataFrame) -> DataFrame:
    """rows x columns and the schema as text (the raw profile's header line)."""
    fields = [f for f in df.schema.fields if f.name not in INTERNAL_COLUMNS]
    schema = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in fields)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(fields)).alias("columns"),
        F.lit(schema).alias("schema"),
    )


def health_check(df: DataFrame, sample_size: int | None = None) -> DataFrame:
    """Per column: nulls, null %, zeros (double/long columns only), zero %."""
    df = bounded(df, sample_size)
    fields = df.schema.fields
    total = F.col("_rows")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"_n{i}"))
        if isinstance(f.dataType, ZERO_COUNTED_TYPES):
            aggs.append(F.count_if(F.col(f.name) == 0).alias(f"_z{i}"))
    one = df.agg(*aggs)
    zeros = lambda i: F.col(f"_z{i}") if f"_z{i}" in one.columns else F.lit(0).cast("long")
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i).alias("ordinal"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_n{i}").alias("nulls"),
            _percent(F.col(f"_n{i}"), total).alias("null_pct"),
            zeros(i).alias("zeros"),
            _percent(zeros(i), total).alias("zero_pct"),
            total.alias("rows"),
        )
        for i, f in enumerate(fields)
    ]
    return _long_form(one, entries)
