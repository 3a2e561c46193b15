"""Newline-delimited JSON source and landing.

Lines are read whole.  ``_line`` keeps the untouched text with every field it had, the declared
fields are columns beside it (explicit schema, no inference pass), and ``_place`` says where the
line stood: file, block of the file, line in the block.  That place is the ingest order of a feed
that does not number its records.  A malformed line has null fields and its text in
``_corrupt_record``; it fails validation and lands in the quarantine.

``read_jsonl`` is lenient: a JSON number in a string field is read as its text, and an absent key
looks like an explicit null.  ``read_jsonl_strict`` keeps both apart (VARIANT per line), and
``parse_requests`` then applies the type rules of ``functions/strict.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.schema import (
    CORRUPT_RECORD,
    JSON_TYPES,
    PLACE,
    RAW_FIELDS,
    RAW_LINE,
    RAW_SCHEMA,
    RAW_SCHEMA_WITH_CORRUPT,
    SEQ,
)

# What is read of a line: its text, and where it stands.
LINE_COLUMNS = (f"value AS {RAW_LINE}", "_metadata.file_path AS _file", "_metadata.file_block_start AS _block")

_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD}


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``_line`` and ``_place`` of every line that is not blank."""
    return placed(spark.read.text(path).selectExpr(*LINE_COLUMNS))


def placed(lines: DataFrame) -> DataFrame:
    """``LINE_COLUMNS`` -> line and place.  A task reads a block from front to back, so the id grows."""
    place = F.struct(
        F.col("_file").alias("file"), F.col("_block").alias("block"), F.monotonically_increasing_id().alias("line")
    )
    return lines.select(RAW_LINE, place.alias(PLACE)).where(F.trim(RAW_LINE) != "")


def lenient_fields(lines: DataFrame) -> DataFrame:
    """Lines -> the declared fields as text beside the line; other columns stay."""
    others = [c for c in lines.columns if c != RAW_LINE]
    record = F.from_json(RAW_LINE, RAW_SCHEMA_WITH_CORRUPT, _JSON_OPTIONS)
    return lines.select(RAW_LINE, *others, record.alias("_record")).select("_record.*", RAW_LINE, *others)


def read_jsonl(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return lenient_fields(read_lines(spark, path))


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of a folder that files keep arriving in; ``placed`` takes them batch by batch."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).selectExpr(*LINE_COLUMNS)


def write_jsonl(df: DataFrame, path: str, mode: str = "append", compression: str | None = None) -> None:
    writer = df.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def arrival_bounds(raw: DataFrame, arrivals: int) -> list[tuple[int | None, int]]:
    """Split the ``seq`` range into ``arrivals`` consecutive ranges (two numbers reach the driver).

    The first range has no lower end: it also takes the rows without a ``seq``.
    """
    lo, hi = raw.agg(F.min(SEQ), F.max(SEQ)).first()
    if lo is None:
        return [(None, 0)]
    width = (hi - lo) // arrivals + 1
    return [(None if a == lo else a, min(hi, a + width - 1)) for a in range(lo, hi + 1, width)]


def in_arrival(lo: int | None, hi: int) -> Column:
    if lo is None:
        return F.col(SEQ).isNull() | (F.col(SEQ) <= hi)
    return F.col(SEQ).between(lo, hi)


def land_arrival(raw: DataFrame, path: str, lo: int | None, hi: int) -> None:
    """Append the raw rows of one arrival to the landing folder as JSON lines.

    Written by the input's own partitions (no funnel into one task); arrivals are
    appended one after another, which is the order a file stream picks them up in.
    """
    write_jsonl(raw.where(in_arrival(lo, hi)), path, mode="append")


def first_non_empty(*candidates: DataFrame | None) -> DataFrame | None:
    """The first candidate that has a row (one ``limit(1)`` probe each), else None.

    The raw profile prefers the raw store and falls back to the landing file.
    """
    for df in candidates:
        if df is not None and not df.isEmpty():
            return df
    return None


def json_kind(v: Column) -> Column:
    """JSON type label of a variant value (SQL NULL = key absent)."""
    t = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit("missing"))
        .when(F.is_variant_null(v), F.lit("null"))
        .when(t == "STRING", F.lit("string"))
        .when(t == "BOOLEAN", F.lit("boolean"))
        .when(t.startswith("OBJECT"), F.lit("object"))
        .when(t.startswith("ARRAY"), F.lit("array"))
        .otherwise(F.lit("number"))
    )


def strict_fields(lines: DataFrame) -> DataFrame:
    """Lines -> declared fields as text plus each field's JSON type (``_json_types``).

    Each line is parsed once into a VARIANT (its own projection); every field is
    read from it.  An unparseable line keeps its text in ``_corrupt_record``.
    """
    others = [c for c in lines.columns if c != RAW_LINE]
    v = F.col("_v")
    parsed = lines.select(RAW_LINE, *others, F.try_parse_json(RAW_LINE).alias("_v"))
    return parsed.select(
        F.try_variant_get(v, f"$.{SEQ}", "bigint").alias(SEQ),
        *[F.try_variant_get(v, f"$.{f}", "string").alias(f) for f in RAW_FIELDS],
        F.when(v.isNull(), F.col(RAW_LINE)).alias(CORRUPT_RECORD),
        RAW_LINE,
        *others,
        F.struct(*[json_kind(F.variant_get(v, f"$.{f}", "variant")).alias(f) for f in RAW_FIELDS]).alias(JSON_TYPES),
    )


def read_jsonl_strict(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Strict source: missing vs null and JSON types are kept (see functions/strict.py)."""
    return strict_fields(read_lines(spark, path))


def undeclared_keys(raw: DataFrame) -> DataFrame:
    """column_name, filled: rows with a value that is not null, of every key beyond the declared ones.

    The row without a name counts all rows of ``raw``.
    """
    entries = F.map_entries(F.from_json(RAW_LINE, "map<string,string>"))
    every = F.struct(F.lit(None).cast("string").alias("key"), F.lit("").alias("value"))
    keys = raw.select(F.explode(F.array_append(F.coalesce(entries, F.array()), every)).alias("_e")).select("_e.*")
    declared = F.coalesce(F.col("key").isin(*RAW_SCHEMA.fieldNames()), F.lit(False))
    return keys.where(~declared).groupBy(F.col("key").alias("column_name")).agg(F.count("value").alias("filled"))
