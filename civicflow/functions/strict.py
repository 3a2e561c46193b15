"""Type-aware field rules for JSON read with its value types (``read_jsonl_strict``).

The lenient path reads every field as text, so a JSON number in a string field is
accepted and a missing key looks like an explicit null.  The strict path knows each
field's JSON type and applies the record model's rules:

* string fields accept JSON strings only (a number is a type error); an optional string
  field also accepts null or absence;
* an alias wins whenever it is *present*, even as null; otherwise the field's own name;
* coordinates accept numbers, booleans (1.0 / 0.0) and numeric text; anything else,
  null or absence is 0.0;
* ``created_date`` accepts text (ISO, then US form) or a number of Unix seconds
  (milliseconds beyond +-2e10); anything else is a type error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.functions.parse import parse_coordinate, parse_created_date
from civicflow.schema import JSON_TYPES

# JSON type labels.
MISSING, NULL, STRING, NUMBER, BOOLEAN = "missing", "null", "string", "number", "boolean"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def is_strict(df: DataFrame) -> bool:
    return JSON_TYPES in df.columns


def json_type(df: DataFrame, name: str) -> Column:
    if name in df.schema[JSON_TYPES].dataType.fieldNames():
        return F.col(f"{JSON_TYPES}.{name}")
    return F.lit(MISSING)


def value(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def resolve_alias(df: DataFrame, alias: str, name: str) -> tuple[Column, Column]:
    """(text, type) of the alias when present (even as null), else of the own name."""
    use_alias = json_type(df, alias) != MISSING
    return (
        F.when(use_alias, value(df, alias)).otherwise(value(df, name)),
        F.when(use_alias, json_type(df, alias)).otherwise(json_type(df, name)),
    )


def string_field(text: Column, kind: Column) -> Column:
    """The value if it is a JSON string, else null."""
    return F.when(kind == STRING, text)


def string_type_error(kind: Column) -> Column:
    """A present, non-null value that is not a string."""
    return ~kind.isin(STRING, NULL, MISSING)


def coordinate(text: Column, kind: Column) -> Column:
    return (
        F.when(kind == NUMBER, F.coalesce(text.try_cast("double"), F.lit(0.0)))
        .when(kind == BOOLEAN, F.when(text == "true", F.lit(1.0)).otherwise(F.lit(0.0)))
        .when(kind == STRING, parse_coordinate(text))
        .otherwise(F.lit(0.0))
    )


def created_date(text: Column, kind: Column) -> Column:
    x = text.try_cast("double")
    micros = F.round(F.when(F.abs(x) <= F.lit(2e10), x * F.lit(1e6)).otherwise(x * F.lit(1e3))).cast("long")
    return F.when(kind == STRING, parse_created_date(text)).when(
        kind == NUMBER, F.timestamp_add("MICROSECOND", micros, _epoch())
    )


def date_type_error(kind: Column) -> Column:
    return ~kind.isin(STRING, NUMBER, NULL, MISSING)


def record_id(df: DataFrame) -> Column:
    """The key as given: 'unknown' only when absent (an explicit null stays null)."""
    kind = json_type(df, "unique_key")
    return F.when(kind == MISSING, F.lit("unknown")).when(kind != NULL, value(df, "unique_key"))
