"""Alias resolution, defaults and case normalisation as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.schema import DEFAULT_ZIP


def column_or_null(df: DataFrame, name: str) -> Column:
    """The column if the input has it, else a typed null (decided at plan time)."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def resolve_alias(df: DataFrame, alias: str, name: str) -> Column:
    """A field may arrive under its alias or its own name; the alias wins when it has a value."""
    return F.coalesce(column_or_null(df, alias), column_or_null(df, name))


def zip_code(df: DataFrame) -> Column:
    """Alias ``incident_zip`` or own name ``zip_code``; missing or null -> '00000'."""
    return F.coalesce(resolve_alias(df, "incident_zip", "zip_code"), F.lit(DEFAULT_ZIP))


def upper_case(c: Column) -> Column:
    return F.upper(c)


def lower_case(c: Column) -> Column:
    return F.lower(c)


def null_flags(names: Iterable[str]) -> Column:
    """array<string> of the names whose column is null, in the given order."""
    flags = F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names])
    return F.filter(flags, lambda x: x.isNotNull())
