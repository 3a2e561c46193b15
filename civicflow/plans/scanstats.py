"""What a filter must read of a Parquet table, from the statistics that the files carry.

``row_groups`` is a table of the row groups of all files: rows, bytes and, for each column asked for, the least and
greatest value and the number of nulls.  Tasks read the footers, one task many files; of a file nothing else is
read.  A partition column has the value of its folder in all row groups of a file.

``examined`` evaluates a filter against that table: a row group must be opened unless the filter rules it out by the
statistics of one of its columns.  The rows of those groups against the rows returned are the same ratio that a
document store reports as documents examined per document returned.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder name of a null partition value; fixed by the Hive layout.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Stores whose files a task can open at the footer.  Of others Spark hands over the whole file.
FOOTER_SCHEMES = ("file", "hdfs", "s3", "gs")

STATISTICS = T.ArrayType(
    T.StructType(
        [
            T.StructField("column", T.StringType()),
            T.StructField("low", T.StringType()),
            T.StructField("high", T.StringType()),
            T.StructField("nulls", T.LongType()),
        ]
    )
)
ROW_GROUPS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("row_group", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("statistics", STATISTICS),
    ]
)


@dataclass(frozen=True)
class Within:
    """``low <= column <= high``; None is no bound.  Equality has the same value twice."""

    column: str
    low: str | float | datetime | None = None
    high: str | float | datetime | None = None

    def text(self) -> str:
        if self.low is not None and self.low == self.high:
            return f"{self.column} = '{self.low}'"
        bounds = [f"{self.column} >= '{self.low}'"] if self.low is not None else []
        bounds += [f"{self.column} <= '{self.high}'"] if self.high is not None else []
        return " AND ".join(bounds) or f"{self.column} IS NOT NULL"

    def matches(self) -> Column:
        bounds = [F.col(self.column).isNotNull()]
        bounds += [F.col(self.column) >= F.lit(self.low)] if self.low is not None else []
        bounds += [F.col(self.column) <= F.lit(self.high)] if self.high is not None else []
        return reduce(lambda a, b: a & b, bounds)

    def may_match(self, statistics: Column, kind: T.DataType) -> Column:
        """False where the statistics rule a row group out; without statistics it must be opened."""
        own = F.get(F.filter(statistics, lambda s: s["column"] == self.column), F.lit(0))
        no_value = own["nulls"] == F.col("rows")
        out = [no_value]
        out += [own["high"].cast(kind) < F.lit(self.low)] if self.low is not None else []
        out += [own["low"].cast(kind) > F.lit(self.high)] if self.high is not None else []
        return ~reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in out])


def equals(column: str, value) -> Within:
    return Within(column, value, value)


def matches(filters: Sequence[Within]) -> Column:
    return reduce(lambda a, b: a & b, [f.matches() for f in filters])


# --- footers ----------------------------------------------------------------------------------------


def _text(value) -> str | None:
    if value is None:
        return None
    return value.isoformat() if isinstance(value, datetime) else str(value)


def _footer(path: str, content: bytes | None) -> pq.FileMetaData:
    if content is not None:
        return pq.read_metadata(pa.BufferReader(content))
    # Spark gives the path as it is, not as a URI: what is escaped in it is part of a folder's name.
    if path.startswith("file:"):
        return pq.read_metadata("/" + path.removeprefix("file:").lstrip("/"))
    system, name = pyarrow.fs.FileSystem.from_uri(quote(path, safe=":/"))
    return pq.read_metadata(name, filesystem=system)


def _folders(path: str) -> dict[str, str | None]:
    """Partition columns and values in a path, whose odd characters are escaped."""
    pairs = (part.partition("=") for part in path.split("/")[:-1] if "=" in part)
    return {name: None if value == NULL_PARTITION else unquote(value) for name, _, value in pairs}


def _file_groups(path: str, content: bytes | None, columns: Sequence[str]) -> Iterator[dict]:
    footer, folders = _footer(path, content), _folders(path)
    for g in range(footer.num_row_groups):
        group = footer.row_group(g)
        found = []
        for name, value in folders.items():
            if name in columns:
                found.append({"column": name, "low": value, "high": value, "nulls": 0 if value is not None else group.num_rows})
        for c in range(group.num_columns):
            chunk = group.column(c)
            if chunk.path_in_schema in columns and chunk.is_stats_set:
                s = chunk.statistics
                ends = (_text(s.min), _text(s.max)) if s.has_min_max else (None, None)
                nulls = s.null_count if s.has_null_count else None
                found.append({"column": chunk.path_in_schema, "low": ends[0], "high": ends[1], "nulls": nulls})
        yield {"path": path, "row_group": g, "rows": group.num_rows, "bytes": group.total_byte_size, "statistics": found}


def row_groups(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row per row group of the table at ``path``, with the statistics of ``columns``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, wanted = to_arrow_schema(ROW_GROUPS), tuple(columns)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    scheme = urlparse(path).scheme
    files = files.select("path", *([] if scheme in ("", *FOOTER_SCHEMES) else ["content"]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                made = list(_file_groups(file["path"], file.get("content"), wanted))
                yield pa.RecordBatch.from_pylist(made, schema)

    return files.mapInArrow(read, ROW_GROUPS)


# --- filters ----------------------------------------------------------------------------------------


def examined(groups: DataFrame, filters: Sequence[Within], table: T.StructType) -> DataFrame:
    """groups_total, rows_total, groups_examined, rows_examined, bytes_examined of a filter (one row)."""
    may = reduce(lambda a, b: a & b, [f.may_match(F.col("statistics"), table[f.column].dataType) for f in filters])
    opened = groups.withColumn("_open", may)
    return opened.agg(
        F.count(F.lit(1)).alias("groups_total"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_total"),
        F.count_if("_open").alias("groups_examined"),
        F.coalesce(F.sum(F.when(F.col("_open"), F.col("rows"))), F.lit(0)).alias("rows_examined"),
        F.coalesce(F.sum(F.when(F.col("_open"), F.col("bytes"))), F.lit(0)).alias("bytes_examined"),
    )
