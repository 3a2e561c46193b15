"""Systematic page sample by rank selection: only the rows of the pages move.

``systematic_sample`` ranks the whole table, so every row crosses a range exchange to keep one in ten.
Here the order is cut into cells by a histogram of the order's columns (a count with partial aggregates;
no row moves).  Running totals give each cell's first rank.  A cell that meets no page is dropped where
it is read; a cell that meets one and holds more than half a page is cut again, by the next column where
the first does not differ any more, until each page boundary lies in a small cell.  Then the rows of the
cells that meet a page, and no others, are numbered within their cell.

The cells that are left are broadcast and bounded by ``CELLS``; a sample of so many pages that they would
not fit is taken by ``systematic_sample`` instead, with the same result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow.operators.sample import systematic_sample
from civicflow.session import checkpoint_root

#: Most cells of a histogram; a row of the broadcast has a few numbers.
CELLS = 1 << 18
#: Most parts that one cell is cut into at a time.
PARTS = 1 << 12

_PATH, _CUT = "_cell_path", "_cell_cut"


def page_sample(
    df: DataFrame,
    order: Sequence[tuple[str, str]],
    page: int,
    stride: int,
    cap: int | None = None,
    rank_col: str = "rank",
) -> DataFrame:
    """Pages of ``page`` rows at every ``stride``-th position, page starts below ``cap``.

    ``order`` lists (column, "asc" or "desc") and must be a total order over whole numbers, dates and
    timestamps; nulls come first ascending and last descending.  Rows that are equal in it get ranks in
    any order.  All columns of ``df`` are kept, an empty table gives an empty result.
    """
    if not 0 < page <= stride:
        raise ValueError("a page has at least one row and at most a stride")
    sort = [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in order]
    keys = [_whole_number(df, c, way) for c, way in order]
    cells = _cells_of_pages(df, keys, [way == "desc" for _, way in order], page, stride, cap)
    if cells is None:
        return systematic_sample(df, sort, page, stride, cap, rank_col)
    rows, met = cells
    inside = Window.partitionBy(_PATH).orderBy(*sort)
    ranked = (
        rows.join(F.broadcast(met.select(_PATH, "_first")), _PATH)
        .withColumn(rank_col, F.col("_first") + F.row_number().over(inside) - 1)
        .drop(_PATH, "_first")
    )
    keep = (F.col(rank_col) % stride) < page
    if cap is not None:
        keep = keep & ((F.col(rank_col) - F.col(rank_col) % stride) < cap)
    return ranked.where(keep)


def _whole_number(df: DataFrame, name: str, way: str) -> Column:
    """The column as a long that ascends in the order asked for."""
    kind = df.schema[name].dataType.simpleString()
    if kind in ("tinyint", "smallint", "int", "bigint"):
        key = F.col(name).cast("long")
    elif kind == "date":
        key = F.unix_date(name).cast("long")
    elif kind == "timestamp":
        key = F.unix_micros(name)
    elif kind == "timestamp_ntz":  # no cast to a moment: the zone's jumps would upset the order
        minutes = F.unix_date(F.to_date(name)).cast("long") * 1440 + F.hour(name) * 60 + F.minute(name)
        key = minutes * 60_000_000 + (F.extract(F.lit("SECOND"), F.col(name)) * 1_000_000).cast("long")
    else:
        raise TypeError(f"{name}: no histogram over {kind}; use systematic_sample")
    return F.bitwise_not(key) if way == "desc" else key


def _meets_page(page: int, stride: int, cap: int | None) -> Column:
    """Whether ranks _first .. _first + _n - 1 hold a row of some page."""
    into = F.col("_first") % stride
    start = F.when(into < page, F.col("_first") - into).otherwise(F.col("_first") - into + stride)
    meets = start < F.col("_first") + F.col("_n")
    return meets if cap is None else meets & (start < cap)


def _cells_of_pages(df, keys, descending, page, stride, cap):
    """(rows with their cell, cells that meet a page with their first rank); None if they are too many."""
    checkpoint_root(df.sparkSession)
    half = max(1, page // 2)
    whole = [F.count(F.lit(1)).alias("n"), F.min(keys[0]).alias("lo"), F.max(keys[0]).alias("hi")]
    n, lo, hi = df.agg(*whole).first()
    pages = math.ceil(min(n, n if cap is None else cap) / stride)
    if 16 * pages > CELLS:
        return None
    lo, hi = (0, 0) if lo is None else (lo, hi)
    parts = max(1, min(CELLS // 4, math.ceil(2 * n / half)))
    number = F.floor((keys[0].cast("double") - F.lit(float(lo))) / F.lit(max(1.0, (hi - lo) / parts)))
    rows = df.withColumn(_PATH, F.array(F.coalesce(number, F.lit(_null_digit(descending[0], parts)))))
    size = parts
    while True:
        cells = _histogram(rows, keys).checkpoint()
        met = cells.where(_meets_page(page, stride, cap))
        hot = _cuts(met.where(F.col("_n") > half), len(keys), half)
        count, more = hot.agg(F.count(F.lit(1)), F.coalesce(F.sum("parts"), F.lit(0))).first()
        size += more
        if size > CELLS:
            return None
        if not count:
            return rows, met
        rows = _cut(rows, hot, keys, descending)


def _null_digit(descending: bool, parts: int) -> int:
    return 2 * parts + 2 if descending else -1


def _histogram(rows: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Per cell the count, least, greatest and number of values of each key, and its first rank.

    The running total is one window over the cells, whose number is bounded by ``CELLS``.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, key in enumerate(keys):
        aggs += [F.min(key).alias(f"_lo{i}"), F.max(key).alias(f"_hi{i}"), F.count(key).alias(f"_some{i}")]
    before = Window.orderBy(_PATH).rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.groupBy(_PATH).agg(*aggs)
    return counted.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def _cuts(hot: DataFrame, keys: int, half: int) -> DataFrame:
    """How to cut each cell: by which key, from where, how many parts.  Cells of equal rows are left out."""
    key, lo, hi = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("long")
    for i in reversed(range(keys)):
        some_null = (F.col(f"_some{i}") > 0) & (F.col(f"_some{i}") < F.col("_n"))
        differs = F.coalesce(F.col(f"_lo{i}") < F.col(f"_hi{i}"), F.lit(False)) | some_null
        key = F.when(differs, F.lit(i)).otherwise(key)
        lo = F.when(differs, F.col(f"_lo{i}")).otherwise(lo)
        hi = F.when(differs, F.col(f"_hi{i}")).otherwise(hi)
    parts = F.least(F.lit(PARTS), F.ceil(2 * F.col("_n") / half)).cast("long")
    cuts = hot.select(_PATH, key.alias("key"), lo.alias("lo"), hi.alias("hi"), parts.alias("parts"))
    return cuts.where("key is not null")


def _cut(rows: DataFrame, hot: DataFrame, keys: Sequence[Column], descending: Sequence[bool]) -> DataFrame:
    """``rows`` with one more digit in the path of each cell of ``hot`` (at most ``CELLS`` rows, checked)."""
    cut = hot.select(_PATH, F.struct("key", "lo", "hi", "parts").alias(_CUT))
    c = F.col(_CUT)
    digit = F.lit(None).cast("long")
    for i, key in enumerate(keys):
        # The difference as a long where it fits one, so that neighbours stay apart.
        fits = F.shiftright(c["hi"], 1) - F.shiftright(c["lo"], 1) < (1 << 61)
        span = F.when(fits, (c["hi"] - c["lo"]).cast("double")).otherwise(c["hi"].cast("double") - c["lo"].cast("double"))
        above = F.when(fits, (key - c["lo"]).cast("double")).otherwise(key.cast("double") - c["lo"].cast("double"))
        number = F.floor(above / F.greatest(F.lit(1.0), span / c["parts"]))
        absent = (2 * c["parts"] + 2) if descending[i] else F.lit(-1).cast("long")
        digit = F.when(c["key"] == i, F.coalesce(number, absent)).otherwise(digit)
    path = F.when(c.isNull(), F.col(_PATH)).otherwise(F.concat(_PATH, F.array(digit)))
    return rows.join(F.broadcast(cut), _PATH, "left").withColumn(_PATH, path).drop(_CUT)
