"""Row validators as Spark column expressions (no Python UDF).

* ``parse_created_date``: ISO 8601 first (every ``Z`` removed), else the US form
  ``month/day/year hour:minute:second AM|PM``; anything else is null (= invalid).
  Both branches follow the grammar of Python's ``datetime.fromisoformat`` and
  ``datetime.strptime('%m/%d/%Y %I:%M:%S %p')`` and build the value with
  ``try_make_timestamp_ntz``, so the result does not depend on the session time zone.
  An explicit UTC offset is applied (the stored value is the UTC wall clock).
  ISO week dates (``2026-W18-5``, ``2026W185``, ``2026-W18``) are accepted as well,
  including ``fromisoformat``'s rules for a digit used as the date/time separator.
* ``parse_coordinate``: Python ``float()`` grammar (underscores between digits,
  ``inf``/``nan``), else ``0.0``.

Each format is matched once per row: ``regexp_replace(s, RE, '$1,$2,...')`` turns the
match into one comma-separated string of all groups (a group that did not take part
gives ''), ``split`` makes it an array, and ``let`` binds it once for the many reads.
"""

from __future__ import annotations

import re

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO 8601 text as Python's ``datetime.fromisoformat`` (C implementation) accepts it,
# after every ``Z`` is removed:
#   date      YYYY-MM-DD | YYYYMMDD | YYYY-Www[-D] | YYYYWww[D]
#   then optionally one separator character of any kind and a time:
#   time      HH[(:)MM[(:)SS]] with one consistent separator; a fraction (. or ,) may follow
#             the last component; without an offset nothing else may follow
#   offset    + or - and the same HH[:MM[:SS]][.f] grammar, ending the text; before it,
#             one extra character may follow the time, and after six fraction digits
#             anything is skipped.  Offset parts are not range-checked (05:75 = 06:15),
#             only the total must stay within 24 hours.
# Written with Python named groups; group numbers come from Python's ``re`` and the text is
# converted to Java's syntax (same numbering).
def _hms(prefix: str) -> str:
    return (
        rf"(?P<{prefix}h>\d{{2}})(?:(?P<{prefix}sep>:?)(?P<{prefix}m>\d{{2}})"
        rf"(?:(?P={prefix}sep)(?P<{prefix}s>\d{{2}}))?)?"
    )


_TIME = (
    _hms("t")
    + r"(?:(?:[.,](?P<tf>\d+))?"  # no offset: an optional fraction ends the text
    + r"|(?:[.,](?P<tfz>\d{1,6})(?:(?<=\d{6})[^+\-]*)?|[^+\-])?"  # before an offset
    + r"(?P<zsign>[+-])" + _hms("z") + r"(?:[.,](?P<zf>\d+))?)"
)
_TIME_GROUPS = ("th", "tm", "ts", "tf", "tfz", "zsign", "zh", "zm", "zs", "zf")
_CALENDAR = r"(?:(?P<ey>\d{4})-(?P<em>\d{2})-(?P<ed>\d{2})|(?P<by>\d{4})(?P<bm>\d{2})(?P<bd>\d{2}))"
# Week dates: the extended day digit counts only when no digit follows it (else the '-' is
# the separator).  In the basic form a run of digits after Www is split by its length, as
# Python does: the day digit belongs to the date when the digits after it number 0 or an
# odd count (the next one is then the separator); otherwise there is no day digit.
_WEEK = (
    r"(?P<wy>\d{4})(?:-W(?P<ew>\d{2})(?:-(?P<ewd>[1-7])(?![0-9]))?"
    r"|W(?P<bw>\d{2})(?:(?P<bwd>[1-7])(?=(?!\d)|\d(?:\d\d)*(?!\d))|(?=(?!\d)|\d(?:\d\d)+(?!\d))))"
)


def _java_pattern(date: str, names: tuple[str, ...]) -> tuple[str, str, dict[str, int]]:
    """(Java regex, regexp_replace template '$i,$j,...', name -> position in the parts array)."""
    py = "^" + date + r"(?:[\s\S]" + _TIME + ")?$"
    index = re.compile(py).groupindex
    java = re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", py).replace("(?P<", "(?<")[:-1] + r"\z"
    template = ",".join(f"${index[n]}" for n in names)
    return java, template, {n: i for i, n in enumerate(names)}


ISO_DATETIME_RE, _ISO_TEMPLATE, _ISO = _java_pattern(
    _CALENDAR, ("ey", "em", "ed", "by", "bm", "bd") + _TIME_GROUPS
)
ISO_WEEK_RE, _WEEK_TEMPLATE, _WK = _java_pattern(_WEEK, ("wy", "ew", "ewd", "bw", "bwd") + _TIME_GROUPS)

# strptime field patterns for %m/%d/%Y %I:%M:%S %p (a format blank matches any run of blanks).
US_DATETIME_RE = (
    r"^(1[0-2]|0[1-9]|[1-9])/(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])/(\d{4})\s+"
    r"(1[0-2]|0[1-9]|[1-9]):([0-5]\d|\d):(6[01]|[0-5]\d|\d)\s+([AaPp][Mm])\z"
)
_US_TEMPLATE = ",".join(f"${i}" for i in range(1, 8))

# The common ISO shapes, on which Spark's own cast agrees with Python (year 0 aside):
# they skip the regex groups entirely.
FAST_ISO_RE = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?\z"

# Python float() literal: digits with single underscores between them, optional
# fraction and exponent, or inf / infinity / nan; surrounding blanks allowed.
_DIGITS = r"\d(?:_?\d)*"
FLOAT_RE = (
    rf"^\s*[+-]?(?:(?:(?:{_DIGITS})?\.{_DIGITS}|{_DIGITS}\.?)(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))\s*$"
)


def _match_groups(s: Column, pattern: str, template: str) -> Column:
    """array<string> of the template's groups when ``s`` matches ``pattern``, else null."""
    return F.when(s.rlike(pattern), F.split(F.regexp_replace(s, pattern, template), ",", -1))


def _int_or(part: Column, default: int, kind: str = "int") -> Column:
    return F.coalesce(F.nullif(part, F.lit("")).try_cast(kind), F.lit(default))


def _micros_of(frac: Column) -> Column:
    """First six fraction digits, right-padded: '5' -> 500000 (more digits are truncated)."""
    return F.when(frac == "", F.lit(0)).otherwise(
        F.rpad(F.substring(frac, 1, 6), 6, "0").try_cast("int")
    )


def _seconds(sec: Column, micros: Column) -> Column:
    """sec in [0, 60), micros in [0, 1e6) -> decimal(8,6) seconds."""
    return F.format_string("%d.%06d", sec, micros).cast("decimal(8,6)")


def _with_time(p: Column, at: dict[str, int], year: Column, month: Column, day: Column) -> Column:
    """Date fields + the time-of-day and offset groups -> timestamp_ntz at UTC wall clock."""
    g = lambda name: p[at[name]]
    hour, minute, sec = _int_or(g("th"), 0), _int_or(g("tm"), 0), _int_or(g("ts"), 0)
    frac = F.coalesce(F.nullif(g("tf"), F.lit("")), g("tfz"))
    local = F.when(
        (year >= 1) & (hour < 24) & (minute < 60) & (sec < 60),
        F.try_make_timestamp_ntz(
            years=year, months=month, days=day, hours=hour, mins=minute,
            secs=_seconds(sec, _micros_of(frac)),
        ),
    )
    tz_h, tz_m, tz_s = (_int_or(g(n), 0, "long") for n in ("zh", "zm", "zs"))
    tz_us = (tz_h * 3600 + tz_m * 60 + tz_s) * 1_000_000 + _micros_of(g("zf")).cast("long")
    sign = F.when(g("zsign") == "-", F.lit(-1)).otherwise(F.lit(1))
    utc = F.when(g("zsign") == "", local).when(
        tz_us < F.lit(24 * 3600 * 1_000_000), F.timestamp_add("MICROSECOND", -sign * tz_us, local)
    )
    # outside years 1..9999 the value has no Python datetime (nor a storable one): invalid
    return F.when(F.year(utc).between(1, 9999), utc)


def _iso_from_groups(p: Column) -> Column:
    g = lambda name: p[_ISO[name]]
    ext = g("ey") != ""
    year = F.when(ext, g("ey")).otherwise(g("by")).try_cast("int")
    month = F.when(ext, g("em")).otherwise(g("bm")).try_cast("int")
    day = F.when(ext, g("ed")).otherwise(g("bd")).try_cast("int")
    return _with_time(p, _ISO, year, month, day)


def _week_from_groups(p: Column) -> Column:
    """ISO year/week/day -> calendar date: Monday of week 1 is the Monday on or before 4 Jan."""
    g = lambda name: p[_WK[name]]
    year = g("wy").try_cast("int")
    week = F.coalesce(F.nullif(g("ew"), F.lit("")), F.nullif(g("bw"), F.lit(""))).try_cast("int")
    weekday = F.coalesce(F.nullif(g("ewd"), F.lit("")), F.nullif(g("bwd"), F.lit("")), F.lit("1")).try_cast("int")
    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    weeks_in_year = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))
    date = F.date_add(F.date_sub(jan4, F.weekday(jan4)), (week - 1) * 7 + weekday - 1)
    valid = (year >= 1) & (week >= 1) & (week <= weeks_in_year) & F.year(date).between(1, 9999)
    return F.when(valid, _with_time(p, _WK, F.year(date), F.month(date), F.dayofmonth(date)))


def _us_from_groups(p: Column) -> Column:
    hour = (p[3].try_cast("int") % 12) + F.when(F.upper(p[6]) == "PM", F.lit(12)).otherwise(F.lit(0))
    sec = p[5].try_cast("int")
    return F.when(
        (sec < 60) & (p[2] != "0000"),
        F.try_make_timestamp_ntz(
            years=p[2].try_cast("int"), months=p[0].try_cast("int"),
            days=F.trim(p[1]).try_cast("int"), hours=hour, mins=p[4].try_cast("int"),
            secs=sec.cast("decimal(8,6)"),
        ),
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    ``body`` may use its argument many times; binding it to a lambda variable keeps
    that a single occurrence in the plan, so when Catalyst copies the expression (a
    filter pushed below the projection that defines it) the regex work is not copied.
    """
    return F.transform(F.array(value), body)[0]


def _fast_iso(value: Column) -> tuple[Column, Column]:
    text = F.replace(value, F.lit("Z"), F.lit(""))
    return text, text.rlike(FAST_ISO_RE) & (F.substring(text, 1, 4) != F.lit("0000"))


def parse_created_date(value: Column) -> Column:
    """Canonical ISO text -> ``try_cast``, then the US form, other ISO shapes and week dates.

    ``coalesce`` stops at the first form that fits and the US form shares no text with the ISO
    ones, so only odd texts pay for the rarer patterns.  ISO forms are read with every ``Z``
    removed, the US form on the untouched text.
    """
    text, fast = _fast_iso(value)
    return F.when(fast, text.try_cast("timestamp_ntz")).otherwise(
        F.coalesce(
            let(_match_groups(value, US_DATETIME_RE, _US_TEMPLATE), _us_from_groups),
            let(_match_groups(text, ISO_DATETIME_RE, _ISO_TEMPLATE), _iso_from_groups),
            let(_match_groups(text, ISO_WEEK_RE, _WEEK_TEMPLATE), _week_from_groups),
        )
    )


def parse_coordinate(value: Column) -> Column:
    """Lenient float: unparseable, blank, 'N/A' or missing -> 0.0 (the 'unknown' marker)."""
    parsed = F.when(value.rlike(FLOAT_RE), F.replace(value, F.lit("_"), F.lit("")).try_cast("double"))
    return F.coalesce(parsed, F.lit(0.0))


# Building the date expression takes about a thousand Python -> JVM calls; Column
# expressions are immutable and unresolved, so each is built once per SparkContext and
# input column and shared by every plan that parses that column.
_BUILT: dict[tuple[int, str, str], Column] = {}


def _once(kind: str, name: str, build) -> Column:
    key = (id(SparkContext._active_spark_context), kind, name)
    if key not in _BUILT:
        _BUILT[key] = build(F.col(name))
    return _BUILT[key]


def created_date_of(name: str) -> Column:
    """``parse_created_date(col(name))``, built once."""
    return _once("date", name, parse_created_date)


def coordinate_of(name: str) -> Column:
    """``parse_coordinate(col(name))``, built once."""
    return _once("coordinate", name, parse_coordinate)
