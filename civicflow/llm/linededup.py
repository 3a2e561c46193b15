"""Line deduplication by winnowing over line hashes (DataFrame functions only).

A line is what stands between line breaks, cut further after a full stop and a blank, so that a passage
of whole sentences inside a paragraph is seen too.  Blank lines take no part.  Only whole equal lines match:
a repeated run of words that holds less than ``GRAM_WORDS`` words of whole lines, as inside a long sentence,
stays.

1. Each line gets a hash and its place, counted in words.  A line's gram is the shortest run of lines from
   there on with ``GRAM_WORDS`` words; its hash covers all of their hashes.
2. Winnowing: of all grams that begin within ``WINDOW_WORDS`` words the least hash is selected.  Two
   equal runs of whole lines with GRAM_WORDS + WINDOW_WORDS words or more, whatever lines stand around
   them, select the same gram, so each such run has a fingerprint in common (guaranteed).
3. A fingerprint's first place in a document is matched with its home, its first place in the first
   document that has it (by id); a later place in a document is matched with the one before it there.  So
   a place has one match, however many places there are, and periodic text has one diagonal per period.
4. Matches are extended both ways along their diagonal: all lines that equal the home document's line at
   the same distance, in unbroken runs.
5. Runs of at least ``GRAM_WORDS`` words are deleted from the later place; the first copy stays.

Steps 1 and 2 are array functions on a document's row and move nothing.  Only fingerprints, the line
hashes of a document and, for the rewrite, the texts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

GRAM_WORDS = 20
WINDOW_WORDS = 6
#: How many fingerprints of a document are searched for an earlier equal one; beyond, its home counts.
LOOK_BACK = 1024
#: How many next lines are looked at one by one.
NEXT = 4
#: Lines per step of the running word count.
STEP = 128
CUT = "\x01"
BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    """The lines of a text with their ends; put together again they are the text."""
    marked = F.replace(F.replace(text, F.lit("\n"), F.lit("\n" + CUT)), F.lit(". "), F.lit(f". {CUT}"))
    slow = F.split(text, r"(?<=\n)|(?<=[.] )")
    # The mark is cut out again, so a text that has it in itself takes the slower way.
    return F.when(F.instr(text, CUT) > 0, slow).otherwise(F.split(marked, CUT))


def running(words: Column) -> Column:
    """Words before each line.  Sums run in steps, as an array grows by copying."""
    grow = lambda values: F.aggregate(
        values, F.array(F.lit(0)), lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
    )
    step = F.lit(STEP)
    steps = lambda w: F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(w), F.lit(1)) - 1) / step).cast("int")),
        lambda b: grow(F.slice(w, b * step + 1, step)),
    )
    shifted = lambda parts, before: F.transform(
        parts, lambda s, b: let(F.get(before, b), lambda y: F.transform(F.slice(s, 1, F.size(s) - 1), lambda x: x + y))
    )
    starts = lambda parts: grow(F.transform(parts, lambda s: F.element_at(s, -1)))
    joined = lambda parts: let(starts(parts), lambda before: F.flatten(shifted(parts, before)))
    return let(words, lambda w: let(steps(w), joined))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body, or a loop in it, reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def line_table(documents: DataFrame) -> DataFrame:
    """Per document d1, d2 (order of documents), lines (pos, h, w) and prints (idx, g, before).

    idx numbers the lines that take part; before is the last earlier place of g in the document.
    """
    blanks = lambda t: F.octet_length(t) - F.octet_length(F.replace(t, F.lit(" ")))
    trimmed = F.transform(
        lines_of(F.col("text")), lambda x, at: F.struct(at.alias("pos"), F.trim(x, F.lit(BLANKS)).alias("t"))
    )
    counted = lambda words: F.transform(
        F.filter(trimmed, lambda x: x["t"] != ""),
        lambda x: F.struct(x["pos"].alias("pos"), F.xxhash64(x["t"]).alias("h"), words(x["t"]).alias("w")),
    )
    # Blanks tell the words where all words stand one blank apart.
    odd = F.col("text").rlike(r"[\t\x0B\f\r]|  ")
    lines = F.when(odd, counted(lambda t: F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")))).otherwise(
        counted(lambda t: blanks(t) + 1)
    )
    body = lambda own: F.struct(own.alias("lines"), let(selected_grams(own), with_earlier).alias("prints"))
    # A text has lines if it has more than blanks.  A filter on the lines would be pushed below and form them twice.
    some = documents.where(F.trim(F.col("text"), F.lit(BLANKS)) != "")
    return some.select(*_order(), let(lines, body).alias("_doc")).select("d1", "d2", "_doc.*")


def selected_grams(lines: Column) -> Column:
    """(idx, g) of the grams that winnowing selects."""

    def of(h: Column, ws: Column, total: Column) -> Column:
        gram = lambda s, i: F.when(
            total - s >= GRAM_WORDS, F.xxhash64(F.slice(h, i + 1, _reach(ws, s, i, GRAM_WORDS)))
        )
        return let(F.transform(ws, gram), lambda g: winnowed(ws, g))

    total = F.aggregate(lines["w"], F.lit(0), lambda a, x: a + x)
    bound = let(
        F.struct(lines["h"].alias("h"), running(lines["w"]).alias("ws"), total.alias("total")),
        lambda v: of(v["h"], v["ws"], v["total"]),
    )
    return F.when(F.size(lines) > 0, bound)


def _reach(ws: Column, s: Column, i: Column, words: int) -> Column:
    """How many lines begin within ``words`` words from line i on, which begins at word s.

    Mostly few: the first ``NEXT`` are looked at one by one, and only then all that there can be.
    """
    beyond = lambda k: F.coalesce(F.get(ws, i + k) >= s + words, F.lit(True))
    reach = F.size(F.filter(F.slice(ws, i + 1, words), lambda x: x < s + words))
    for k in reversed(range(1, NEXT + 1)):
        reach = F.when(beyond(k), F.lit(k)).otherwise(reach)
    return reach


def winnowed(ws: Column, g: Column) -> Column:
    """(idx, g) of the grams that are the least of a window."""
    alone = lambda s, i: F.coalesce(F.get(ws, i + 1) >= s + WINDOW_WORDS, F.lit(True))
    least = F.transform(
        ws,
        lambda s, i: F.when(alone(s, i), F.get(g, i)).otherwise(
            F.array_min(F.slice(g, i + 1, _reach(ws, s, i, WINDOW_WORDS)))
        ),
    )

    def chosen(low: Column, s: Column, i: Column) -> Column:
        # The windows that gram i lies in begin at most WINDOW_WORDS - 1 words before it.
        many = F.least(i + 1, F.lit(WINDOW_WORDS))
        back = F.size(F.filter(F.slice(ws, i + 2 - many, many), lambda x: x > s - WINDOW_WORDS))
        far = F.coalesce(F.get(ws, i - 1) <= s - WINDOW_WORDS, F.lit(True))
        return F.when(far, F.get(low, i) == F.get(g, i)).otherwise(
            let(back, lambda n: F.array_max(F.slice(low, i + 2 - n, n)) == F.get(g, i))
        )

    marked = let(
        least,
        lambda low: F.transform(
            ws, lambda s, i: F.struct(i.alias("idx"), F.when(chosen(low, s, i), F.get(g, i)).alias("g"))
        ),
    )
    return F.filter(marked, lambda p: p["g"].isNotNull())


def with_earlier(prints: Column) -> Column:
    """Adds the last earlier place of the same gram, among the ``LOOK_BACK`` places before."""
    whole = lambda p, before: F.struct(p["idx"].alias("idx"), p["g"].alias("g"), before.alias("before"))

    def earlier(p: Column, i: Column) -> Column:
        near = F.slice(prints, F.greatest(i + 1 - LOOK_BACK, F.lit(1)), F.least(i, F.lit(LOOK_BACK)))
        return F.array_max(F.transform(F.filter(near, lambda q: q["g"] == p["g"]), lambda q: q["idx"]))

    none = F.lit(None).cast("int")
    return F.when(
        F.size(F.array_distinct(prints["g"])) < F.size(prints), F.transform(prints, lambda p, i: whole(p, earlier(p, i)))
    ).otherwise(F.transform(prints, lambda p: whole(p, none)))


def _order() -> list[Column]:
    """d1, d2: by id, among rows of one id by text; rows without an id come last, by text."""
    text = F.xxhash64("text")
    last = F.lit(1 << 62) + F.shiftrightunsigned(text, 2)
    return [
        F.coalesce(F.col("doc_id").cast("long"), last).alias("d1"),
        F.shiftrightunsigned(text, 40).cast("int").alias("d2"),
    ]


def repeated_runs(documents: DataFrame) -> DataFrame:
    """d1, d2, first, last (positions in ``lines_of``) of all runs to delete; a run may come more than once."""
    table = stored(line_table(documents), "lines")
    prints = table.select("d1", "d2", F.inline("prints"))
    firsts = prints.where(F.col("before").isNull()).select("g", "d1", "d2", "idx")
    homes = (
        firsts.groupBy("g")
        .agg(F.min(F.struct("d1", "d2", "idx")).alias("home"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("g", F.col("home.d1").alias("a1"), F.col("home.d2").alias("a2"), F.col("home.idx").alias("aidx"))
    )
    abroad = (
        firsts.join(homes, "g")
        .where((F.col("d1") != F.col("a1")) | (F.col("d2") != F.col("a2")) | (F.col("idx") != F.col("aidx")))
        .select("d1", "d2", "a1", "a2", (F.col("idx") - F.col("aidx")).alias("diagonal"))
    )
    inside = prints.where(F.col("before").isNotNull()).select(
        "d1", "d2", F.col("d1").alias("a1"), F.col("d2").alias("a2"), (F.col("idx") - F.col("before")).alias("diagonal")
    )
    diagonals = stored(abroad.unionByName(inside).distinct(), "diagonals")
    own = table.select("d1", "d2", "lines")
    home = table.select(F.col("d1").alias("a1"), F.col("d2").alias("a2"), F.col("lines.h").alias("home"))
    both = diagonals.join(own, ["d1", "d2"]).join(home, ["a1", "a2"])
    runs = equal_runs(F.col("lines"), F.col("home"), F.col("diagonal"))
    return both.select("d1", "d2", F.explode(runs).alias("_run")).select("d1", "d2", "_run.*")


def equal_runs(lines: Column, home: Column, diagonal: Column) -> Column:
    """(first, last) of the unbroken runs of lines that equal the home's, of GRAM_WORDS words or more."""
    span = "array<struct<first:int,last:int>>"
    state = lambda spans, first, last, words: F.struct(
        spans.alias("spans"), first.cast("int").alias("first"), last.cast("int").alias("last"), words.cast("int").alias("words")
    )
    zero = F.lit(0)
    closed = lambda s: F.when(
        s["words"] >= GRAM_WORDS,
        F.concat(s["spans"], F.array(F.struct(s["first"].alias("first"), s["last"].alias("last"))).cast(span)),
    ).otherwise(s["spans"])
    words = F.transform(
        lines,
        lambda x, i: F.struct(
            x["pos"].alias("pos"),
            F.when((i >= diagonal) & (F.get(home, i - diagonal) == x["h"]), x["w"]).otherwise(zero).alias("w"),
        ),
    )
    step = lambda s, x: F.when(
        x["w"] > 0,
        state(s["spans"], F.when(s["words"] > 0, s["first"]).otherwise(x["pos"]), x["pos"], s["words"] + x["w"]),
    ).otherwise(state(closed(s), zero, zero, zero))
    return F.aggregate(words, state(F.array().cast(span), zero, zero, zero), step, closed)


def line_deduplicated(documents: DataFrame) -> DataFrame:
    """All rows and columns of ``documents`` with later copies of repeated runs of lines cut out of text.

    Adds _deleted_lines and _deleted_bytes.  An empty table stays empty.  Untouched texts stay byte for byte; null and empty texts stay
    as they are.  Rows with equal id and text count as one document and get the same result; null ids come
    last in the order.  Internal columns begin with an underscore.
    """
    gone = (
        repeated_runs(documents)
        .groupBy(F.col("d1").alias("_d1"), F.col("d2").alias("_d2"))
        .agg(F.collect_set(F.struct("first", "last")).alias("_gone"))
    )
    d1, d2 = _order()
    # The texts are large at any size: always the same plan.
    joined = documents.withColumns({"_d1": d1, "_d2": d2}).hint("merge").join(gone, ["_d1", "_d2"], "left")
    every = lines_of(F.col("text"))
    inside = lambda at: F.exists("_gone", lambda run: (at >= run["first"]) & (at <= run["last"]))
    left = F.filter(every, lambda line, at: ~inside(at))
    some = F.col("_gone").isNotNull()
    joined = joined.withColumn("_left", F.when(some, left))
    return joined.select(
        *[F.when(some, F.array_join("_left", "")).otherwise(F.col(c)).alias(c) if c == "text" else F.col(c) for c in documents.columns],
        F.when(some, F.size(every) - F.size("_left")).otherwise(F.lit(0)).alias("_deleted_lines"),
        F.when(some, F.octet_length("text") - F.octet_length(F.array_join("_left", ""))).otherwise(F.lit(0)).alias("_deleted_bytes"),
    )


def deduplicate_lines(documents: DataFrame) -> DataFrame:
    """doc_id, text without repeated runs, deleted_lines, deleted_bytes, for all rows of ``documents``."""
    return line_deduplicated(documents.select("doc_id", "text")).select(
        "doc_id",
        "text",
        F.col("_deleted_lines").alias("deleted_lines"),
        F.col("_deleted_bytes").alias("deleted_bytes"),
    )


def keep_first_lines(documents: DataFrame) -> DataFrame:
    """``documents``, same columns, with repeated runs cut out; rows that lose all their words go.

    Such a row consists of copies of earlier text only.  A column n_chars, if there is one, follows the
    new text.
    """
    rows = line_deduplicated(documents)
    rows = rows.where((F.col("_deleted_lines") == 0) | (F.trim(F.col("text"), F.lit(BLANKS)) != ""))
    if "n_chars" in documents.columns:
        changed = F.length("text").cast(documents.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col("_deleted_lines") > 0, changed).otherwise(F.col("n_chars")))
    return rows.select(*documents.columns)
