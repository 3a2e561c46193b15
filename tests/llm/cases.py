"""Small tables that every operator must get through."""

from pyspark.sql import types as T

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60)) + "."
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for their own columns.
        T.StructField("score", T.StringType()),
        T.StructField("component_id", T.StringType()),
        T.StructField("n", T.StringType()),
        T.StructField("d1", T.StringType()),
        T.StructField("part", T.StringType()),
    ]
)

ROWS = [
    (0, "The quick brown fox jumps over the lazy dog and runs away from the very old farm house today."),
    (1, "The quick brown fox jumps over the lazy dog and runs away from the very old farm house today."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "one"),
    (6, "one"),
    (7, LONG),
    (8, "Ünïcode wörds \x00 \u0085 mixed\x0bseparators\x0chere 漢字 🙂 ÉÀ"),
    (9, "12345 !!! ???"),
    (10, "a" * 50_000),
    (11, f"Start of this one here. {PASSAGE} End of this one here."),
    (12, f"Another begin, quite different. {PASSAGE} Another end."),
    (12, f"Another begin, quite different. {PASSAGE} Another end."),
    (13, "same id twice first text with several words in it"),
    (13, "same id twice second text with several other words in it"),
    (None, "a row without an id but with some words in it"),
    (None, None),
    (-5, "negative id"),
    (14, "x\n" * 3000),
]


def documents(spark, rows=ROWS):
    full = [(i, t, "en" if i is not None and i % 2 else None, "s", 1, "a", "b", "c", "d", "e") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(text):
    return (text or "").encode().lower().split()
