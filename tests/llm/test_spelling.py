import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from civicflow.llm import spelling

from .cases import documents
from .sql import same_rows


def near(a, b):
    """One code point put in, taken out or replaced, by trying all places."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, factor=2):
    rows = {}
    for w, n in words.items():
        others = sorted((-words[x], x) for x in words if near(w, x))
        form = others[0][1] if others and -others[0][0] >= factor * n else None
        rows[w] = [form, n, len(others), words[form] if form else None]
    out = set()
    for w, (form, *rest) in rows.items():
        root = w
        while rows[root][0] is not None:
            root = rows[root][0]
        out.add((w, form, root, *rest))
    return out


def groups(spark, words, **options):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = spelling.variant_groups(df, **options).collect()
    assert len(rows) == len(words)
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    same_rows(spark, "op11_spelling", f"/root/testdata/{sf}")


@pytest.mark.parametrize("tile", [3, 1024])
def test_against_all_pairs(spark, tile):
    """Short words of few letters: many near pairs, common halves, insertions that fit both halves, chains of forms."""
    rng = random.Random(7)
    words = {}
    while len(words) < 600:
        words["".join(rng.choice("abé漢") for _ in range(rng.choice((1, 2, 3, 4, 5, 6, 7))))] = rng.choice((1, 2, 3, 4, 8, 16, 40))
    words |= {"aa": 5, "aaa": 10, "aaaa": 20, "aaaaa": 41, "🙂🙂": 3, "🙂": 6}
    assert groups(spark, words, tile=tile) == brute(words)


def test_hot_half_is_cut_into_blocks(spark):
    """A third of all words share their first half: more tiles, same answer, no tile above the bound."""
    rng = random.Random(1)
    words = {f"abcdef{rng.randrange(16**6):06x}": rng.randrange(3, 50) for _ in range(300)}
    words |= {"".join(rng.choice("ghijkl") for _ in range(8)): rng.randrange(3, 50) for _ in range(600)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    laid = spelling.tiles(df, tile=40).groupBy("key", "a", "b").count()
    assert laid.agg(F.max("count")).first()[0] <= 2 * 40 * 2
    assert laid.where("key = 'p12:abcdef' and a < b").count() >= 28
    assert groups(spark, words, tile=40) == brute(words)


def test_long_words_and_stacks(spark):
    rng = random.Random(3)
    stem = "".join(rng.choice("abcdefgh") for _ in range(30_000))
    words = {stem: 9, stem[:100] + stem[101:]: 4, stem[:-1] + "z": 3, stem + "z": 4, "z" + stem: 2, "short": 5, "shore": 1}
    assert groups(spark, words) == brute(words)


def test_no_circles_and_long_chains(spark):
    words = {"a" * k: 2**k for k in range(1, 24)}
    got = groups(spark, words)
    assert {r[2] for r in got} == {"a" * 23}
    assert groups(spark, {"abcde": 5, "abcdf": 5, "abcdg": 9}) == brute({"abcde": 5, "abcdf": 5, "abcdg": 9})


def test_words_of_documents(spark):
    rows = [(i, "Größe MIXED×case ÉCOLE Größe 漢字 don't " * 3 + ("Tables" if i % 2 else "")) for i in range(200)]
    rows += [(None, "Nullid nullid nullid"), (1, None), (2, ""), (3, "Größe")]
    want = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                want[run] = want.get(run, 0) + 1
    got = {r["word"]: r["n"] for r in spelling.word_counts(documents(spark, rows)).collect()}
    assert got == {w: n for w, n in want.items() if n >= 3}
    assert "mixed×case" in got


def test_edge_cases(spark):
    assert spelling.spelling_variants(documents(spark, [])).collect() == []
    assert spelling.spelling_variants(documents(spark, [(1, None), (2, "")])).collect() == []
    rows = spelling.spelling_variants(documents(spark)).collect()
    counts = {r["word"]: r["n"] for r in rows}
    # Only words that three places have; the repeated rows count twice.
    assert {w for w in counts if w.startswith("shared") or len(w) < 5} <= {"shared"}
    one = spark.createDataFrame([("solo", 3), (None, 4), ("", 5)], "word string, n long")
    assert [tuple(r) for r in spelling.variant_groups(one).collect()] == [("solo", None, "solo", 3, 0, None)]
