import collections
import random
import re

import pytest

from civicflow.llm import linededup
from civicflow.llm.linededup import GRAM_WORDS, WINDOW_WORDS
from civicflow.llm.queries import op9_line_dedup

from .cases import PASSAGE, ROWS, documents

BLANKS = linededup.BLANKS


def lines(text):
    """(position, stripped line, words) of the lines that take part, and all lines."""
    every = re.split(r"(?<=\n)|(?<=[.] )", text or "")
    return every, [(p, x.strip(BLANKS), x.strip(BLANKS).count(" ") + 1) for p, x in enumerate(every) if x.strip(BLANKS)]


def repeated_runs(docs, least):
    """(later document, positions) of all runs of ``least`` words or more that stood somewhere before."""
    seen, out = {}, []
    for i, text in docs:
        own = lines(text)[1]
        for s in range(len(own)):
            n, key, at = 0, [], []
            for p, line, w in own[s:]:
                key.append(line)
                at.append(p)
                n += w
                if n >= least:
                    break
            if n < least:
                break
            if seen.setdefault(tuple(key), (i, s)) != (i, s):
                out.append((i, at))
    return out


def check(rows, docs):
    """A text loses characters only if a run in it stood before, and no guaranteed run stays."""
    got = {r["doc_id"]: r for r in rows}
    allowed = collections.Counter()
    for i, at in repeated_runs(docs, GRAM_WORDS):
        allowed[i] += len(at)
    texts = dict(docs)
    for i, text in docs:
        if not allowed[i]:
            assert got[i]["text"] == text and got[i]["deleted_lines"] == 0
    for i, at in repeated_runs(docs, GRAM_WORDS + WINDOW_WORDS):
        run = "".join(lines(texts[i])[0][p] for p in at)
        assert texts[i].count(run) > 1 or run not in got[i]["text"]


def test_whole_table(spark, sf001):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf001}/documents.parquet").collect())
    rows = op9_line_dedup(spark, sf001).collect()
    assert len(rows) == len(docs)
    check(rows, docs)
    assert sum(r["deleted_lines"] for r in rows) > 0


def definition(spark, docs):
    """Steps 3 to 5 done by hand on the line table (whose grams need Spark's hash)."""
    table = {r["d1"]: r for r in linededup.line_table(documents(spark, docs)).collect()}
    home = {}
    for d in sorted(table):
        for p in table[d]["prints"]:
            home.setdefault(p["g"], (d, p["idx"]))
    out = {}
    for d, row in table.items():
        last, diagonals = {}, set()
        for p in row["prints"]:
            assert p["before"] == last.get(p["g"])
            if p["g"] in last:
                diagonals.add((d, p["idx"] - last[p["g"]]))
            elif home[p["g"]][0] != d:
                diagonals.add((home[p["g"]][0], p["idx"] - home[p["g"]][1]))
            last[p["g"]] = p["idx"]
        gone, own = set(), row["lines"]
        for a, k in diagonals:
            other, run = table[a]["lines"], []
            for i in range(len(own) + 1):
                if i < len(own) and 0 <= i - k < len(other) and other[i - k]["h"] == own[i]["h"]:
                    run.append(own[i])
                    continue
                if sum(x["w"] for x in run) >= GRAM_WORDS:
                    gone.update(range(run[0]["pos"], run[-1]["pos"] + 1))
                run = []
        out[d] = gone
    return out


def grams_by_hand(own):
    """For lines of (key, words): which grams are selected, as (first line, lines in it), under an order of grams."""
    starts = [sum(w for _, w in own[:i]) for i in range(len(own))]
    total = sum(w for _, w in own)
    grams = {}
    for i, s in enumerate(starts):
        if total - s >= GRAM_WORDS:
            grams[i] = tuple(k for (k, _), t in zip(own[i:], starts[i:]) if t < s + GRAM_WORDS)
    return starts, grams


def test_grams_and_windows_by_hand(spark):
    """The array functions against plain loops: which lines a gram covers, and which gram a window selects."""
    rng = random.Random(1)
    docs = [(k, " ".join(" ".join(f"w{rng.randint(0, 5)}" for _ in range(rng.choice([1, 1, 2, 3, 7, 30]))) + "." for _ in range(rng.randint(1, 300)))) for k in range(25)]
    rows = {r["d1"]: r for r in linededup.line_table(documents(spark, docs)).collect()}
    hashes = {}
    for d, text in docs:
        own = [(x["h"], x["w"]) for x in rows[d]["lines"]]
        assert [w for _, w in own] == [w for _, _, w in lines(text)[1]]
        starts, grams = grams_by_hand(own)
        got = {p["idx"]: p["g"] for p in rows[d]["prints"]}
        assert set(got) <= set(grams)
        for i, g in got.items():
            assert hashes.setdefault(grams[i], g) == g
        for i in grams:  # every window selects one of its grams
            window = [j for j in range(i, len(own)) if starts[j] < starts[i] + WINDOW_WORDS]
            assert any(j in got for j in window)
    assert len(set(hashes.values())) == len(hashes)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_definition(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()]
    gone = definition(spark, docs)
    got = {r["doc_id"]: r for r in linededup.deduplicate_lines(documents(spark, docs)).collect()}
    for i, text in docs:
        left = "".join(x for p, x in enumerate(lines(text)[0]) if p not in gone.get(i, ()))
        assert (got[i]["text"], got[i]["deleted_lines"]) == (left, len(gone.get(i, ())))
        assert got[i]["deleted_bytes"] == len(text.encode()) - len(left.encode())


def test_grams_are_selected_alike_wherever_they_stand(spark):
    run = " ".join(f"Line {k} has some words of its own." for k in range(8))
    docs = [(1, run), (2, f"Something else first. {run} And more after it."), (3, f"One. Two words. {run}")]
    table = linededup.line_table(documents(spark, docs)).collect()
    prints = {r["d1"]: {p["g"] for p in r["prints"]} for r in table}
    assert prints[1] & prints[2] & prints[3]
    rows = linededup.deduplicate_lines(documents(spark, docs)).collect()
    assert {r["doc_id"]: r["text"].strip() for r in rows} == {
        1: run, 2: "Something else first. " + "" + "And more after it.", 3: "One. Two words."}


def test_edge_cases(spark):
    rows = linededup.deduplicate_lines(documents(spark)).collect()
    assert len(rows) == len(ROWS)
    got = collections.defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append(r)
    same = [0, 2, 3, 4, 5, 6, 7, 8, 9, 10, -5]
    assert all(r["text"] == dict(ROWS)[i] and r["deleted_lines"] == 0 for i in same for r in got[i])
    # Rows that repeat id and text get the same result; the passage in 12 is a copy of that in 11.
    assert len(got[12]) == 2 and len({r["text"] for r in got[12]}) == 1
    assert PASSAGE in got[11][0]["text"] and PASSAGE not in got[12][0]["text"]
    assert got[1][0]["text"] == "" or got[1][0]["text"] == dict(ROWS)[1]
    # A periodic text keeps its first line.
    assert got[14][0]["text"] == "x\n" and got[14][0]["deleted_lines"] == 2999
    assert linededup.deduplicate_lines(documents(spark, [])).collect() == []
    kept = linededup.keep_first_lines(documents(spark))
    assert kept.columns == documents(spark).columns
    assert [r["n_chars"] for r in kept.where("doc_id = 14").collect()] == [2]
    texts = [(1, "a\x01b. c"), (2, None)]
    assert {r["text"] for r in linededup.deduplicate_lines(documents(spark, texts)).collect()} == {"a\x01b. c", None}


def test_words_are_counted_at_any_white_space(spark):
    """Words counted by Python: runs of ASCII characters that are not white space, whatever stands between."""
    tabs = "\t".join(f"cell{k}" for k in range(40))
    gaps = "left" + " " * 19 + "right"
    mixed = "a\x0bb\x0cc \t d\r e  f"
    docs = [(k, f"Own words of {k}\n{tabs}\n{gaps}\n{mixed}\nplain words here\n") for k in range(3)]
    docs += [(k, f"Other words of {k}\n{gaps}\nand an end of {k}\n") for k in range(3, 6)]
    for r in linededup.line_table(documents(spark, docs)).collect():
        every = [x for x in re.split(r"(?<=\n)|(?<=[.] )", dict(docs)[r["d1"]]) if x.strip(BLANKS)]
        assert [x["w"] for x in r["lines"]] == [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in every]
    got = {r["doc_id"]: r["text"] for r in linededup.deduplicate_lines(documents(spark, docs)).collect()}
    assert tabs in got[0] and tabs not in got[1] and tabs not in got[2]
    assert all(got[k] == dict(docs)[k] for k in range(3, 6))


def test_a_twin_beyond_the_look_back_is_still_found(spark, monkeypatch):
    """With one place to look back on, every later copy goes to the first place instead; the result is the same."""
    block = lambda k: "".join(f"b{k}l{j} " + " ".join(f"b{k}w{j}x{i}" for i in range(9)) + "\n" for j in range(8))
    a, b, c = block(1), block(2), block(3)
    rows = [(1, a + b + c + a + c), (2, c + b + block(4) + a), (3, block(4) + block(5) + block(5))]
    want = {1: a + b + c, 2: block(4), 3: block(5)}
    for back in (1024, 1):
        monkeypatch.setattr(linededup, "LOOK_BACK", back)
        assert {r["doc_id"]: r["text"] for r in linededup.deduplicate_lines(documents(spark, rows)).collect()} == want
