import random
import re
import time

import numpy as np

from civicflow.llm import licenses
from civicflow.llm.queries import op10_licenses

from .cases import ROWS, documents

TOKEN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    w = [m.decode("utf-8", "replace") for m in TOKEN.findall((text or "").encode().lower())]
    at = []
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        at += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    first = min(at)[0] if at else None
    last = max(at)[0] if at else None
    return len(w), len(at), first, last, ",".join(sorted({x for _, x in at}))


def check(df, texts):
    rows = df.collect()
    got = sorted(str((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])) for r in rows)
    assert got == sorted(str((i, *brute(t))) for i, t in texts)
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
    return rows


def test_base_places_of_the_whole_table(spark, sf01):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()]
    check(op10_licenses(spark, sf01), docs)


def test_places_overlaps_and_borders(spark):
    texts = [
        (1, "MIT License, mit--license; MITlicense mit licenses mit é license"),
        (2, "GNU General Public License general\npublic\tlicense"),
        (3, "the apache license mit\x00license 1mit license mit license"),
        *ROWS,
    ]
    check(licenses.scan_licenses(documents(spark, texts)), texts)


def test_edited_notices_are_found_with_spans(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy"
    edited = notice.replace("hereby", "herby").replace("charge,", "charge").replace("person", "persons")
    texts = [(1, f"{'x ' * 500}{edited} and more"), (2, "permission is granted to nobody"), (3, "Licenced under CC BY-NC 4.0")]
    rows = {r["doc_id"]: r for r in check(licenses.scan_licenses(documents(spark, texts)), texts)}
    assert rows[1]["labels"] == "mit" and rows[1]["base_labels"] == ""
    span = rows[1]["spans"][0]
    assert texts[0][1][span["first_char"] : span["last_char"]].startswith("Permission")
    assert span["edits"] == 3 and abs(rows[1]["score"] - (1 - 3 / len(notice))) < 1e-9
    assert rows[2]["labels"] == "" and rows[2]["score"] == 0
    assert rows[3]["labels"] == "cc-by-nc"


def test_pieces_keep_one_seed_whole():
    for notice in licenses.NOTICES:
        e = licenses.edits_allowed(notice)
        cut = licenses.pieces(notice, e)
        assert len(cut) == e + 1 and "".join(p for _, p in cut) == notice and all(p for _, p in cut)


def test_empty_table(spark):
    assert licenses.scan_licenses(documents(spark, [])).collect() == []


def test_neighbouring_notices_with_different_edits():
    """The better copy does not hide the one before it, nor the one between two."""
    scanner = licenses.Scanner()
    good = "all rights reserved"
    assert good in licenses.NOTICES or any(good in n for n in licenses.NOTICES)
    notice = next(n for n in licenses.NOTICES if good in n)
    edited = notice.replace("reserved", "reservd")
    for text in (f"{edited} {notice}", f"{notice} {edited}", f"{edited} {notice} {edited} {notice} {edited}"):
        spans = scanner.spans(text)
        want = [(m.start(), int(m.group() == edited)) for m in re.finditer(f"{re.escape(edited)}|{re.escape(notice)}", text)]
        assert len(spans) == len(want) >= 2
        for (_, a, b, edits, _), (at, wrong) in zip(spans, want):
            assert abs(a - at) <= 1 and edits == wrong, (text, spans)


def edit_scan(notice, text):
    """Per end position the least number of edits between the notice and a part of the text that ends there."""
    codes = np.array([ord(c) for c in notice])
    col, out = np.arange(len(notice) + 1), []
    steps = np.arange(len(notice) + 1)
    for c in text:
        new = np.minimum(col + 1, np.r_[0, col[:-1] + (codes != ord(c))])
        col = np.minimum.accumulate(new - steps) + steps
        out.append(int(col[-1]))
    return out


def distance(notice, part):
    col = list(range(len(part) + 1))
    for i, a in enumerate(notice, 1):
        diag, col[0] = col[0], i
        for j, b in enumerate(part, 1):
            diag, col[j] = col[j], min(col[j] + 1, col[j - 1] + 1, diag + (a != b))
    return col[-1]


def test_spans_against_a_full_edit_distance_scan():
    rng = random.Random(11)
    scanner = licenses.Scanner()
    notices = list(licenses.NOTICES)

    def edited(notice, most):
        chars = list(notice)
        for _ in range(rng.randint(0, most)):
            at = rng.randrange(len(chars))
            chars[at : at + 1] = rng.choice([[], [rng.choice("aeiou ,")], [chars[at], rng.choice("xyz ")]])
        return "".join(chars)

    seen = 0
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 6)):
            notice = rng.choice(notices)
            parts.append(edited(notice, licenses.edits_allowed(notice) + 1))
            parts.append(rng.choice(["", " ", "; some words between ", " license under the "]))
        text = "".join(parts)
        spans = scanner.spans(text)
        assert all(x[2] <= y[1] for x, y in zip(spans, spans[1:]))
        for label, a, b, edits, size in spans:
            of = [n for n in notices if licenses.NOTICES[n] == label and len(n) == size]
            assert edits <= size * licenses.EDIT_SHARE and edits in {distance(n, text[a:b]) for n in of}
        for notice in notices:
            for end, wrong in enumerate(edit_scan(notice, text), 1):
                if wrong <= licenses.edits_allowed(notice):
                    seen += 1
                    # Every place within the bound meets a span that is no worse.
                    assert any(
                        a < end and b > end - len(notice) - wrong and e / n <= wrong / len(notice) + 1e-9 for _, a, b, e, n in spans
                    ), (notice, end, wrong, text, spans)
    assert seen > 500


def test_time_is_linear_in_repeated_notices():
    scanner = licenses.Scanner()
    took = []
    for n in (400, 6400):
        for notice in ("all rights reservd. ", "all rights reserved. "):
            text = notice * n
            at = time.perf_counter()
            spans = scanner.spans(text)
            took.append(time.perf_counter() - at)
            assert [s[1] for s in spans] == list(range(0, len(text), len(notice)))
    assert took[2] + took[3] < 16 * 5 * (took[0] + took[1])  # 16 times the text; quadratic would be 256 times
