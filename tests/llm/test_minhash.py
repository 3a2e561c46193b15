import random

import numpy as np
import pytest

from civicflow.llm import graph, minhash
from civicflow.llm.queries import op3_minhash

from .cases import ROWS, documents, words


def shingles(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(docs, width, percent=80):
    """doc_id -> component over ids; every pair compared."""
    sets = [(i, shingles(t, width)) for i, t in docs if i is not None]
    up = {i: i for i, _ in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                p, q = sorted((find(a), find(b)))
                up[q] = p
    return {i: find(i) for i in up}


def check(rows, docs, width):
    want = brute(docs, width)
    sizes = sorted(str((i, len(shingles(t, width)))) for i, t in docs)
    assert sorted(str((r["doc_id"], r["n_shingles"])) for r in rows) == sizes
    for r in rows:
        i = r["doc_id"]
        assert r["component_id"] == (want[i] if i is not None else None)
        assert r["kept"] == (i is None or want[i] == i)


def test_whole_table_against_all_pairs(spark, sf001):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()]
    check(op3_minhash(spark, sf001).collect(), docs, 4)


def edited(rng, text, share):
    return [w if rng.random() > share else f"e{rng.randint(0, 10**9)}" for w in text]


@pytest.mark.parametrize("block", [256, 7])
def test_links_that_a_star_misses(spark, monkeypatch, block):
    """Copies of one original that resemble it but not each other; the least id is a copy."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(2)
    docs = []
    for group in range(4):
        original = [f"g{group}w{k}" for k in range(400)]
        docs.append((1000 + group, " ".join(original)))
        for k in range(12):
            # One block of shingles changed per copy: 0.86 to the original, about 0.74 to each other.
            at = 30 * k
            docs.append((group * 100 + k, " ".join(original[:at] + [f"x{group}y{k}z{j}" for j in range(27)] + original[at + 27 :])))
    docs += [(5000 + k, " ".join(edited(rng, [f"q{j}" for j in range(200)], 0.02))) for k in range(15)]
    rows = minhash.near_duplicates(documents(spark, docs), 4).collect()
    check(rows, docs, 4)
    assert len({r["component_id"] for r in rows if r["doc_id"] < 400 or 1000 <= r["doc_id"] < 1004}) == 4


def test_many_copies_and_small_sets(spark):
    docs = [(k, "the same seven words in every row") for k in range(300)]
    docs += [(1000 + k, " ".join(f"t{j}" for j in range(k % 7))) for k in range(60)]
    check(minhash.near_duplicates(documents(spark, docs), 4).collect(), docs, 4)


def test_edge_cases(spark):
    # The rows that share id 13 are one document, as the all-pairs version has it by id.
    check(minhash.near_duplicates(documents(spark), 4).collect(), ROWS, 4)
    assert minhash.near_duplicates(documents(spark, []), 5).collect() == []
    assert minhash.near_duplicates(documents(spark, [(1, None), (2, "")]), 5).count() == 2
    kept = minhash.keep_one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [-5, 0, 2, 3, 4, 5, 7, 8, 9, 10, 11, 12, 13, 14] and ids.count(None) == 2


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    a, b = np.sort(x[:1800]), np.sort(x[200:])
    sig = minhash.densify(np.stack([minhash.bin_minima(s) for s in (a, b)]))
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.15
    one = minhash.densify(np.stack([minhash.bin_minima(np.sort(x[:k])) for k in (1, 3, 0)]))
    assert len(set(one[0])) == 1 and len(set(one[1])) == 3 and (one[2] == np.uint64(2**64 - 1)).all()


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(300, 900)] + [(900, 8), (8, 7), (5, 5)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 161)) and all(got[k] == 7 for k in (7, 8, *range(300, 901)))
    assert len(got) == 61 + 603
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
