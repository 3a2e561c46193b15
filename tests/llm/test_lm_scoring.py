import collections
import math
import zlib

import numpy as np
import pytest

from civicflow.llm import lm_scoring

from .cases import ROWS, documents, words


def brute(docs, weights):
    """Counts by plain loops, scores from the definition."""
    one, two, context = collections.Counter(), collections.Counter(), collections.Counter()
    total = 0
    part = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 7
    tokens = [(i, words(t) + [None]) for i, t in docs]
    for i, w in tokens:
        if part(i) != 2:
            one.update(w)
            two.update(zip([0] + w[:-1], w))
            context.update([0] + w[:-1])
            total += len(w)
    v = len(one)

    def chance(a, b):
        f = context[a]
        l2, l1, l0 = weights[min(f.bit_length(), lm_scoring.CONTEXT_BUCKETS - 1)]
        return l2 * (two[a, b] / f if f else 0) + l1 * (one[b] / total if total else 0) + l0 / (v + 1)

    out = []
    for i, w in tokens:
        base = sum(math.log10((one[t] + 1) / (total + v + 1)) for t in w)
        own = sum(math.log10(chance(a, b)) for a, b in zip([0] + w[:-1], w))
        out.append((i, part(i) == 2, len(w), sum(one[t] > 0 for t in w), total, base, own))
    return out, one, context, chance


def compare(rows, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got = sorted((tuple(r) for r in rows), key=key)
    want = sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("entries", [10**6, 9_000])
def test_whole_table_by_plain_counting(spark, sf001, entries):
    table = spark.read.parquet(f"{sf001}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in table.collect()]
    model = lm_scoring.train(table, entries)
    want, one, context, chance = brute(docs, model.weights)
    rows = lm_scoring.score_documents(table, entries).collect()
    compare(rows, want)
    assert np.allclose(model.weights.sum(axis=1), 1) and (model.weights >= 0).all() and (model.weights[:, 2] > 0).all()
    # Each context has a distribution: all known words and one unknown sum to one.
    for a in [0, "the".encode(), b"never seen", *list(context)[:5]]:
        assert math.isclose(sum(chance(a, b) for b in one) + chance(a, b"never seen either"), 1, rel_tol=1e-9)
    # Better than the add-one words on held-out texts.
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_em_learns_the_mixture():
    """Events drawn from a known mixture: the weights come back."""
    rng = np.random.default_rng(0)
    side = 2 * lm_scoring.CELLS * lm_scoring.OCTAVES + 2
    pair, word, uniform = 0.3, 0.01, 1 / 10_001
    kinds = [(pair, word), (0.0, word), (pair, 0.0), (0.0, 0.0)]
    likelihood = lambda w: sum(n * math.log(w[0] * p + w[1] * q + w[2] * uniform) for (p, q), n in zip(kinds, counts))
    counts = rng.integers(50, 500, 4).tolist()
    rows = [{"cell": 3 * side * side + k, "n": float(n), "pair": p * n, "word": q * n} for k, ((p, q), n) in enumerate(zip(kinds, counts))]
    got = lm_scoring.learn_weights(rows, 10_000)[3]
    grid = [(a, b, 1 - a - b) for a in np.linspace(0, 1, 101) for b in np.linspace(0, 1, 101) if a + b < 1]
    assert likelihood(got) >= max(map(likelihood, grid)) - 1e-3


def test_edge_cases(spark):
    rows = lm_scoring.score_documents(documents(spark)).collect()
    model = lm_scoring.train(documents(spark))
    compare(rows, brute(ROWS, model.weights)[0])
    assert lm_scoring.score_documents(documents(spark, [])).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (only,) = lm_scoring.score_documents(documents(spark, [(held, "nothing learned")])).collect()
    assert (only["n_tokens"], only["n_known"], only["train_tokens"], only["base_score"], only["score"]) == (3, 0, 0, 0.0, 0.0)
