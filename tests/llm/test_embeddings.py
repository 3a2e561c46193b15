import numpy as np

from civicflow.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, n string, node string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y") for i, v, label in rows], SCHEMA)


def brute(rows, threshold=0.93):
    def sound(v, label, i):
        return v and label is not None and i is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = []
    for i, v, label in rows:
        x = np.array(v, np.float32).astype(np.float64) if sound(v, label, i) else None
        unit.append(None if x is None else x / np.linalg.norm(x))
    links = [0] * len(rows)
    up = {i: i for i, _, _ in rows if i is not None}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            x, y = unit[a], unit[b]
            if x is None or y is None or rows[a][2] != rows[b][2] or len(x) != len(y) or x @ y < threshold:
                continue
            links[a] += 1
            links[b] += 1
            p, q = sorted((find(rows[a][0]), find(rows[b][0])))
            up[q] = p
    return [(i, n, find(i) if i is not None else None) for (i, _, _), n in zip(rows, links)]


def groups(rng, sizes, dims=16, spread=0.06):
    rows = []
    for g, size in enumerate(sizes):
        centre = rng.normal(size=dims)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            rows.append((centre + spread * rng.normal(size=dims)).astype(np.float32).tolist())
    return rows


def test_recall_and_precision_with_splits(spark):
    rng = np.random.default_rng(1)
    vectors = groups(rng, [1] * 300 + [2] * 60 + [8] * 20 + [60])
    rows = [(k, v, k % 2) for k, v in enumerate(vectors)]
    want = brute(rows)
    got = {r["vec_id"]: r for r in embeddings.near_vectors(table(spark, rows), leaf=100).collect()}
    found, all_links = sum(r["n_links"] for r in got.values()), sum(n for _, n, _ in want)
    assert all_links > 500 and found >= 0.97 * all_links
    assert all(got[i]["n_links"] <= n for i, n, _ in want)
    assert np.mean([got[i]["component_id"] == c for i, _, c in want]) >= 0.99


def test_exact_without_splits_copies_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    vectors = groups(rng, [1] * 20 + [5] * 6)
    rows = [(100 + k, v, 1) for k, v in enumerate(vectors)]
    rows += [(1000 + k, vectors[0], 1) for k in range(40)]  # copies
    rows += [(2000, vectors[0], 2), (2001, vectors[0], None), (2002, None, 1), (2003, [], 1), (2004, [0.0] * 16, 1)]
    rows += [(2005, [float("nan")] + vectors[0][1:], 1), (2006, [float("inf")] + vectors[0][1:], 1), (2007, vectors[0][:8], 1)]
    rows += [(2008, [None] + vectors[0][1:], 1), (None, vectors[0], 1), (2009, [x * 3e30 for x in vectors[1]], 1), (2010, [x * 1e-30 for x in vectors[1]], 1)]
    got = embeddings.near_vectors(table(spark, rows)).collect()
    assert sorted(str((r["vec_id"], r["n_links"], r["component_id"])) for r in got) == sorted(str(w) for w in brute(rows))
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in got)
    assert embeddings.near_vectors(table(spark, [])).collect() == []


def test_dense_groups_larger_than_a_leaf(spark):
    """Groups whose members nearly all link, alone in a label and among other vectors, against all pairs."""
    rng = np.random.default_rng(3)
    dims, spread = 64, 0.2 / 8  # nearly all pairs of a group link
    rows = [(k, v, 1) for k, v in enumerate(groups(rng, [700], dims, spread))]
    mixed = groups(rng, [400, 250] + [1] * 500, dims, spread)
    rows += [(10_000 + k, v, 2) for k, v in enumerate(mixed)]
    got = {r["vec_id"]: r for r in embeddings.near_vectors(table(spark, rows), leaf=100).collect()}
    for label, least in ((1, 1.0), (2, 0.99)):
        ids = [i for i, _, k in rows if k == label]
        x = np.array([v for _, v, k in rows if k == label], np.float32).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        want = (x @ x.T >= embeddings.THRESHOLD).sum(axis=1) - 1
        found = np.array([got[i]["n_links"] for i in ids])
        assert (found <= want).all() and found.sum() >= least * want.sum() > 100_000
