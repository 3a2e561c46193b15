import math
import random

import pytest

from civicflow.llm import topk

from .sql import same_rows

SCHEMA = "vec_id long, embedding array<double>, label int, score string, row string, part string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], SCHEMA)


def brute(rows, k=5, every=50):
    """By Python's own integers, each row against all others."""

    def weights(v):
        return [math.floor(x) * 256 if abs(x) > 2.0**60 else math.floor(256 * x) for x in v]

    rows = [(i, weights(v)) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(rows):
        if i is None or i % every:
            continue
        all_ = [(min(max(sum(x * y for x, y in zip(v, w)), -(2**63)), 2**63 - 1), j) for b, (j, w) in enumerate(rows) if a != b]
        all_.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(i, r, j, s) for r, (s, j) in enumerate(all_[:k], 1)]
    return sorted(out, key=repr)


def found(df, **options):
    return sorted((tuple(r) for r in topk.top_k(df, **options).collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_equals_sql(spark, sf):
    same_rows(spark, "op13_topk", f"/root/testdata/{sf}")


@pytest.mark.parametrize("block", [7, 4096])
def test_against_every_pair(spark, block):
    """Blocks of any size, negative and sparse components, many copies (ties), rows in any order."""
    rng = random.Random(4)
    rows = [(i, [rng.choice((0.0, 0.0, rng.uniform(-1, 1))) for _ in range(12)]) for i in range(-100, 200)]
    rows += [(1000 + i, list(rows[5][1])) for i in range(150)]
    rng.shuffle(rows)
    assert found(table(spark, rows), block=block) == brute(rows)


def test_nulls_bad_numbers_lengths_and_repeats(spark):
    rows = [
        (0, [1.0, 2.0]), (50, [0.5]), (100, []), (150, None), (200, [1.0, None]), (250, [math.nan]), (300, [math.inf, 1.0]),
        (1, [1.0, 2.0, 3.0]), (2, [-0.001, 0.0]), (None, [9.0, 9.0]), (None, None), (3, [1.0, 2.0]), (50, [0.5]), (50, [0.25, 4.0]),
    ]
    want = brute(rows)
    # A repeated query id has its list once for each of its rows.
    got = found(table(spark, rows))
    assert got == want and len([r for r in got if r[0] == 50]) == 15


def test_scores_beyond_long(spark):
    rows = [(0, [1e300, -1.0]), (50, [-1e300, 2.5]), (1, [1e300, 1e308]), (2, [2.0**62, 1.0]), (3, [0.5, 0.25])]
    assert found(table(spark, rows)) == brute(rows)


def test_few_rows(spark):
    assert found(table(spark, [])) == []
    assert found(table(spark, [(0, [1.0])])) == []
    assert found(table(spark, [(1, [1.0]), (2, [2.0])])) == []
    assert found(table(spark, [(0, [1.0]), (7, [2.0])])) == [(0, 1, 7, 512 * 256)]
