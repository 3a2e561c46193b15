import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from civicflow.llm import merkle

from .cases import ROWS, documents
from .sql import same_rows


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        row = out[-1]
        out.append([h("".join(row[i : i + 2])) for i in range(0, len(row), 2)])
    return out


def siblings(rows, i):
    path = []
    for row in rows[:-1]:
        pair = row[i - i % 2 : i - i % 2 + 2]
        path.append((pair[1 - i % 2] if len(pair) > 1 else None, i % 2 == 1))
        i //= 2
    return path


def postorder(n):
    """Nodes of a tree of n leaves by walking it."""
    made = []

    def visit(level, index):
        if level:
            for child in (2 * index, 2 * index + 1):
                if child << (level - 1) < n:
                    visit(level - 1, child)
        made.append((level, index))

    visit(merkle.top_level(n), 0)
    return made


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    same_rows(spark, "op12_manifest", f"/root/testdata/{sf}")


def test_positions_are_the_postorder():
    for n in range(1, 140):
        assert [merkle.position(level, index, n) for level, index in postorder(n)] == list(range(len(postorder(n))))


def test_builders_write_in_completion_order():
    for n in (1, 2, 3, 7, 8, 9, 37):
        digests = [h(str(i)) for i in range(n)]
        made = list(merkle.completed(digests, 0, n, 0, 10))
        assert [x[:2] for x in made] == postorder(n)
        assert made[-1][2] == levels(digests)[-1][0]


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_trees_of_all_sizes(spark, bits):
    """Log, tops and paths of 40 trees of 1 to 40 leaves, a lone one and one of 600, built in one go."""
    rows = [(t, n, i, h(f"{t}/{i}")) for t, n in [*((k, k) for k in range(1, 41)), (600, 600)] for i in range(n)]
    random.Random(2).shuffle(rows)
    leaves = spark.createDataFrame(rows, "tree long, n long, idx long, digest string")
    rounds = merkle.append_log(leaves, bits)
    trees = {t: levels([h(f"{t}/{i}") for i in range(n)]) for t, n, *_ in rows}
    assert {r["tree"]: r["digest"] for r in merkle.tops(rounds).collect()} == {t: v[-1][0] for t, v in trees.items()}
    above = merkle.tops(rounds).select("tree", F.array().cast(merkle.PATH).alias("path"))
    paths = merkle.with_paths(leaves, rounds, above, bits).collect()
    assert len(paths) == len(rows)
    for r in paths:
        assert [tuple(s) for s in r["path"]] == siblings(trees[r["tree"]], r["idx"])
    # Every node of a tree is in the log once, at its own place; builders above the first list their base again.
    for tree in (1, 7, 40, 600):
        log = {r["pos"]: (r["level"], r["idx"]) for d in rounds for r in d.where(F.col("tree") == tree).collect()}
        assert [log[k] for k in sorted(log)] == postorder(len(trees[tree][0])) and min(log) == 0


def brute(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, more=0):
        n = None if r["n_chars"] is None else r["n_chars"] + more
        return h("".join(map(field, (r["doc_id"], r["source"], r["lang"], n, r["text"]))))

    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = {
        x: sorted((r for r in rows if r["lang"] == x), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for x in langs
    }
    trees = {x: levels([leaf(r) for r in order[x]]) for x in langs}
    crown = levels([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, r in enumerate(order[x]):
            path = siblings(trees[x], i) + siblings(crown, k)
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            top = leaf(r, int(bad))
            for digest, left in path:
                top = h((digest or "") + top if left else top + (digest or ""))
            proof = h("".join(d for d, _ in path if d))
            out.append((r["doc_id"], leaf(r), trees[x][-1][0], crown[-1][0], proof, top, top == crown[-1][0]))
    return sorted(out, key=repr)


def test_nulls_ties_repeats_and_many_languages(spark):
    rng = random.Random(5)
    base = documents(spark).collect()
    rows = [{**r.asDict(), "lang": rng.choice([None, "", "de", "é", "z"]), "n_chars": rng.choice([None, 0, 2**63 - 1])} for r in base * 3]
    rows += [{**rows[0], "doc_id": i, "text": f"t{i}", "lang": "en" if i % 3 else f"only {i}"} for i in range(100, 230)]
    df = spark.createDataFrame(rows, documents(spark).schema)
    got = merkle.verify_manifest(df).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    # Tampered rows fail, but for those without n_chars; no other does.
    assert {r["verified"] for r in got} == {True, False}


def test_empty_and_single(spark):
    assert merkle.verify_manifest(documents(spark, [])).collect() == []
    (one,) = merkle.verify_manifest(documents(spark, [(3, "a")])).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof_sha256"] == h("")
    assert len(merkle.verify_manifest(documents(spark)).collect()) == len(ROWS)
