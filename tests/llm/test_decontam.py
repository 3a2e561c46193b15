import random

import pytest
from pyspark.sql import functions as F

from civicflow.llm import decontam
from civicflow.llm.queries import ORACLE_SQL, op7_decontamination
from tools.oracle_check import duck, frame_digest, spark_pdf

from .cases import PASSAGE, ROWS, documents, words


def brute(docs, items, width=5, threshold=0.8):
    def sets(w, k):
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    found = set()
    for doc, text in docs:
        for item, q in items:
            q = words(q)
            k = min(width, len(q))
            if item is None or not k:
                continue
            want = sets(q, k)
            shared = len(want & sets(words(text), k))
            if shared >= threshold * len(want) - 1e-9:
                found.add((doc, item, len(want), shared))
    return found


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    want = duck(path).execute(ORACLE_SQL["op7_decontamination"]).df()
    assert frame_digest(spark_pdf(op7_decontamination(spark, path))) == frame_digest(want)


def test_sketch_loses_no_pair():
    """More shingles can be missing than the threshold allows only if the whole sketch can be missing."""
    for n in range(1, 400):
        missing = max(m for m in range(n + 1) if n - m >= 0.8 * n - 1e-9)
        assert missing < decontam.sketch_size(n, 0.8) <= n


@pytest.mark.parametrize("block", [10**6, 40])
def test_edited_items_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_SHINGLES", block)  # a benchmark too large to be sent
    rng = random.Random(4)
    items = [(k, " ".join(f"v{rng.randint(0, 300)}" for _ in range(rng.randint(1, 60)))) for k in range(25)]
    items += [(90, None), (91, " "), (None, "no id here at all, is it"), (92, items[0][1])]
    docs = []
    for d in range(60):
        body = [f"v{rng.randint(0, 300)}" for _ in range(rng.randint(0, 400))]
        q = words(rng.choice(items[:25])[1])
        q = [w.decode() if rng.random() > rng.choice([0, 0.03, 0.08]) else "edit" for w in q]
        at = rng.randint(0, len(body))
        docs.append((d, " ".join(body[:at] + q + body[at:])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.containment_pairs(documents(spark, docs), bench)
    assert {tuple(r)[:4] for r in got.collect()} == brute(docs, items)


def test_edge_cases(spark):
    bench = spark.createDataFrame([(1, PASSAGE, "x"), (2, "One", "y")], "item_id long, text string, doc_id string")
    rows = decontam.containment_pairs(documents(spark), bench).collect()
    want = brute([(r[0], r[1]) for r in ROWS], [(1, PASSAGE), (2, "One")])
    assert {tuple(r)[:4] for r in rows} == want
    assert {(d, i) for d, i, *_ in want} >= {(5, 2), (6, 2), (11, 1), (12, 1)}
    kept = decontam.decontaminated(documents(spark), bench)
    assert kept.columns == documents(spark).columns
    assert {11, 12, 5, 6}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert kept.where("doc_id is null").count() == 2
    assert decontam.containment_pairs(documents(spark, []), bench).count() == 0
    assert decontam.containment_pairs(documents(spark), bench.limit(0)).count() == 0
    assert decontam.decontaminated(documents(spark), bench.limit(0)).count() == documents(spark).count()


def test_large_benchmark_gives_the_same_rows(spark, sf001, monkeypatch):
    """Joined in Spark or sent to the tasks: same pairs with the same spans, and the same documents stay."""
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    odd = documents(spark).select("doc_id", "text")
    both = docs.select("doc_id", "text").unionByName(odd).withColumn("row", F.lit(1))
    bench = spark.read.parquet(f"{sf001}/benchmark.parquet").select("item_id", "text")
    bench = bench.unionByName(spark.createDataFrame([(-1, PASSAGE), (-2, "One"), (-2, "One")], bench.schema))

    def results():
        pairs = decontam.containment_pairs(both, bench)
        kept = decontam.decontaminated(both, bench)
        assert kept.columns == both.columns
        return pairs.columns, sorted(map(str, pairs.collect())), sorted(map(str, kept.collect()))

    sent = results()
    monkeypatch.setattr(decontam, "BLOCK_SHINGLES", 10)
    assert results() == sent
    assert len(sent[1]) > 5
    empty = documents(spark, [])
    assert decontam.containment_pairs(empty, bench).count() == decontam.decontaminated(empty, bench).count() == 0
