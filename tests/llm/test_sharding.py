import zlib

from pyspark.sql import functions as F

from civicflow.llm import sharding
from civicflow.llm.queries import op2_sharding

from .cases import ROWS, documents


def result(df):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in df.collect())


def test_rows_law_sizes_and_checksums(spark, sf001):
    rows = op2_sharding(spark, sf001).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    shards = {}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        assert r["position"] == r["slot"] * 16 + r["shard"]
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert set(shards) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1


def test_same_for_any_partitioning_and_seed_matters(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    one = result(sharding.shard_documents(docs))
    assert one == result(sharding.shard_documents(docs.repartition(7, "text")))
    assert one != result(sharding.shard_documents(docs, seed=1))


def test_walks_bring_every_row_inside(spark):
    """Against walking each cell by hand over the table of the rectangle's permutation."""
    for n in (1, 2, 3, 5, 17, 50, 101, 230):
        a, b = sharding.domain(n)
        assert n <= a * b < n + a
        cells = spark.range(a * b).select("id", sharding.feistel(F.col("id"), n, 3).alias("to"))
        to = {r["id"]: r["to"] for r in cells.collect()}
        assert sorted(to.values()) == list(range(a * b))
        want = {}
        for i in range(n):
            x = to[i]
            while x >= n:
                x = to[x]
            want[i] = x
        got = sharding.permuted(spark.range(n), "id", "at", n, 3)
        assert {r["id"]: r["at"] for r in got.collect()} == want


def test_edge_cases(spark):
    rows = sharding.shard_documents(documents(spark), shards=4).collect()
    assert sorted(r["position"] for r in rows) == list(range(len(ROWS)))
    null = [r for r in rows if r["size"] == 1]
    assert {r["text_crc32"] for r in null} == {0} and len(null) == 3
    assert sharding.shard_documents(documents(spark, [])).collect() == []
    assert len(sharding.shard_documents(documents(spark, [(1, "a")])).collect()) == 1
