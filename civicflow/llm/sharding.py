"""Sharding by a Feistel permutation over global row numbers (DataFrame functions only).

Every row gets a global number (its rank in the order of id, size and checksum).  A keyed permutation
of 0..n-1 sends the number to a shuffled position; shard = position mod shards and slot = position div
shards.  Both are computable from (n, seed, number) alone, the shuffle is the same on every run and
for every partitioning, and shard sizes differ by at most one row.

The permutation is an alternating Feistel network on pairs (left < a, right < b) with a * b >= n and
a * b - n < a, about the root of n.  Positions that fall outside 0..n-1 are walked on along their
cycle.  How often is not guessed: the chain that the few outside values form is followed in Spark until
it is empty, which gives the number of walks that is enough for every row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir, numbered

ROUNDS = 6


def domain(n: int) -> tuple[int, int]:
    """Sides of the rectangle that holds 0..n-1: a * b >= n with less than a cells to spare."""
    a = max(1, math.isqrt(max(n, 1)))
    return a, -(-max(n, 1) // a)


def feistel(x: Column, n: int, seed: int) -> Column:
    """One application of the keyed permutation of the rectangle's cells."""
    a, b = domain(n)
    left = x % F.lit(a).cast("long")
    right = F.call_function("div", x, F.lit(a).cast("long"))
    for k in range(ROUNDS):
        if k % 2 == 0:
            left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(seed), F.lit(k)), F.lit(a)), F.lit(a))
        else:
            right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(seed), F.lit(k)), F.lit(b)), F.lit(b))
    return left + right * F.lit(a)


def walks_needed(spark: SparkSession, n: int, seed: int) -> int:
    """The longest run of outside cells on any cycle: that many extra steps bring every row inside."""
    a, b = domain(n)
    outside = spark.range(n, a * b)
    steps = 0
    # Each step keeps the cells whose next cell is outside again: about root(n) cells, then ever fewer.
    # A cycle that lies wholly outside is never entered from inside; a run has at most a * b - n cells.
    while steps < a * b - n and not outside.isEmpty():
        steps += 1
        outside = _step(outside, n, seed)
    return steps


def _step(cells: DataFrame, n: int, seed: int) -> DataFrame:
    nxt = cells.select(feistel(F.col("id"), n, seed).alias("id"))
    rows = nxt.where(F.col("id") >= n)
    # Cut the plan: the steps of one loop would otherwise nest.
    return rows.checkpoint()


def permuted(df: DataFrame, number: str, position: str, n: int, seed: int) -> DataFrame:
    """Adds ``position``: the place of row ``number`` in the shuffle of n rows."""
    ensure_checkpoint_dir(df.sparkSession)
    walks = walks_needed(df.sparkSession, n, seed) if n else 0
    df = df.withColumn(position, feistel(F.col(number), n, seed))
    for _ in range(walks):
        df = df.withColumn(
            position,
            F.when(F.col(position) >= n, feistel(F.col(position), n, seed)).otherwise(F.col(position)),
        )
    return df


def shard_documents(documents: DataFrame, shards: int = 16, seed: int = 20240229) -> DataFrame:
    """All rows of ``documents`` (doc_id, text; other columns are ignored) dealt into ``shards`` shards.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; a null text has none), text_crc32, law
    ('rows': shard counts are at most one apart), shard, slot (0.. without gaps in each shard),
    grown_shard (null) and position (the place in the whole shuffle, slot * shards + shard).

    Null ids come first in the numbering; rows with equal id and text are interchangeable, each keeps a
    place of its own.  An empty table gives an empty result.  Texts are read once and never shuffled.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("text_crc32"),
    )
    rows = numbered(rows, ["doc_id", "size", "text_crc32"], "_row")
    n = rows.count()
    rows = permuted(rows, "_row", "position", n, seed)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("position") % shards).cast("int").alias("shard"),
        F.call_function("div", F.col("position"), F.lit(shards).cast("long")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("position").cast("long").alias("position"),
    )
