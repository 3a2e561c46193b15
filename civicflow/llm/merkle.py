"""A manifest of the corpus as Merkle trees, kept as a postorder append log.

A tree is over leaves 0 .. n - 1.  Node (level, index) stands over leaves index * 2^level and on; its digest is
the hash of its children's digests, of a lone child's digest where the second is missing, up to the one node
of the top level.  The log lists a tree's nodes in the order in which they are complete: a node follows its
children, and a subtree fills one run of positions.  So the position of any node follows from sizes alone
(``position``), and a sibling is found in the log without a search.

Builders are aligned: one takes 2^BITS consecutive nodes of a level (the last of a tree fewer), writes them
and all nodes above them, up to BITS levels, in completion order, and hands its last node on to the builder
above.  Rounds of builders follow until every tree has its top; their number grows with the logarithm of the
largest tree.  Trees may be many and of any size; a hot one is many builders.

Proofs are taken from the top down: a builder's part of the log has the siblings of all its nodes, at the
positions of a tree over its base level, counted from its first node; the path above its last node is the one
that the round above found.

Manifest of documents: one tree for every ``lang`` (leaves in the order of doc_id), and one tree over their
tops, in the order of ``lang`` (null first, then bytewise).  Rows that repeat a doc_id stand in the order of
their leaf digests; a null doc_id comes first in its tree and counts as not tampered with.  Null fields have
their own mark in the leaf, so null and empty text differ.  An empty table gives no rows and has no root.
Columns beyond the five are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_remainder, numbered, stored

BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree long, n long, block long, pos long, level int, idx long, digest string, top boolean"
#: One step of a path, from the leaf up: the sibling's digest (null: none) and whether it stands on the left.
PATH = T.ArrayType(T.StructType([T.StructField("digest", T.StringType()), T.StructField("left", T.BooleanType())]))


# --- one tree ---------------------------------------------------------------------------------------


def top_level(n: int) -> int:
    """Level of the last node of a tree of n leaves."""
    return (n - 1).bit_length()


def position(level: int, index: int, n: int) -> int:
    """Place of a node in the log of a tree of n leaves.

    All subtrees before it are full: ``start`` leaves have 2 start - popcount(start) complete nodes.  Its own
    subtree follows, a level of ``width`` leaves halving (rounded up) at each step, and it is the last of it.
    """
    start = index << level
    width = min(1 << level, n - start)
    return 2 * start - start.bit_count() + sum(-(-width >> j) for j in range(level + 1)) - 1


def completed(digests: list[str], first: int, n: int, base: int, bits: int) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) of a builder's nodes in the order in which they are complete.

    ``digests`` are the nodes ``first`` and on of level ``base``.
    """
    highest = min(base + bits, top_level(n))
    waiting: dict[int, str] = {}
    for index, digest in enumerate(digests, first):
        level = base
        yield level, index, digest
        while level < highest:
            last = index == (n - 1) >> level
            if index & 1:
                digest = _hash(waiting.pop(level) + digest)
            elif last:
                digest = _hash(digest)
            else:
                waiting[level] = digest
                break
            level, index = level + 1, index >> 1
            yield level, index, digest


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- builders ---------------------------------------------------------------------------------------


def _builder(base: int, bits: int):
    def build(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("idx")
        tree, n, block = (nodes[c][0].as_py() for c in ("tree", "n", "block"))
        made = list(completed(nodes["digest"].to_pylist(), nodes["idx"][0].as_py(), n, base, bits))
        level, idx, digest = zip(*made)
        same = lambda x: pa.array(np.full(len(made), x, np.int64))
        return pa.table(
            {
                "tree": same(tree),
                "n": same(n),
                "block": same(block),
                "pos": pa.array([position(a, b, n) for a, b in zip(level, idx)], pa.int64()),
                "level": pa.array(level, pa.int32()),
                "idx": pa.array(idx, pa.int64()),
                "digest": pa.array(digest, pa.string()),
                "top": pa.array([a == top_level(n) for a in level]),
            }
        )

    return build


def append_log(leaves: DataFrame, bits: int = BITS) -> list[DataFrame]:
    """The logs of all trees of ``leaves`` (tree, n, idx, digest), one stored table for each round of builders."""
    largest = leaves.agg(F.max("n")).first()[0] or 1
    rounds: list[DataFrame] = []
    nodes = leaves.select("tree", "n", "idx", "digest")
    while True:
        base = bits * len(rounds)
        blocks = nodes.withColumn("block", F.shiftright("idx", bits)).groupBy("tree", "block")
        rounds.append(stored(blocks.applyInArrow(_builder(base, bits), NODE), f"log-{len(rounds)}"))
        if largest <= 1 << (base + bits):
            return rounds
        handed_on = ~F.col("top") & (F.col("level") == base + bits)
        nodes = rounds[-1].where(handed_on).select("tree", "n", "idx", "digest")


def tops(rounds: list[DataFrame]) -> DataFrame:
    """tree, digest of the last node of every tree."""
    return reduce(DataFrame.unionByName, [r.where("top").select("tree", "digest") for r in rounds])


# --- proofs -----------------------------------------------------------------------------------------


def _finder(base: int, bits: int, schema: T.StructType):
    def find(nodes: pa.Table, log: pa.Table) -> pa.Table:
        if not len(nodes):
            return _with_path(nodes, [], schema)
        log = log.sort_by("pos")
        above, digests = log["above"][0].as_py(), log["digest"].to_pylist()[1:]
        n, first = nodes["n"][0].as_py(), nodes["block"][0].as_py() << bits
        highest = min(base + bits, top_level(n))
        n_base = (n - 1 >> base) + 1  # the builder's nodes are those of a tree over the nodes of its base level
        start = position(0, first, n_base)
        paths = []
        for index in nodes["idx"].to_pylist():
            path = []
            for level in range(base, highest):
                sibling = index ^ 1
                missing = sibling > (n - 1) >> level
                digest = None if missing else digests[position(level - base, sibling, n_base) - start]
                path.append({"digest": digest, "left": bool(index & 1)})
                index >>= 1
            paths.append(path + above)
        return _with_path(nodes, paths, schema)

    return find


def _with_path(nodes: pa.Table, paths: list, schema: T.StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_type

    kept = nodes.select([f.name for f in schema.fields[:-1]])
    return kept.append_column("path", pa.array(paths, to_arrow_type(schema["path"].dataType)))


def with_paths(leaves: DataFrame, rounds: list[DataFrame], above: DataFrame, bits: int = BITS) -> DataFrame:
    """``leaves`` (tree, n, idx and more) with the path of each, followed by the path ``above`` (tree, path) its tree."""
    paths = None
    for k in reversed(range(len(rounds))):
        base, log = bits * k, rounds[k]
        ended = log.where("top").select("tree", "block").join(above, "tree")
        if paths is not None:
            ended = ended.unionByName(paths.select("tree", F.col("idx").alias("block"), "path"))
        # The path above a builder travels as the first entry of its part of the log.
        entry = lambda pos, digest, path: ["tree", "block", pos, digest, path]
        part = log.select(*entry("pos", "digest", F.lit(None).cast(PATH).alias("above"))).unionByName(
            ended.select(*entry(F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"), F.col("path").alias("above")))
        )
        nodes = leaves if k == 0 else rounds[k].where(F.col("level") == base).select("tree", "n", "idx").toDF("tree", "n", "idx")
        schema = T.StructType([*nodes.schema.fields, T.StructField("path", PATH)])
        paths = (
            nodes.withColumn("block", F.shiftright("idx", bits))
            .groupBy("tree", "block")
            .cogroup(part.toDF(*part.columns).groupBy("tree", "block"))
            .applyInArrow(_finder(base, bits, schema), schema)
        )
    return paths


def folded(leaf: Column, path: Column) -> Column:
    """The top that follows from a leaf and its path."""
    step = lambda acc, s: F.sha2(
        F.when(s["left"], F.concat(F.coalesce(s["digest"], F.lit("")), acc)).otherwise(
            F.concat(acc, F.coalesce(s["digest"], F.lit("")))
        ),
        256,
    )
    return F.aggregate(path, leaf, step)


def proof_digest(path: Column) -> Column:
    """Hash of a path's siblings, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: s["digest"]), ""), 256)


# --- documents --------------------------------------------------------------------------------------


def leaf_digest(**changed: Column) -> Column:
    """Hash of a row's fields: ``-`` for null, else the length in bytes, ``:`` and the value."""

    def field(name: str) -> Column:
        text = changed.get(name, F.col(name)).cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[field(c) for c in FIELDS]), 256)


def manifest(docs: DataFrame, tampered: Column | None = None, bits: int = BITS) -> DataFrame:
    """doc_id, leaf, subroot, root, path, checked (the leaf that is verified).

    ``tampered`` says whose n_chars is raised by one before verifying; trees and paths are of the rows as they are.
    """
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    checked = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf_digest(n_chars=more))
    rows = docs.select("doc_id", "lang", leaf_digest().alias("digest"), checked.alias("checked"))
    rows = numbered(rows, ["lang", "doc_id", "digest"], "place")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    trees = stored(numbered(sizes, ["lang"], "tree"), "trees")
    known = trees.withColumnRenamed("lang", "tree_lang")
    leaves = rows.join(known, F.col("lang").eqNullSafe(F.col("tree_lang"))).select(
        "tree", "n", (F.col("place") - F.col("first")).alias("idx"), "doc_id", "digest", "checked"
    )
    log = append_log(leaves, bits)
    subroots = tops(log)
    n_trees = trees.count()
    joined = subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("idx"), "digest")
    crown = append_log(joined, bits)
    root = tops(crown).first()
    no_more = joined.sparkSession.createDataFrame([(0, [])], T.StructType([T.StructField("tree", T.LongType()), T.StructField("path", PATH)]))
    above = with_paths(joined, crown, no_more, bits).select(F.col("idx").alias("tree"), F.col("digest").alias("subroot"), "path")
    above = stored(above, "above")
    found = with_paths(leaves, log, above.select("tree", "path"), bits)
    return found.join(above.select("tree", "subroot"), "tree").select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"),
        "path",
        F.coalesce("checked", "digest").alias("checked"),
    )


def verify_manifest(docs: DataFrame, modulus: int = 7) -> DataFrame:
    """The manifest's digests, and whether each row still folds to the root when every row whose
    crc32(doc_id) the modulus divides has been tampered with."""
    tampered = F.col("doc_id").isNotNull() & (id_remainder(F.col("doc_id"), modulus) == 0)
    made = manifest(docs, tampered)
    return made.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("checked"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
