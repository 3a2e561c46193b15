"""Near-duplicate vectors by a forest of random-projection trees.

1. Equal vectors of a label form a class; the class goes on once, with its number of copies.
2. One pass projects every class on ``TREES`` x ``LEVELS`` random directions.
3. Each tree starts from (label, dimension) and splits every node of more than ``LEAF`` classes at the
   median of its level's projection.  Classes within ``SPILL`` of the median, in rank, or within ``REACH``
   of the threshold distance of it go to both sides.  Counts and quantiles are partial aggregates per node,
   so a hot label never meets in one task.
4. A node whose side would keep more than ``WIDEST`` of it is dense: splits would part its pairs.  It is
   dealt into blocks of about ``LEAF`` classes, and each pair of blocks is compared as one leaf.
5. Within a leaf all pairs are compared by exact cosine in double precision, a block of rows at a time.  A
   pair that shares several leaves counts in the first of them only, so links are counted without being
   written out: a leaf gives one row per linked class (its links there and the least class it reaches).
6. The rows are summed to link counts and joined up to components.

A pair at the threshold stays together at one split with a probability of about 0.98 or more, as nodes that
are not much wider than the pair are not split, so four trees miss next to none; the tests measure the recall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .graph import components

THRESHOLD = 0.93
TREES = 4
LEVELS = 40
LEAF = 2048
SPILL = 0.1
#: Least half width of the overlap of two sides, in threshold distances.
REACH = 0.7
#: Largest share of a node that a side may keep; from 1/sqrt(2) on, splits cost more than pairs of blocks.
WIDEST = 0.7
SEED = 11
#: Rows of a leaf compared at a time.
BLOCK = 256


def vector_classes(embeddings: DataFrame) -> DataFrame:
    """vec_id, c1, c2 (digest of label and vector, null if it links with nothing), label, embedding."""
    number = F.col("embedding")
    sound = (
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(number, lambda x: x != 0)
    )
    sound = F.coalesce(sound, F.lit(False))
    key = F.col("label").cast("string")
    return embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(sound, F.xxhash64(key, "embedding")).alias("c1"),
        F.when(sound, F.xxhash64(F.lit(SEED), "embedding", key)).alias("c2"),
        key.alias("label"),
        "embedding",
    )


def projected(classes: DataFrame, trees: int, levels: int) -> DataFrame:
    """rep, node (root of each tree, an array) and projections (trees * levels floats)."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            out = np.empty((batch.num_rows, trees * levels), np.float32)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                x = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d)
                x = x.astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                ways = np.random.default_rng(SEED + int(d)).standard_normal((d, trees * levels))
                out[at] = x @ ways
            ends = np.arange(0, (batch.num_rows + 1) * out.shape[1], out.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("label"), pa.array(sizes.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))],
                names=["rep", "label", "size", "projections"],
            )

    rows = classes.select("rep", "label", "embedding")
    return rows.mapInArrow(project, "rep long, label string, size int, projections array<float>")


def leaves(
    classes: DataFrame, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, threshold: float = THRESHOLD
) -> DataFrame:
    """(node, rep, blocks): the leaves and dense nodes that each class lies in, in every tree."""
    rows = projected(classes, trees, LEVELS).select(
        "rep",
        F.explode(
            F.array(*[
                F.struct(
                    F.xxhash64("label", "size", F.lit(t)).alias("node"),
                    F.xxhash64("label", "size").alias("root"),
                    F.slice("projections", t * LEVELS + 1, LEVELS).alias("p"),
                )
                for t in range(trees)
            ])
        ).alias("at"),
    ).select("rep", "at.node", "at.root", "at.p")
    # Two unit vectors at the threshold are so far apart; on a direction the standard deviation is the same.
    reach = REACH * float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    done = None
    for level in range(LEVELS):
        rows = stored(rows, "tree-level")
        value = F.element_at("p", level + 1)
        cuts = rows.groupBy("node").agg(
            F.count(F.lit(1)).alias("n"),
            F.first("root").alias("root"),
            F.percentile_approx(value, [1 - WIDEST, 0.5 - spill, 0.5, 0.5 + spill, WIDEST], 2000).alias("q"),
        )
        q = F.col("q")
        low, high = F.least(q[1], q[2] - F.lit(reach)), F.greatest(q[3], q[2] + F.lit(reach))
        cuts = cuts.select(
            "node", "n", "root", low.alias("low"), high.alias("high"),
            ((F.col("n") > leaf) & ((low < q[0]) | (high > q[4]))).alias("dense"),
        )
        cuts = stored(cuts, "tree-cuts")
        blocks = F.when(F.col("dense"), F.ceil(F.col("n") / F.lit(leaf))).otherwise(F.lit(1)).cast("long")
        ended = cuts.where((F.col("n") <= leaf) | F.col("dense")).select("node", blocks.alias("blocks"))
        large = cuts.where((F.col("n") > leaf) & ~F.col("dense")).select("node", "low", "high")
        if not level:
            # All trees begin with the same classes: where one root is dense, its pairs need no other tree.
            whole = cuts.where("dense").groupBy("root").agg(F.min("node").alias("only"))
            rows = rows.join(whole, "root", "left").where(F.col("only").isNull() | (F.col("only") == F.col("node")))
            rows = rows.drop("only")
        part = rows.join(ended, "node").select("node", "rep", "blocks")
        done = part if done is None else done.unionByName(part)
        split = rows.join(large, "node").select(
            "rep",
            "root",
            "p",
            F.explode(
                F.array_compact(
                    F.array(
                        F.when(value <= F.col("high"), F.xxhash64("node", F.lit(0))),
                        F.when(value >= F.col("low"), F.xxhash64("node", F.lit(1))),
                    )
                )
            ).alias("node"),
        )
        rows = split.select("rep", "node", "root", "p")
        if large.isEmpty():
            return done
    # Not split in LEVELS levels: compared by pairs of blocks.
    rows = stored(rows, "tree-level")
    sizes = rows.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / F.lit(leaf)).cast("long").alias("blocks"))
    return done.unionByName(rows.join(sizes, "node").select("node", "rep", "blocks"))


def compare_leaf(table: pa.Table, threshold: float) -> pa.Table:
    """rep, links (copies counted) and root of the classes of one leaf, or pair of blocks, that have links.

    Two different blocks are compared with each other only: pairs within a block have a group of their own.
    """
    table = table.sort_by("own")
    rep = table.column("rep").to_numpy()
    copies = table.column("copies").to_numpy()
    node = table.column("node")[0].as_py()
    m = len(rep)
    vectors = table.column("embedding").combine_chunks()
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(m, -1)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
    member = table.column("nodes").combine_chunks()
    at = np.repeat(np.arange(m), member.value_lengths().to_numpy(zero_copy_only=False))
    ids = member.flatten().to_numpy()
    earlier = ids < node
    names, ids = np.unique(ids[earlier], return_inverse=True)
    shares = np.zeros((m, len(names)), np.float32)
    shares[at[earlier], ids] = 1

    links = np.zeros(m, np.int64)
    linked = np.zeros(m, bool)
    root = np.arange(m)  # component so far, as the place of its first member
    same = table.column("low")[0].as_py() == table.column("high")[0].as_py()
    half = m if same else int((table.column("own").to_numpy() == table.column("low")[0].as_py()).sum())
    steps = [(a, min(half, a + BLOCK), 0 if same else half, m) for a in range(0, half, BLOCK)]
    steps += [(a, min(m, a + BLOCK), 0, half) for a in range(half, m, BLOCK)]
    for a, b, c, d in steps:  # rows a to b against rows c to d
        close = (x[a:b] @ x[c:d].T >= threshold) & (label[a:b, None] == label[None, c:d])
        if same:
            close[np.arange(b - a), np.arange(a, b)] = False
        some = np.flatnonzero(close.any(axis=1))
        if not len(some):
            continue
        linked[a + some] = True
        cols = np.flatnonzero(close.any(axis=0))
        first = close[np.ix_(some, cols)] & ~(shares[a + some] @ shares[c + cols].T > 0)
        links[a + some] += first @ copies[c + cols]
        for i in some:
            roots = np.unique(root[np.r_[a + i, c + np.flatnonzero(close[i])]])
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[0]
    least = np.full(m, np.iinfo(np.int64).max)
    np.minimum.at(least, root, rep)
    return pa.table({"rep": rep[linked], "links": links[linked], "root": least[root[linked]]})


def near_vectors(
    embeddings: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF
) -> DataFrame:
    """Links among all rows of ``embeddings`` (vec_id, embedding, label; other columns are ignored).

    Two rows link if their labels are equal and their cosine is at least ``threshold``.  Returns per row
    vec_id, n_links (other rows linked directly), component_id (least id reachable, itself included) and
    kept (vec_id = component_id).  An empty table gives an
    empty result.  Vectors that are null, empty, all zero or hold a null or non-finite
    number, and rows with a null label or id, link with nothing; a null id has a null component and is
    kept.  Rows that share an id share a component.  Vectors of different length never link.
    """
    rows = stored(vector_classes(embeddings), "vectors")
    usable = rows.where(F.col("c1").isNotNull())
    classes = stored(
        usable.groupBy("c1", "c2", "label", "embedding").agg(
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
        ),
        "classes",
    ).withColumn("name", F.col("c1"))
    # A class is known by its digest: two classes may share their least id if ids repeat.
    named = classes.select(F.col("name").alias("rep"), "label", "embedding", "copies")
    places = stored(leaves(named, trees, leaf, threshold=threshold), "leaves")
    nodes = places.groupBy("rep").agg(F.collect_list("node").alias("nodes"))
    full = places.join(named, "rep").join(nodes, "rep")
    # Each pair of blocks is one group; a leaf is a single block.
    full = full.withColumn("own", F.pmod(F.xxhash64("rep"), "blocks"))
    full = full.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    full = full.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def compare(table: pa.Table) -> pa.Table:
        return compare_leaf(table, threshold)

    found = stored(
        full.groupBy("node", "low", "high").applyInArrow(compare, "rep long, links long, root long"), "leaf-links"
    )
    counts = found.groupBy(F.col("rep").alias("c1")).agg(F.sum("links").alias("links"))
    keys = classes.select("c1", "c2", F.col("rep").alias("least"), "copies")
    ids = classes.select(F.col("name"), F.col("rep").alias("least"))
    pairs = (
        found.join(ids.withColumnRenamed("name", "rep").withColumnRenamed("least", "a"), "rep")
        .join(ids.withColumnRenamed("name", "root").withColumnRenamed("least", "b"), "root")
        .select("a", "b")
    )
    own = usable.select("vec_id", "c1", "c2").join(keys, ["c1", "c2"])
    copies = own.where(F.col("vec_id") != F.col("least")).select(F.col("least").alias("a"), F.col("vec_id").alias("b"))
    groups = components(pairs.unionByName(copies)).select(F.col("node").alias("vec_id"), "component")
    per_class = keys.join(counts, "c1", "left").select(
        "c1", "c2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n")
    )
    return (
        rows.select("vec_id", "c1", "c2")
        .join(per_class, ["c1", "c2"], "left")
        .join(groups, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )
