"""MinHash near-duplicates: one-permutation hashing, banded buckets, star-shaped candidates, full check.

1. One pass turns each text into its set of word shingles (64-bit hashes) and a signature: one permutation
   splits the hash space into ``BINS`` bins, each bin keeps its least hash, and empty bins borrow from the
   bin that a shared hash sequence reaches first (optimal densification).
2. Documents with equal sets form a class; only its least id goes on, however many copies there are.
3. ``BANDS`` bands of ``BINS / BANDS`` bins give bucket keys.  In each bucket the least id is the star's
   centre; candidate pairs are (centre, other), so a bucket of m gives m - 1 pairs, not m squared.
4. Candidates of fitting set sizes are confirmed on the full sets, recomputed from whole texts.
5. A star can miss a link between two members that both fail against the centre.  Buckets whose members
   are not yet in one component are finished by comparing the rest in blocks: texts are dealt to pairs of
   blocks, pairs that share a bucket are checked there, and only links come out.
6. Confirmed links and class membership give components.

At a similarity of 0.8 a band of 4 bins agrees with probability 0.41, so 32 bands miss a pair with a
probability of about 5e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import GOLDEN, Words, mix64, plain_texts, slices, stored, text_shingles
from .graph import components

BINS = 128
BANDS = 32
#: Similarity in per cent, a whole number so that the comparison is exact.
PERCENT = 80
#: Members of a block, where all pairs of an unfinished cluster are compared.
BLOCK = 256

SIGNATURE_SCHEMA = "doc_id long, n long, s1 long, s2 long, bands array<long>"


def bin_minima(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Least hash of each bin of a sorted set; the all-ones word marks an empty bin."""
    shift = np.uint64(64 - int(bins).bit_length() + 1)
    where = shingles >> shift
    first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]]) if len(where) else np.empty(0, np.int64)
    out = np.full(bins, np.uint64(0xFFFFFFFFFFFFFFFF))
    out[where[first].astype(np.int64)] = shingles[first]
    return out


def densify(minima: np.ndarray) -> np.ndarray:
    """Fills empty bins of each row: bin j takes the first full bin of the sequence hash(j, 1), hash(j, 2), ..."""
    bins = minima.shape[1]
    full = minima != np.uint64(0xFFFFFFFFFFFFFFFF)
    out = minima.copy()
    todo = ~full & full.any(axis=1)[:, None]
    j = np.arange(bins, dtype=np.uint64)
    attempt = 0
    while todo.any():
        attempt += 1
        probe = (mix64(j * GOLDEN + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        hit = todo & full[:, probe]
        rows, cols = np.nonzero(hit)
        out[rows, cols] = minima[rows, probe[cols]]
        todo &= ~hit
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit bucket key per row and band."""
    n, bins = signature.shape
    parts = signature.reshape(n, bands, bins // bands)
    key = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), (n, bands))
    for k in range(bins // bands):
        key = mix64(key * GOLDEN + parts[:, :, k])
    return key


def signatures(documents: DataFrame, width: int, bins: int = BINS, bands: int = BANDS) -> DataFrame:
    """doc_id, n (set size), s1 and s2 (128-bit digest of the set) and band keys (null for an empty set)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = list(text_shingles(Words(batch.column("text")), width))
            sizes = np.array([len(s) for s in sets], np.int64)
            s1 = np.array([np.add.reduce(mix64(s ^ GOLDEN)) for s in sets], np.uint64)
            s2 = np.array([np.bitwise_xor.reduce(mix64(s + GOLDEN)) for s in sets], np.uint64)
            keys = band_keys(densify(np.stack([bin_minima(s, bins) for s in sets])), bands).astype(np.int64)
            ends = np.arange(0, (len(sets) + 1) * bands, bands, dtype=np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(ends), pa.array(keys.ravel()), mask=pa.array(sizes == 0)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(s1.astype(np.int64)),
                 pa.array(s2.astype(np.int64)), lists],
                names=["doc_id", "n", "s1", "s2", "bands"],
            )

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(sign, SIGNATURE_SCHEMA)


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough; ``texts`` has doc_id and text."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text_b"):
                a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                left = _sets(batch.column("text_a"), width)
                right = _sets(batch.column("text_b"), width)
                good = np.zeros(len(a), bool)
                for k, (x, y) in enumerate(zip(left, right)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good[k] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(a, np.int64)[good]), pa.array(np.array(b, np.int64)[good])], names=["a", "b"]
                )

    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b").mapInArrow(
        check, "a long, b long"
    )


def _sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Shingle sets of a column of texts; a text that repeats in it (a star's centre) is cut up once."""
    coded = plain_texts(texts).dictionary_encode()
    sets = []
    for piece in slices([pa.RecordBatch.from_arrays([coded.dictionary], names=["text"])], "text"):
        sets.extend(text_shingles(Words(piece.column("text")), width))
    return [sets[i] for i in coded.indices.to_pylist()]


def similar_sizes(x, y, percent: int):
    """Sets of these sizes can reach the similarity at all."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def near_duplicates(documents: DataFrame, width: int, percent: int = PERCENT) -> DataFrame:
    """Groups of near-duplicates among all rows of ``documents`` (doc_id, text; other columns are ignored).

    Returns per row doc_id, n_shingles, component_id (least id reachable over links of similarity
    ``percent`` / 100 or more, itself included) and kept (doc_id = component_id).

    Null and empty texts have no shingles and link with nothing; a text of fewer than ``width`` words is
    one shingle.  Rows that share an id are one document: their links are pooled.  A null id links with
    nothing: its component is null and it is kept.  An empty table gives an empty result.
    """
    signed = stored(signatures(documents, width), "signatures")
    usable = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = stored(usable.groupBy("s1", "s2", "n", "bands").agg(F.min("doc_id").alias("rep")), "classes")
    copies = (
        usable.select("doc_id", "s1", "s2", "n")
        .join(classes.select("s1", "s2", "n", "rep"), ["s1", "s2", "n"])
        .where(F.col("doc_id") != F.col("rep"))
        .select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    )
    groups = linked_groups(classes, stored(copies, "copies"), documents, width, percent)
    return (
        signed.select("doc_id", "n")
        .join(groups.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def linked_groups(classes: DataFrame, copies: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame:
    """node, component over all confirmed links between class representatives and over ``copies`` (a, b)."""
    rows = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    heads = rows.groupBy("bucket").agg(
        F.min("rep").alias("head"), F.min_by("n", "rep").alias("head_n"), F.count(F.lit(1)).alias("size")
    )
    shared = stored(rows.join(heads.where("size > 1").drop("size"), "bucket"), "buckets")

    # Texts of documents that share a bucket, taken out of the table once for all rounds.
    wanted = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = stored(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").hint("merge").join(wanted, "doc_id", "left_semi"),
        "candidate-texts",
    )
    pairs = stored(
        shared.where((F.col("rep") != F.col("head")) & similar_sizes(F.col("n"), F.col("head_n"), percent))
        .select(F.col("head").alias("a"), F.col("rep").alias("b"))
        .distinct(),
        "pairs",
    )
    links = stored(confirmed(pairs, texts, width, percent), "links")
    groups = components(links.unionByName(copies))

    # Centres have been compared with all of their bucket; the others of an unfinished bucket have not.
    rest = shared.where(F.col("rep") != F.col("head")).select("bucket", "rep", "n")
    rest = stored(_unfinished(rest, groups), "unfinished")
    if rest.isEmpty():
        return groups
    more = stored(compared_in_blocks(rest, texts, width, percent), "links")
    return components(links.unionByName(copies).unionByName(more))


def _unfinished(rest: DataFrame, groups: DataFrame) -> DataFrame:
    """bucket, rep, n, component and near (the bucket's least component) of buckets that hold different ones."""
    rest = rest.join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "bucket", "rep", "n", F.coalesce("component", "rep").alias("component")
    )
    mixed = (
        rest.groupBy("bucket")
        .agg(F.min("component").alias("near"), F.max("component").alias("most"))
        .where("near < most")
        .drop("most")
    )
    return rest.join(mixed, "bucket")


def compared_in_blocks(rest: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links among members that share a bucket and are in different components, found without listing pairs.

    Components that share a bucket form a cluster.  A cluster is dealt into blocks of about ``BLOCK`` members,
    each pair of blocks is one group, so a member travels once per block of its cluster.
    """
    clusters = components(rest.select(F.col("component").alias("a"), F.col("near").alias("b")))
    clusters = clusters.select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    members = rest.groupBy("rep").agg(
        F.first("n").alias("n"), F.first("component").alias("component"), F.collect_set("bucket").alias("buckets")
    )
    members = stored(members.join(clusters, "component"), "members")
    sizes = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    members = members.join(sizes, "cluster")
    members = members.withColumn("own", F.pmod(F.xxhash64("rep"), "blocks"))
    members = members.join(texts.select(F.col("doc_id").alias("rep"), "text"), "rep")
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def compare(table: pa.Table) -> pa.Table:
        return compare_blocks(table, width, percent)

    fields = ["cluster", "low", "high", "own", "rep", "n", "component", "buckets", "text"]
    return dealt.select(*fields).groupBy("cluster", "low", "high").applyInArrow(compare, "a long, b long")


def compare_blocks(table: pa.Table, width: int, percent: int) -> pa.Table:
    """Links (a, b) of one pair of blocks."""
    rep, component, own = (table.column(c).to_numpy() for c in ("rep", "component", "own"))
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    sets = _sets(table.column("text").combine_chunks(), width)
    sizes = np.array([len(x) for x in sets])
    ends = np.r_[0, np.cumsum(sizes)]
    names, ids = np.unique(np.concatenate(sets), return_inverse=True)
    flag = np.zeros(len(names) + 1, bool)
    lists = table.column("buckets").combine_chunks()
    bucket_names, bucket = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    bucket_ends = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]
    mark = np.zeros(len(bucket_names), bool)
    a, b = [], []
    for x in range(len(rep)):
        mark[:] = False
        mark[bucket[bucket_ends[x] : bucket_ends[x + 1]]] = True
        near = np.logical_or.reduceat(mark[bucket], bucket_ends[:-1])
        near &= (rep > rep[x]) & (component != component[x])
        near &= 100 * np.minimum(sizes, sizes[x]) >= percent * np.maximum(sizes, sizes[x])
        if low != high:  # pairs within a block have a group of their own
            near &= own != own[x]
        if not near.any():
            continue
        flag[:] = False
        flag[ids[ends[x] : ends[x + 1]]] = True
        both = np.add.reduceat(np.r_[flag[ids], False].astype(np.int64), ends[:-1])
        good = np.flatnonzero(near & (both > 0) & (100 * both >= percent * (sizes + sizes[x] - both)))
        a.extend([rep[x]] * len(good))
        b.extend(rep[good])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def keep_one_of_each(documents: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents``, all columns, without all but the least id of each near-duplicate group.

    Of rows that share an id one stays (the one with the least text); rows with a null id all stay.
    """
    drop, place = "_near_dup_id", "_near_dup_place"
    gone = near_duplicates(documents, width, percent).where(~F.col("kept")).select(F.col("doc_id").alias(drop))
    left = documents.join(gone.distinct(), F.col("doc_id").cast("long") == F.col(drop), "left_anti")
    ranked = left.where(F.col("doc_id").isNotNull()).withColumn(
        place, F.row_number().over(Window.partitionBy(F.col("doc_id").cast("long")).orderBy(F.col("text").asc_nulls_last()))
    )
    return ranked.where(F.col(place) == 1).drop(place).unionByName(left.where(F.col("doc_id").isNull()))
