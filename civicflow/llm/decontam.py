"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification.

Items are short, documents may be very long, so Jaccard similarity says little; what counts is the share
of an item's shingles that a document contains.  Items are partitioned by size (shingle count, powers of
two).  Each partition has its own sketch length: the bottom-k MinHash sketch of an item (its k smallest
hashes) with k = largest size of the partition * (1 - threshold) + 1.  A document that contains at least
``threshold`` of an item misses fewer than k of its shingles, so at least one sketch hash is among the
document's shingles: the search loses no pair.  Candidates are then verified on the full sets.

A benchmark of at most ``BLOCK_SHINGLES`` shingle hashes (checked before it is sent) goes to the tasks as
one block, and the documents are read once and never shuffled.  A larger one stays in Spark: the documents'
shingle hashes are joined with the sketches, and each candidate's shared shingles are counted by a join
with the item's full set, both spread by hash; no text travels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, mix64, shingle_hashes, slices, stored

WIDTH = 5
THRESHOLD = 0.8
#: Most shingle hashes of a benchmark that is sent to the tasks whole (8 bytes each).
BLOCK_SHINGLES = 1_000_000

HASH_SCHEMA = "row long, width int, hash long, first_word long, last_word long"
PAIR_SCHEMA = "doc_id long, item_id long, n_item long, n_shared long, containment double, first_word long, last_word long"
#: Name of the row number that a large benchmark's join needs.
ROW = "_decontam_row"
ITEM_SCHEMA = "item_id long, width int, shingles array<long>, sketch array<long>"


def sketch_size(n: int, threshold: float) -> int:
    """Sketch length of the size partition of ``n`` shingles, at most n."""
    largest = 1 << (n - 1).bit_length() if n > 1 else 1
    return min(n, largest - int(np.ceil(threshold * largest - 1e-9)) + 1)


def item_sketches(benchmark: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """item_id, width, distinct shingle hashes and their bottom-k sketch; items without words are left out.

    An item of fewer than ``width`` words is one shingle of its own width.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            tokens = words.fingerprints()[words.ids] if len(words.ids) else np.empty(0, np.uint64)
            rows = []
            for item, a, n in zip(batch.column("item_id").to_pylist(), words.starts, words.counts):
                if not n or item is None:
                    continue
                own = min(width, int(n))
                found = np.unique(shingle_hashes(tokens[a : a + n], own))
                order = found[np.argsort(mix64(found), kind="stable")]
                k = sketch_size(len(found), threshold)
                rows.append((item, own, found.astype(np.int64), order[:k].astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                ],
                names=["item_id", "width", "shingles", "sketch"],
            )

    source = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return source.mapInArrow(sketch, ITEM_SCHEMA)


class Block:
    """A bounded set of items: their shingle sets and an index of their sketches, by shingle width."""

    def __init__(self, rows: list, threshold: float):
        self.threshold = threshold
        self.items = [(r["item_id"], r["width"], np.array(r["shingles"], np.int64).astype(np.uint64)) for r in rows]
        self.index = {}
        for width in sorted({r["width"] for r in rows}):
            pairs = sorted((h % (1 << 64), k) for k, r in enumerate(rows) if r["width"] == width for h in r["sketch"])
            keys = np.array([h for h, _ in pairs], np.uint64)
            at = np.array([k for _, k in pairs], np.int64)
            bits = np.zeros(1 << 20, bool)
            bits[keys >> np.uint64(44)] = True
            self.index[width] = (keys, at, bits)

    def matches(self, words: Words, ids: list) -> Iterator[tuple]:
        tokens = words.fingerprints()[words.ids] if len(words.ids) else np.empty(0, np.uint64)
        for width, (keys, at, bits) in self.index.items():
            every = shingle_hashes(tokens, width)
            near = np.flatnonzero(bits[every >> np.uint64(44)])
            near = near[np.isin(every[near], keys)]
            if not len(near):
                continue
            text = np.searchsorted(words.starts, near, side="right") - 1
            inside = near + width <= words.starts[text + 1]  # not across two texts
            near, text = near[inside], text[inside]
            for t in np.unique(text):
                hits = np.unique(every[near[text == t]])
                lo, hi = np.searchsorted(keys, hits, "left"), np.searchsorted(keys, hits, "right")
                candidates = np.unique(np.concatenate([at[a:b] for a, b in zip(lo, hi)]))
                own = every[words.starts[t] : words.starts[t + 1] - width + 1]
                for k in candidates:
                    item, _, shingles = self.items[k]
                    places = np.flatnonzero(np.isin(own, shingles))
                    shared = len(np.unique(own[places]))
                    if shared >= self.threshold * len(shingles) - 1e-9:
                        share = shared / len(shingles)
                        yield ids[t], item, len(shingles), shared, share, int(places[0]), int(places[-1]) + width - 1


def containment_pairs(
    documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD
) -> DataFrame:
    """Pairs (document, item) where the document contains at least ``threshold`` of the item's shingles.

    ``documents`` has doc_id and text, ``benchmark`` item_id and text; other columns are ignored.  Returns
    doc_id, item_id, n_item (distinct shingles of the item), n_shared, containment, and first_word and
    last_word (words of the document, from 0, that the shared shingles span).  An empty table on either side gives no
    pairs.  Null or empty texts contain
    nothing and are contained in nothing; null ids of documents are kept as null, items with a null id
    cannot be named and are left out.  Repeated rows give repeated pairs.
    """
    sketches = stored(item_sketches(benchmark, width, threshold), "sketches")
    block = _block(sketches, threshold)
    if block is None:
        return _joined_pairs(_with_row(documents.select("doc_id", "text")), sketches, threshold).drop("row")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            got = list(block.matches(Words(batch.column("text")), batch.column("doc_id").to_pylist()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            cols = list(zip(*got)) or [[] for _ in kinds]
            names = [c.split()[0] for c in PAIR_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, PAIR_SCHEMA)


def decontaminated(
    documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``documents``, all columns, whose text contains no benchmark item."""
    sketches = stored(item_sketches(benchmark, width, threshold), "sketches")
    block = _block(sketches, threshold)
    if block is not None:
        return documents.where(~_leaks(block)("text"))
    rows = _with_row(documents)
    leaking = _joined_pairs(rows, sketches, threshold).select(F.col("row").alias(ROW)).distinct()
    return rows.join(leaking, ROW, "left_anti").drop(ROW)


def _block(sketches: DataFrame, threshold: float) -> Block | None:
    """All items, if their shingle hashes are few enough to be sent; else nothing."""
    size = sketches.agg(F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()[0]
    return Block(sketches.collect(), threshold) if size <= BLOCK_SHINGLES else None


def _with_row(documents: DataFrame) -> DataFrame:
    """The rows with a number of their own, written once, since a second evaluation might number otherwise."""
    return stored(documents.withColumn(ROW, F.monotonically_increasing_id()), "numbered-documents")


def document_hashes(rows: DataFrame, widths: list[int]) -> DataFrame:
    """row, width, hash, first_word and last_word (where its first and last occurrence start): once per text and hash."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            words = Words(batch.column("text"))
            tokens = words.fingerprints()[words.ids] if len(words.ids) else np.empty(0, np.uint64)
            row = batch.column("row").to_numpy()
            for width in widths:
                every = shingle_hashes(tokens, width)
                place = np.arange(len(every))
                text = np.searchsorted(words.starts, place, side="right") - 1
                inside = place + width <= words.starts[text + 1]  # not across two texts
                place, text = place[inside], text[inside]
                order = np.lexsort((place, every[place], text))
                place, text = place[order], text[order]
                own = every[place]
                new = np.r_[True, (text[1:] != text[:-1]) | (own[1:] != own[:-1])] if len(own) else np.empty(0, bool)
                first = np.flatnonzero(new)
                last = np.r_[first[1:], len(own)] - 1 if len(first) else first
                start = words.starts[text]
                cols = [row[text[first]], np.full(len(first), width, np.int32), own[first].astype(np.int64)]
                cols += [place[first] - start[first], place[last] - start[first]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[c.split()[0] for c in HASH_SCHEMA.split(", ")])

    return rows.mapInArrow(hashes, HASH_SCHEMA)


def _joined_pairs(rows: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """``row`` and the columns of ``containment_pairs``, with the benchmark as a table."""
    items = stored(sketches.withColumn("item", F.monotonically_increasing_id()), "items")
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # as many as a shingle has words
    texts = rows.select(F.col(ROW).alias("row"), "text")
    index = items.select("item", "width", F.explode("sketch").alias("hash"))
    found = document_hashes(texts, widths).select("row", "width", "hash").join(index, ["width", "hash"])
    candidates = stored(found.select("row", "item").distinct(), "candidates")

    # The texts of candidates once more; an item's shingles stand beside each document that may hold it.
    wanted = texts.join(candidates.select("row").distinct(), "row", "left_semi")
    asked = candidates.join(items.select("item", "width", F.explode("shingles").alias("hash")), "item")
    shared = asked.join(document_hashes(wanted, widths), ["row", "width", "hash"]).groupBy("row", "item")
    counts = shared.agg(
        F.count(F.lit(1)).alias("n_shared"),
        F.min("first_word").alias("first_word"),
        (F.max("last_word") + F.first("width") - 1).alias("last_word"),
    )
    sizes = items.select("item", "item_id", F.size("shingles").cast("long").alias("n_item"))
    names = rows.select(F.col(ROW).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    kept = counts.join(sizes, "item").where(F.col("n_shared") >= threshold * F.col("n_item") - 1e-9)
    kept = kept.withColumn("containment", F.col("n_shared") / F.col("n_item"))
    return kept.join(names, "row").select("row", *[c.split()[0] for c in PAIR_SCHEMA.split(", ")])


def _leaks(block: Block):
    @F.arrow_udf("boolean")
    def leaks(texts: pa.Array) -> pa.Array:
        found = np.zeros(len(texts), bool)
        whole = pa.RecordBatch.from_arrays([texts, pa.array(np.arange(len(texts)))], names=["text", "row"])
        for batch in slices([whole], "text"):
            for pair in block.matches(Words(batch.column("text")), batch.column("row").to_pylist()):
                found[pair[0]] = True
        return pa.array(found)

    return leaks
