"""Language-model scoring by deleted interpolation.

P(w | v) = l2 * c(v w) / c(v) + l1 * c(w) / N + l0 / (V + 1)

The weights (l2, l1, l0) depend on the bucket of the context's frequency c(v), in powers of two, and are
learned by expectation-maximisation: counts come from one part of the training documents, the events from
a deleted part that the counts have not seen.  The scores then use the counts of both parts.  Every
weight set sums to one and l0 is never zero, so each P is a distribution over the V known words and one
unknown word.  Contexts are words; a text's first word follows a start mark, its last token is an end mark.

How it runs:

1. ``blocks``: one pass packs texts into blocks (a slice of texts of one part) and stores, per block, its
   token stream as numbers into the block's own vocabulary, and the vocabulary's 64-bit hashes.
2. ``entries``: each block lists its distinct words and word pairs with their counts, dealt by hash into
   buckets of a bounded number of entries.  A pair or word, however frequent, has one entry per block.
3. ``totals``: each bucket sums its entries over all blocks and returns the totals to the blocks, in the
   order in which they were listed.
4. The deleted blocks look up their pairs' counts and give histograms, a bounded table of cells of
   (context bucket, log ratio of pair to word estimate and of word estimate to the uniform one); EM runs
   on the cells' means.
5. Every block looks up its pairs and sums the log probabilities per document.

What moves between machines grows with the corpus; what reaches the driver are sums and the histogram.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, Words, id_remainder, mix64, slices, stored

#: Text per block.
BLOCK_BYTES = 6 << 20
#: Entries (words and pairs, summed over blocks) per bucket: what one task holds at a time.
BUCKET_ENTRIES = 1_000_000
#: crc32(doc_id) mod 7: 2 is held out from training; of the training documents, 5 is the deleted part.
MODULUS, HELD_OUT, DELETED = 7, 2, 5
#: Context frequencies 0, 1, 2-3, 4-7, ...; the last bucket is open.
CONTEXT_BUCKETS = 24
#: Histogram cells per factor of two, and the range covered on either side.
CELLS, OCTAVES = 4, 40
EM_STEPS = 100

END, START = np.uint64(0x8C5F1E2D3B4A6978), np.uint64(0x1F3A5C7E9B2D4F61)
COUNTED, DELETED_PART, UNSEEN = 0, 1, 2

BLOCK_SCHEMA = (
    "block long, part int, docs array<long>, sizes array<int>, stream binary, vocabulary binary, n_words long, n_tokens long"
)
ENTRY_SCHEMA = "bucket int, block long, part int, kind int, hashes binary, counts binary"
TOTAL_SCHEMA = "block long, kind int, bucket int, counted binary, trained binary, n_counted long, n_trained long"
SCORE_SCHEMA = "doc_id long, part int, n_tokens long, n_known long, base_score double, score double"
CELL_SCHEMA = "cell long, n double, pair double, word double"


def _pack(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a), codec="zstd", asbytes=True)


def _unpack(b: bytes, kind: type, n: int) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(b, decompressed_size=size, codec="zstd"), kind) if n else np.empty(0, kind)


@dataclass
class Block:
    """A block's tokens: ``stream`` numbers ``vocabulary``; each text ends with the end mark."""

    docs: list
    sizes: np.ndarray
    stream: np.ndarray
    vocabulary: np.ndarray

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word) codes, sorted; for each token the place of its pair; pair counts."""
        starts = np.r_[0, np.cumsum(self.sizes)][:-1]
        context = np.r_[0, self.stream[:-1]]
        context[starts] = len(self.vocabulary)  # the start mark
        code = context.astype(np.int64) * len(self.vocabulary) + self.stream
        return np.unique(code, return_inverse=True, return_counts=True)

    def pair_hashes(self, code: np.ndarray) -> np.ndarray:
        marks = np.r_[self.vocabulary, START]
        return mix64(marks[code // len(self.vocabulary)] * GOLDEN + mix64(self.vocabulary[code % len(self.vocabulary)]))


def make_block(texts: pa.Array, docs: list) -> Block:
    words = Words(texts)
    n = len(words.counts)
    vocabulary = np.r_[words.fingerprints() if len(words.vocabulary) else np.empty(0, np.uint64), END]
    stream = np.empty(len(words.ids) + n, np.int64)
    ends = words.starts[1:] + np.arange(n)
    inner = np.ones(len(stream), bool)
    inner[ends] = False
    stream[inner] = words.ids
    stream[ends] = len(vocabulary) - 1
    return Block(docs, words.counts + 1, stream, vocabulary)


def blocks(documents: DataFrame) -> DataFrame:
    """Texts as blocks of one part each (counted, deleted or held out)."""
    part = id_remainder(F.col("doc_id"), MODULUS)
    source = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(part == HELD_OUT, UNSEEN).when(part == DELETED, DELETED_PART).otherwise(COUNTED).alias("part"),
        "text",
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() + 1) << 32
        for batch in gathered(batches, BLOCK_BYTES):
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            for p in np.unique(parts):
                rows = batch.filter(pa.array(parts == p))
                b = make_block(rows.column("text"), rows.column("doc_id").to_pylist())
                number += 1
                pa.default_memory_pool().release_unused()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]), pa.array([int(p)], pa.int32()), pa.array([b.docs], pa.list_(pa.int64())),
                        pa.array([b.sizes], pa.list_(pa.int32())), pa.array([_pack_stream(b.stream)], pa.binary()),
                        pa.array([_pack(b.vocabulary)], pa.binary()), pa.array([len(b.vocabulary)]),
                        pa.array([len(b.stream)]),
                    ],
                    names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")],
                )

    return source.mapInArrow(build, BLOCK_SCHEMA)


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches joined or cut to about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in slices(batches, "text", limit):
        n = batch.column("text").nbytes
        if held and size + n > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += n
    if held:
        yield pa.concat_batches(held)


def _pack_stream(stream: np.ndarray) -> bytes:
    """Numbers below 2^32, byte planes apart, which compress better."""
    planes = stream.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return _pack(planes)


def _stream(b: bytes, n: int) -> np.ndarray:
    planes = _unpack(b, np.uint8, 4 * n).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(n).astype(np.int64)


def load_block(row: dict) -> Block:
    sizes = np.array(row["sizes"], np.int64)
    return Block(
        list(row["docs"]), sizes, _stream(row["stream"], int(sizes.sum())), _unpack(row["vocabulary"], np.uint64, row["n_words"])
    )


def by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts hashes into their buckets, and the buckets' bounds in it."""
    bucket = (hashes >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def entries(table: DataFrame, buckets: int) -> DataFrame:
    """Per block, kind (0 words, 1 pairs) and bucket: hashes and counts of the block's entries."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one block at a time, however many a batch has
                (row,) = batch.slice(i, 1).to_pylist()
                b = load_block(row)
                code, _, n_pairs = b.pairs()
                n_words = np.bincount(b.stream, minlength=len(b.vocabulary))
                out = []
                for kind, hashes, n in ((0, b.vocabulary, n_words), (1, b.pair_hashes(code), n_pairs)):
                    order, bounds = by_bucket(hashes, buckets)
                    for k in np.flatnonzero(np.diff(bounds)):
                        at = order[bounds[k] : bounds[k + 1]]
                        out.append((int(k), row["block"], row["part"], kind, _hash_bytes(hashes[at], kind), _pack(n[at].astype("<u4"))))
                cols = list(zip(*out))
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds)], names=[c.split()[0] for c in ENTRY_SCHEMA.split(", ")]
                )
                pa.default_memory_pool().release_unused()

    return table.mapInArrow(deal, ENTRY_SCHEMA)


def _hash_bytes(hashes: np.ndarray, kind: int) -> bytes:
    """Words keep 64 bits.  Pairs keep 48, which with the bucket's own bits tell a bucket's entries apart."""
    raw = np.ascontiguousarray(hashes.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return raw.tobytes() if kind == 0 else np.ascontiguousarray(raw[:, :6]).tobytes()


def _hashes(raw: bytes, kind: int) -> np.ndarray:
    if kind == 0:
        return np.frombuffer(raw, "<u8")
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def sum_bucket(table: pa.Table) -> pa.Table:
    """Totals of one bucket: for each block's entries the counts over the counted and over all training blocks."""
    block, part, kind = (table.column(c).to_numpy() for c in ("block", "part", "kind"))
    hashes, counts = table.column("hashes").to_pylist(), table.column("counts").to_pylist()
    out = []
    for k in np.unique(kind):
        rows = np.flatnonzero(kind == k)
        keys = [_hashes(hashes[r], k) for r in rows]
        ends = np.r_[0, np.cumsum([len(x) for x in keys])]
        n = np.concatenate([_unpack(counts[r], "<u4", len(x)) for r, x in zip(rows, keys)]).astype(np.float64)
        owner = np.repeat(part[rows], np.diff(ends))
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        counted = np.bincount(place, weights=n * (owner == COUNTED)).astype(np.uint64)
        trained = np.bincount(place, weights=n * (owner != UNSEEN)).astype(np.uint64)
        if k == 0:  # one row for the bucket: its distinct words
            known = (int(np.count_nonzero(counted)), int(np.count_nonzero(trained)))
            out.append((None, None, None, None, None, *known))
        counted, trained = counted[place], trained[place]
        for r, a, b in zip(rows, ends, ends[1:]):
            # Only deleted blocks, whose events train the weights, need the counts without them.
            first = _pack(counted[a:b]) if part[r] == DELETED_PART else None
            out.append((int(block[r]), int(k), int(table.column("bucket")[0].as_py()), first, _pack(trained[a:b]), None, None))
    cols = list(zip(*out))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, kinds)], names=[c.split()[0] for c in TOTAL_SCHEMA.split(", ")]
    )


def looked_up(b: Block, code: np.ndarray, totals: list[dict], column: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The block's words' and pairs' totals, put back into the block's own order."""
    out = []
    for kind, hashes in ((0, b.vocabulary), (1, b.pair_hashes(code))):
        order, bounds = by_bucket(hashes, buckets)
        n = np.zeros(len(hashes), np.float64)
        found = 0
        for row in totals:
            if row["kind"] == kind:
                k = row["bucket"]
                n[order[bounds[k] : bounds[k + 1]]] = _unpack(row[column], np.uint64, int(bounds[k + 1] - bounds[k]))
                found += int(bounds[k + 1] - bounds[k])
        assert found == len(hashes), "a block's totals are incomplete"
        out.append(n)
    return out[0], out[1]


@dataclass
class Counts:
    """Of the whole training part: tokens, distinct tokens, texts; and the same of the counted part."""

    tokens: float
    distinct: float
    texts: float


def estimates(b: Block, code: np.ndarray, words: np.ndarray, pairs: np.ndarray, c: Counts):
    """Per pair: context frequency bucket, pair estimate c(v w)/c(v), word estimate c(w)/N."""
    v = len(b.vocabulary)
    # The end mark is never a context; the start mark opens every text.
    frequency = np.r_[words, c.texts][code // v]
    bucket = np.minimum(np.where(frequency > 0, np.floor(np.log2(np.maximum(frequency, 1))) + 1, 0), CONTEXT_BUCKETS - 1)
    pair = pairs / np.maximum(frequency, 1)
    word = words[code % v] / max(c.tokens, 1)
    return bucket.astype(np.int64), pair, word


def cells(b: Block, totals: list[dict], c: Counts, buckets: int) -> tuple[np.ndarray, ...]:
    """Histogram of a deleted block's events: cell, events, sum of pair estimates, sum of word estimates."""
    code, _, n = b.pairs()
    words, pairs = looked_up(b, code, totals, "counted", buckets)
    bucket, pair, word = estimates(b, code, words, pairs, c)

    def grade(x: np.ndarray) -> np.ndarray:
        level = np.floor(CELLS * np.log2(np.maximum(x, 2.0**-OCTAVES) * (c.distinct + 1)))
        return np.where(x > 0, np.clip(level, -CELLS * OCTAVES, CELLS * OCTAVES - 1) + CELLS * OCTAVES + 1, 0).astype(np.int64)

    side = 2 * CELLS * OCTAVES + 2
    cell = (bucket * side + grade(pair)) * side + grade(word)
    names, place = np.unique(cell, return_inverse=True)
    return names, *(np.bincount(place, weights=w * n, minlength=len(names)) for w in (np.ones(len(n)), pair, word))


def learn_weights(rows: list, distinct: float) -> np.ndarray:
    """EM over the histogram's cells; (buckets, 3) weights of the pair, word and uniform estimates.

    A bucket without events borrows from the next lower one that has some; context frequency 0 has no
    pair estimate.
    """
    side = 2 * CELLS * OCTAVES + 2
    out = np.full((CONTEXT_BUCKETS, 3), np.nan)
    uniform = 1.0 / (distinct + 1)
    data = np.array([(r["cell"] // (side * side), r["n"], r["pair"], r["word"]) for r in rows], np.float64).reshape(-1, 4)
    for k in range(CONTEXT_BUCKETS):
        mine = data[data[:, 0] == k]
        if not len(mine):
            continue
        n = mine[:, 1]
        p = np.stack([mine[:, 2] / n, mine[:, 3] / n, np.full(len(n), uniform)], axis=1)
        w = np.array([0.0, 0.9, 0.1]) if k == 0 else np.array([0.4, 0.5, 0.1])
        for _ in range(EM_STEPS):
            each = p * w
            each /= each.sum(axis=1, keepdims=True)
            w = (each * n[:, None]).sum(axis=0) / n.sum()
            w = np.maximum(w, [0.0, 0.0, 1e-6])
            w /= w.sum()
        out[k] = w
    known = np.flatnonzero(~np.isnan(out[:, 0]))
    for k in range(CONTEXT_BUCKETS):
        if np.isnan(out[k, 0]):
            lower = known[known < k]
            out[k] = out[lower[-1]] if len(lower) else [0.0, 0.9, 0.1]
    out[0] = [0.0, *(out[0, 1:] / out[0, 1:].sum())]
    return out


def score_block(b: Block, totals: list[dict], c: Counts, weights: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """n_tokens, n_known, base_score and score per document."""
    code, place, _ = b.pairs()
    words, pairs = looked_up(b, code, totals, "trained", buckets)
    bucket, pair, word = estimates(b, code, words, pairs, c)
    w = weights[bucket]
    chance = np.log10(w[:, 0] * pair + w[:, 1] * word + w[:, 2] / (c.distinct + 1))
    base = np.log10((words + 1) / (c.tokens + (c.distinct + 1)))
    starts = np.r_[0, np.cumsum(b.sizes)][:-1]
    add = lambda x: np.add.reduceat(x, starts)  # noqa: E731  no text is without tokens
    return b.sizes, add((words > 0)[b.stream].astype(np.int64)), add(base[b.stream]), add(chance[place])


@dataclass
class Trained:
    """A model with what is needed to score its documents."""

    table: DataFrame  # blocks
    totals: DataFrame  # per block and bucket
    buckets: int
    counts: Counts
    weights: np.ndarray


def train(documents: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> Trained:
    """Blocks, totals and interpolation weights; learns from rows that are not held out."""
    table = stored(blocks(documents), "lm-blocks")
    # Each block lists at most its words and as many pairs as it has tokens.
    size = table.agg(F.sum(F.col("n_words") + F.col("n_tokens"))).first()[0] or 0
    buckets = int(size // bucket_entries) + 1
    listed = entries(table, buckets)
    totals = stored(listed.groupBy("bucket").applyInArrow(sum_bucket, TOTAL_SCHEMA), "lm-totals")
    seen = table.groupBy("part").agg(F.sum(F.size("docs")).alias("texts"), F.sum("n_tokens").alias("tokens"))
    sums = {r["part"]: r for r in seen.collect()}  # three rows
    parts = [sums[p] for p in (COUNTED, DELETED_PART) if p in sums]
    distinct = totals.where(F.col("block").isNull()).agg(F.sum("n_counted"), F.sum("n_trained")).first()
    first = [sums[COUNTED]] if COUNTED in sums else []
    counted, trained = (
        Counts(sum(r["tokens"] for r in rows), n or 0, sum(r["texts"] for r in rows))
        for rows, n in ((first, distinct[0]), (parts, distinct[1]))
    )

    def histogram(key: tuple, mine: pa.Table, found: pa.Table) -> pa.Table:
        got = cells(load_block(mine.to_pylist()[0]), found.to_pylist(), counted, buckets)
        return pa.table(dict(zip(("cell", "n", "pair", "word"), got)))

    deleted = table.where(F.col("part") == DELETED_PART).groupBy("block")
    found = totals.where(F.col("counted").isNotNull()).select("block", "kind", "bucket", "counted").groupBy("block")
    rows = deleted.cogroup(found).applyInArrow(histogram, CELL_SCHEMA)
    rows = rows.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("pair").alias("pair"), F.sum("word").alias("word"))
    # A bounded table: at most as many rows as there are cells.
    weights = learn_weights(rows.orderBy("cell").collect(), counted.distinct)
    if not trained.tokens:  # no word estimate either
        weights[:] = [0.0, 0.0, 1.0]
    return Trained(table, totals, buckets, trained, weights)


def score_documents(documents: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """Scores all whole texts of ``documents`` (doc_id, text; other columns are ignored).

    Learns from rows whose crc32(doc_id as text) mod 7 is not 2.  Returns per row doc_id, held_out (it is
    2), n_tokens (words and one end), n_known (tokens seen in training), train_tokens, base_score (log10 by
    add-one word counts) and score (log10 by this model).  An empty table gives an empty result.  A null or empty text is one end token.  A null
    id counts as the empty text; repeated rows count and are scored one by one.  If nothing can be learned
    from, every token has the probability 1 / (V + 1) = 1.
    """
    model = train(documents, bucket_entries)
    counts, weights, buckets = model.counts, model.weights, model.buckets

    def score(key: tuple, mine: pa.Table, found: pa.Table) -> pa.Table:
        row = mine.to_pylist()[0]
        b = load_block(row)
        n, known, base, own = score_block(b, found.to_pylist(), counts, weights, buckets)
        part = np.full(len(n), row["part"], np.int32)
        ids = pa.array(b.docs, pa.int64())
        return pa.table({"doc_id": ids, "part": part, "n_tokens": n, "n_known": known, "base_score": base, "score": own})

    found = model.totals.where(F.col("block").isNotNull()).select("block", "kind", "bucket", "trained")
    scored = model.table.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, SCORE_SCHEMA)
    return scored.select(
        "doc_id",
        (F.col("part") == UNSEEN).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(counts.tokens)).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
