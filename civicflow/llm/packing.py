"""Best-fit packing of documents into token sequences, in bulk-synchronous steps.

Every document becomes token ids plus one end id; only documents longer than a sequence are cut.  The
pieces are range-sorted by length and numbered, so the pieces of one length are a range of numbers and a
piece's rank in its class is known.  Sequences with equal room form a class of gaps.

One step handles all pieces of one length, longest first: the class sweeps the gap classes upwards from its
successor (the smallest gap that fits) and takes them in order.  Pieces that want the same gap class are
told apart by rank: rank r takes the r-th sequence of the class.  The gaps shrink, and the next class
follows; pieces that find no gap open new sequences.  This is what best-fit decreasing does one piece at
a time.  Since lengths and gaps are at most the capacity, the state of the sweep is a few ranges per
class, bounded by the capacity and not by the number of documents; the pieces themselves never leave
Spark, each finds its sequence from its number.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, plain_texts, slices, stored

CAPACITY = 2048
END_ID = 0

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"

#: Texts made only of these characters are cut into pre-tokens alike by both tokenizer libraries.
COMMON = r"[^\t\n\r -~\x{A1}-\x{AC}\x{AE}-\x{24F}]"
#: White space that is not a single blank between two other characters.
ODD_BLANKS = r"\s | \s| $"


class Encoder:
    """Token ids of texts by a byte-level BPE file of the ``tokenizers`` library.

    That library defines the ids.  Texts of common characters take a shorter way to the same ids: the
    same vocabulary as ranks, applied once per distinct word of a slice.  A single blank between two other
    characters always starts a pre-token, so a text may be cut there.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(json_path)
        self.plain.encode_special_tokens = True
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, k in ranks.items():
            self.width[k] = len(token)

    def slow(self, text: str) -> list[int]:
        return self.plain.encode(text, add_special_tokens=False).ids

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """uint32 ids of each text (large strings without nulls), the end id not included."""
        rare = pc.match_substring_regex(texts, COMMON).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, ODD_BLANKS).to_numpy(zero_copy_only=False)
        easy = np.flatnonzero(~rare & ~odd)
        parts = pc.split_pattern(texts.take(pa.array(easy)), " ")
        ends = parts.offsets.to_numpy().astype(np.int64)
        ends = ends - ends[0] if len(ends) else np.zeros(1, np.int64)
        coded = pc.dictionary_encode(pc.list_flatten(parts))
        words = coded.dictionary
        at = coded.indices.to_numpy(zero_copy_only=False)
        # All distinct words in one go, each with the blank before it; pre-tokens never span two words.
        joined = "".join([" " + w for w in words.to_pylist()])
        ids = np.array(self.fast.encode_ordinary(joined), np.uint32)
        bounds = np.r_[0, np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1)]
        cuts = np.searchsorted(np.r_[0, np.cumsum(self.width[ids])], bounds)
        sizes = np.diff(cuts)
        # Where each word's ids begin in the stream of all easy texts; first words come without a blank.
        n = sizes[at] if len(at) else np.empty(0, np.int64)
        first = ends[:-1]
        n[first[first < len(n)]] = 0
        total = np.r_[0, np.cumsum(n)]
        stream = ids[np.repeat(cuts[:-1][at] - total[:-1], n) + np.arange(total[-1])] if len(at) else ids[:0]
        place = dict(zip(easy.tolist(), range(len(easy))))
        for k, text in enumerate(texts):
            e = place.get(k)
            if e is not None:
                head = self.fast.encode_ordinary(words[int(at[ends[e]])].as_py())
                yield np.r_[np.array(head, np.uint32), stream[total[ends[e]] : total[ends[e + 1]]]]
            elif rare[k]:
                yield np.array(self.slow(text.as_py()), np.uint32)
            else:
                yield np.array(self.fast.encode_ordinary(text.as_py()), np.uint32)


def token_pieces(documents: DataFrame, encoder: dict, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and end id, cut if over ``capacity``.

    Of a long document the first piece is the shorter one, the others fill a sequence each.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Encoder(**encoder)
        for batch in slices(batches, "text", 16 << 20):
            rows: list[tuple] = []
            texts = plain_texts(batch.column("text"))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode(texts)):
                ids = np.r_[ids, np.uint32(END_ID)].astype("<u4")
                n = len(ids)
                a, b, k = 0, (n % capacity or capacity) if n > capacity else n, 0
                while a < n:
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b])))
                    a, b, k = b, b + capacity, k + 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(cut, PIECE_SCHEMA)


@dataclass
class Plan:
    """Ranges of piece numbers: number i of range k goes to sequence first[k] + (i - start[k]) // each[k]."""

    start: np.ndarray
    first: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    sequences: int


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The steps over all length classes, longest first; ``counts`` has the number of pieces by length."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges (first sequence, how many)
    order: list[int] = []  # gaps with sequences, ascending
    ranges: list[tuple[int, int, int, int, int]] = []
    opened = number = 0

    def add(gap: int, first: int, many: int) -> None:
        if gap not in gaps:
            gaps[gap] = []
            bisect.insort(order, gap)
        gaps[gap].append((first, many))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(order, length)  # successor: the smallest gap that fits
            if at < len(order):
                gap = order[at]
                first, many = gaps[gap].pop()
            else:
                gap = capacity
                first, many = opened, -(-left // (capacity // length))
                opened += many
            # The best fit of the next piece is the sequence just used, as long as it fits there.
            each = gap // length
            used = min(many, left // each)
            if used:
                ranges.append((number, first, each, capacity - gap, length))
                add(gap - each * length, first, used)
                number += used * each
                left -= used * each
            if left and used < many:
                ranges.append((number, first + used, left, capacity - gap, length))
                add(gap - left * length, first + used, 1)
                number += left
                left = 0
                used += 1
            if used < many:
                add(gap, first + used, many - used)
            if gap in gaps and not gaps[gap]:
                del gaps[gap]
                order.remove(gap)
    cols = np.array(ranges, np.int64).reshape(len(ranges), 5).T
    return Plan(*cols, sequences=opened)


def pack(documents: DataFrame, encoder: dict, capacity: int = CAPACITY) -> DataFrame:
    """All rows of ``documents`` (doc_id, text) packed into sequences of at most ``capacity`` tokens.

    Returns per piece doc_id, piece, start, length, ids_crc32, sequence_id and offset.  A null text is
    empty: one end id.  Rows with equal or null ids are packed one by one.  Extra columns are ignored, an
    empty table gives an empty result.
    """
    pieces = stored(token_pieces(documents, encoder, capacity), "pieces")
    pieces = pieces.withColumn("_short", -F.col("length"))
    sorted_pieces = numbered(pieces, ["_short", "doc_id", "piece", "start", "ids_crc32"], "_number")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = best_fit(counts, capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            number = batch.column("_number").to_numpy(zero_copy_only=False)
            k = np.searchsorted(plan.start, number, side="right") - 1
            rank = number - plan.start[k]
            cols = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            cols.append(pa.array(plan.first[k] + rank // plan.each[k]))
            cols.append(pa.array(plan.offset[k] + rank % plan.each[k] * plan.length[k]))
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in PACKED_SCHEMA.split(", ")])

    return sorted_pieces.mapInArrow(place, PACKED_SCHEMA)
