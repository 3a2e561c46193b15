"""Helpers shared by the training-data operators.

Tokens, wherever an operator speaks of words: A-Z is lower-cased (no other letter changes) and the
text is cut at runs of the ASCII white space characters 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.session import checkpoint_root, scratch_path

#: Texts are handled in slices of about this many bytes, so that a Python worker's memory does not
#: follow the size of Spark's Arrow batches.
SLICE_BYTES = 8 << 20

MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer() -> dict[str, str]:
    """Where the public byte-level BPE vocabulary is, as options of packing.Encoder."""
    import public_tokenizers

    return {
        "json_path": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back: computed once, safe to lose executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    checkpoint_root(spark)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the decimal text of an id, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def numbered(df: DataFrame, order: list[str], number: str) -> DataFrame:
    """Rows numbered 0.. without gaps in the total order of ``order``, with no one-task window.

    A range exchange deals the rows, each partition numbers its own sorted rows, and the partitions'
    start numbers (one row per partition) are joined back.  The numbered partitions are stored first:
    range boundaries come from a sample, so a second evaluation might cut elsewhere.
    """
    spark = df.sparkSession
    local, part, first = f"_{number}_local", f"_{number}_part", f"_{number}_first"
    dealt = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    dealt = dealt.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    # The low 33 bits count the rows of a partition, the high bits are the partition.
    dealt = stored(dealt.withColumn(local, F.monotonically_increasing_id()), "numbered")
    dealt = dealt.withColumn(part, F.shiftright(local, 33)).withColumn(
        local, F.col(local).bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = dealt.groupBy(part).agg((F.max(local) + 1).alias("n"))
    starts = {}
    total = 0
    for row in sorted(sizes.collect()):  # one row per partition
        starts[row[0]] = total
        total += row[1]
    offsets = spark.createDataFrame(sorted(starts.items()) or [(0, 0)], f"{part} bigint, {first} bigint")
    return (
        dealt.join(F.broadcast(offsets), part)
        .withColumn(number, F.col(first) + F.col(local))
        .drop(part, first, local)
    )


# --- Arrow and NumPy side -------------------------------------------------------------------------


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that the text of a piece stays near ``limit`` bytes (one text may exceed it)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


def plain_texts(texts: pa.Array) -> pa.Array:
    """Large strings without nulls (a null becomes empty) whose offsets begin at 0.

    Built from the buffers: a cast of a sliced array keeps the offsets of the whole, and Arrow's case
    kernels (seen in 23.0.1) then read bytes beside the slice.
    """
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    n = len(texts)
    if not n or data is None:
        return pa.array([""] * n, pa.large_string())
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    part = data.slice(int(bounds[0]), int(bounds[-1] - bounds[0]))
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(bounds - bounds[0]), part)


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an array of large strings without nulls, end to end, and the texts' bounds in them."""
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser: a bijection of 64-bit words that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


class Words:
    """The words of a slice of texts: ``ids`` into ``vocabulary`` in text order, ``counts`` per text."""

    def __init__(self, texts: pa.Array):
        plain = plain_texts(texts)
        parts = pc.ascii_split_whitespace(pc.ascii_lower(plain))
        flat = pc.list_flatten(parts)
        full = pc.greater(pc.binary_length(flat), 0)
        ends = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)]
        offsets = parts.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        self.counts = ends[offsets[1:]] - ends[offsets[:-1]]
        coded = pc.dictionary_encode(flat.filter(full))
        self.vocabulary = coded.dictionary
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.r_[0, np.cumsum(self.counts)]

    def fingerprints(self) -> np.ndarray:
        """A 64-bit hash per vocabulary entry."""
        return word_hashes(self.vocabulary)


def word_hashes(words: pa.Array) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))


def shingle_hashes(tokens: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` consecutive word hashes, at their start positions."""
    n = len(tokens) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = mix64(h * GOLDEN + tokens[k : k + n])
    return h


def text_shingles(words: Words, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles.

    A text of fewer words gives its whole sequence as one shingle, a text without words gives none.
    """
    tokens = words.fingerprints()[words.ids] if len(words.ids) else np.empty(0, np.uint64)
    every = shingle_hashes(tokens, width)
    for a, n in zip(words.starts[:-1], words.counts):
        if n >= width:
            yield np.unique(every[a : a + n - width + 1])
        elif n:
            yield shingle_hashes(tokens[a : a + n], int(n)) ^ np.uint64(n)
        else:
            yield np.empty(0, np.uint64)
