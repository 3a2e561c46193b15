"""Groups of spelling variants: words at one edit from each other, and the form that a word belongs to.

Dense prefix-suffix tiling.  Two different words are one edit apart (one code point put in, taken out or
replaced) exactly if their common prefix and their common suffix together reach the longer length minus one.
Tiles of words are laid out as padded matrices of code points, and all pairs of a tile are compared at once,
position by position from the front and from the back.

Which words share a tile: of the shorter word, cut at its middle, one half is untouched by an edit.  So a word
of length m stands in the tiles of its first and its last half as the shorter (L = m), and in those of
L = m - 1 as the longer one; a tile holds words of L and L + 1 with one half in common.  A pair that both of its
halves bring together is counted in the tile of the first half only.  Tiles of more than ``TILE`` words (fewer
when words are long: ``CELLS`` code points) are cut into blocks by the words' hashes, and every pair of blocks is a
tile of its own, so a half that very many words share is spread over many tasks and no pair is lost.  Small
tiles of like size are stacked and compared together.

A tile gives one row for each of its words that has a near word: how many, and the most frequent of them.  The
rest is joins: a word's form is its most frequent near word, if that is at least twice as frequent; the root
follows the forms by pointer doubling.  Frequencies double at each step, so there is no circle.

A table of words must have each word once.  Null words are left out.  Null and empty texts have no words, an
empty table gives no rows, and repeated rows count as often as they stand there.  Words are not cut, however
long they are.  A null doc_id counts as the empty text.  Columns beyond doc_id and text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

RUN = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TILE = 1024
CELLS = 1 << 20
#: Cells of a stack of compared tiles, and by how much tiles of a stack may differ in size.
STACK_CELLS = 1 << 20
UNEVEN = 1.3
NEAR = "word string, n_near long, best_n long, best string"


def word_counts(docs: DataFrame, dropped: int = 97, shortest: int = 5, least: int = 3) -> DataFrame:
    """word, n: runs of Latin letters, A-Z lower-cased, of enough code points and occurrences.

    A run loses one code point where ``dropped`` divides the crc32 of its document's id and itself.
    """
    text = F.translate(F.col("text"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"),
    )
    runs = runs.withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % dropped == 0, shorter).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


# --- tiles ------------------------------------------------------------------------------------------


def halves(words: DataFrame) -> DataFrame:
    """A row for each of the four halves that a word is looked up by: key, size (L), head, word, n."""
    m = F.length("word")
    by = []
    for size in (m, m - 1):
        first = ((size + 1) / 2).cast("int")
        rest = size - first
        name = F.concat(size.cast("string"), F.lit(":"))
        front = F.concat(F.lit("p"), name, F.substring(F.col("word"), F.lit(1), first))
        back = F.concat(F.lit("s"), name, F.substring(F.col("word"), m - rest + 1, rest))
        for key, head in ((front, first), (back, F.lit(0))):
            by.append(F.when(size > 0, F.struct(key.alias("key"), size.alias("size"), first.alias("first"), (head > 0).alias("head"))))
    return words.select(F.explode(F.array_compact(F.array(*by))).alias("_h"), "word", "n").select("_h.*", "word", "n")


def tiles(words: DataFrame, tile: int = TILE) -> DataFrame:
    """The rows of ``halves`` with the tile (key, a, b) that each stands in; ``block`` is a or b."""
    rows = halves(words)
    fits = F.greatest(F.lit(1), F.least(F.lit(tile), (F.lit(CELLS) / F.col("size")).cast("int")))
    sizes = rows.groupBy("key", "size").agg(F.count(F.lit(1)).alias("rows"))
    large = stored(sizes.where(F.col("rows") > fits).select("key", F.ceil(F.col("rows") / fits).alias("blocks")), "large-halves")
    rows = rows.join(large, "key", "left")
    rows = rows.withColumn("block", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("word"), F.col("blocks"))))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("blocks"), F.lit(1)) - 1))
    rows = rows.withColumn("other", other)
    return rows.select(
        "key", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
        "block", "size", "first", "head", "word", "n",
    )


def shared(matrix: np.ndarray) -> np.ndarray:
    """(g, s, w) padded rows -> (g, s, s): how many first columns two rows of a tile share."""
    g, s, w = matrix.shape
    total = np.zeros((g, s, s), np.uint8 if w < 128 else np.int32)
    alive = np.ones((g, s, s), bool)
    for k in range(w):
        column = matrix[:, :, k]
        alive &= column[:, :, None] == column[:, None, :]
        total += alive
    return total


class Rows:
    """Rows of whole tiles, as arrays."""

    def __init__(self, table: pa.Table):
        self.words = table["word"].to_pylist()
        number = lambda c: table[c].to_numpy()
        self.n, self.block, self.size, self.first = (number(c) for c in ("n", "block", "size", "first"))
        self.head = number("head").astype(bool)
        self.paired = number("a") != number("b")
        self.length = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.codes = np.frombuffer("".join(self.words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.starts = np.cumsum(self.length) - self.length

    def matrices(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points of rows (-1: none) left- and right-aligned, the latter from the back; 0 beyond the end."""
        length = np.where(rows < 0, 0, self.length[rows])
        width = int(length.max())
        k = np.arange(width)
        inside = k < length[..., None]
        front = np.where(inside, self.starts[rows][..., None] + k, 0)
        back = np.where(inside, (self.starts[rows] + length)[..., None] - 1 - k, 0)
        return np.where(inside, self.codes[front], 0), np.where(inside, self.codes[back], 0)


def compared(rows: Rows, stack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a stack of tiles (row numbers, -1: none): rows with near words, how many, and the first of them."""
    real = stack >= 0
    front, back = rows.matrices(stack)
    prefix, suffix = shared(front), shared(back)
    length = np.where(real, rows.length[stack], 0)
    longer = np.maximum(length[:, :, None], length[:, None, :])
    near = prefix.astype(np.int32) + suffix >= longer - 1
    short = length == rows.size[stack]
    near &= short[:, :, None] | short[:, None, :]
    near &= real[:, :, None] & real[:, None, :]
    block = rows.block[stack]
    near &= ~rows.paired[stack][:, :1, None] | (block[:, :, None] != block[:, None, :])
    lead = stack[:, 0]  # every tile has rows; what follows is the same for all of them
    near &= rows.head[lead][:, None, None] | (prefix < rows.first[lead][:, None, None])
    own = np.arange(stack.shape[1])
    near[:, own, own] = False
    counts = near.sum(axis=2)
    g, s = np.nonzero(counts)
    return stack[g, s], counts[g, s], stack[g, near[g, s].argmax(axis=1)]


def stacks(starts: np.ndarray, sizes: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Tiles of like size, as matrices of row numbers filled up with -1."""
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 1]
    i = 0
    while i < len(order):
        least = sizes[order[i]]
        j = int(np.searchsorted(sizes[order], least * UNEVEN, "right"))
        most = sizes[order[j - 1]]
        j = min(j, i + max(1, STACK_CELLS // int(most * max(most, width))))
        taken = order[i:j]
        k = np.arange(int(sizes[taken].max()))
        yield np.where(k < sizes[taken][:, None], starts[taken][:, None] + k, -1)
        i = j


def near_words(table: pa.Table) -> pa.RecordBatch:
    """Partial answers of whole tiles, whose rows stand together, the most frequent word first."""
    rows = Rows(table)
    ids = np.stack([table["key"].combine_chunks().dictionary_encode().indices.to_numpy(), table["a"].to_numpy(), table["b"].to_numpy()])
    starts = np.flatnonzero(np.r_[True, (ids[:, 1:] != ids[:, :-1]).any(axis=0)])
    sizes = np.diff(np.r_[starts, len(rows.words)])
    found = [compared(rows, stack) for stack in stacks(starts, sizes, int(rows.length.max()))]
    word, count, best = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3))
    text = table["word"].combine_chunks()
    return pa.record_batch(
        [text.take(pa.array(word)), pa.array(count, pa.int64()), pa.array(rows.n[best], pa.int64()), text.take(pa.array(best))],
        names=["word", "n_near", "best_n", "best"],
    )


def compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile -> partial answers; the last tile of a batch waits for the next batch."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        last = tuple(table[c][-1].as_py() for c in ("key", "a", "b"))
        cut = table.num_rows
        while cut and tuple(table[c][cut - 1].as_py() for c in ("key", "a", "b")) == last:
            cut -= 1
        if cut:
            yield near_words(table.slice(0, cut))
        rest = table.slice(cut)
    if rest is not None:
        yield near_words(rest)


# --- forms and roots --------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """word, root for (word, form) pairs without circles: pointer doubling until no pointer moves."""
    pointers = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = pointers.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = pointers.join(onward, "root", "left")
        moved = stored(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        pointers = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return pointers


def variant_groups(words: DataFrame, factor: int = 2, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table (word, n) of distinct words."""
    words = stored(words.select("word", F.col("n").cast("long").alias("n")).where("word is not null and word <> ''"), "words")
    laid = tiles(words, tile).repartition("key", "a", "b")
    laid = laid.sortWithinPartitions("key", "a", "b", F.desc("n"), "word")
    partial = laid.mapInArrow(compare_tiles, NEAR)
    # Of equally frequent words the first in code-point order: the least pair of (-n, word).
    near = partial.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("best")
    )
    known = words.join(near, "word", "left")
    frequent = -F.col("best.less") >= factor * F.col("n")
    known = known.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.best")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n"),
    )
    known = stored(known, "near")
    ends = roots(known.where("form is not null").select("word", "form"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variant groups of the words of ``documents``."""
    return variant_groups(word_counts(docs))
