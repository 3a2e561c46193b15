"""Exact top-k search by inner product over quantised vectors.

Exhaustive, term at a time.  A component's number is a term; a block of candidates keeps one posting list
per term: the slots that have a weight there, and the weights.  A query is a sparse row of (term, weight).
Its terms are taken one after the other, and each scatters weight times posting weights into the block's
dense score array.  The k best of a block are cut out by a partition of the array, and the blocks' bests
are merged per query by a window with a limit, which Spark also applies before the exchange.

Queries and candidates meet in a grid of blocks: every query block is sent to every candidate block, and
the other way round.  A block holds at most ``BLOCK`` rows, fewer when vectors are long (``CELLS`` components).
A block is given by the hash of a row's own number, so copies and hot ids spread like other rows.

Weights are floor(256 * x) of the component x as a double; scores are whole numbers.  Blocks whose scores
could leave 64 bits are computed with Python's integers; a score beyond 64 bits counts as the end of their
range.

Null vectors, and those that hold a null, a NaN or an infinity, are neither queries nor candidates.  Vectors
of different length have weight 0 where they end; an empty vector scores 0 with all.  A row without an id
is a candidate, ordered after those with one.  Every row is its own: rows that repeat an id are candidates
of each other, and each of them that is a query has its own list.  Equal scores go to the smaller id.  With
fewer candidates than k all are returned; an empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BLOCK = 4096
CELLS = 1 << 20
SCALE = 256
LONG = np.iinfo(np.int64)
FOUND = "query_row long, query_id long, vec_id long, row long, score long"


def numbered_vectors(vectors: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id, components of the vectors that take part."""
    finite = F.forall("components", lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("components")
    ).where(F.col("components").isNotNull() & finite)
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "topk-rows")


def weights_of(components: np.ndarray) -> np.ndarray:
    """floor(256 x) as doubles, exact; as Python integers where a double cannot hold 256 x."""
    with np.errstate(over="ignore"):
        weights = np.floor(SCALE * components)
    if np.isfinite(weights).all():
        return weights
    return np.array([math.floor(x) * SCALE if abs(x) > 2.0**60 else math.floor(SCALE * x) for x in components.tolist()], object)


def sparse_rows(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of all weights that are not 0, row by row."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    rows = np.repeat(np.arange(len(lists)), lengths)
    terms = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    weights = weights_of(lists.flatten().to_numpy(zero_copy_only=False))
    full = np.flatnonzero(weights != 0)
    return rows[full], terms[full], weights[full]


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Slots of the k largest scores, largest first; equal scores in slot order."""
    slots = np.arange(len(scores))
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        slots = np.flatnonzero(scores >= least)
    return slots[np.argsort(~scores[slots], kind="stable")[:k]]


def block_best(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of one block for each query of one block."""
    candidates = candidates.sort_by([("vec_id", "ascending"), ("row", "ascending")])
    n = len(candidates)
    own_slot = {row: slot for slot, row in enumerate(candidates["row"].to_pylist())}
    slots, terms, weights = sparse_rows(candidates["components"])
    q_rows, q_terms, q_weights = sparse_rows(queries["components"])
    largest = lambda w: int(max(abs(w).max(initial=0), 0))
    width = int(max(terms.max(initial=0), q_terms.max(initial=0))) + 1
    exact = largest(weights) * largest(q_weights) * width <= LONG.max and max(largest(weights), largest(q_weights)) < 2**62
    kind = np.int64 if exact else object
    if not exact:
        weights, q_weights = (np.array([int(x) for x in w], object) for w in (weights, q_weights))
    weights, q_weights = weights.astype(kind), q_weights.astype(kind)

    by_term = np.argsort(terms, kind="stable")
    ends = np.searchsorted(terms[by_term], np.arange(width + 1))
    postings = []
    for a, b in zip(ends[:-1], ends[1:]):
        at = by_term[a:b]
        postings.append((slice(None) if b - a == n else slots[at], weights[at]))

    q_ends = np.searchsorted(q_rows, np.arange(len(queries) + 1))
    picked: list[np.ndarray] = []
    gained: list[np.ndarray] = []
    for i, row in enumerate(queries["row"].to_pylist()):
        scores = np.zeros(n, kind)
        for j in range(q_ends[i], q_ends[i + 1]):
            where, values = postings[q_terms[j]]
            scores[where] += q_weights[j] * values
        if not exact:
            scores = np.array([min(max(x, LONG.min), LONG.max) for x in scores.tolist()], np.int64)
        top = best(scores, k + 1)
        top = top[top != own_slot.get(row, -1)][:k]
        picked.append(top)
        gained.append(scores[top])
    counts = np.array([len(p) for p in picked], np.int64)
    of_query = np.repeat(np.arange(len(queries)), counts)
    found = np.concatenate(picked) if picked else np.empty(0, np.int64)
    return pa.table(
        {
            "query_row": queries["row"].take(of_query),
            "query_id": queries["vec_id"].take(of_query),
            "vec_id": candidates["vec_id"].take(found),
            "row": candidates["row"].take(found),
            "score": pa.array(np.concatenate(gained) if gained else [], pa.int64()),
        }
    )


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for every row whose id ``every`` divides."""
    rows = numbered_vectors(vectors)
    is_query = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    size = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("queries"), F.max(F.size("components")).alias("width")
    ).first()
    block = max(1, min(block, CELLS // max(1, size["width"] or 1)))
    parts, query_parts = max(1, -(-size["n"] // block)), max(1, -(-size["queries"] // block))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = rows.where(is_query).withColumn("query_part", dealt(query_parts)).withColumn("part", all_of(parts))
    candidates = rows.withColumn("part", dealt(parts)).withColumn("query_part", all_of(query_parts))
    found = (
        queries.groupBy("query_part", "part")
        .cogroup(candidates.groupBy("query_part", "part"))
        .applyInArrow(lambda left, right: block_best(left, right, k), FOUND)
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
