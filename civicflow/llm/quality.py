"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Every whole text is reduced to a few statistics (``STATS``) in one pass.
2. Small boosted trees are grown on a bounded sample of labelled rows; every path from a root to a node
   is a conjunctive rule such as ``symbol_share > 0.04 AND word_bytes <= 6.1``.
3. A lasso logistic regression weighs the rules; most weights become exactly zero.
4. The rules that remain are compiled into one Spark column expression over the statistics, which scores
   every row inside whole-stage code.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, id_remainder, plain_texts, raw_bytes, slices, stored

STATS = (
    "log_bytes log_words word_bytes upper_share digit_share punct_share symbol_share bang_share "
    "high_share line_words distinct_share repeated_line_share"
).split()
STATS_TYPE = T.StructType([T.StructField(s, T.DoubleType()) for s in STATS])

#: Labelled rows used for fitting, chosen by a hash of their id.
TRAIN_ROWS = 20_000
TREES = 24
DEPTH = 3
CUTS = 24
LASSO = 2e-3

UPPER, DIGIT, PUNCT, SYMBOL, BANG, SPACE, HIGH = range(1, 8)
CLASSES = np.zeros(256, np.uint8)
CLASSES[ord("A") : ord("Z") + 1] = UPPER
CLASSES[ord("0") : ord("9") + 1] = DIGIT
for _c in b".,;:?'\"()-":
    CLASSES[_c] = PUNCT
for _c in b"#$%&*+/<=>@[\\]^_`{|}~":
    CLASSES[_c] = SYMBOL
CLASSES[ord("!")] = BANG
for _c in b" \t\n\v\f\r":
    CLASSES[_c] = SPACE
CLASSES[0x80:] = HIGH


def text_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of each text; a null text counts as empty, an empty one has zeros throughout."""
    plain = plain_texts(texts)
    data, ends = raw_bytes(plain)
    lengths = np.diff(ends)
    kinds = CLASSES[data]

    def count(kind: int) -> np.ndarray:
        total = np.r_[0, np.cumsum(kinds == kind, dtype=np.int64)]
        return total[ends[1:]] - total[ends[:-1]]

    some = np.maximum(lengths, 1)
    words = Words(plain)
    n_words = words.counts
    owner = np.repeat(np.arange(len(plain)), n_words)
    pairs = np.unique(owner * max(len(words.vocabulary), 1) + words.ids)
    distinct = np.bincount(pairs // max(len(words.vocabulary), 1), minlength=len(plain))

    lines = pc.split_pattern(plain, "\n")
    n_lines = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(pc.list_flatten(lines))
    line_pairs = np.unique(
        np.repeat(np.arange(len(plain)), n_lines) * max(len(coded.dictionary), 1)
        + coded.indices.to_numpy(zero_copy_only=False)
    )
    distinct_lines = np.bincount(line_pairs // max(len(coded.dictionary), 1), minlength=len(plain))
    spaces = count(SPACE)
    out = {
        "log_bytes": np.log1p(lengths),
        "log_words": np.log1p(n_words),
        "word_bytes": (lengths - spaces) / np.maximum(n_words, 1),
        "upper_share": count(UPPER) / some,
        "digit_share": count(DIGIT) / some,
        "punct_share": count(PUNCT) / some,
        "symbol_share": count(SYMBOL) / some,
        "bang_share": count(BANG) / some,
        "high_share": count(HIGH) / some,
        "line_words": n_words / np.maximum(n_lines, 1),
        "distinct_share": distinct / np.maximum(n_words, 1),
        "repeated_line_share": 1 - distinct_lines / np.maximum(n_lines, 1),
    }
    return {s: np.where(lengths > 0, out[s], 0.0) for s in STATS}


@F.arrow_udf(STATS_TYPE)
def stats_udf(texts: pa.Array) -> pa.Array:
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    parts = [text_stats(piece.column("text")) for piece in slices([batch], "text")]
    cols = [np.concatenate([p[s] for p in parts]) if parts else np.empty(0) for s in STATS]
    return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in cols], names=STATS)


# --- fitting on a bounded sample -----------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    stat: str
    above: bool
    cut: float

    def column(self, stats: str) -> Column:
        value = F.col(stats).getField(self.stat)
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, STATS.index(self.stat)]
        return v > self.cut if self.above else v <= self.cut


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, stats: str) -> Column:
        """The probability of label 1 as one column expression over the struct column ``stats``."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            held = rule[0].column(stats)
            for c in rule[1:]:
                held = held & c.column(stats)
            total = total + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(x: np.ndarray, grad: np.ndarray, cuts: list[np.ndarray], stats: np.ndarray, depth: int):
    """Grows one least-squares tree; yields (rule, rows, mean gradient, is_leaf) of each node below the root."""
    out = []

    def grow(rows: np.ndarray, path: Rule) -> None:
        best = None
        if len(path) < depth and len(rows) >= 20:
            g = grad[rows]
            base = g.sum() ** 2 / len(rows)
            for f in stats:
                v = x[rows, f]
                place = np.searchsorted(cuts[f], v, side="left")  # v <= cuts[k] exactly if place <= k
                n = np.cumsum(np.bincount(place, minlength=len(cuts[f]) + 1))[:-1]
                s = np.cumsum(np.bincount(place, weights=g, minlength=len(cuts[f]) + 1))[:-1]
                ok = (n >= 5) & (len(rows) - n >= 5)
                if not ok.any():
                    continue
                rest = np.maximum(len(rows) - n, 1)
                gain = np.where(ok, s**2 / np.maximum(n, 1) + (g.sum() - s) ** 2 / rest - base, -1)
                k = int(np.argmax(gain))
                if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                    best = (gain[k], f, float(cuts[f][k]))
        if path:
            out.append((path, rows, float(grad[rows].mean()), best is None))
        if best:
            _, f, cut = best
            low = x[rows, f] <= cut
            grow(rows[low], (*path, Condition(STATS[f], False, cut)))
            grow(rows[~low], (*path, Condition(STATS[f], True, cut)))

    grow(np.arange(len(x)), ())
    return out


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> RuleModel:
    """Boosted trees -> rules -> lasso logistic weights.  No rows or one class give a constant score."""
    if not len(y):
        return RuleModel(0.0, ())
    prior = float(np.clip(y.mean(), 0.01, 0.99))
    bias = float(np.log(prior / (1 - prior)))
    if y.min() == y.max():
        return RuleModel(bias, ())
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, CUTS))) for f in range(x.shape[1])]
    margin = np.full(len(y), bias)
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        chosen = np.sort(rng.choice(x.shape[1], size=max(2, x.shape[1] // 2), replace=False))
        for rule, rows, mean, leaf in tree_rules(x, y - p, cuts, chosen, DEPTH):
            rules[rule] = None
            if leaf:
                curve = float((p[rows] * (1 - p[rows])).mean())
                margin[rows] += 0.3 * mean / max(curve, 0.05)
    names = list(rules)
    held = np.stack([np.logical_and.reduce([c.holds(x) for c in r]) for r in names], 1).astype(np.float64)
    weights, bias = lasso_logistic(held, y, LASSO, bias)
    kept = tuple((r, float(w)) for r, w in zip(names, weights) if abs(w) > 1e-6)
    return RuleModel(bias, kept)


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, bias: float, steps: int = 400):
    """Accelerated proximal gradient for the mean logistic loss plus penalty * |weights|."""
    rate = 4.0 / max(1.0, float(np.linalg.norm(x, ord="fro") ** 2 / len(y)) + 1.0)
    w = np.zeros(x.shape[1])
    v, b, c, t = w.copy(), bias, bias, 1.0
    for _ in range(steps):
        g = 1 / (1 + np.exp(-(x @ v + c))) - y
        nw = v - rate * (x.T @ g) / len(y)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - rate * penalty, 0)
        nb = c - rate * g.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)


# --- operators -----------------------------------------------------------------------------------


def fit_quality(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> RuleModel:
    """Fits on at most ``train_rows`` labelled rows whose crc32(id) mod 3 is not 1.

    ``stats`` has doc_id and the struct column stats.  A document with several labels has their least;
    null labels and ids do not count.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(id_remainder(F.col("doc_id"), 3) != 1)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
    )
    share = min(1.0, 1.2 * train_rows / max(known.count(), 1))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    rows = (
        stats.join(known, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", *[f"stats.{s}" for s in STATS])
        .limit(train_rows)
        .select("quality", *[f"stats.{s}" for s in STATS])
        .collect()  # bounded by train_rows
    )
    data = np.array([tuple(r) for r in rows], np.float64).reshape(len(rows), 1 + len(STATS))
    return fit_rules(data[:, 1:], (data[:, 0] > 0).astype(np.float64))


def quality_scores(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Scores every row of ``documents`` (doc_id, text): doc_id, held_out, score, predicted.

    Only the text enters a score.  held_out: crc32(doc_id as text) mod 3 is 1; such rows are never
    learned from.  Null and empty texts get the score of all-zero statistics, null ids are scored too
    (held_out by the empty text).  Extra columns are ignored, an empty table gives an empty result.
    """
    stats = stored(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), stats_udf("text").alias("stats")), "stats"
    )
    model = fit_quality(stats, labels, train_rows)
    scored = stats.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        model.score("stats").alias("score"),
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep_quality(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``documents``, all columns unchanged, that the classifier does not reject."""
    held = "_quality_stats"
    rows = stored(documents.withColumn(held, stats_udf("text")), "with-stats")
    model = fit_quality(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(held).alias("stats")), labels, train_rows)
    return rows.where(model.score(held) >= 0.5).select(*documents.columns)
