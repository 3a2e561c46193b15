"""Language identification by a linear-chain conditional random field over words.

Every word has features of its form: all byte n-grams of 2 to 4 bytes of the word between a start and an
end mark (those with a mark are its affixes), and its entry in a lexicon learned from the training words.
The chain adds learned transitions between the languages of neighbouring words, so code-switched text is
labelled word by word: forward-backward gives each word's probabilities, and a document's language is the
one with the largest expected share of its words.

The model knows every language that a labelled document has.  It is fitted on a sample of them: about
``TRAIN_DOCS`` texts, equally many per language and at least ``FEWEST`` (if there are so many), of longer ones
the whole lines of their first ``TRAIN_BYTES`` bytes.  Their lines are dealt into mixed sequences, so that
transitions between languages are seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GOLDEN, Words, id_remainder, mix64, raw_bytes, slices, word_hashes

TRAIN_DOCS = 1200
TRAIN_BYTES = 20_000
#: Texts per language, however many languages there are.
FEWEST = 20
#: Slots of hashed n-gram weights.
SLOTS = 1 << 17
LEXICON_COUNT = 3
SEQUENCE = 50
STEPS = 40
RATE = 0.3
RIDGE = 1e-4
#: Words per chunk of the parallel forward-backward pass.
CHUNK = 32
#: Bytes of text labelled at a time with up to 4 languages, less with more.
LABEL_BYTES = 4 << 20
#: Numbers per array of the fit's forward-backward pass.
FIT_CELLS = 4 << 20
BLANKS = " \t\n\x0b\x0c\r"

LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = True
LETTER[0x80:] = True


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (slots + lexicon entries, languages)
    lexicon: np.ndarray  # sorted word hashes
    transitions: np.ndarray  # log weights, from language to language


class Features:
    """Feature numbers of an array of words: ``ids``, those of word k from ``starts[k]`` on."""

    def __init__(self, words: pa.Array, lexicon: np.ndarray):
        words = pc.utf8_lower(words.cast(pa.large_string()))
        start, end, between = (pa.scalar(c, pa.large_string()) for c in ("\x02", "\x03", ""))
        marked = pc.binary_join_element_wise(start, words, end, between)
        data, ends = raw_bytes(marked)
        n = len(words)
        owner = np.repeat(np.arange(n), np.diff(ends))
        room = ends[1:][owner] - np.arange(len(data))  # bytes from here to the end of the word
        found_ids, found_owner = [], []
        code = data.astype(np.uint64)
        for length in range(2, 5):
            code = code[:-1] | (data[length - 1 :].astype(np.uint64) << np.uint64(8 * (length - 1)))
            fits = np.flatnonzero(room[: len(code)] >= length)
            found_ids.append((mix64(code[fits] * GOLDEN + np.uint64(length)) % np.uint64(SLOTS)).astype(np.int64))
            found_owner.append(owner[fits])
        hashes = word_hashes(words)
        at = np.searchsorted(lexicon, hashes)
        known = np.zeros(n, bool)
        inside = at < len(lexicon)
        known[inside] = lexicon[at[inside]] == hashes[inside]
        found_ids.append(SLOTS + at[known])
        found_owner.append(np.flatnonzero(known))
        ids, own = np.concatenate(found_ids), np.concatenate(found_owner)
        order = np.argsort(own, kind="stable")
        self.ids, self.owner = ids[order], own[order]
        self.count = np.bincount(own, minlength=n)
        self.scale = 1 / np.sqrt(np.maximum(self.count, 1))
        letters = np.r_[0, np.cumsum(LETTER[data])]
        self.letters = letters[ends[1:]] > letters[ends[:-1]]
        # Words without a letter say nothing about the language.
        self.scale[~self.letters] = 0

    def scores(self, weights: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.count), weights.shape[1]))
        for k in range(weights.shape[1]):
            out[:, k] = np.bincount(self.owner, weights=weights[:, k][self.ids], minlength=len(self.count))
        return out * self.scale[:, None]


def chunk_marginals(emission: np.ndarray, transition: np.ndarray, mask: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Label probabilities of every word, by forward-backward.

    ``emission`` (chunks, words, labels) and ``transition`` are non-negative factors, ``mask`` marks real
    words (a prefix of each chunk), ``document`` gives each chunk's document; chunks are in order.  Products
    over chunks are formed side by side, then carried along each document, then opened up again.
    """
    m, c, k = emission.shape
    product = np.broadcast_to(np.eye(k), (m, k, k)).copy()
    for t in range(c):
        step = (product.reshape(m * k, k) @ transition).reshape(m, k, k) * emission[:, t, None, :]
        step /= step.max(axis=(1, 2), keepdims=True)
        live = mask[:, t]
        product[live] = step[live]
    first = np.flatnonzero(np.r_[True, document[1:] != document[:-1]]) if m else np.empty(0, np.int64)
    last = np.r_[first[1:], m] - 1
    before, after = np.full((m, k), 1.0 / k), np.ones((m, k))
    longest = int((last - first).max()) if m else 0
    for j in range(longest):
        at = (first + j)[first + j < last]
        v = np.einsum("ij,ijk->ik", before[at], product[at])
        before[at + 1] = v / v.sum(axis=1, keepdims=True)
        at = (last - j)[last - j > first]
        v = np.einsum("ijk,ik->ij", product[at], after[at])
        after[at - 1] = v / v.sum(axis=1, keepdims=True)
    forward = np.empty((m, c, k))
    f = before
    for t in range(c):
        step = (f @ transition) * emission[:, t]
        step /= step.sum(axis=1, keepdims=True)
        f = np.where(mask[:, t, None], step, f)
        forward[:, t] = f
    g = after
    for t in range(c - 1, -1, -1):
        forward[:, t] *= g
        step = (emission[:, t] * g) @ transition.T
        step /= step.sum(axis=1, keepdims=True)
        g = np.where(mask[:, t, None], step, g)
    return forward / forward.sum(axis=2, keepdims=True)


def label_texts(model: Model, texts: pa.Array) -> tuple[list[int | None], np.ndarray]:
    """Per text the language with the largest expected share of its words, and that share."""
    words = Words(texts)
    n = len(words.counts)
    k = len(model.languages)
    if not len(words.ids) or not k:
        return [None] * n, np.zeros(n)
    features = Features(words.vocabulary, model.lexicon)
    scores = features.scores(model.weights)
    factor = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -30, 0))
    chunks = -(-words.counts // CHUNK)
    document = np.repeat(np.arange(n), chunks)
    opening = np.r_[0, np.cumsum(chunks)][:-1]
    owner = np.repeat(np.arange(n), words.counts)
    place = np.arange(len(words.ids)) - words.starts[:-1][owner] + opening[owner] * CHUNK
    emission = np.ones((len(document) * CHUNK, k))
    mask = np.zeros(len(document) * CHUNK, bool)
    emission[place], mask[place] = factor[words.ids], True
    shape = (len(document), CHUNK)
    marginals = chunk_marginals(emission.reshape(*shape, k), np.exp(model.transitions), mask.reshape(shape), document)
    told = marginals.reshape(-1, k)[place]
    voice = features.letters[words.ids].astype(np.float64)
    share = np.stack([np.bincount(owner, weights=told[:, j] * voice, minlength=n) for j in range(k)], axis=1)
    total = share.sum(axis=1)
    best = share.argmax(axis=1)
    score = share.max(axis=1) / np.maximum(total, 1e-300)
    return [int(b) if t > 0 else None for b, t in zip(best, total)], np.where(total > 0, np.clip(score, 0, 1), 0)


# --- fitting -------------------------------------------------------------------------------------


def beginning(text: Column) -> Column:
    """A text of at most ``TRAIN_BYTES`` bytes, of a longer one its first whole lines, or words, up to about there."""
    whole = F.ltrim(text, F.lit(BLANKS))
    head = F.left(whole, F.floor(F.lit(TRAIN_BYTES) * F.length(whole) / F.octet_length(whole)).cast("int"))
    upto = lambda mark: F.left(head, F.length(head) - F.length(F.substring_index(head, mark, -1)))
    cut = F.when(F.instr(head, "\n") > 0, upto("\n")).when(F.instr(head, " ") > 0, upto(" ")).otherwise(head)
    return F.when(F.octet_length(text) <= TRAIN_BYTES, text).when(F.octet_length(whole) <= TRAIN_BYTES, whole).otherwise(cut)


def training_sample(documents: DataFrame, limit: int = TRAIN_DOCS) -> list:
    """Rows (lang, text) of every language, chosen by a hash of the id: ``limit`` over the languages, or ``FEWEST`` each."""
    usable = documents.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull()
        & (F.trim(F.col("text"), F.lit(BLANKS)) != "")
        & (id_remainder(F.col("doc_id"), 4) != 2)
    )
    counts = usable.groupBy("lang").count().collect()  # one row per language
    if not counts:
        return []
    quota = max(FEWEST, limit // len(counts))
    wide = 1 << 30
    limits = documents.sparkSession.createDataFrame(
        [(r["lang"], int(wide * min(1.0, 2 * quota / r["count"])) + 1) for r in counts], "lang string, _below long"
    )
    key = F.xxhash64("doc_id", "text")
    near = usable.withColumn("_key", key).join(F.broadcast(limits), "lang").where(F.pmod("_key", F.lit(wide)) < F.col("_below"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("_key", F.lit(wide)), "_key"))
    rows = near.withColumn("_rank", rank).where(F.col("_rank") <= quota)
    # Bounded by ``quota`` for each language.
    return rows.select("lang", beginning(F.col("text")).alias("text"), "_key").orderBy("lang", "_key").collect()


def fit(rows: list, seed: int = 5) -> Model:
    languages = sorted({r["lang"] for r in rows})
    k = len(languages)
    if not rows:
        return Model([], np.zeros((SLOTS, 0)), np.empty(0, np.uint64), np.zeros((0, 0)))
    number = {lang: j for j, lang in enumerate(languages)}
    lines, labels = [], []
    for r in rows:
        for line in r["text"].split("\n"):
            if line.strip():
                lines.append(line)
                labels.append(number[r["lang"]])
    words = Words(pa.array(lines, pa.large_string()))
    order = np.random.default_rng(seed).permutation(len(lines))
    token = np.concatenate([words.ids[words.starts[i] : words.starts[i + 1]] for i in order])
    truth = np.repeat(np.array(labels)[order], words.counts[order])
    length = min(SEQUENCE, len(token))
    if not length:
        return Model(languages, np.zeros((SLOTS, k)), np.empty(0, np.uint64), np.zeros((k, k)))
    # The last sequence overlaps the one before it, so that no word is left out.
    opening = np.minimum(np.arange(0, len(token), length), len(token) - length)[:, None] + np.arange(length)
    token, truth = token[opening], truth[opening]
    often = np.bincount(words.ids, minlength=len(words.vocabulary)) >= LEXICON_COUNT
    lexicon = np.unique(word_hashes(pc.utf8_lower(words.vocabulary))[often])
    features = Features(words.vocabulary, lexicon)
    # Weights of features that no training word has stay zero.
    used, features.ids = np.unique(features.ids, return_inverse=True)
    weights, trans = np.zeros((len(used), k)), np.zeros((k, k))
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (weights, trans)]
    part = max(1, FIT_CELLS // (length * k))
    for step in range(1, STEPS + 1):
        scores = features.scores(weights)
        factor = np.exp(scores - scores.max(axis=1, keepdims=True))
        wrong, pairs = np.zeros((len(features.count), k)), np.zeros((k, k))
        for a in range(0, len(token), part):
            own, right = token[a : a + part], truth[a : a + part]
            marginals, more = sequence_marginals(factor[own], np.exp(trans))
            marginals[np.arange(len(own))[:, None], np.arange(length), right] -= 1
            pairs += more
            for j in range(k):
                wrong[:, j] += np.bincount(own.ravel(), weights=marginals[:, :, j].ravel(), minlength=len(wrong))
        wrong *= features.scale[:, None]
        grad = np.stack(
            [np.bincount(features.ids, weights=wrong[:, j][features.owner], minlength=len(weights)) for j in range(k)], 1
        )
        grads = (grad / token.size + RIDGE * weights / len(languages), (pairs - seen) / token.size + RIDGE * trans)
        for p, g, (mean, square) in zip((weights, trans), grads, state):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            p -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    full = np.zeros((SLOTS + len(lexicon), k))
    full[used] = weights
    return Model(languages, full, lexicon, trans)


def sequence_marginals(emission: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word marginals (sequences, words, labels) and expected transition counts of equally long sequences."""
    s, t, k = emission.shape
    forward = np.empty_like(emission)
    f = np.full((s, k), 1.0 / k)
    for i in range(t):
        f = (f @ transition) * emission[:, i]
        f /= f.sum(axis=1, keepdims=True)
        forward[:, i] = f
    out = np.empty_like(emission)
    pairs = np.zeros((k, k))
    g = np.ones((s, k))
    for i in range(t - 1, -1, -1):
        m = forward[:, i] * g
        out[:, i] = m / m.sum(axis=1, keepdims=True)
        tail = emission[:, i] * g
        if i:
            before = forward[:, i - 1]
            before = before / ((before @ transition) * tail).sum(axis=1, keepdims=True)
            pairs += transition * (before.T @ tail)
        g = tail @ transition.T
        g /= g.sum(axis=1, keepdims=True)
    return out, pairs


# --- operator ------------------------------------------------------------------------------------

LABEL_SCHEMA = "doc_id long, lettered boolean, lang string, score double"


def identify_languages(documents: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The language of every whole text of ``documents`` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Learns from rows with a non-null lang whose crc32(doc_id as text) mod 4 is not 2 (held_out: it is 2).
    Only the text enters a prediction.  A null text or one without a letter is ``und`` with score 0, and so
    is everything if there is nothing to learn from; an empty table gives an empty result.  Null ids are labelled too (held_out by the empty
    text); repeated rows give repeated results; other columns are ignored.  Nothing but the training sample
    is shuffled.
    """
    model = fit(training_sample(documents, train_docs))
    # The arrays of a slice have words x labels numbers, and words / CHUNK x labels x labels.
    k = max(4, len(model.languages))
    limit = max(1, int(LABEL_BYTES * (4 / k) / max(1, k / CHUNK)))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, None], object)
        for batch in slices(batches, "text", limit):
            best, score = label_texts(model, batch.column("text"))
            lang = pa.array(names[[len(names) - 1 if b is None else b for b in best]], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lettered"), lang, pa.array(score)],
                names=["doc_id", "lettered", "lang", "score"],
            )

    source = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
        "text",
    )
    told = source.mapInArrow(label, LABEL_SCHEMA)
    sure = F.col("lettered") & F.col("lang").isNotNull()
    return told.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        F.when(sure, F.col("lang")).otherwise(F.lit("und")).alias("lang_pred"),
        F.when(sure, F.col("score")).otherwise(F.lit(0.0)).alias("score"),
    )
