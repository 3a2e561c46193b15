import numpy as np

from civicflow.llm import langid
from civicflow.llm.queries import op5_language

from .cases import ROWS, documents


def test_held_out_accuracy_and_scores(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "lang")
    rows = op5_language(spark, sf001).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 200 and len(held) > 20
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_chunks_equal_one_pass_over_the_text():
    """Forward-backward in chunks against the plain recursion over the whole document."""
    rng = np.random.default_rng(2)
    k, transition = 3, rng.random((3, 3)) + 0.05
    lengths = [1, 5, langid.CHUNK, langid.CHUNK + 1, 3 * langid.CHUNK - 1]
    chunks = [-(-n // langid.CHUNK) for n in lengths]
    emission = rng.random((sum(chunks), langid.CHUNK, k)) + 0.01
    mask = np.zeros(emission.shape[:2], bool)
    document = np.repeat(np.arange(len(lengths)), chunks)
    at = 0
    for n, c in zip(lengths, chunks):
        mask[at : at + c].reshape(-1)[:n] = True
        at += c
    got = langid.chunk_marginals(emission, transition, mask, document)
    for d in range(len(lengths)):
        e = emission[document == d].reshape(-1, k)[: lengths[d]]
        f, forward = np.full(k, 1 / k), []
        for row in e:
            f = (f @ transition) * row
            f /= f.sum()
            forward.append(f)
        g, want = np.ones(k), []
        for row, f in zip(e[::-1], forward[::-1]):
            want.append(f * g / (f * g).sum())
            g = transition @ (row * g)
            g /= g.sum()
        assert np.allclose(got[document == d].reshape(-1, k)[: lengths[d]], want[::-1])


def test_marginals_and_gradient_of_the_fit():
    """Expected transitions sum to the steps, and marginals agree with enumerating all label sequences."""
    import itertools

    rng = np.random.default_rng(3)
    emission, transition = rng.random((1, 4, 2)), rng.random((2, 2))
    got, pairs = langid.sequence_marginals(emission, transition)
    want, total = np.zeros((4, 2)), 0.0
    for path in itertools.product(range(2), repeat=4):
        p = sum(transition[s, path[0]] for s in range(2)) * emission[0, 0, path[0]]
        for t in range(1, 4):
            p *= transition[path[t - 1], path[t]] * emission[0, t, path[t]]
        total += p
        want[range(4), path] += p
    assert np.allclose(got[0], want / total) and np.isclose(pairs.sum(), 3)


def test_code_switched_text_is_labelled_word_by_word():
    import pyarrow as pa

    rows = [{"lang": "aa", "text": "\n".join("baba gaga dada " * 6 for _ in range(10))},
            {"lang": "zz", "text": "\n".join("zixi wixu yuzu " * 6 for _ in range(10))}]
    model = langid.fit(rows)
    best, score = langid.label_texts(model, pa.array(["baba dada gaga zixi", "zixi yuzu wixu baba", "", "12 34"]))
    assert best == [0, 1, None, None] and 0.6 < score[0] < 0.9 and 0.6 < score[1] < 0.9


def test_edge_cases(spark):
    rows = langid.identify_languages(documents(spark)).collect()
    assert len(rows) == len(ROWS)
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert {2, 3, 4, 9} <= und and all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")
    assert {r["lang_pred"] for r in rows} <= {"en", "und"}
    assert langid.identify_languages(documents(spark, [])).collect() == []
    nothing = langid.identify_languages(documents(spark, [(0, "words to label")])).collect()
    assert [r["lang_pred"] for r in nothing] == ["und"]


def test_every_language_is_learned_also_from_long_texts_only(spark):
    """More languages than any fixed number of the most frequent ones; the rarest has only long texts."""
    rng = np.random.default_rng(4)
    names = [f"l{j:02d}" for j in range(24)]
    pairs = [(c, v) for c in "bcdfghjklmnpqrstvwxz" for v in "aeiou"]
    order = rng.permutation(len(pairs))
    syllables = {name: ["".join(pairs[i]) for i in order[4 * j : 4 * j + 4]] for j, name in enumerate(names)}
    word = lambda lang: "".join(rng.choice(syllables[lang], 3))
    line = lambda lang: " ".join(word(lang) for _ in range(12))
    rows, truth = [], {}
    for j, lang in enumerate(names):
        long = lang == names[-1]
        for k in range(8 if long else 30 - j):
            i = len(rows)
            text = "\n".join(line(lang) for _ in range(400 if long else 6))
            assert (len(text) > langid.TRAIN_BYTES) == long
            rows.append((i, text, lang if k % 4 else None))
            truth[i] = lang
    got = langid.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r["lang_pred"] for r in got} == set(names)
    for lang in names:
        assert np.mean([r["lang_pred"] == lang for r in got if truth[r["doc_id"]] == lang]) >= 0.9
    # A long text without line breaks is cut between words, one without blanks anywhere.
    odd = spark.createDataFrame([("ab " * 9000,), ("é" * 15_000,), ("\n" * 30_000 + "ab cd",)], "text string")
    cut = [r[0] for r in odd.select(langid.beginning(odd.text)).collect()]
    assert cut[0] == "ab " * 6666 and cut[1] == "é" * 10_000 and cut[2] == "ab cd"
