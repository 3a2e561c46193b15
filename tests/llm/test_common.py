"""Slices of Arrow arrays: what an operator sees of a text must not depend on the batch around it."""

import random

import numpy as np
import pyarrow as pa
import pytest

from civicflow.llm import common, langid, licenses, quality
from civicflow.llm.common import tokenizer
from civicflow.llm.packing import Encoder


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    bits = ["Wort", "ÉÀ", "licensed under the apache license, version 2.0", "x", "漢字", "MIT License", "straße", "\n", "  ", "12", "!!"]
    out = [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return [None if k % 37 == 5 else t for k, t in enumerate(out)]


def pieces(texts, kind):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, kind)], names=["text"])
    return list(common.slices([batch.slice(3)], "text", 2000))


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_and_bytes_of_slices(texts, kind):
    parts = pieces(texts, kind)
    assert len(parts) > 10
    seen = []
    for part in parts:
        plain = common.plain_texts(part.column("text"))
        plain.validate(full=True)
        data, ends = common.raw_bytes(plain)
        words = common.Words(part.column("text"))
        vocabulary = words.vocabulary.to_pylist()
        for k in range(len(plain)):
            raw = data[ends[k] : ends[k + 1]].tobytes()
            own = [vocabulary[i].encode() for i in words.ids[words.starts[k] : words.starts[k + 1]]]
            assert own == raw.lower().split()
            seen.append(raw.decode())
    assert seen == [t or "" for t in texts[3:]]


def test_operators_see_the_same_in_slices(texts):
    parts = pieces(texts, pa.string())
    model = langid.Model(["a", "b"], np.random.default_rng(0).normal(size=(langid.SLOTS, 2)), np.empty(0, np.uint64), np.zeros((2, 2)))
    scanner = licenses.Scanner()
    encoder = Encoder(**tokenizer())
    at = 3
    for part in parts:
        own = texts[at : at + part.num_rows]
        at += part.num_rows
        fresh = pa.array([t or "" for t in own], pa.large_string())
        for stat, values in quality.text_stats(part.column("text")).items():
            assert np.allclose(values, quality.text_stats(fresh)[stat])
        got, want = langid.label_texts(model, part.column("text")), langid.label_texts(model, fresh)
        assert got[0] == want[0] and np.allclose(got[1], want[1])
        ids = pa.array(range(len(own)), pa.int64())
        scan = lambda a: licenses.scan_batch(scanner, pa.RecordBatch.from_arrays([ids, a], names=["doc_id", "text"]))
        assert scan(part.column("text")).equals(scan(fresh))
        for a, b in zip(encoder.encode(common.plain_texts(part.column("text"))), encoder.encode(fresh)):
            assert a.tolist() == b.tolist()


def test_shingles_of_slices(texts):
    for part in pieces(texts, pa.string()):
        own = [t or "" for t in part.column("text").to_pylist()]
        for t, got in zip(own, common.text_shingles(common.Words(part.column("text")), 4)):
            (want,) = common.text_shingles(common.Words(pa.array([t])), 4)
            w = t.encode().lower().split()
            assert got.tolist() == want.tolist()
            assert len(got) == len({tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else ())
