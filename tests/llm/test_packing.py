import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from civicflow.llm import packing
from civicflow.llm.common import tokenizer
from civicflow.llm.queries import op4_packing

from .cases import ROWS, documents


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer()["json_path"])
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(**tokenizer())


def test_ids_are_those_of_the_tokenizers_library(plain, encoder, spark, sf001):
    rng = random.Random(3)
    bits = ["a", "é", " ", "  ", "\n", " \n", "don't", "I'll", "'s", "123", "!!", "\t", "漢", "\u0085", "x" * 50,
            "<|endoftext|>", " ", "ß", "🙂", "\x1c", "­", "Ω", " ", "ſ"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    texts += ["", " ", "a", "a b", " a", "a "] + [r["text"] for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()]
    for text, ids in zip(texts, encoder.encode(pa.array(texts, pa.large_string()))):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_ids_of_any_text(texts):
    from tokenizers import Tokenizer

    e = _ENCODER.setdefault("e", None) or packing.Encoder(**tokenizer())
    p = _ENCODER.setdefault("p", None) or Tokenizer.from_file(tokenizer()["json_path"])
    p.encode_special_tokens = True
    _ENCODER.update(e=e, p=p)
    for text, ids in zip(texts, e.encode(pa.array(texts, pa.large_string()))):
        assert ids.tolist() == p.encode(text, add_special_tokens=False).ids


_ENCODER: dict = {}


def check(rows, docs, plain, capacity):
    """Round trip: the pieces cover every document's ids once, sequences are gapless and within capacity."""
    by_text = collections.Counter()
    for _, text in docs:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        a, k = 0, 0
        while a < len(ids):
            n = (len(ids) % capacity or capacity) if a == 0 and len(ids) > capacity else min(capacity, len(ids) - a)
            by_text[k, a, n, zlib.crc32(ids[a : a + n])] += 1
            a, k = a + n, k + 1
    assert collections.Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == by_text
    place = collections.defaultdict(list)
    for r in rows:
        place[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in place.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= capacity
    return len(place)


def test_whole_table(spark, sf001, plain):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()]
    rows = op4_packing(spark, sf001).collect()
    used = check(rows, docs, plain, 2048)
    assert used <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_edge_cases(spark, plain):
    docs = list(ROWS)
    for capacity in (64, 1):
        some = docs if capacity > 1 else docs[:6]
        rows = packing.pack(documents(spark, some), tokenizer(), capacity).collect()
        check(rows, some, plain, capacity)
    assert packing.pack(documents(spark, []), tokenizer()).collect() == []


def test_steps_equal_best_fit_decreasing():
    rng = np.random.default_rng(0)
    for _ in range(200):
        capacity = int(rng.integers(1, 60))
        counts = {int(k): int(v) for k, v in zip(rng.integers(1, capacity + 1, 20), rng.integers(1, 40, 20))}
        plan = packing.best_fit(counts, capacity)
        lengths = [k for k in sorted(counts, reverse=True) for _ in range(counts[k])]
        number = np.arange(len(lengths))
        k = np.searchsorted(plan.start, number, side="right") - 1
        rank = number - plan.start[k]
        place = collections.defaultdict(list)
        for s, o, n in zip(plan.first[k] + rank // plan.each[k], plan.offset[k] + rank % plan.each[k] * plan.length[k], lengths):
            place[s].append((o, n))
        for parts in place.values():
            end = 0
            for at, n in sorted(parts):
                assert at == end
                end += n
            assert end <= capacity
        room: list[int] = []
        for n in lengths:
            fits = [j for j, g in enumerate(room) if g >= n]
            if fits:
                room[min(fits, key=lambda j: room[j])] -= n
            else:
                room.append(capacity - n)
        assert len(place) == plan.sequences == len(room)
