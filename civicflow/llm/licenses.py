"""License scan: fuzzy search for short notices.

Base labels come from exact phrases of consecutive words.  The fuzzy search finds notices that were
edited a little: a notice with at most e edits, cut into e + 1 pieces, keeps at least one piece whole
(pigeonhole).  An automaton over all pieces finds the seeds in one pass over the text, each seed bounds a
window, and the regex library's bounded-error matching verifies the window and gives span and edits.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain_texts, slices

#: Phrase of consecutive words -> label.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Short notices as they are commonly written, with the label each one shows.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
    "licensed under the apache license, version 2.0": "apache",
    "licensed under the gnu general public license, version": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms, with or without modification": "bsd",
    "licensed under cc by-nc": "cc-by-nc",
    "licensed under cc by-sa": "cc-by-sa",
    "licensed under a creative commons attribution": "cc-by",
    "subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}

#: Edits allowed per notice character; a notice of n characters may differ by n * EDIT_SHARE.
EDIT_SHARE = 0.1

WORD = np.zeros(256, bool)
WORD[ord("0") : ord("9") + 1] = True
WORD[ord("a") : ord("z") + 1] = True
WORD[ord("A") : ord("Z") + 1] = True
WORD[0x80:] = True
WORD_CLASS = rb"[0-9a-z\x80-\xff]"

SCAN_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label:string,first_char:int,last_char:int,edits:int>>"
)


def edits_allowed(notice: str) -> int:
    return int(len(notice) * EDIT_SHARE)


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice cut into edits + 1 pieces of nearly equal length, with their offsets."""
    cuts = [len(notice) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, notices: dict[str, str] = NOTICES, phrases: dict[str, str] = BASE_PHRASES):
        self.notices = [(n, label, edits_allowed(n)) for n, label in notices.items()]
        self.phrases = phrases
        words = b"|".join(
            (rb"[^0-9a-z\x80-\xff]+").join(re.escape(w.encode()) for w in p.split()) for p in phrases
        )
        # A lookahead, so that overlapping places all count.
        self.base = re.compile(rb"(?<!" + WORD_CLASS + rb")(?=(" + words + rb")(?!" + WORD_CLASS + rb"))")
        self.base_hint = {p.split()[-1].encode() for p in phrases}
        self.automaton = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (notice, _, edits) in enumerate(self.notices):
            for at, piece in pieces(notice, edits):
                seeds.setdefault(piece, []).append((k, at))
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()
        self.patterns = [
            regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={e}}}") for n, _, e in self.notices
        ]

    def base_places(self, low: bytes) -> list[tuple[int, str]]:
        """(byte offset, label) of every place of a base phrase."""
        if not any(h in low for h in self.base_hint):
            return []
        return [(m.start(), self.phrases[" ".join(self._words(m.group(1)))]) for m in self.base.finditer(low)]

    @staticmethod
    def _words(found: bytes) -> list[str]:
        return [w.decode("utf-8", "replace") for w in re.findall(WORD_CLASS + rb"+", found)]

    def candidate(self, low: str, k: int, a: int, b: int) -> tuple | None:
        """The best match of notice k in characters a to b, in the order in which matches are taken."""
        notice, label, edits = self.notices[k]
        m = self.patterns[k].search(low, a, b) if b - a >= len(notice) - edits else None
        if not m:
            return None
        wrong = sum(m.fuzzy_counts)
        return wrong / len(notice), -len(notice), m.start(), label, m.end(), wrong, k, a, b

    def spans(self, low: str) -> list[tuple[str, int, int, int, int]]:
        """(label, first character, end, edits, notice length) of the notices found.

        Notices resemble each other; where matches overlap, the one with the least share of edits stays, and
        what it leaves of the other's window is searched again.  A window is bounded by its notice's length, so
        the time grows with the seeds and not with their square.
        """
        starts: dict[int, set[int]] = {}
        for end, (length, places) in self.automaton.iter(low):
            for k, at in places:
                starts.setdefault(k, set()).add(end - length + 1 - at)
        heap = []
        for k, at in starts.items():
            notice, _, edits = self.notices[k]
            for first, last in clusters(at, edits):
                heap.append(self.candidate(low, k, max(0, first - edits), min(len(low), last + len(notice) + edits)))
        heap = [c for c in heap if c]
        heapq.heapify(heap)
        ends: list[int] = []  # of the spans kept, ascending, as they stand in the text
        kept: list[tuple[str, int, int, int, int]] = []
        while heap:
            _, size, start, label, end, wrong, k, a, b = heapq.heappop(heap)
            at = bisect.bisect_right(ends, start)
            if at == len(ends) or kept[at][1] >= end:
                ends.insert(at, end)
                kept.insert(at, (label, start, end, wrong, -size))
                continue
            at = bisect.bisect_right(ends, a)
            while a < b:
                stop, after = (kept[at][1], kept[at][2]) if at < len(kept) else (b, b)
                c = self.candidate(low, k, a, min(stop, b))
                if c:
                    heapq.heappush(heap, c)
                a, at = after, at + 1
        return kept


def clusters(positions: set[int], width: int) -> list[tuple[int, int]]:
    """Ascending positions in runs that span at most ``width``."""
    out: list[tuple[int, int]] = []
    for p in sorted(positions):
        if out and p - out[-1][0] <= width:
            out[-1] = (out[-1][0], p)
        else:
            out.append((p, p))
    return out


def scan_licenses(documents: DataFrame, notices: dict[str, str] = NOTICES) -> DataFrame:
    """Licence phrases and edited notices in every whole text of ``documents`` (doc_id, text).

    Returns per row: doc_id, n_words, n_base (all places of base phrases), first_word and last_word (their
    smallest and largest start in words, else null), base_labels and labels (distinct, sorted,
    comma-joined; labels adds those of the fuzzy search), score (1 for an exact phrase, else 1 minus the
    least share of edits among the notices found, else 0) and spans (label, characters from-to, edits).
    A null text counts as empty: no words, no labels, score 0.  Repeated rows give repeated results,
    an empty table none.
    Nothing is shuffled.
    """
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in slices(batches, "text"):
            yield scan_batch(scanner, batch)

    return source.mapInArrow(scan, SCAN_SCHEMA)


def scan_batch(scanner: Scanner, batch: pa.RecordBatch) -> pa.RecordBatch:
    lowered = pc.ascii_lower(plain_texts(batch.column("text")))
    rows = []
    for low in lowered.to_pylist():
        raw = low.encode()
        marks = WORD[np.frombuffer(raw, np.uint8)]
        starts = marks.copy()
        starts[1:] &= ~marks[:-1]
        n_words = int(np.count_nonzero(starts))
        base = scanner.base_places(raw)
        first = last = None
        if base:
            at = [int(np.count_nonzero(starts[:p])) for p in (min(base)[0], max(base)[0])]
            first, last = at
        spans = scanner.spans(low)
        base_labels = sorted({label for _, label in base})
        labels = sorted({*base_labels, *(s[0] for s in spans)})
        score = 1.0 if base else max((1 - s[3] / s[4] for s in spans), default=0.0)
        rows.append(
            (n_words, len(base), first, last, ",".join(base_labels), ",".join(labels), score,
             [{"label": s[0], "first_char": s[1], "last_char": s[2], "edits": s[3]} for s in spans])
        )
    kinds = [
        pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
        pa.list_(pa.struct([("label", pa.string()), ("first_char", pa.int32()), ("last_char", pa.int32()), ("edits", pa.int32())])),
    ]
    cols = [batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    return pa.RecordBatch.from_arrays(cols, names=names)
