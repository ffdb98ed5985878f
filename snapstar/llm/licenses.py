"""License scan by winnowed fingerprints and banded alignment.

Every run of ``K`` words of a template is hashed, and of each ``W`` neighbouring
hashes the smallest is kept (the rightmost of equals); an inverted index maps the
kept hashes to templates and places.  The words of a document are winnowed in the
same way, so each stretch of ``K + W - 1`` words that it shares with a template
gives a hit.  Hits on neighbouring diagonals that go on in the template make a
candidate, which is aligned with the whole template by dynamic programming within
a band around them, again and again on the words that no match covers, so each of
any number of repeats is found.  A match reports the share of the template's words that are matched (coverage) and
its span in the text.  Of overlapping matches the one with the most matched words
stays (then the best coverage, then the name).

The index is as large as the templates, a fixed parameter; documents are read
once and never shuffled.

Rows: one for each match, in texts of any length; null, empty and clean texts
give none; repeated rows repeat their matches; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.llm.common import map_arrow

K, W = 3, 2
BAND = 6
MIN_COVERAGE = 0.8
MATCH, MISMATCH, GAP = 2, -1, -1
WORDS_KEPT = 300_000

# Notices and opening passages of licenses, as they are published.
TEMPLATES = {
    "MIT (notice)": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0 (notice)": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0 (notice)": "This work is licensed under the GNU General Public License, version 3.",
    "GPL": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-NC-4.0 (notice)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 (notice)": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 (notice)": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "All rights reserved": "All rights reserved. No part of this publication may be reproduced",
}

_WORD = re.compile(r"[^\W_]+")


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        return h


_HASHES = _Hashes()


def hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def winnowed(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes of runs of ``K`` words, and their places."""
    if len(h) < K:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    runs = np.zeros(len(h) - K + 1, np.uint64)
    for k in range(K):
        runs = (runs ^ (runs >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - K + 1 + k]
    runs ^= runs >> np.uint64(32)
    if len(runs) <= W:
        at = np.array([len(runs) - 1 - int(np.argmin(runs[::-1]))])
    else:
        views = np.lib.stride_tricks.sliding_window_view(runs, W)
        at = np.unique(np.arange(len(views)) + W - 1 - np.argmin(views[:, ::-1], 1))
    return runs[at], at


class Index:
    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words = [hashes(_WORD.findall(templates[n].lower())) for n in self.names]
        places: dict[int, list[tuple[int, int]]] = {}
        for t, w in enumerate(self.words):
            for h, at in zip(*winnowed(w)):
                places.setdefault(int(h), []).append((t, int(at)))
        self.places = places
        self.known = np.array(sorted(places), np.uint64)

    def candidates(self, h: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, lowest diagonal, highest diagonal) of neighbouring hits."""
        kept, at = winnowed(h)
        if not len(kept) or not len(self.known):
            return []
        k = np.minimum(np.searchsorted(self.known, kept), len(self.known) - 1)
        hits = sorted((t, int(p), q) for x, p in zip(kept[self.known[k] == kept].tolist(), at[self.known[k] == kept].tolist()) for t, q in self.places[x])
        out: list[list[int]] = []
        open_: list[list[int]] = []  # (index in out, last diagonal, last template place, last place)
        now = None
        for t, p, q in hits:
            if t != now:
                now, open_ = t, []
            open_ = [x for x in open_ if p - x[3] <= len(self.words[t]) + BAND]
            # A hit that repeats a template place begins another candidate.
            x = min((x for x in open_ if abs(p - q - x[1]) <= BAND and q > x[2]), key=lambda x: abs(p - q - x[1]), default=None)
            if x is None:
                open_.append([len(out), p - q, q, p])
                out.append([t, p - q, p - q])
            else:
                x[1:] = p - q, q, p
                c = out[x[0]]
                c[1], c[2] = min(c[1], p - q), max(c[2], p - q)
        return [tuple(x) for x in out]

    def aligned(self, h: np.ndarray, t: int, low: int, high: int, covered: bytearray) -> tuple[int, int, int]:
        """The best local alignment of template ``t`` within the band of
        diagonals, over words that are not ``covered``: (matched words, first
        word, end word) in the document.

        Cell (i, j) stands for template word i and document word i + low - BAND + j.
        """
        words, base, width = self.words[t], low - BAND, high - low + 2 * BAND + 1
        # A cell holds (score, matched words, start).
        before = [(0, 0, -1)] * (width + 1)
        best = (0, 0, 0, 0)
        for i, w in enumerate(words.tolist()):
            now = [(0, 0, -1)] * (width + 1)
            for j in range(width):
                d = i + base + j
                if not 0 <= d < len(h) or covered[d]:
                    continue
                same = int(h[d]) == w
                s, m, start = before[j]
                cell = (s + (MATCH if same else MISMATCH), m + same, start if start >= 0 else d)
                for s, m, start in (before[j + 1], now[j - 1] if j else (0, 0, -1)):
                    if s + GAP > cell[0]:
                        cell = (s + GAP, m, start)
                if cell[0] > 0:
                    now[j] = cell
                    if (cell[0], cell[1]) > best[:2]:
                        best = (cell[0], cell[1], cell[2], d + 1)
            before = now
        return best[1:]

    def matches(self, text: str, min_coverage: float) -> list[tuple[str, float, int, int, int]]:
        """(name, coverage, matched words, start, end) with places in characters."""
        h = hashes(_WORD.findall(text.lower()))
        covered, taken, found = bytearray(len(h)), [], []

        def look(c):
            matched, first, end = self.aligned(h, *c, covered)
            if matched and matched >= min_coverage * len(self.words[c[0]]):
                heapq.heappush(found, (-matched, -matched / len(self.words[c[0]]), self.names[c[0]], first, end, c))

        for c in dict.fromkeys(self.candidates(h)):
            look(c)
        while found:  # the best first; its candidate may hold more, or another place if this one is covered
            *x, c = heapq.heappop(found)
            if not any(covered[x[3]:x[4]]):
                taken.append(x)
                covered[x[3]:x[4]] = b"\1" * (x[4] - x[3])
            look(c)
        if not taken:
            return []
        lower = text.lower()
        # str.lower can change lengths; spans are then those of the folded text.
        spans = [m.span() for m in _WORD.finditer(text if len(lower) == len(text) else lower)]
        return sorted((x[2], -x[1], -x[0], spans[x[3]][0], spans[x[4] - 1][1]) for x in taken)


_INDEX: dict[tuple, Index] = {}


def scan_batches(batches, templates, min_coverage):
    key = tuple(sorted(templates.items()))
    index = _INDEX.get(key) or _INDEX.setdefault(key, Index(templates))
    for b in batches:
        rows = [(i.as_py(), *m) for i, t in zip(b.column(0), b.column(1)) if t.is_valid for m in index.matches(t.as_py(), min_coverage)]
        cols = list(zip(*rows)) if rows else [()] * 6
        kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "license", "coverage", "matched_words", "span_start", "span_end"])


def scan(docs: DataFrame, templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``doc_id, license, coverage, matched_words, span_start, span_end``: one row
    for each match."""
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "snapstar.llm.licenses:scan_batches",
                     "doc_id long, license string, coverage double, matched_words long, span_start long, span_end long",
                     templates=dict(templates or TEMPLATES), min_coverage=min_coverage)
