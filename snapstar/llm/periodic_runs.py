"""Periodic runs of words: stretches that repeat a period four times or more.

A text's words are the runs of characters that are no ASCII white space.  A run
is a stretch of consecutive words with smallest period q (words q apart are
identical), of ``max(least_length, exponent * q)`` words at least, that no word
beside it extends.  Collapsing a text keeps of every run its first q words.

Method, within each text (Kruskal by descending common prefix):

1. Suffixes whose first few words occur nowhere else can start no run and are
   left out.  "Few" is the shortest prefix that the two first periods of a run
   have in common (5 words for runs of 6).
2. The others are sorted by prefix doubling; Kasai's scan gives the common prefix
   (LCP) of neighbours in that order.
3. Neighbours are united in order of decreasing LCP by union-find, so that a class
   is the set of suffixes with a common prefix of that length.  Each class keeps
   its positions in order; the smaller class goes into the larger one.
4. Positions i < j that become adjacent in a class at LCP l have exactly l words
   in common and no occurrence between them.  If their distance d is within l
   (here: l is ``(exponent - 1) * d`` at least), the words from i to j + l have
   smallest period d and end there; they are a run if the word before i differs
   from the word before j.  Every run of period d from i is found so, once: when
   i and i + d are united.

An ordered set is a list of sorted lists of bounded length, so a text of one
repeated word costs no quadratic moves.  Work is O(n log n) in a text's words;
texts are independent, so rows are scanned where they lie and nothing is
shuffled.  Memory is in proportion to the longest text.

Rows: null or empty text has no words and no runs (best run null, empty text
collapsed); a null ``doc_id`` is kept; repeated rows are rows of their own; ties
for the best run go to the smallest start, then period; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.llm.common import map_arrow

LEAST_LENGTH = 6
EXPONENT = 4
#: Bytes of text after which a batch of results is passed on.
FLUSH = 8_000_000

RUN = "struct<start: long, length: long, period: long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, best {RUN}, collapsed binary"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("best", _RUN), ("collapsed", pa.binary())])


class Ordered:
    """An ordered set of positions in sorted chunks of bounded length."""

    __slots__ = ("chunks", "heads", "size")
    CHUNK = 1024

    def __init__(self, first: int):
        self.chunks, self.heads, self.size = [[first]], [first], 1

    def __iter__(self):
        for chunk in self.chunks:
            yield from chunk

    def insert(self, x: int) -> tuple[int | None, int | None]:
        """Put ``x`` in; the positions before and after it."""
        at = max(0, bisect_left(self.heads, x) - 1) if len(self.heads) > 1 else 0
        chunk = self.chunks[at]
        k = bisect_left(chunk, x)
        before = chunk[k - 1] if k else (self.chunks[at - 1][-1] if at else None)
        after = chunk[k] if k < len(chunk) else (self.heads[at + 1] if at + 1 < len(self.heads) else None)
        chunk.insert(k, x)
        if not k:
            self.heads[at] = x
        if len(chunk) > self.CHUNK:
            half = len(chunk) // 2
            self.chunks.insert(at + 1, chunk[half:])
            self.heads.insert(at + 1, chunk[half])
            del chunk[half:]
        self.size += 1
        return before, after


def least_prefix(least_length: int, exponent: int) -> int:
    """Words that the suffixes at a run's start and one period later share at least."""
    return min(max(least_length, exponent * q) - q for q in range(1, least_length + 1))


def repeats(hashes: np.ndarray, width: int) -> bool:
    """Whether any ``width`` consecutive words may occur twice (never wrongly no)."""
    n = len(hashes) - width + 1
    if n < 2:
        return False
    mixed = hashes[:n].copy()
    for k in range(1, width):
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed += hashes[k:k + n]
    mixed.sort()
    return bool((mixed[1:] == mixed[:-1]).any())


def sorted_suffixes(ids: np.ndarray, width: int) -> np.ndarray:
    """The positions whose first ``width`` words occur twice or more, by suffix."""
    n = len(ids)
    rank, done = ids.astype(np.int64), 1
    while done < width:
        step = min(done, width - done)
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:] + 1
        _, rank = np.unique(rank * (n + 2) + after, return_inverse=True)
        done += step
    count = np.bincount(rank)
    start = np.cumsum(count) - count
    place = np.append(start[rank], -1)  # of each suffix: how many come before its group
    active = open_ = np.flatnonzero(count[rank] > 1)
    while len(open_):
        first, second = place[open_], place[open_ + done]
        order = np.lexsort((second, first))
        open_, first, second = open_[order], first[order], second[order]
        new_first = np.append(True, first[1:] != first[:-1])
        new_pair = new_first | np.append(True, second[1:] != second[:-1])
        at = np.arange(len(open_))
        group, pair = np.maximum.accumulate(np.where(new_first, at, 0)), np.maximum.accumulate(np.where(new_pair, at, 0))
        place[open_] = first + pair - group
        alone = new_pair & np.append(new_pair[1:], True)
        open_ = open_[~alone]
        done *= 2
    return active[np.argsort(place[active])]


def neighbour_prefixes(ids: list[int], order: list[int], width: int) -> list[int]:
    """Common prefix of each suffix in ``order`` with the one before (0 for the first)."""
    n, found, before = len(ids), {}, dict(zip(order[1:], order))
    last, same = -2, 0
    for i in sorted(order):
        j = before.get(i)
        # A prefix of more than ``width`` words carries over to the next suffix.
        same = same - 1 if last == i - 1 and same > width else 0
        if j is None:
            same = 0
        else:
            end = n - max(i, j)
            while same < end and ids[i + same] == ids[j + same]:
                same += 1
        found[i], last = same, i
    return [found[i] for i in order]


def find_runs(words: list[bytes], least_length: int = LEAST_LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """All runs (start, length, period), by start, then period."""
    width = least_prefix(least_length, exponent)
    if len(words) < least_length or not repeats(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), width):
        return []
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    order = sorted_suffixes(np.array(ids), width).tolist()
    prefix = neighbour_prefixes(ids, order, width)
    parent, classes = list(range(len(order))), [None] * len(order)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    runs = []

    def adjacent(i: int, j: int, same: int) -> None:
        d = j - i
        if same >= (exponent - 1) * d and d + same >= least_length and (i == 0 or ids[i - 1] != ids[j - 1]):
            runs.append((i, d + same, d))

    for t in np.argsort(-np.array(prefix), kind="stable").tolist():
        same = prefix[t]
        if same < width:
            break
        a, b = find(t - 1), find(t)
        large, small = classes[a] or Ordered(order[a]), classes[b] or Ordered(order[b])
        if large.size < small.size:
            large, small = small, large
        parent[b], classes[a], classes[b] = a, large, None
        moved = list(small)
        for k, x in enumerate(moved):
            before, after = large.insert(x)
            if before is not None and (not k or before != moved[k - 1]):
                adjacent(before, x, same)
            if after is not None and (k + 1 == len(moved) or after < moved[k + 1]):
                adjacent(x, after, same)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    kept, upto = [], 0
    for first, last in sorted((start + period, start + length) for start, length, period in runs):
        if first > upto:
            kept += words[upto:first]
        upto = max(upto, last)
    return kept + words[upto:]


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact exponent; the first of those that tie."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def scan_batches(batches, least_length: int, exponent: int):
    name = lambda r: None if r is None else dict(zip(("start", "length", "period"), r))
    for batch in batches:
        ids, texts, rows, size = batch.column(0), batch.column(1), [], 0
        for k in range(batch.num_rows):
            text = texts[k].as_py() or b""
            words = text.split()  # bytes are split at ASCII white space alone
            runs = find_runs(words, least_length, exponent)
            rows.append((ids[k].as_py(), len(words), [name(r) for r in runs], name(greatest(runs)), b" ".join(collapse(words, runs) if runs else words)))
            size += len(text)
            if size >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def scan(docs: DataFrame, least_length: int = LEAST_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """``doc_id, n_words, runs, best, collapsed`` (the text with its words joined by
    one space, of every run the first period) for every document."""
    if exponent < 3:
        raise ValueError("the exponent is 3 at least: a run of two periods may hold shorter ones")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_arrow(rows, "snapstar.llm.periodic_runs:scan_batches", SCHEMA, least_length=least_length, exponent=exponent).withColumn("collapsed", F.col("collapsed").cast("string"))


def report(docs: DataFrame, least_length: int = LEAST_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """Number of runs, the greatest one, and digests of all runs and of the
    collapsed text."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return scan(docs, least_length, exponent).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
