"""Toxicity scores from a bidirectional gated recurrent network.

A word enters as its own vector (words known from training) and as the scaled
sum of the vectors of its hashed byte trigrams, so that unknown and inflected
words have one too.  Runs of more than ``WHOLE`` letters (joined words, clauses of
scripts without blanks) enter as half-overlapping pieces of ``PIECE`` characters, each a
word of its own, so nothing of them is left out.  Two gated recurrent layers read each window of ``WINDOW``
words from either end; attention pools their states into one logit.  A text is
scored over all windows at half-window steps, the last one aligned to its end;
its logit is the soft maximum of theirs, which does not grow with their number.
Training minimises the log loss of the
document's label through that soft maximum by Adam, all in numpy, on a bounded
and documented sample of labelled rows; the prior of the classes is then set to
that of all training labels.

Rows: a null, empty or blank text is one window of padding and gets that window's
score; repeated rows get equal scores; an empty table gives an empty result;
further columns are ignored.  Null labels are not learned from.  Without both
classes among the training rows every score is the share of toxic rows (0 when
there is none).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.llm.common import map_arrow

WINDOW = 48
#: Characters of a word that enters whole, and of the pieces of a longer one.
WHOLE, PIECE = 24, 8
HIDDEN = 8
DIM = 8
TRIGRAMS = 1 << 13
#: Bounds of what is learned from: rows of each class, and characters of a text
#: (longer ones are left out of training, never of scoring).
SAMPLE_ROWS = 1_500
SAMPLE_CHARS = 8_000
#: Passes over the sample, and steps at least (a small sample is passed more often).
EPOCHS, MIN_STEPS = 5, 480
#: Words whose projections a Python worker keeps, and characters of the texts that it
#: scores at a time.
WORDS_KEPT = 100_000
CHARS_AT_ONCE = 1_000_000
#: Windows that go through the network at a time.
AT_ONCE = 2_048

_WORD = re.compile(r"[^\W_]+")


def pieces(word: str) -> list[str]:
    if len(word) <= WHOLE:
        return [word]
    return [word[k:k + PIECE] for k in (*range(0, len(word) - PIECE, PIECE // 2), len(word) - PIECE)]


def words_of(text: str | None) -> list[str]:
    words = _WORD.findall((text or "").lower())
    if max(map(len, words), default=0) > WHOLE:
        return [p for w in words for p in pieces(w)]
    return words


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all words in a row, and where each word's begin."""
    raw = [b"\x02" + w.encode("utf-8", "replace") + b"\x03" for w in words]
    lengths = np.array([max(1, len(r) - 2) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    starts = np.cumsum([0, *map(len, raw[:-1])]) if raw else np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(first, lengths) + np.repeat(starts, lengths)
    h = data[at] * 961 + data[at + 1] * 31337 + data[at + 2] * 7919 + ((data[at] * data[at + 2]) << 5)
    return h % TRIGRAMS, first


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


class Network:
    """Parameters, and the forward and backward passes."""

    def __init__(self, vocabulary: dict[str, int], seed: int = 7):
        rng = np.random.default_rng(seed)
        n = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
        self.vocabulary = vocabulary  # words from 1; 0 is every other word
        self.shift = np.float32(0)
        self.p = {"E": n(len(vocabulary) + 1, DIM, scale=0.1), "C": n(TRIGRAMS, DIM, scale=0.3), "pad": n(2, 3 * HIDDEN, scale=0.1),
                  "head": np.zeros(1, np.float32)}
        self.p["E"][0] = 0
        for d in "fb":
            self.p |= {f"W{d}": n(2 * DIM, 3 * HIDDEN, scale=0.3), f"b{d}": np.zeros(3 * HIDDEN, np.float32), f"U{d}": n(HIDDEN, 3 * HIDDEN, scale=0.3),
                       f"o{d}": n(HIDDEN, 2, scale=0.4)}  # attention score and value of a state

    def inputs(self, words: list[str]):
        ids = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        tri, first = trigrams(words)
        scale = 1 / np.sqrt(np.diff(np.r_[first, len(tri)]).astype(np.float32))
        x = np.concatenate([self.p["E"][ids], np.add.reduceat(self.p["C"][tri], first, axis=0) * scale[:, None]], 1) if words else np.zeros((0, 2 * DIM), np.float32)
        return x, ids, tri, first, scale

    def gates(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Input projections of the two directions for each word."""
        x = self.inputs(words)[0]
        return x @ self.p["Wf"] + self.p["bf"], x @ self.p["Wb"] + self.p["bb"]

    def _read(self, gates, index, d, keep=None):
        """States of one direction over ``index`` (windows by steps)."""
        U, o = self.p[f"U{d}"], self.p[f"o{d}"]
        h = np.zeros((len(index), HIDDEN), np.float32)
        out = np.empty((len(index), index.shape[1], 2), np.float32)
        for t in range(index.shape[1]):
            g = gates[index[:, t]]
            rz = _sigmoid(g[:, :2 * HIDDEN] + h @ U[:, :2 * HIDDEN])
            r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
            c = np.tanh(g[:, 2 * HIDDEN:] + (r * h) @ U[:, 2 * HIDDEN:])
            if keep is not None:
                keep.append((h, r, z, c))
            h = z * h + (1 - z) * c
            out[:, t] = h @ o
        return out, h

    def windows(self, gates: tuple[np.ndarray, np.ndarray], index: np.ndarray) -> np.ndarray:
        """The logit of each window; ``gates`` by word number, padding at 0."""
        f, _ = self._read(gates[0], index, "f")
        b, _ = self._read(gates[1], index[:, ::-1], "b")
        s = f + b[:, ::-1]
        a = np.exp(s[:, :, 0] - s[:, :, 0].max(1, keepdims=True))
        return (a * s[:, :, 1]).sum(1) / a.sum(1) + self.p["head"][0]

    def gradients(self, words, index, owner, labels):
        """Of the mean log loss of the documents whose windows are given."""
        p, half = self.p, 3 * HIDDEN
        x, ids, tri, first, scale = self.inputs(words)
        gates = {d: np.concatenate([p["pad"][k:k + 1], x @ p[f"W{d}"] + p[f"b{d}"]]) for k, d in enumerate("fb")}
        kept = {"f": [], "b": []}
        f, _ = self._read(gates["f"], index, "f", kept["f"])
        b, _ = self._read(gates["b"], index[:, ::-1], "b", kept["b"])
        s = f + b[:, ::-1]
        a = np.exp(s[:, :, 0] - s[:, :, 0].max(1, keepdims=True))
        a /= a.sum(1, keepdims=True)
        pooled = (a * s[:, :, 1]).sum(1)
        logits, share = soft_maximum(pooled + p["head"][0], owner, len(labels))
        prob = _sigmoid(logits)
        d_logit = ((prob - labels) / len(labels)).astype(np.float32)
        d_window = d_logit[owner] * share
        ds = np.stack([a * (s[:, :, 1] - pooled[:, None]), a], 2) * d_window[:, None, None]
        grads = {"head": np.array([d_window.sum()], np.float32)}
        dx = np.zeros_like(x)
        for k, (d, idx, dout) in enumerate((("f", index, ds), ("b", index[:, ::-1], ds[:, ::-1]))):
            U, o = p[f"U{d}"], p[f"o{d}"]
            dU, do, dg_all = np.zeros_like(U), np.zeros_like(o), np.zeros_like(gates[d])
            dh = np.zeros((len(idx), HIDDEN), np.float32)
            for t in range(idx.shape[1] - 1, -1, -1):
                h, r, z, c = kept[d][t]
                new = z * h + (1 - z) * c
                do += new.T @ dout[:, t]
                dh = dh + dout[:, t] @ o.T
                dc = dh * (1 - z) * (1 - c * c)
                dz = dh * (h - c) * z * (1 - z)
                drh = dc @ U[:, 2 * HIDDEN:].T
                dr = drh * h * r * (1 - r)
                drz = np.concatenate([dr, dz], 1)
                dU[:, 2 * HIDDEN:] += (r * h).T @ dc
                dU[:, :2 * HIDDEN] += h.T @ drz
                np.add.at(dg_all, idx[:, t], np.concatenate([drz, dc], 1))
                dh = dh * z + drh * r + drz @ U[:, :2 * HIDDEN].T
            grads |= {f"U{d}": dU, f"o{d}": do, f"W{d}": x.T @ dg_all[1:], f"b{d}": dg_all[1:].sum(0)}
            grads.setdefault("pad", np.zeros_like(p["pad"]))[k] = dg_all[0]
            dx += dg_all[1:] @ p[f"W{d}"].T
        grads["E"] = np.zeros_like(p["E"])
        np.add.at(grads["E"], ids, dx[:, :DIM])
        grads["E"][0] = 0
        grads["C"] = np.zeros_like(p["C"])
        np.add.at(grads["C"], tri, np.repeat(dx[:, DIM:] * scale[:, None], np.diff(np.r_[first, len(tri)]), 0))
        return grads, prob


def soft_maximum(logits: np.ndarray, owner: np.ndarray, n: int):
    """The mean by owner, weighted by exp(logit), and each window's share of the
    gradient.  Any number of equal windows gives their own logit; one that stands
    out by more than the log of their number decides alone."""
    top = np.full(n, -np.inf, np.float32)
    np.maximum.at(top, owner, logits)
    e = np.exp(logits - top[owner])
    weight = e / np.bincount(owner, e, n)[owner]
    mean = np.bincount(owner, weight * logits, n)
    return mean.astype(np.float32), (weight * (1 + logits - mean[owner])).astype(np.float32)


def window_index(numbers: list[np.ndarray], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of each text at half-window steps (the last aligned to the
    end), and the text that each belongs to.  Short texts are padded with 0."""
    rows, owner = [], []
    for k, a in enumerate(numbers):
        if len(a) <= size:
            w = np.zeros((1, size), np.int64)
            w[0, :len(a)] = a
        else:
            starts = np.arange(0, len(a) - size + size // 2, size // 2)
            starts[-1] = len(a) - size
            w = a[starts[:, None] + np.arange(size)]
        rows.append(w)
        owner.append(np.full(len(w), k))
    return np.concatenate(rows), np.concatenate(owner)


def train(texts: list[str], labels: np.ndarray, share: float, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """``share``: the share of toxic rows among all training labels."""
    tokens = [words_of(t) for t in texts]
    count: dict[str, int] = {}
    for t in tokens:
        for w in set(t):
            count[w] = count.get(w, 0) + 1
    vocabulary = {w: k for k, w in enumerate(sorted(w for w, n in count.items() if n >= 5), 1)}
    net, rng = Network(vocabulary, seed), np.random.default_rng(seed)
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for _ in range(max(epochs, -(-MIN_STEPS // max(1, len(texts) // 32)))):
        order = rng.permutation(len(texts))
        for part in np.array_split(order, max(1, len(order) // 32)):
            number: dict[str, int] = {}
            numbers = [np.array([number.setdefault(w, len(number) + 1) for w in tokens[i]], np.int64) for i in part]
            index, owner = window_index(numbers)
            grads, _ = net.gradients(list(number), index, owner, labels[part].astype(np.float32))
            step += 1
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                m, v = state[k]
                m += 0.1 * (g - m)
                v += 0.005 * (g * g - v)
                net.p[k] -= (0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.995 ** step)) + 1e-8)).astype(np.float32)
    seen = labels.mean()
    net.shift = np.float32(np.log(share / (1 - share)) - np.log(seen / (1 - seen)))
    return net


class Scorer:
    def __init__(self, net: Network):
        self.net = net
        self._clear()

    def _clear(self):
        self.number: dict[str, int] = {}
        self.rows = [np.concatenate([pad.reshape(1, -1), np.zeros((1023, 3 * HIDDEN), np.float32)]) for pad in self.net.p["pad"]]

    def _numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.number) > WORDS_KEPT:
            self._clear()
        known, had = self.number, len(self.number)
        out = [np.array([known.setdefault(w, len(known) + 1) for w in words_of(t)], np.int64) for t in texts]
        new = list(known)[had:] if len(known) > had else []
        if new:
            for d in (0, 1):
                while len(known) >= len(self.rows[d]):
                    self.rows[d] = np.concatenate([self.rows[d], np.zeros_like(self.rows[d])])
            for k in range(0, len(new), 20_000):
                part = new[k:k + 20_000]
                for d, found in enumerate(self.net.gates(part)):
                    self.rows[d][had + 1 + k:had + 1 + k + len(part)] = found
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        index, owner = window_index(self._numbers(texts))
        logits = np.concatenate([self.net.windows(self.rows, index[k:k + AT_ONCE]) for k in range(0, len(index), AT_ONCE)])
        return _sigmoid(soft_maximum(logits, owner, len(texts))[0] + self.net.shift).astype(np.float64)


def scored(batches, column, net):
    """Pieces of the batches, so many characters of the named column each, and the
    scores of their rows: little is held beside a batch."""
    net = net.value if hasattr(net, "value") else net
    scorer = Scorer(net) if isinstance(net, Network) else None
    for b in batches:
        texts, size = [], 0
        for k, t in enumerate(b.column(b.schema.get_field_index(column)), 1):
            texts.append(t.as_py())
            size += len(texts[-1] or "")
            if size > CHARS_AT_ONCE or k == b.num_rows:
                yield b.slice(k - len(texts), len(texts)), scorer.scores(texts) if scorer else np.full(len(texts), float(net))
                texts, size = [], 0


def score_batches(batches, net):
    for b, found in scored(batches, "text", net):
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found)], ["doc_id", "score"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, epochs: int = EPOCHS):
    """A network from (doc_id, toxic) of ``labels``; the driver holds ``rows``
    rows of each class at most, those with the smallest hashes of doc_id."""
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if len(counts) < 2:
        return share
    # Twice as many are drawn, as the longest texts are left out of training.
    drawn = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * rows) for c in (0, 1)]
    ids = F.broadcast(drawn[0].unionByName(drawn[1]))
    found = (docs.where(F.length("text") <= chars).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id").collect())
    found = sorted({(r["toxic"], r["doc_id"]): r["text"] for r in found}.items())
    sample = [(t, c) for k in (0, 1) for (c, _), t in [x for x in found if x[0][0] == k][:rows]]
    if len({c for _, c in sample}) < 2:
        return share
    return train([t for t, _ in sample], np.array([c for _, c in sample]), share, epochs)


def score(docs: DataFrame, net) -> DataFrame:
    """``doc_id`` and ``score`` of every row by ``net`` (from ``fit``)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                     "snapstar.llm.toxicity:score_batches", "doc_id long, score double", net=shared)


def held_out(doc_id):
    """The fold that nothing is learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    net = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, net).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def remove(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``.  The score is made
    in a column beside the row's others, so no row is joined."""
    net = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = docs.schema
    from snapstar.llm.common import worker
    return docs.mapInArrow(worker("snapstar.llm.toxicity:clean_batches", net=shared, threshold=threshold), schema)


def clean_batches(batches, net, threshold):
    for b, found in scored(batches, "text", net):
        yield b.filter(pa.array(found < threshold))
