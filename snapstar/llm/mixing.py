"""Mixing sources to target weights by soft membership.

A classifier learned from a labelled table gives each document its posterior for
every domain.  A document of ``n`` tokens and posterior ``p`` that is taken
``x`` times gives ``x * n * p[k]`` expected tokens to domain ``k``.  The rates
``x >= 0`` minimise the squared differences between the domains' expected totals
and their targets (each domain scaled by the root of its diagonal in the Gram
matrix) by accelerated projected gradients from ``x = 1``.  Gradients are taken
per token, so that documents with equal posteriors get equal rates, however long
they are.

A step needs the totals of all domains only, so an iteration is one aggregation
of as many numbers as there are domains.  A document's rate follows from its own
row and the residuals of the steps so far; no state is kept between steps, and
whatever is lost is computed anew.

Rows: null and empty texts have no tokens and rate 1; repeated rows are rows of
their own with equal rates; an empty table gives an empty result; further columns
are ignored.  Domains without labelled rows have posterior 0 and are not fitted;
without any labelled row every rate is 1.
"""

from __future__ import annotations

import warnings
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.llm.common import map_arrow, worker
from snapstar.session import stage

FEATURES = 1 << 15
#: Bounds of what is learned from: rows of each domain, characters of a text
#: (longer ones are left out of training, never of scoring).
SAMPLE_ROWS, SAMPLE_CHARS = 1_200, 12_000
EPOCHS = 60
MAX_STEPS, TOLERANCE = 100, 1e-6
WORDS_KEPT = 400_000
DENSE = 5

#: What ``str.split`` takes for white space, as a regular expression of Java.
PYTHON_SPACE = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"

_SIGNS = "#*$%&|<>!"


def _hashed(s: str) -> int:
    return xxhash.xxh32_intdigest(s.encode("utf-8", "replace")) % FEATURES


class _Memo(dict):
    """Hashes of endings and kinds, of which a corpus has few; emptied when full."""

    def __missing__(self, s: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[s] = _hashed(s)
        return h


_MEMO = _Memo()


def word_features(word: str) -> tuple[int, int, int]:
    """Hashed features of a word: itself, its ending, the kinds of its signs."""
    low = word.lower()
    signs = "" if word.isalnum() else "".join(sorted({c for c in word if not c.isalnum()}))
    kinds = ("a" if low == word and low.islower() else "A" if word.isupper() else "Aa") + signs
    return _hashed("w" + low), _MEMO["e" + low[-3:]], _MEMO["k" + kinds]


def dense_features(text: str, words: list[str]) -> list[float]:
    n, c = max(1, len(words)), max(1, len(text))
    lines = text.split("\n")
    return [len(set(words)) / n, sum(map(text.count, _SIGNS)) / c, sum(map(str.isupper, words)) / n, len(set(lines)) / len(lines), min(1.0, n / 50)]


class Classifier:
    """Softmax regression on mean word features and a few figures of the text."""

    def __init__(self, weights: np.ndarray, dense: np.ndarray, bias: np.ndarray):
        self.weights, self.dense, self.bias = weights, dense, bias


def train(texts: list[str], labels: np.ndarray, domains: int, prior: np.ndarray, seed: int = 3) -> Classifier:
    """``prior``: the domains' shares among all labelled rows."""
    rng = np.random.default_rng(seed)
    memo: dict[str, tuple[int, int, int]] = {}
    rows, cols, vals, dense = [], [], [], []
    for i, t in enumerate(texts):
        words = t.split()
        dense.append(dense_features(t, words))
        for w in words:
            if w not in memo:
                memo[w] = word_features(w)
        f = np.array([memo[w] for w in words], np.int64).ravel()
        ids, n = np.unique(f, return_counts=True)
        rows.append(np.full(len(ids), i))
        cols.append(ids)
        vals.append(n / max(1, len(words)))
    rows, cols, vals, dense = np.concatenate(rows), np.concatenate(cols), np.concatenate(vals), np.array(dense)
    w, d, b = rng.standard_normal((FEATURES, domains)) * 0, np.zeros((DENSE, domains)), np.zeros(domains)
    hot = np.eye(domains)[labels]
    grads2 = [np.full_like(x, 1e-8) for x in (w, d, b)]
    # Classes count alike in training; the prior is put into the bias after it.
    weight = 1 / np.maximum(1, np.bincount(labels, minlength=domains))[labels]
    weight /= weight.sum()
    for _ in range(EPOCHS):
        z = dense @ d + b
        np.add.at(z, rows, w[cols] * vals[:, None])
        z -= z.max(1, keepdims=True)
        p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        g = (p - hot) * weight[:, None]
        gw = np.zeros_like(w)
        np.add.at(gw, cols, g[rows] * vals[:, None])
        for x, gx, s in zip((w, d, b), (gw + 1e-6 * w, dense.T @ g, g.sum(0)), grads2):
            s += gx * gx
            x -= 0.5 * gx / np.sqrt(s)
    seen = np.bincount(labels, minlength=domains) > 0
    bias = b + np.where(seen, np.log(np.maximum(prior, 1e-9)), -np.inf)
    return Classifier(w, d, bias)


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class _Scorer:
    def __init__(self, model: Classifier):
        self.model = model
        self.clear()

    def clear(self):
        self.number = _Numbers()
        self.rows: list[np.ndarray] = []
        self.table = np.zeros((0, self.model.weights.shape[1]))

    def posterior(self, text: str) -> tuple[int, np.ndarray]:
        words = text.split()
        if len(self.number) > WORDS_KEPT:
            self.clear()
        known, had = self.number, len(self.number)
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        if len(known) > had:
            need = len(known)
            f = np.array([word_features(w) for w in islice(reversed(known), need - had)][::-1], np.int64)
            if need > len(self.table):
                grown = np.zeros((max(2 * len(self.table), need, 4096), self.table.shape[1]))
                grown[:len(self.table)] = self.table
                self.table = grown
            self.table[had:need] = self.model.weights[f].sum(1)
        z = np.array(dense_features(text, words)) @ self.model.dense + self.model.bias
        if len(ids):
            z = z + self.table[ids].mean(0)
        e = np.exp(z - z.max())
        return len(words), e / e.sum()


def posterior_batches(batches, model):
    scorer = _Scorer(model.value)
    for b in batches:
        got = [scorer.posterior(t.as_py() or "") for t in b.column(1)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([n for n, _ in got], pa.int64()), pa.array([p.tolist() for _, p in got], pa.list_(pa.float64()))], ["doc_id", "n_tokens", "posterior"])


def fit_classifier(docs: DataFrame, labels: DataFrame, domains: list[str], rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Classifier | None:
    """From ``labels`` (doc_id, domain); the driver holds ``rows`` rows of each
    domain at most, those with the smallest hashes of doc_id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("domain").alias("domain"))
    counts = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    drawn = None
    for d in domains:
        part = known.where(F.col("domain") == d).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        drawn = part if drawn is None else drawn.unionByName(part)
    found = docs.where(F.length("text") <= chars).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id").collect()
    sample = sorted({(r["domain"], r["doc_id"]): r["text"] for r in found}.items())
    if not sample:
        return None
    prior = np.array([counts.get(d, 0) for d in domains], float)
    return train([t for _, t in sample], np.array([domains.index(d) for (d, _), _ in sample]), len(domains), prior / prior.sum())


def posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id, n_tokens, posterior`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "snapstar.llm.mixing:posterior_batches",
                     "doc_id long, n_tokens long, posterior array<double>", model=shared)


def replayed(p: np.ndarray, steps: list[tuple[np.ndarray, float]]) -> tuple[np.ndarray, np.ndarray]:
    """The rates after ``steps`` (scaled residual, momentum) for rows of scaled
    posteriors, and the point at which the next residual is taken."""
    x = np.ones(len(p))
    y = x
    for residual, momentum in steps:
        new = np.maximum(0.0, y - p @ residual)
        y, x = new + momentum * (new - x), new
    return x, y


def _posterior(b) -> np.ndarray:
    values = b.column(b.schema.get_field_index("posterior")).flatten()
    return values.to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)


def total_batches(batches, scale, steps):
    total = None
    for b in batches:
        if b.num_rows:
            p = _posterior(b) * scale
            _, y = replayed(p, steps)
            part = (y * b.column(b.schema.get_field_index("n_tokens")).to_numpy(zero_copy_only=False)) @ p
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["k", "total"])


def rate_batches(batches, scale, steps):
    for b in batches:
        x = replayed(_posterior(b) * scale, steps)[0] if b.num_rows else np.zeros(0)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(x)], [*b.schema.names, "rate"])


def fit_rates(rows: DataFrame, target: np.ndarray, max_steps: int = MAX_STEPS, tolerance: float = TOLERANCE):
    """(scale, steps, missed) for ``replayed`` from staged ``rows`` (n_tokens,
    posterior); ``missed`` is the greatest difference from a target that is left,
    as a part of the greatest target.

    Steps end when the targets are met or when the totals stand still, where the
    targets cannot be met by any nonnegative rates; a warning tells the latter, and
    that ``max_steps`` was too few."""
    k = len(target)
    pair = lambda i, j: F.sum(F.col("n_tokens") * F.col("posterior")[i] * F.col("posterior")[j])
    got = rows.agg(*[pair(i, j).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    gram = np.array([[got[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
    diagonal = np.diag(gram)
    scale = np.where(diagonal > 0, 1 / np.sqrt(np.maximum(diagonal, 1e-300)), 0.0)
    lipschitz = max(float(np.linalg.eigvalsh(gram * scale[:, None] * scale[None, :]).max()), 1e-12)
    want = target * scale
    most = max(np.abs(want).max(), 1e-300)
    steps: list[tuple[np.ndarray, float]] = []
    pace, before, still = 1.0, None, 0
    while True:
        sums = map_arrow(rows.select("n_tokens", "posterior"), "snapstar.llm.mixing:total_batches", "k int, total double", scale=scale, steps=steps)
        total = np.zeros(k)
        for r in sums.groupBy("k").agg(F.sum("total").alias("total")).collect():
            total[r["k"]] = r["total"]
        residual = total - want
        missed = float(np.abs(residual).max() / most)
        still = still + 1 if before is not None and np.abs(total - before).max() <= tolerance * most else 0
        if missed <= tolerance or still == 3 or len(steps) == max_steps:
            break
        before = total
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        steps.append((residual / lipschitz, (pace - 1) / faster))
        pace = faster
    if missed > tolerance:
        why = "no nonnegative rates meet them" if still == 3 else f"{max_steps} steps are too few"
        warnings.warn(f"targets are missed by up to {missed:.2e} of the greatest: {why}", RuntimeWarning, stacklevel=3)
    return scale, steps, missed


def totals(rows: DataFrame, k: int) -> np.ndarray:
    got = rows.agg(*[F.sum(F.col("n_tokens") * F.col("posterior")[i]).alias(f"t{i}") for i in range(k)]).first()
    return np.array([got[f"t{i}"] or 0.0 for i in range(k)])


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], anchor: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, posterior, rate`` for every row.

    ``weights``: target shares of the domains of ``labels`` (doc_id, domain).  The
    target of all domains together is the present number of tokens or, with
    ``anchor``, such that this domain's total stays as it is."""
    domains = sorted(weights)
    model = fit_classifier(docs, labels, domains)
    if model is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), PYTHON_SPACE), "")).cast("long").alias("n_tokens"),
                           F.array(*[F.lit(0.0)] * len(domains)).alias("posterior"), F.lit(1.0).alias("rate"))
    rows = stage(posteriors(docs, model), "mixing-posteriors")
    now = totals(rows, len(domains))
    share = np.array([weights[d] for d in domains], float) * (now > 0)
    share /= max(share.sum(), 1e-300)
    at = domains.index(anchor) if anchor else None
    all_ = now[at] / share[at] if anchor and share[at] > 0 else now.sum()
    scale, steps, _ = fit_rates(rows, share * all_)
    return rows.mapInArrow(worker("snapstar.llm.mixing:rate_batches", scale=scale, steps=steps), "doc_id long, n_tokens long, posterior array<double>, rate double")


def label_domains(labels: DataFrame) -> DataFrame:
    """Domains of the labelled table by quality: clean or poor, toxic rows too.
    (Toxicity itself is no domain to be thinned here: the classifier's posteriors
    for it are so soft that a small target lets few documents make up the whole.)"""
    return labels.select("doc_id", F.when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "poor").alias("domain"))


def sampled(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` with each row as often as its rate says: the whole part, and once
    more if a hash of doc_id falls below the rest.  Rows with a null doc_id stay
    once."""
    copies, copy = ("_".join([name, *docs.columns]) for name in ("copies", "copy"))  # names that no column of docs has
    draw = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    taken = (mixed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("rate").alias("rate"))
             .select("doc_id", F.floor(F.col("rate") + draw).cast("int").alias(copies)).where(F.col(copies) != 1))
    left = docs.join(taken, "doc_id", "left").withColumn(copies, F.coalesce(copies, F.lit(1))).where(F.col(copies) > 0)
    return left.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[F.col(f"`{c}`") for c in docs.columns])
