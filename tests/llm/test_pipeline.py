"""Each stage of the pipeline against brute force over its own input."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from snapstar.llm import bpe, mixing, toxicity
from snapstar.llm.queries import RANKS
from snapstar.session import stage
from tests.llm.conftest import DOC_SCHEMA, SF, rows_of, words
from tests.llm.test_ngram_join import brute


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each, as ``run`` makes them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [rows_of(docs)]
    for name, f in corpus_pipeline.STAGES:
        docs = stage(f(spark, docs, SF), f"test-{name}")
        out.append(rows_of(docs))
    return out


def key(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


def test_toxic_rows_go(spark, stages):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    net = toxicity.fit(docs, labels.where(~toxicity.held_out(labels["doc_id"])))
    texts = [r["text"] for r in stages[0]]
    # One text at a time, by the network's own formula.
    scorer = toxicity.Scorer(net)
    scores = np.array([scorer.scores([t])[0] for t in texts])
    sure = np.abs(scores - corpus_pipeline.TOXIC) > 1e-3
    kept = key(stages[1])
    assert all((kept[r["doc_id"], r["text"]] > 0) == (s < corpus_pipeline.TOXIC) for r, s, ok in zip(stages[0], scores, sure) if ok)
    assert not key(stages[1]) - key(stages[0])


def test_one_row_of_equal_texts_stays(stages):
    groups = {}
    for r in stages[1]:
        groups.setdefault(" ".join(words(r["text"])), []).append(r["doc_id"])
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(min(g) for g in groups.values())


def test_one_of_near_copies_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2]]
    want = sorted(i for i, n, c in brute(rows, 5, 4, 5) if not n or i == c)
    assert sorted(r["doc_id"] for r in stages[3]) == want


def test_copies_follow_the_rates(spark, stages):
    """Each row as often as its rate's floor or ceiling; the expected tokens of the
    rates meet the targets with clean text as the anchor."""
    docs = spark.createDataFrame([tuple(r.values()) for r in stages[3]], DOC_SCHEMA)
    labels = mixing.label_domains(spark.read.parquet(f"{SF}/labels.parquet"))
    rates = {r["doc_id"]: r["rate"] for r in rows_of(mixing.mix(docs, labels, corpus_pipeline.MIX, anchor="clean"))}
    before, after = key(stages[3]), key(stages[4])
    assert set(after) <= set(before) and len(rates) == len(before)
    assert all(np.floor(rates[i]) <= after[i, t] <= np.ceil(rates[i]) for i, t in before)
    assert abs(sum(after.values()) - sum(rates.values())) <= 4 * np.sqrt(len(rates))


def test_digests_are_those_of_the_library(stages):
    path = public_tokenizers.path(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    want = Counter()
    for r in stages[4]:
        ids = np.array(library.encode_ordinary(r["text"] or ""), "<u4").tobytes()
        want[r["doc_id"], hashlib.sha256(ids).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["ids_sha256"], r["decoded_sha256"]) for r in stages[5]) == want
