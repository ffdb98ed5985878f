"""Encoding against the tiktoken library, decoding against the bytes."""

import gc
import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from snapstar.llm import bpe
from snapstar.llm.queries import RANKS
from tests.llm.conftest import SF, make_docs, rows_of

PATH, PATTERN = public_tokenizers.path(RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def random_texts(n=400):
    rng = random.Random(5)
    letters = "ab  \n\t the THé漢字🙂123.,!'s't\xa0\x85"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return out + ["".join(chr(rng.choice([rng.randint(1, 127), rng.randint(128, 0x2FFF), rng.randint(0x10000, 0x1FFFF)])) for _ in range(40)) for _ in range(n // 4)]


def test_ids_equal_the_librarys(library):
    c = bpe.codec(PATH, PATTERN)
    for t in [*random_texts(), "", " ", "a  b", "a \n \n b", "don't  stop ", "x" * 5000, "the " * 5000]:
        ids = np.frombuffer(c.encode(t), "<u4")
        assert ids.tolist() == library.encode_ordinary(t)
        raw, ok = c.decode_bytes(ids)
        assert raw == t.encode() and ok
        stream = bpe.StreamDecoder(c)
        assert "".join(map(stream.feed, ids.tolist())) + stream.finish() == t


def test_small_memos_and_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 8)
    monkeypatch.setattr(bpe, "TABLE_ENTRIES", 50)
    c = bpe.Codec(PATH, PATTERN)
    for t in random_texts(60):
        assert np.frombuffer(c.encode(t), "<u4").tolist() == library.encode_ordinary(t)


def test_ill_formed_ids_decode_with_replacement():
    c = bpe.codec(PATH, PATTERN)
    lead = next(i for t, i in c.fst.ranks.items() if t == b"\xe6")
    a = next(i for t, i in c.fst.ranks.items() if t == b"a")
    assert c.decode(np.array([a, lead, a])) == "a�a"
    assert c.decode_bytes(np.array([a, lead]))[1] is False
    stream = bpe.StreamDecoder(c)
    assert "".join(map(stream.feed, [a, lead, a, lead])) + stream.finish() == "a�a�"


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = rows_of(bpe.round_trip(docs, PATH, PATTERN))
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_rows_and_round_trip(spark, odd_texts):
    docs = make_docs(spark, odd_texts)
    ids = bpe.encode(docs, PATH, PATTERN)
    back = sorted(((r["doc_id"], r["text"]) for r in rows_of(bpe.decode(ids, PATH, PATTERN))), key=str)
    assert back == sorted(((i, t or "") for i, t in odd_texts), key=str)
    empty = next(r for r in rows_of(bpe.round_trip(docs, PATH, PATTERN)) if r["doc_id"] == 0)
    assert (empty["n_tokens"], empty["ids_sha256"], empty["decoded_sha256"]) == (0, hashlib.sha256().hexdigest(), hashlib.sha256().hexdigest())
    assert rows_of(bpe.round_trip(make_docs(spark, []), PATH, PATTERN)) == []


def test_stream_decoder_takes_runs_of_ids_as_it_takes_single_ones(monkeypatch):
    c = bpe.codec(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    rng = random.Random(8)
    odd = np.flatnonzero(~c.whole).tolist()
    for _ in range(300):
        ids = np.array([rng.choice(odd) if rng.random() < 0.4 else rng.randrange(len(c.token_bytes)) for _ in range(rng.randint(0, 30))], np.uint32)
        one, many = bpe.StreamDecoder(c), bpe.StreamDecoder(c)
        want = "".join([one.feed(int(i)) for i in ids] + [one.finish()]).encode()
        cut = rng.randint(0, len(ids))
        assert many.feed_ids(ids[:cut]) + many.feed_ids(ids[cut:]) + many.finish().encode() == want
        monkeypatch.setattr(bpe, "STREAMED", 3)
        assert bpe.decoded_digest(c, ids) == hashlib.sha256(want).hexdigest()
    assert gc.isenabled()


def new_words(n, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("etaoinshrdlué漢") for _ in range(rng.randint(3, 14)))
    return [" ".join(word() + rng.choice(["", ",", ".\n", "!!", "'s"]) for _ in range(200)) for _ in range(n // 200)]


def test_words_met_once_leave_little_in_a_worker():
    """40,000 different words left a transducer's table of 60 MB and more."""
    c, texts = bpe.Codec(PATH, PATTERN), new_words(40_000)
    tracemalloc.start()
    try:
        with bpe.working(c):
            for t in texts:
                c.encode(t)
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 20e6


@pytest.mark.parametrize("together", [0, 4, 256])
def test_pieces_in_step_and_alone_equal_the_librarys(library, monkeypatch, together):
    monkeypatch.setattr(bpe, "TOGETHER", together)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 7)
    monkeypatch.setattr(bpe, "CHUNKS_AT_ONCE", 50)
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 90)
    monkeypatch.setattr(bpe, "PAIR_ENTRIES", 100)
    c = bpe.Codec(PATH, PATTERN)
    texts = [*random_texts(60), None, "", *new_words(1_000), "漢字" * 300, "x" * 700, " ".join("ab" * k for k in range(150))]
    assert [np.frombuffer(i, "<u4").tolist() for i in c.encode_many(texts)] == [library.encode_ordinary(t or "") for t in texts]


def test_groups_of_texts_keep_the_rows(monkeypatch):
    monkeypatch.setattr(bpe, "CHARS_AT_ONCE", 30)
    rows = [(k, None if k % 7 == 0 else "word " * (k % 11)) for k in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([t for _, t in rows])], ["doc_id", "text"])
    got = [r for b in bpe.digest_batches([batch, batch.slice(0, 0)], PATH, PATTERN) for r in b.to_pylist()]
    assert [(r["doc_id"], r["decoded_sha256"]) for r in got] == [(k, hashlib.sha256((t or "").encode()).hexdigest()) for k, t in rows]
