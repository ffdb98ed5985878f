"""Periodic runs against a scan of all periods."""

import hashlib
import random
import zlib

import pytest

from snapstar.llm import periodic_runs, queries
from tests.llm.conftest import SF, make_docs, rows_of


def brute(w, least=periodic_runs.LEAST_LENGTH, exponent=periodic_runs.EXPONENT):
    """Every maximal stretch of every period, without those of a smaller period."""
    runs, n = [], len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                stretch = w[i:i + length]
                if not any(stretch[:length - r] == stretch[r:] for r in range(1, q)):
                    runs.append((i, length, q))
            i = max(j, i + 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, planted=False):
    w = (text or "").encode().split()
    if planted and doc_id is not None and w and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        a = (h // 10) % len(w)
        p = 1 + (len(w) - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = brute(w)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in dropped)).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def compare(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    assert sorted([tuple(r[c] for c in COLUMNS) for r in rows_of(got)], key=key) == sorted(want, key=key)


def test_find_runs_equals_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        a = rng.choice([1, 2, 3, 20])
        w = [b"%d" % rng.randrange(a) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            u = [b"%d" % rng.randrange(a) for _ in range(rng.randint(1, 9))]
            at = rng.randint(0, len(w))
            w[at:at] = u * rng.randint(2, 7) + u[:rng.randrange(len(u))]
        least, exponent = rng.choice([(6, 4), (3, 3), (10, 5)])
        assert periodic_runs.find_runs(w, least, exponent) == brute(w, least, exponent), w


def test_one_word_for_ever_splits_the_ordered_set():
    n = 5 * periodic_runs.Ordered.CHUNK
    assert periodic_runs.find_runs([b"x"] * n) == [(0, n, 1)]
    s = periodic_runs.Ordered(0)
    rng, inside = random.Random(1), [0]
    for x in rng.sample(range(1, 10**6), 3 * s.CHUNK):
        before, after = s.insert(x)
        assert before == max((y for y in inside if y < x), default=None) and after == min((y for y in inside if y > x), default=None)
        inside.append(x)
    assert list(s) == sorted(inside)


def test_odd_rows(spark, odd_texts):
    texts = [*odd_texts, (20, "a b c " * 4), (20, "a b c " * 4), (21, "x x x x x x y y y y y y"), (22, "x\x85x " * 7), (23, "Los\xa0x\x1cy\tz\x0bz\rz z z z"), (24, "a a a a a")]
    texts = [(i, t) for i, t in texts if len(t or "") < 50_000] + [(30, "long " * 20_000 + "tail"), (31, " ".join(f"w{k % 3000}" for k in range(15_000)))]
    small = [(i, t) for i, t in texts if i not in (30, 31)]
    want = [expected(i, t) for i, t in small]
    compare(periodic_runs.report(make_docs(spark, small).withColumnsRenamed({"size": "runs", "node": "best"})), want)
    long = rows_of(periodic_runs.report(make_docs(spark, texts[-2:])).orderBy("doc_id"))
    assert [(r["n_runs"], r["start"], r["length"], r["period"]) for r in long] == [(1, 0, 20_000, 1), (1, 0, 15_000, 3000)]
    assert rows_of(periodic_runs.report(make_docs(spark, []))) == []


def test_small_exponents_are_refused(spark):
    with pytest.raises(ValueError):
        periodic_runs.scan(make_docs(spark, []), exponent=2)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len((r["text"] or "").split()) <= 1500]
    got = {r["doc_id"]: r for r in rows_of(queries.op11_periodic_runs(spark, SF))}
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    for r in short:
        assert tuple(got[r["doc_id"]][c] for c in COLUMNS) == expected(r["doc_id"], r["text"], planted=True)
    assert sum(g["n_runs"] > 0 for g in got.values()) > 5
