"""Benchmark decontamination against a plain scan of every window."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from snapstar.llm import decontaminate
from tests.llm.conftest import make_docs, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, size=decontaminate.SIZE):
    """Hit words and items of one text, by comparing every window with every item's."""
    w, hit, found = split(text), set(), set()
    for item, t in items:
        v = split(t)
        k = min(size, len(v))
        grams = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1 if k else 0):
            if tuple(w[i:i + k]) in grams:
                hit |= set(range(i, i + k))
                if item is not None:
                    found.add(str(item))
    return hit, found


PASSAGE = "Alpha beta GAMMA delta epsilon zeta eta theta iota kappa lambda my"
ITEMS = [(1, PASSAGE), (2, "short item"), (2, "x " + PASSAGE.lower()), (10, "É c'est été"), (3, None), (4, " .,! "), (None, "nameless test item"), (1, PASSAGE)]


@pytest.fixture(scope="module")
def planted(spark, odd_texts):
    texts = odd_texts + [
        (100, f"before it, {PASSAGE.replace(' ', '--')}! after"), (101, PASSAGE), (102, " ".join(PASSAGE.split()[:9])), (103, "SHORT,ITEM short item Short\nItem"),
        (104, "short x item"), (105, "É C'EST éTé"), (105, "É C'EST été"), (106, f"{PASSAGE} {PASSAGE} short item"), (107, "a nameless TEST item"), (None, PASSAGE),
        (108, "short item " * 30_000), (109, PASSAGE), (109, PASSAGE)]
    return texts


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit("clash")).withColumn("h", F.lit("clash"))


@pytest.mark.parametrize("at_once", [decontaminate.AT_ONCE, 3])
def test_scan_equals_brute_force(spark, planted, at_once):
    docs = make_docs(spark, planted).withColumn("row", F.lit("clash")).withColumn("spans", F.lit("clash"))
    got = [(r["doc_id"], r["n_words"], sorted(p for s in r["spans"] for p in range(s["start"], s["stop"])), r["items"])
           for r in rows_of(decontaminate.scan(docs, benchmark(spark), at_once=at_once))]
    want = []
    for i, t in planted:
        hit, found = brute(t, ITEMS)
        want.append((i, len(split(t)), sorted(hit), sorted(found)))
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(bool(r[2]) for r in want) > 8


def test_report_columns(spark):
    got = rows_of(decontaminate.report(make_docs(spark, [(1, PASSAGE), (2, "clean"), (3, None)]), benchmark(spark)).orderBy("doc_id"))
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in got] == [(12, 12, 2, True), (1, 0, 0, False), (0, 0, 0, False)]
    assert [r["items_sha256"] for r in got] == [hashlib.sha256(b"1,2").hexdigest(), empty, empty]


def test_remove_documents_and_spans(spark, planted):
    docs = make_docs(spark, planted).withColumn("digest", F.lit("clash"))
    left = rows_of(decontaminate.remove(docs, benchmark(spark)).select("doc_id", "text", "digest"))
    want = [(i, t) for i, t in planted if not brute(t, ITEMS)[0]]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted([(r["doc_id"], r["text"]) for r in left], key=key) == sorted(want, key=key)
    cut = decontaminate.remove(docs, benchmark(spark), "spans")
    assert cut.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in cut.where("doc_id >= 100").select("doc_id", "text").collect()}
    assert texts[100] == "before it, ! after" and texts[101] == "" and texts[104] == "short x item" and texts[107] == "a "
    assert cut.where("doc_id = 7").first()["text"] == dict(planted)[7]
    assert cut.count() == len(planted)


def test_empty_tables(spark):
    none, docs = benchmark(spark, []), make_docs(spark, [(1, PASSAGE), (None, None)])
    assert [r["n_hit"] for r in rows_of(decontaminate.report(docs, none))] == [0, 0]
    assert rows_of(decontaminate.report(make_docs(spark, []), benchmark(spark))) == []
    assert decontaminate.remove(docs, none).count() == 2
