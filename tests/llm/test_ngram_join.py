"""The join against brute force over all pairs."""

import random

import numpy as np
import pytest

from snapstar.llm import ngram_join as J
from snapstar.llm.components import components
from tests.llm.conftest import SF, make_docs, rows_of, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, k, num, den):
    """(doc_id, size, component) by position."""
    sets = []
    for _, t in rows:
        w = words((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and min(len(a), len(b)) * den >= num * max(len(a), len(b)):
                if den * len(a & b) >= num * len(a | b):
                    x, y = root(i), root(j)
                    parent[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(sets[i]), least.get(root(i)) if d is not None else None) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(df)), key=str)


def near_copies(n_groups=25, seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, i = [], 0
    for _ in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 12, 25, 60, 150, 400]))] + (passage if rng.random() < 0.4 else [])
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                at = rng.randrange(len(w))
                kind = rng.random()
                if kind < 0.5:
                    w[at] = rng.choice(vocabulary)
                elif kind < 0.75:
                    w.insert(at, rng.choice(vocabulary))
                elif len(w) > 1:
                    del w[at]
            rows.append((i, " ".join(w).upper() if rng.random() < 0.2 else " ".join(w)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,num,den", [(3, 9, 10), (5, 4, 5)])
def test_planted_copies_match_brute_force(spark, k, num, den):
    rows = near_copies()
    assert got(J.similarity_classes(make_docs(spark, rows), k, num, den)) == brute(rows, k, num, den)


def test_tiles_give_the_same_classes(spark):
    rows = near_copies(12, seed=8)
    rows += [(1000 + i, t) for i, (_, t) in enumerate(near_copies(1, seed=9) * 1)]
    want = brute(rows, 3, 9, 10)
    assert got(J.similarity_classes(make_docs(spark, rows), 3, 9, 10, tile_tokens=400)) == want


def test_driver_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(J.similarity_classes(docs, 3, 9, 10)) == brute(rows, 3, 9, 10)


def test_odd_rows(spark, odd_texts):
    assert got(J.similarity_classes(make_docs(spark, odd_texts), 3, 9, 10)) == brute(odd_texts, 3, 9, 10)


def test_empty_table(spark):
    assert got(J.similarity_classes(make_docs(spark, []), 3, 9, 10)) == []


def test_keep_one(spark, odd_texts):
    kept = [r["doc_id"] for r in rows_of(J.keep_one(make_docs(spark, odd_texts)))]
    assert sorted(kept, key=str) == sorted([0, 1, 2, 3, 7, 8, 10, 11, 12, 12, 13, None, None], key=str)


def test_rtree_loses_no_pair():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 500, rng.integers(1, 60)).astype(np.uint64)) for _ in range(300)]
    sets += [np.unique(np.r_[s[1:], np.uint64(900)]) for s in sets[:100]]
    points, sizes = J.points_of(sets), np.array([len(s) for s in sets])
    tree = J.RTree(points, sizes)
    found = {tuple(sorted(p)) for part in tree.pairs(tree, 4, 5) for p in part.tolist()}
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 9 * both >= 4 * (len(sets[i]) + len(sets[j])):
                assert (j, i) in found
    assert len(found) < len(sets) * (len(sets) - 1) // 2


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    found = {r["node"]: r["root"] for r in rows_of(components(spark.createDataFrame(edges, "a long, b long")))}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert all(found.get(x, x) == root(x) for x in parent)


@pytest.mark.parametrize("num,den", [(4, 5), (9, 10), (1, 2)])
def test_linked_sets_share_a_key_or_are_both_scattered(num, den):
    rng = np.random.default_rng(7)
    seen = 0
    for _ in range(3000):
        a = np.unique(rng.integers(0, 1 << 62, int(rng.choice([1, 2, 5, 10, 20, 40, 90, 300]))).astype(np.uint64))
        gone = rng.integers(0, len(a) * (den - num) // den + 1)
        more = rng.integers(0, max(1, (len(a) - gone) * den // num - len(a) + 1))
        b = np.unique(np.r_[rng.permutation(a)[gone:], rng.integers(0, 1 << 62, more).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        if not both or den * both < num * (len(a) + len(b) - both):
            continue
        (ka, sa), (kb, sb) = J.group_keys(a, num, den), J.group_keys(b, num, den)
        assert len(np.intersect1d(ka, kb)) or (sa and sb)
        seen += not (sa and sb)
    assert seen > 300 or 2 * num == den  # at one half all sets of this kind are scattered


def test_rare_prefixes_of_linked_sets_meet(spark):
    rng = random.Random(5)
    common = rng.sample(range(10**6), 12)
    sets = {}
    for i in range(0, 300, 2):
        s = set(common[:rng.randint(0, 12)]) | set(rng.sample(range(10**6, 10**9), rng.randint(1, 25)))
        sets[i] = s
        sets[i + 1] = set(rng.sample(sorted(s), len(s) - len(s) // 5)) | (set(rng.sample(range(10**9, 10**10), 1)) if len(s) > 12 and rng.random() < 0.3 else set())
    rows = [(i, len(s), x) for i, s in sets.items() for x in s] * 2
    keys = {}
    for r in rows_of(J._rare_prefixes(spark.createDataFrame(rows, "node long, n long, key long"), 4, 5)):
        keys.setdefault(r["node"], set()).add(r["key"])
    linked = [(i, i + 1) for i in range(0, 300, 2) if 5 * len(sets[i] & sets[i + 1]) >= 4 * len(sets[i] | sets[i + 1])]
    assert len(linked) > 100 and all(keys[i] & keys[j] for i, j in linked)
    assert max(sum(k in s for s in keys.values()) for k in set().union(*keys.values())) < 20


@pytest.mark.parametrize("k,num,den", [(5, 4, 5), (3, 9, 10)])
def test_unrelated_texts_share_few_keys(spark, k, num, den):
    texts = [r["text"] for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("text").collect()]
    sets = {J.fingerprint(s): s for s in (J.shingle_set(t, k) for t in texts) if len(s)}
    parent, first = {n: n for n in sets}, {}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for node, s in sets.items():
        for key in J.group_keys(s, num, den)[0].tolist():
            parent[root(node)] = root(first.setdefault(key, node))
    sizes = {}
    for n in sets:
        sizes[root(n)] = sizes.get(root(n), 0) + 1
    assert max(sizes.values()) <= 20 and len(sets) > 900
