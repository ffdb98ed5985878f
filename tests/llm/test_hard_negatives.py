"""Hard negatives against scoring every pair."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapstar.llm import hard_negatives
from tests.llm.conftest import rows_of

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, n_positives=5, n_negatives=3, low=50, high=95, scale=256):
    rows = [(v, [math.floor(scale * float(np.float32(x))) for x in e], c) for v, e, c in rows
            if v is not None and c is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, (v, e, c) in enumerate(rows):
        if v % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(e, f)), w, j, d) for j, (w, f, d) in enumerate(rows) if j != i]
        for p, pid, _, _ in sorted(s for s in scored if s[3] == c)[:n_positives]:
            inside = sorted(s for s in scored if s[3] != c and low * -p <= 100 * -s[0] <= high * -p)
            out += [(v, pid, k + 1, s[1], -p, -s[0]) for k, s in enumerate(inside[:n_negatives])]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("clash")).withColumn("anchor", F.lit("clash")).withColumn("rank", F.lit("clash"))
    return sorted(tuple(r.values()) for r in rows_of(hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **kw)))


def clustered(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 0.2, (labels, dims)) + 0.1
    return [(i, (centre[i % labels] + rng.normal(0, 0.15, dims)).tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("dims,kw", [(64, {}), (64, {"block_rows": 37, "block_anchors": 3}), (5, {"block_rows": 100}), (1, {})])
def test_equals_brute_force(spark, dims, kw):
    rows = clustered(400, dims, dims)
    want = brute(rows)
    assert mined(spark, rows, **kw) == want and want


def test_bounds_hold_and_filter():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    x = np.floor(256 * (rng.normal(0, 0.1, (300, 50)) + np.repeat(rng.normal(0, 0.5, (300, 5)), 10, axis=1)))
    means, deviations = hard_negatives.summary(x)
    block = hard_negatives.Block(pa.table({"row": np.arange(300), "vec_id": np.arange(300), "label": np.zeros(300, int),
                                           "vector": hard_negatives._lists(x.astype(np.int64), pa.int64()), "means": hard_negatives._lists(means, pa.float64()),
                                           "deviations": hard_negatives._lists(deviations, pa.float64())}))
    every, widths = np.arange(300), []
    for level in range(len(hard_negatives.LEVELS)):
        spread = []
        for k in range(0, 300, 30):
            least, most = block.bounds(block, k, every, level)
            assert (least <= x @ x[k]).all() and (x @ x[k] <= most).all()
            spread.append((most - least).mean())
        widths.append(np.mean(spread))
    assert widths[0] > widths[1] > widths[2]


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = clustered(120, 6, 9, 3)
    rows += [(0, rows[0][1], rows[0][2]), (50, rows[50][1], rows[50][2]), (7, None, 1), (None, rows[1][1], 1), (8, rows[8][1], None), (9, [0.1, None, 0.2], 1),
             (10, [float("nan")] * 6, 1), (11, [float("inf")] * 6, 1), (200, [], 0), (250, [0.5], 2), (300, [0.0] * 6, 1)]
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(40)]
    rng.shuffle(rows)
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows, block_rows=16, block_anchors=2) == brute(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0, 2.0], 1)]) == []


def test_large_components_are_exact(spark):
    rows = [(50 * i, [float(2**20 + i), float(2**19 - 3 * i), 1.0], i % 2) for i in range(8)]
    assert mined(spark, rows) == brute(rows)
