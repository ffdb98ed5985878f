"""Hard negatives by segment summaries of vectors.

Vectors are quantised (``floor(scale * x)`` of each component), and a score is
the integer inner product with the anchor; higher scores come first, ties by
smaller ``vec_id``.  An anchor's positives are its first ``n_positives`` other
rows of the same label.  For each of them its hard negatives are the first
``n_negatives`` rows of other labels whose score lies between ``low`` and
``high`` percent of the positive's.

Each vector is stored with the mean and the deviation (root of the summed
squared differences from the mean) of its segments, at 1, 4 and 16 segments.
Over a segment of n components two vectors' products sum to n times the product
of the means, give or take the product of the deviations.  So the summaries
bound a score; rows whose bounds cannot reach the places or the window that are
sought drop out, the others are bounded again by finer segments, and what is
left is scored exactly.  The bounds are widened by more than their rounding.

Anchors (a stated query set) meet all rows in blocks: rows and anchors are dealt
into blocks of bounded size by a hash of their row number, and each task takes
one block of each.  A block gives at most ``n_positives`` rows for an anchor, or
``n_negatives`` for an anchor and positive score, whatever the labels' sizes; the
first of all blocks are picked by a window over these.  Labels are no shuffle
key, so a hot label or a vector that is repeated thousands of times meets no
single task.  Nothing passes through the driver but three counts.

Rows without ``vec_id``, label or vector, or with a null or non-finite component,
take no part.  A shorter vector's missing components count as 0.  Rows that
repeat a ``vec_id`` are rows of their own (ties between them go by row); an
anchor without positives, or a positive without negatives, gives no row; an
empty table gives an empty result; further columns are ignored.  A component or
score beyond a long is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstar.llm.common import ROOT, map_arrow
from snapstar.session import stage

N_POSITIVES, N_NEGATIVES = 5, 3
LOW, HIGH = 50, 95
SCALE = 256.0
#: Segments of each level.
LEVELS = (1, 4, 16)
#: Rows and anchors of a block: about 1 KB each.
ROWS, ANCHORS = 32_768, 8_192
#: Bounds are widened by this part of the product of the norms.
MARGIN = 1e-9

VECTORS = "row long, vec_id long, label int, anchor boolean, vector array<long>, means array<double>, deviations array<double>"
FOUND = "anchor_row long, positive_score long, row long, vec_id long, score long"
_FOUND = pa.schema([(c, pa.int64()) for c in ("anchor_row", "positive_score", "row", "vec_id", "score")])


def segments(dims: int, n: int) -> np.ndarray:
    """First components of ``n`` segments (fewer where there are fewer components);
    those of a level are cut again by the next one."""
    return np.unique(np.linspace(0, dims, n, endpoint=False).astype(int))


def summary(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of all segments of all levels, side by side."""
    means, deviations = [], []
    for n in LEVELS:
        first = segments(x.shape[1], n)
        length = np.diff(np.append(first, x.shape[1]))
        mean = np.add.reduceat(x, first, axis=1) / length
        means.append(mean)
        deviations.append(np.sqrt(np.add.reduceat((x - np.repeat(mean, length, axis=1)) ** 2, first, axis=1)))
    return np.concatenate(means, axis=1), np.concatenate(deviations, axis=1)


def _matrix(column, rows: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _lists(x: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), kind))


def summarised(batches, dims: int, scale: float):
    """The rows quantised, padded to ``dims`` components, with their summaries."""
    for batch in batches:
        x = np.zeros((batch.num_rows, dims))
        for k, v in enumerate(batch.column(4)):
            v = v.values.to_numpy(zero_copy_only=False)
            x[k, :len(v)] = v
        x = np.floor(scale * x)
        if x.size and np.abs(x).max() >= 2.0**63:
            raise OverflowError("a quantised component does not fit a long")
        means, deviations = summary(x)
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], _lists(x.astype(np.int64), pa.int64()), _lists(means, pa.float64()), _lists(deviations, pa.float64())],
                                         ["row", "vec_id", "label", "anchor", "vector", "means", "deviations"])


def vectors(rows: DataFrame, anchors: Column, scale: float = SCALE) -> DataFrame:
    """The rows that take part with their summaries, staged."""
    good = rows.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"), anchors.alias("anchor"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = good.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    dims = max(1, good.agg(F.max(F.size("embedding"))).first()[0] or 0)
    numbered = good.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("int"),
                           F.coalesce("anchor", F.lit(False)).alias("anchor"), "embedding")
    return stage(map_arrow(numbered, "snapstar.llm.hard_negatives:summarised", VECTORS, dims=dims, scale=scale), "vector-summaries")


class Block:
    """Rows of one block with their bounds and scores."""

    def __init__(self, table: pa.Table):
        n = table.num_rows
        self.row, self.vec_id, self.label = (table.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.vector, self.means, self.deviations = (_matrix(table.column(c), n) for c in ("vector", "means", "deviations"))
        dims = self.vector.shape[1]
        self.parts, at = [], 0
        for k in LEVELS:
            first = segments(dims, k)
            self.parts.append((slice(at, at + len(first)), np.diff(np.append(first, dims))))
            at += len(first)
        whole = self.parts[0][0]
        self.norm = np.sqrt(dims * self.means[:, whole] ** 2 + self.deviations[:, whole] ** 2)[:, 0]
        self.exact = self.vector.astype(np.float64)
        self.most = float(np.abs(self.exact).max()) if n else 0.0

    def bounds(self, other: Block, k: int, some: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible scores of rows ``some`` with row ``k`` of ``other``."""
        part, length = self.parts[level]
        middle = self.means[some, part] @ (length * other.means[k, part])
        around = self.deviations[some, part] @ other.deviations[k, part] + MARGIN * self.norm[some] * other.norm[k] + 1e-6
        return middle - around, middle + around

    def scores(self, other: Block, k: int, some: np.ndarray) -> np.ndarray:
        if self.most * other.most * self.vector.shape[1] < 2.0**53:  # sums of doubles are exact
            return (self.exact[some] @ other.exact[k]).astype(np.int64)
        whole = self.vector[some].astype(object) @ other.vector[k].astype(object)
        return np.array(whole.tolist(), np.int64)  # an OverflowError beyond a long

    def first(self, some: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
        return np.lexsort((self.row[some], self.vec_id[some], -scores))[:n]


def _table(found: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    columns = [np.concatenate([np.full(len(f[2]), f[0]) for f in found] or [[]]), np.concatenate([np.full(len(f[2]), f[1]) for f in found] or [[]]),
               *[np.concatenate([f[c] for f in found] or [[]]) for c in (2, 3, 4)]]
    return pa.Table.from_arrays([pa.array(np.asarray(c, np.int64)) for c in columns], schema=_FOUND)


def nearest_of_label(rows: pa.Table, anchors: pa.Table, n: int) -> pa.Table:
    """Of one block of rows, each anchor's first ``n`` others of its label."""
    block, asked = Block(rows), Block(anchors)
    by_label = {label: np.flatnonzero(block.label == label) for label in np.unique(asked.label)}
    found = []
    for k in range(len(asked.row)):
        some = by_label[asked.label[k]]
        some = some[block.row[some] != asked.row[k]]
        for level in range(len(LEVELS)):
            if len(some) <= n:
                break
            least, most = block.bounds(asked, k, some, level)
            some = some[most >= np.partition(least, len(some) - n)[len(some) - n]]
        if len(some):
            scores = block.scores(asked, k, some)
            order = block.first(some, scores, n)
            found.append((asked.row[k], 0, block.row[some[order]], block.vec_id[some[order]], scores[order]))
    return _table(found)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score between ``low`` and ``high`` percent of ``score``."""
    return -(-low * score // 100), high * score // 100


def negatives_in_windows(rows: pa.Table, anchors: pa.Table, n: int, low: int, high: int) -> pa.Table:
    """Of one block of rows, the first ``n`` rows of other labels in the window of
    each of the anchors' positive scores."""
    block, asked = Block(rows), Block(anchors)
    others = {label: np.flatnonzero(block.label != label) for label in np.unique(asked.label)}
    found = []
    for k, wanted in enumerate(anchors.column("positive_scores").to_pylist()):
        spans = [(s, *window(s, low, high)) for s in wanted]
        spans = [s for s in spans if s[1] <= s[2]]
        some = others[asked.label[k]] if spans else ()
        for level in range(len(LEVELS)):
            if not len(some):
                break
            least, most = block.bounds(asked, k, some, level)
            needed = np.zeros(len(some), bool)
            for _, a, b in spans:
                # Rows that are surely inside raise what others must reach.
                inside = least[(least >= a) & (most <= b)]
                reach = np.partition(inside, len(inside) - n)[len(inside) - n] if len(inside) >= n else a
                needed |= (most >= max(a, reach)) & (least <= b)
            some = some[needed]
        if not len(some):
            continue
        scores = block.scores(asked, k, some)
        for s, a, b in spans:
            inside = np.flatnonzero((scores >= a) & (scores <= b))
            if len(inside):
                order = inside[block.first(some[inside], scores[inside], n)]
                found.append((asked.row[k], s, block.row[some[order]], block.vec_id[some[order]], scores[order]))
    return _table(found)


def _by_blocks(rows: DataFrame, anchors: DataFrame, counts: tuple[int, int], target: str, **kw) -> DataFrame:
    """``target`` applied to every block of rows with every block of anchors."""
    root = ROOT

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module("snapstar.llm.hard_negatives"), target)(left, right, **kw)

    n_rows, n_anchors = counts
    number = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.withColumn("row_block", number(n_rows)).withColumn("anchor_block", every(n_anchors))
    # Aliases tell the two sides' columns apart where both come from one table.
    asked = anchors.select(*[F.col(c).alias(c) for c in anchors.columns]).withColumn("anchor_block", number(n_anchors)).withColumn("row_block", every(n_rows))
    keys = ["anchor_block", "row_block"]
    return dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, FOUND)


def _first(found: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("anchor_row", "positive_score").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(rows: DataFrame, anchors: Column, n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: float = SCALE, block_rows: int = ROWS, block_anchors: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``
    for the rows (vec_id, embedding, label) where ``anchors`` holds."""
    table = vectors(rows, anchors, scale)
    total, asked = table.agg(F.count("*"), F.count_if("anchor")).first()
    # Enough blocks to keep all cores busy, and none of more rows than allowed.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    counts = max(1, -(-total // block_rows), min(2 * cores, total // 1024)), max(1, -(-asked // block_anchors))
    chosen = table.where("anchor")
    found = _by_blocks(table, chosen, counts, "nearest_of_label", n=n_positives)
    positives = stage(_first(found, n_positives).select("anchor_row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    wanted = positives.groupBy("anchor_row").agg(F.collect_set("positive_score").alias("positive_scores"))  # n_positives at most
    chosen = chosen.join(wanted.withColumnRenamed("anchor_row", "row"), "row")
    found = _by_blocks(table, chosen, counts, "negatives_in_windows", n=n_negatives, low=low, high=high)
    negatives = _first(found, n_negatives).select("anchor_row", "positive_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = table.where("anchor").select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return (positives.join(negatives, ["anchor_row", "positive_score"]).join(names, "anchor_row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
