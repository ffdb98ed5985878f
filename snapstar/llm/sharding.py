"""Minimax contiguous partition of atomic groups into shards of near equal bytes.

Rows with equal texts are a group and never parted.  Groups are ordered by a
hash of their text, so that order, groups and cuts need no join.  Among all ways
to cut that order into at most ``shards`` runs, the one with the smallest
largest run is found by binary search over the capacity; each capacity is
checked greedily (fill a shard as far as it goes, cut, go on).

The check asks "which is the last group end at or before position x".  The
driver answers from a summary of the ends: cells with their first and last end.
Where an answer falls strictly inside a cell, only that cell is refined, by one
aggregation of the sorted ends that are stored in the shared folder.  The driver
holds ``CELLS`` cells at first and a few hundred for each refinement, whatever
the input.

Rows: null text has no bytes and is grouped with empty text; size is at least
the 16 bytes of overhead; repeated rows are rows of their own; an empty table
gives an empty result; further columns are ignored.  With fewer groups than
shards some shards are empty.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from snapstar.llm.common import numbered
from snapstar.session import stage

OVERHEAD = 16
CELLS = 65_536
FINER = 4_096


class Ends:
    """Summary of the group ends (cumulative bytes): disjoint cells, each with
    its first and last end."""

    def __init__(self, ends: DataFrame, total: int):
        self.ends, self.total = ends, total
        width = max(1, -(-total // CELLS))
        self.cells = self._summary(ends, 0, width)
        self.first = [a for a, _ in self.cells]

    @staticmethod
    def _summary(ends: DataFrame, start: int, width: int) -> list[tuple[int, int]]:
        got = (ends.groupBy(F.floor((F.col("end") - F.lit(start) - 1) / F.lit(width)).alias("c"))
               .agg(F.min("end").alias("a"), F.max("end").alias("b")).collect())
        return sorted((r["a"], r["b"]) for r in got)

    def last_end(self, x: int) -> int:
        """The largest end that is at most ``x``; 0 if there is none."""
        while True:
            k = bisect_right(self.first, x) - 1
            if k < 0:
                return 0
            a, b = self.cells[k]
            if b <= x or a == x:
                return min(b, x)
            # x falls strictly inside the cell.
            finer = self._summary(self.ends.where(F.col("end").between(a, b)), a - 1, max(1, -(-(b - a + 1) // FINER)))
            self.cells[k:k + 1] = finer
            self.first[k:k + 1] = [p for p, _ in finer]

    def cuts(self, capacity: int, shards: int) -> list[int] | None:
        """The ends of the shards, filled greedily; None if they do not suffice."""
        at, cuts = 0, []
        while at < self.total:
            to = self.last_end(at + capacity)
            if to <= at or len(cuts) == shards:
                return None
            cuts.append(at := to)
        return cuts


def smallest_capacity(ends: Ends, largest: int, shards: int) -> list[int]:
    """The greedy cuts at the smallest feasible capacity."""
    low = max(largest, -(-ends.total // shards))  # below it nothing fits
    high = low
    while (best := ends.cuts(high, shards)) is None:
        low, high = high + 1, high + max(largest, ends.total // shards // 64, 1)
    while low < high:
        middle = (low + high) // 2
        if (cuts := ends.cuts(middle, shards)) is None:
            low = middle + 1
        else:
            high, best = middle, cuts
    return best


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("g"))
    # In the order of groups, rows of one group by doc_id: a large group may
    # span several tasks here, and is merged map-side below.
    ordered = numbered(rows.repartitionByRange("g", "doc_id").sortWithinPartitions("g", "doc_id", "size"), "shard-rows")
    groups = ordered.groupBy("g").agg(F.sum("size").alias("size"), F.min("row_no").alias("row_no"))
    sorted_groups = stage(groups.repartitionByRange("g").sortWithinPartitions("g")
                          .select("g", "size", "row_no", F.spark_partition_id().alias("part")), "shard-groups")
    parts = sorted_groups.groupBy("part").agg(F.sum("size").alias("n"), F.max("size").alias("m")).orderBy("part").collect()
    total, offsets = 0, []
    for r in parts:
        offsets.append((r["part"], total))
        total += r["n"]
    if not total:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))
    spark = docs.sparkSession
    offs = F.broadcast(spark.createDataFrame(offsets, "part int, off long"))
    # One window partition is one range of groups, each of which occurs once.
    running = F.sum("size").over(W.partitionBy("part").orderBy("g").rowsBetween(W.unboundedPreceding, 0))
    ends = stage(sorted_groups.withColumn("run", running).join(offs, "part").select("g", "row_no", "size", (F.col("off") + F.col("run")).alias("end")), "shard-ends")
    cuts = smallest_capacity(Ends(ends, total), max(r["m"] for r in parts), shards)
    # The first row of each shard: the row number of the group after each cut.
    firsts = ends.where((F.col("end") - F.col("size")).isin([0, *cuts[:-1]])).select("end", "row_no").orderBy("end").collect()
    starts = [r["row_no"] for r in firsts]
    bounds = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(zip(starts, [*starts[1:], 1 << 62]))], "shard int, start long, stop long")
    placed = F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= F.col("row_no"))) - 1
    return (ordered.withColumn("shard", placed).join(F.broadcast(bounds), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row_no") - F.col("start")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
