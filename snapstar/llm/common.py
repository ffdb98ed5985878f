"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.session import stage

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: White space of the word rules (space, and tab to carriage return).
WORD_BREAK = r"[\x20\x09-\x0D]+"


def worker(target: str, **kw) -> Callable:
    """A function for ``mapInArrow``/``applyInPandas`` that calls ``module:function``
    on the executor.  It is pickled by value, so caches that the module keeps
    (compiled models, word tables) live as long as the Python worker."""
    module, name, root = *target.split(":"), ROOT

    def run(first):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(first, **kw)

    return run


def map_arrow(df: DataFrame, target: str, schema: str, **kw) -> DataFrame:
    return df.mapInArrow(worker(target, **kw), schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` in its present order of partitions and rows, staged, with a gapless
    ``row_no`` from 0.

    The row positions are written with the rows, so a recomputed task cannot
    change them.  The driver sees one count per partition.
    """
    staged = stage(df.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright(F.col("_at"), 33)
    counts = sorted((r["p"], r["n"]) for r in staged.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    start, offsets = 0, []
    for p, n in counts:
        offsets.append((p, start))
        start += n
    spark = df.sparkSession
    offs = spark.createDataFrame(offsets or [(0, 0)], "_p long, _off long")
    return (staged.withColumn("_p", part).join(F.broadcast(offs), "_p")
            .withColumn("row_no", F.col("_off") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_p", "_off", "_at"))
