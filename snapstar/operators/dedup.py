"""Row selection per key: latest, canonical, at-latest-snapshot, dedup.

Skew: every per-key pick here is an *aggregate* (``min``/``max`` over a
struct whose leading fields are the ordering), not a window.  Aggregates
combine map-side, so a key that holds a third of all rows still ships at most
one row per map partition through the shuffle.  A ``row_number`` window would
instead sort the whole hot key inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstar.operators.asof import broadcast_if_small
from snapstar.session import stage

#: Hashes of repeated keys that are broadcast; beyond, all rows count as repeated.
REPEATED_BROADCAST = 1_000_000
#: Keys of these types are equal in a grouping only if their hashes are.
_HASHED = (T.StringType, T.BinaryType, T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def pick_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    pick: str = "max",
) -> DataFrame:
    """One row per key: the row with the greatest (``max``) or least (``min``)
    ordering tuple.  Ties on ``order`` are broken by the remaining columns, so
    the result is deterministic.  Keeps the input column order.
    """
    keys = list(keys)
    # An ordering that is a column need not travel twice.
    ordered = {c: f"_o{i}" for i, c in reversed(list(enumerate(order))) if isinstance(c, str) and c in df.columns and c not in keys}
    rest = [c for c in df.columns if c not in keys and c not in ordered]
    order_fields = [c.alias(f"_o{i}") for i, c in enumerate(_cols(order))]
    packed = F.struct(*order_fields, F.struct(*rest).alias("_row")) if rest else F.struct(*order_fields)
    agg = F.max(packed) if pick == "max" else F.min(packed)
    picked = df.groupBy(*keys).agg(agg.alias("_pick"))
    of = {**{c: F.col(f"_pick._row.`{c}`") for c in rest}, **{c: F.col(f"_pick.{o}").alias(c) for c, o in ordered.items()}}
    return picked.select(*[of.get(c, F.col(f"`{c}`")) for c in df.columns])


def repeated_and_alone(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may occur more than once, rows whose key does not): an exact
    partition of a stored frame, which is read several times.

    Only the hashes of the keys are shuffled.  A hash that occurs once belongs to a
    key that occurs once; where different keys share a hash, their rows are among
    the repeated ones too.  If repeated keys are many, all rows are."""
    none = df.where(F.lit(False))
    if not all(isinstance(df.schema[k].dataType, _HASHED) for k in keys):
        return df, none
    code = F.xxhash64(*keys)
    counted = df.groupBy(code.alias("_code")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = stage(counted.where("_n > 1").select("_code"), "repeated-keys")
    n = repeated.count()
    if n == 0 or n > REPEATED_BROADCAST:
        return (df, none) if n else (none, df)
    marked, few = df.withColumn("_code", code), F.broadcast(repeated)
    return tuple(marked.join(few, "_code", how).select(*df.columns) for how in ("left_semi", "left_anti"))


def pick_where_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], pick: str = "max") -> DataFrame:
    """As :func:`pick_per_key`, for a stored frame whose keys seldom repeat: rows that
    are alone in their key are not shuffled, and the others are picked once, whoever
    reads them.  ``df`` itself if no key repeats."""
    repeated, alone = repeated_and_alone(df, keys)
    if alone is df:
        return df
    picked = pick_per_key(repeated, keys, order, pick)
    return picked if repeated is df else alone.unionByName(stage(picked, "picked-rows"))


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest row per key by ``ts``; ``tiebreak`` columns decide equal times."""
    return pick_per_key(df, keys, [ts, *tiebreak], pick="max")


def canonical_per_key(df: DataFrame, keys: Sequence[str], preferred: Column, order: Sequence[str]) -> DataFrame:
    """Row per key preferring rows where ``preferred`` is true, then the least
    ``order`` tuple (e.g. exact id match first, then smallest id)."""
    rank = F.when(preferred, F.lit(0)).otherwise(F.lit(1))
    return pick_per_key(df, keys, [rank, *order], pick="min")


def rows_at_latest(df: DataFrame, ts: str) -> DataFrame:
    """Rows whose ``ts`` equals the global maximum.

    The maximum is a scalar subquery planned inside the same query (no driver
    round trip); the equality is pushed into the parquet scan as a filter.
    """
    latest = df.select(F.max(ts)).scalar()
    return df.filter(F.col(ts) == latest)


def rows_at_latest_per_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows at each key's newest ``ts`` (ties kept).

    Per-key maxima come from a combining aggregate and are stored, so that their size
    is known: a small table is broadcast.  Else the semi-join runs on (keys, ts), which
    spreads a hot key over its many timestamps instead of sending it to one task.
    """
    keys = list(keys)
    latest = stage(df.groupBy(*keys).agg(F.max(ts).alias(ts)), "latest-per-key")
    return df.join(broadcast_if_small(latest), on=[*keys, ts], how="left_semi")
