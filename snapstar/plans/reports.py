"""Read-side reports over serving and fact tables.

Dashboard reads become DataFrame functions; rendering is out of scope.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstar.plans.serving import round_half_up


def flagged_list(df: DataFrame, flag: str, order: Sequence[str]) -> DataFrame:
    """Rows with ``flag`` true, sorted (e.g. disrupted lines by name)."""
    return df.filter(F.col(flag)).orderBy(*order)


def series(df: DataFrame, x: str, y: str) -> DataFrame:
    """Chart feed: (x, y) with null y dropped, ascending x."""
    return df.select(x, y).dropna(subset=[y]).orderBy(x)


def weighted_average(value: str, weight: str) -> Column:
    """Aggregate: sum(value * weight) / sum(weight) over rows with a
    positive weight and a value; null when no such row."""
    ok = F.col(weight).isNotNull() & (F.col(weight) > 0) & F.col(value).isNotNull()
    num = F.sum(F.when(ok, F.col(value) * F.col(weight)))
    den = F.sum(F.when(ok, F.col(weight)))
    return num / F.nullif(den, F.lit(0.0))


def sightings_rollup(df: DataFrame, station: str, line: str, vehicle: str) -> DataFrame:
    """Per station: the sum of per-line distinct vehicles (a vehicle on two
    lines counts twice - ``vehicle_line_sightings``) next to the exact
    distinct count.  Both are combining aggregates keyed by the station."""
    per_line = df.groupBy(station, line).agg(F.count_distinct(vehicle).alias("_dv"))
    sight = per_line.groupBy(station).agg(
        F.sum("_dv").cast("bigint").alias("vehicle_line_sightings"), F.count(F.lit(1)).alias("lines")
    )
    exact = df.groupBy(station).agg(F.count_distinct(vehicle).alias("distinct_vehicles"))
    return sight.join(exact, on=station, how="inner")


def distinct_profile(df: DataFrame, cols: Sequence[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """One row: total rows and a distinct count per column (or expression)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_distinct(c).alias(f"distinct_{c}") for c in cols]
    aggs += [F.count_distinct(e).alias(n) for n, e in (extra or {}).items()]
    return df.agg(*aggs)


def freshness(sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per source: oldest and newest timestamp (one combining aggregate
    each, unioned)."""
    parts = [
        df.agg(F.min(ts).cast("timestamp").alias("oldest"), F.max(ts).cast("timestamp").alias("newest")).select(
            F.lit(name).alias("source"), "oldest", "newest"
        )
        for name, (df, ts) in sources.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def by_expression(df: DataFrame, key: Column, name: str, aggs: Sequence[Column]) -> DataFrame:
    """Group by a derived expression (year of a date, a CASE bucket)."""
    return df.groupBy(key.alias(name)).agg(*aggs)


def short_name(name: Column | str, pattern: str, replacement: str = "") -> Column:
    """Display name with a suffix/prefix pattern removed."""
    c = F.col(name) if isinstance(name, str) else name
    return F.trim(F.regexp_replace(c, pattern, replacement))


def timestamp_text(ts: Column | str, fmt: str = "dd MMM yyyy, HH:mm") -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.date_format(c, fmt), F.lit("No data"))


def rounded(col: Column, digits: int) -> Column:
    return round_half_up(col, digits)


def stamp(df: DataFrame, *cols: str) -> DataFrame:
    """Audit stamp columns (processed_at, created_at, updated_at,
    serving_updated_at): the query's start time, one value per query."""
    for c in cols:
        df = df.withColumn(c, F.current_timestamp())
    return df


def mix(df: DataFrame, col: str) -> DataFrame:
    """Row count per value (e.g. status mix)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))


def degree(pairs: DataFrame, node: str, other: str, name: str) -> DataFrame:
    """Per node: number of distinct partners in a pair table (lines per
    station, stations per line)."""
    return pairs.groupBy(node).agg(F.count_distinct(other).alias(name))
