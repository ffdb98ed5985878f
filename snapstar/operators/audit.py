"""Table-level audit checks, evaluated together as one Spark job.

Each check builder returns a one-row DataFrame
``(check_name, actual_value bigint, expected_value bigint)``; the suite unions
them, derives ``status`` and stamps the run.  The union is one plan, so the
whole audit is one action instead of one job per check, and results are
persisted before any gate fails the run.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.operators.asof import small_enough
from snapstar.operators.dedup import repeated_and_alone
from snapstar.operators.segmented import prev_within_key

AUDIT_COLUMNS = ["check_name", "status", "actual_value", "expected_value"]


def _one(name: str, df_with_actual: DataFrame, expected: int | None = 0, expected_col=None) -> DataFrame:
    exp = F.lit(expected).cast("bigint") if expected_col is None else expected_col.cast("bigint")
    return df_with_actual.select(
        F.lit(name).alias("check_name"),
        F.col("actual").cast("bigint").alias("actual_value"),
        exp.alias("expected_value"),
    )


def aggregate_checks(df: DataFrame, specs) -> DataFrame:
    """Several checks over one frame in a single aggregate pass.

    ``specs``: ``(name, actual aggregate, expected)`` where expected is an
    int, None (informational) or an aggregate column.  The one-row result is
    unpivoted with ``inline`` into one row per check.
    """
    aggs, rows = [], []
    for i, (name, actual, expected) in enumerate(specs):
        aggs.append(actual.cast("bigint").alias(f"_a{i}"))
        if isinstance(expected, int) or expected is None:
            exp = F.lit(expected).cast("bigint")
        else:
            aggs.append(expected.cast("bigint").alias(f"_e{i}"))
            exp = F.col(f"_e{i}")
        rows.append(F.struct(F.lit(name).alias("check_name"), F.col(f"_a{i}").alias("actual_value"), exp.alias("expected_value")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def row_count(name: str, df: DataFrame) -> DataFrame:
    """Informational count (expected null -> status INFO)."""
    return _one(name, df.agg(F.count(F.lit(1)).alias("actual")), expected=None)


def table_exists(spark, name: str, table: str) -> DataFrame:
    """Existence probe of a catalog table as a check row (catalog metadata,
    no data read)."""
    found = 1 if spark.catalog.tableExists(table) else 0
    return spark.range(1).select(
        F.lit(name).alias("check_name"), F.lit(found).cast("bigint").alias("actual_value"),
        F.lit(1).cast("bigint").alias("expected_value"))


def zero_rows(name: str, df: DataFrame) -> DataFrame:
    """actual = rows of ``df`` (a set of offending rows), expected 0."""
    return _one(name, df.agg(F.count(F.lit(1)).alias("actual")))


def non_empty(name: str, df: DataFrame) -> DataFrame:
    """actual = 1 if the table has rows (a bounded probe, not a full count)."""
    probe = df.limit(1).agg(F.count(F.lit(1)).alias("actual"))
    return _one(name, probe, expected=1)


def duplicate_keys(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("actual"))
    return _one(name, dup)


def duplicate_keys_stored(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As :func:`duplicate_keys`, for a large stored table: a first pass shuffles the
    hashes of the keys, and the check looks at the keys whose hash repeats."""
    return duplicate_keys(name, repeated_and_alone(df.select(*keys), keys)[0], keys)


def null_keys(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return _one(name, df.agg(F.count_if(cond).alias("actual")))


def not_one_current(name: str, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Business keys whose number of current versions is not exactly one."""
    per = dim.groupBy(*keys).agg(F.count_if(F.col("is_current")).alias("n"))
    return _one(name, per.agg(F.count_if(F.col("n") != 1).alias("actual")))


def version_flags(dim: DataFrame, prefix: str) -> DataFrame:
    """Inverted dates, current-with-end and closed-without-end in one pass."""
    return aggregate_checks(dim, [
        (f"{prefix}_inverted_dates",
         F.count_if(F.col("effective_to").isNotNull() & (F.col("effective_to") <= F.col("effective_from"))), 0),
        (f"{prefix}_current_with_end", F.count_if(F.col("is_current") & F.col("effective_to").isNotNull()), 0),
        (f"{prefix}_closed_without_end", F.count_if(~F.col("is_current") & F.col("effective_to").isNull()), 0),
    ])


def inverted_dates(name: str, dim: DataFrame) -> DataFrame:
    cond = F.col("effective_to").isNotNull() & (F.col("effective_to") <= F.col("effective_from"))
    return _one(name, dim.agg(F.count_if(cond).alias("actual")))


def current_with_end(name: str, dim: DataFrame) -> DataFrame:
    cond = F.col("is_current") & F.col("effective_to").isNotNull()
    return _one(name, dim.agg(F.count_if(cond).alias("actual")))


def closed_without_end(name: str, dim: DataFrame) -> DataFrame:
    cond = ~F.col("is_current") & F.col("effective_to").isNull()
    return _one(name, dim.agg(F.count_if(cond).alias("actual")))


def overlapping_versions(name: str, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions that start before the previous version of the key ended, or
    whose previous version is still open (an open older version is otherwise
    only caught by the one-current check).  Skew-safe previous lookup.  Of rows
    that repeat a version the open one comes last, so that the count does not
    depend on where the rows lie.
    """
    until = F.coalesce(F.col("effective_to").cast("timestamp"), F.lit("9999-12-31").cast("timestamp"))
    v = dim.select(*keys, "effective_from", "effective_to", "version_key", F.lit(1).alias("_has"), until.alias("_until"))
    p = prev_within_key(v, keys, ["effective_from", "version_key", "_until"], ["effective_to", "_has"])
    prev_to = F.col("prev_effective_to")
    bad = F.col("prev__has").isNotNull() & (prev_to.isNull() | (prev_to > F.col("effective_from")))
    return _one(name, p.agg(F.count_if(bad).alias("actual")))


def orphans(name: str, child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose (non-null) key has no parent row."""
    parent_keys = list(parent_keys or child_keys)
    # An anti-join ignores parent duplicates, so no distinct (and no extra
    # shuffle) on the parent side.
    p = parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_keys, child_keys)])
    c = child.select(*child_keys)
    for k in child_keys:
        c = c.filter(F.col(k).isNotNull())
    if small_enough(p):
        missing = c.join(F.broadcast(p), on=list(child_keys), how="left_anti")
        return _one(name, missing.agg(F.count(F.lit(1)).alias("actual")))
    # Children are counted by key before they are shuffled.
    counted = c.groupBy(*child_keys).agg(F.count(F.lit(1)).alias("_n"))
    missing = counted.join(p, on=list(child_keys), how="left_anti")
    return _one(name, missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("actual")))


def reconcile(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """actual = rows(left), expected = rows(right)."""
    sides = left.select(F.lit(1).alias("_side")).unionByName(right.select(F.lit(2).alias("_side")))
    counts = sides.agg(
        F.count_if(F.col("_side") == 1).alias("actual"),
        F.count_if(F.col("_side") == 2).alias("expected"),
    )
    return _one(name, counts, expected_col=F.col("expected"))


def set_difference(name: str, left: DataFrame, right: DataFrame, keys: Sequence[str], within: Sequence[tuple[str, DataFrame]] = ()) -> DataFrame:
    """Distinct keys in ``left`` absent from ``right``; of keys whose column of each name
    in ``within`` occurs in the frame beside it, which only those absent are asked."""
    d = left.select(*keys).distinct().join(right.select(*keys), on=list(keys), how="left_anti")
    for key, frame in within:
        d = d.join(frame.select(key), on=key, how="left_semi")
    return _one(name, d.agg(F.count(F.lit(1)).alias("actual")))


def present(name: str, found: bool, spark) -> DataFrame:
    """Whether an expected table is there."""
    return spark.range(1).select(F.lit(name).alias("check_name"), F.lit(int(found)).cast("bigint").alias("actual_value"), F.lit(1).cast("bigint").alias("expected_value"))


def mismatched(name: str, df: DataFrame, left, right) -> DataFrame:
    """Rows where two derivations of a value disagree (null-safe), e.g. a
    stored local date key against one recomputed from the timestamp."""
    lc = F.col(left) if isinstance(left, str) else left
    rc = F.col(right) if isinstance(right, str) else right
    return _one(name, df.agg(F.count_if(~lc.eqNullSafe(rc)).alias("actual")))


def pointing_at_expired(name: str, rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Serving rows whose version key is not a current version (expected 0)."""
    cur = dim.filter(F.col("is_current")).select(key)
    missing = rows.select(key).filter(F.col(key).isNotNull()).join(cur, on=key, how="left_anti")
    return _one(name, missing.agg(F.count(F.lit(1)).alias("actual")))


def rerun_adds_nothing(name: str, once: DataFrame, twice: DataFrame) -> DataFrame:
    """Idempotency probe: rows(twice) - rows(once), expected 0."""
    sides = once.select(F.lit(-1).alias("_d")).unionByName(twice.select(F.lit(1).alias("_d")))
    return _one(name, sides.agg(F.sum("_d").alias("actual")))


def suite(checks: Sequence[DataFrame], run_id: str | None = None) -> DataFrame:
    """Union the checks and derive ``status`` (PASS/FAIL, INFO when no
    expectation)."""
    u = reduce(lambda a, b: a.unionByName(b), checks)
    status = (
        F.when(F.col("expected_value").isNull(), "INFO")
        .when(F.col("actual_value") == F.col("expected_value"), "PASS")
        .otherwise("FAIL")
    )
    out = u.withColumn("status", status).select(*AUDIT_COLUMNS)
    if run_id is not None:
        told = F.concat_ws(" ", F.lit("found"), F.col("actual_value").cast("string"), F.lit("expected"), F.col("expected_value").cast("string"))
        out = (out.withColumn("details", F.when(F.col("status") == "FAIL", told)).withColumn("validation_run_id", F.lit(run_id))
               .withColumn("checked_at", F.current_timestamp()))
    return out


def latest_run_failures(history: DataFrame) -> DataFrame:
    """Failed checks of the newest run in a persisted audit history (the run
    is found by a scalar subquery, not a driver round trip)."""
    latest = history.select(F.max("checked_at")).scalar()
    runs = history.filter(F.col("checked_at") == latest).select("validation_run_id").distinct()
    return history.join(runs, on="validation_run_id", how="left_semi").filter(F.col("status") == "FAIL")


def run_summary(history: DataFrame) -> DataFrame:
    """Checks per run and status."""
    return history.groupBy("validation_run_id", "status").agg(
        F.count(F.lit(1)).alias("checks"), F.max("checked_at").alias("checked_at")
    )


class AuditFailed(RuntimeError):
    pass


def persist_then_gate(results: DataFrame, write) -> DataFrame:
    """Materialise once, hand the rows to ``write`` (e.g. an append), then
    raise if any check failed.  Results are stored before the failure."""
    rows = results.collect()  # bounded: one row per check
    spark = results.sparkSession
    stored = spark.createDataFrame(rows, schema=results.schema)
    write(stored)
    failed = [r["check_name"] for r in rows if r["status"] == "FAIL"]
    if failed:
        raise AuditFailed(f"failed checks: {failed}")
    return stored
