"""Table writes: append, staged replace, insert-only merge, upsert, expire.

The merge semantics are DataFrame functions first (``*_frame``) so they can
be planned, tested and streamed (``foreachBatch``) without a lakehouse
format; the catalog writers wrap them.  ``MERGE INTO`` needs a format that
supports it; with one on the classpath, ``DataFrame.mergeInto`` is a drop-in
for :func:`merge_upsert`.

Overwrite safety: a table is never overwritten by a plan that reads it.
Replacement writes a staged table, then swaps names (single writer); tables with
versions and a history are in :mod:`snapstar.sources.versions`.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.session import stage  # noqa: F401  (re-exported: lineage cut in the shared folder)


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()) -> Column:
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(right[k]) if k in null_safe else left[k] == right[k]
        cond = e if cond is None else cond & e
    return cond


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()) -> DataFrame:
    """Source rows whose key has no match in the target (anti-join)."""
    return source.join(target, _match(source, target, keys, null_safe), "left_anti")


def insert_only_frame(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: Sequence[str] = (),
    dedup_source: bool = True,
) -> DataFrame:
    """Target plus source rows with unseen keys.  Rerunning with the same
    source adds nothing.  Duplicate source keys are collapsed (the plain
    merge would insert them all)."""
    src = source.dropDuplicates(list(keys)) if dedup_source else source
    return target.unionByName(new_rows(target, src, keys, null_safe))


def upsert_frame(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()) -> DataFrame:
    """Update-all on match, insert otherwise: (target minus matched keys)
    plus source."""
    kept = target.join(source, _match(target, source, keys, null_safe), "left_anti")
    return kept.unionByName(source)


def expire_frame(
    dim: DataFrame,
    changed_keys: DataFrame,
    keys: Sequence[str],
    at: Column,
    to_col: str = "effective_to",
    current_col: str = "is_current",
) -> DataFrame:
    """Close the current row of every key in ``changed_keys`` at ``at``.

    A left join with a match marker, then a conditional rewrite: one pass,
    no update-in-place.
    """
    marks = changed_keys.select(*keys).distinct().withColumn("_chg", F.lit(True))
    j = dim.join(marks, on=list(keys), how="left")
    hit = F.col(current_col) & F.coalesce(F.col("_chg"), F.lit(False))
    return (
        j.withColumn(to_col, F.when(hit, at.cast("timestamp")).otherwise(F.col(to_col).cast("timestamp")))
        .withColumn(current_col, F.when(hit, F.lit(False)).otherwise(F.col(current_col)))
        .withColumns({c: F.when(hit, F.current_timestamp()).otherwise(F.col(c)) for c in ("updated_at",) if c in dim.columns})
        .drop("_chg")
        .select(*dim.columns)
    )


# --------------------------------------------------------------------------
# Catalog writers
# --------------------------------------------------------------------------


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_database(spark: SparkSession, name: str) -> None:
    """Namespace for a layer (bronze, silver, gold, meta)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Table inventory of a namespace (catalog metadata, no data read)."""
    return sorted(t.name for t in spark.catalog.listTables(database))


LOAD_LOG_SCHEMA = "load_id string, table_name string, operation string, rows_written bigint, logged_at timestamp"


def log_load(spark: SparkSession, log_table: str, table_name: str, operation: str, rows_written: int | None) -> None:
    """Append one load record (replaces a format's commit history on plain
    parquet tables).  One small row from the driver."""
    row = [(uuid.uuid4().hex, table_name, operation, rows_written)]
    df = spark.createDataFrame(row, "load_id string, table_name string, operation string, rows_written bigint")
    df.withColumn("logged_at", F.current_timestamp()).write.mode("append").saveAsTable(log_table)


def laid_out(df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """Physical layout before a write.

    * ``partition_by`` (e.g. a date): rows are first rebalanced on the
      partition columns, so that a table partition gets few large files; unlike
      a plain repartition, adaptive execution may split a partition that is
      larger than the advisory size over several tasks;
    * ``sort_by`` (e.g. ``snapshot_at``): sorted within each file, so
      parquet min/max statistics let later filters on that column (latest
      snapshot, latest day) skip row groups.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    return df


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str], sort_by: Sequence[str]):
    w = laid_out(df, partition_by, sort_by).write.mode(mode)
    return w.partitionBy(*partition_by) if partition_by else w


def append(df: DataFrame, name: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    _writer(df, "append", partition_by, sort_by).saveAsTable(name)


def replace(spark: SparkSession, df: DataFrame, name: str, partition_by: Sequence[str] = (),
            sort_by: Sequence[str] = ()) -> None:
    """Full replace with schema overwrite through a staged table.

    ``df`` may read ``name``: the staged write finishes first.  Then the old table
    steps aside under another name, the staged one takes its place and the old one
    goes.  A run that dies on the way leaves a whole table under one of the names,
    which the next call (or :func:`recover`) puts right.  Versions, history and
    several writers are what :mod:`snapstar.sources.versions` is for.
    """
    recover(spark, name)
    _writer(df, "overwrite", partition_by, sort_by).saveAsTable(f"{name}__staged")
    if table_exists(spark, name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    recover(spark, name)


def recover(spark: SparkSession, name: str) -> None:
    """Finish or undo an interrupted :func:`replace`.

    The old table steps aside only when the staged one is whole: where ``name`` is
    missing, the staged table is the new one; where it is there, a staged table may
    be half written."""
    staged, old = f"{name}__staged", f"{name}__old"
    if table_exists(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
    elif table_exists(spark, staged):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    elif table_exists(spark, old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
    if table_exists(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def merge_insert_only(
    spark: SparkSession, source: DataFrame, name: str, keys: Sequence[str], null_safe: Sequence[str] = (),
    partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), log_table: str | None = None,
) -> str:
    """Create the table from ``source`` or append its unseen keys.
    Returns ``"created"`` or ``"merged"``.

    With ``partition_by`` columns that are part of the key (e.g. the
    ingestion date), the existence check reads only the target partitions
    present in the source."""
    recover(spark, name)
    src = source.dropDuplicates(list(keys))
    if not table_exists(spark, name):
        _writer(src, "overwrite", partition_by, sort_by).saveAsTable(name)
        if log_table:
            log_load(spark, log_table, name, "created", None)
        return "created"
    target = spark.table(name)
    if partition_by and set(partition_by) <= set(keys):
        target = target.join(src.select(*partition_by).distinct(), on=list(partition_by), how="left_semi")
    append(new_rows(target, src, keys, null_safe), name, partition_by, sort_by)
    if log_table:
        log_load(spark, log_table, name, "merged", None)
    return "merged"


class DuplicateSourceKeys(ValueError):
    pass


def refuse_repeated(source: DataFrame, keys: Sequence[str], name: str) -> None:
    """A source key that occurs twice would match a row twice."""
    if (n := source.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").count()):
        raise DuplicateSourceKeys(f"{n} source keys occur more than once in the merge into {name}")


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def merge_upsert(spark: SparkSession, source: DataFrame, name: str, keys: Sequence[str], null_safe: Sequence[str] = (),
                 partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), log_table: str | None = None) -> str:
    """Create, or rewrite as (old minus matched) plus source.
    Returns ``"created"`` or ``"upserted"``.

    A source key that occurs twice is refused, as it would match a row twice.
    An existing table keeps its partition columns.  Where these are part of the
    key, only the partitions that the source touches are rewritten."""
    recover(spark, name)
    refuse_repeated(source, keys, name)
    if not table_exists(spark, name):
        _writer(source, "overwrite", partition_by, sort_by).saveAsTable(name)
        done = "created"
    else:
        parts = partition_columns(spark, name)
        target = spark.table(name)
        if parts and set(parts) <= set(keys):
            touched = target.join(source.select(*parts).distinct(), on=parts, how="left_semi")
            rows = stage(upsert_frame(touched, source, keys, null_safe), "upsert").select(*target.columns)
            mode = "spark.sql.sources.partitionOverwriteMode"  # insertInto takes it from the session alone
            before = spark.conf.get(mode)
            try:
                spark.conf.set(mode, "dynamic")
                laid_out(rows, parts, sort_by).write.mode("overwrite").insertInto(name)
            finally:
                spark.conf.set(mode, before)
        else:
            replace(spark, upsert_frame(target, source, keys, null_safe), name, parts, sort_by)
        done = "upserted"
    if log_table:
        log_load(spark, log_table, name, done, None)
    return done
