"""Versioned tables: immutable folders of Parquet behind a numbered commit log.

A table is a folder::

    <base>/data/commit_folder=<id>/...   what one write has written; never changed
    <base>/_log/<20 digits>.json         one entry for each version, from 1

A write first fills a folder of its own, then puts the next log entry under its
number, which fails if another writer was first.  The entry is the commit: it
names the folders that make up the version.  A driver that dies before it leaves
the table as it was, with a folder that nobody names (``vacuum`` removes it);
one that dies behind it has committed.  There is no moment without a whole table,
and older versions stay readable until they are vacuumed.

Replacing does not depend on what was there, so a replacement that loses the race
takes the next number.  So does an append.  A merge depends on the version that
it has read (``expected``) and is computed again.

The driver lists log entries and reads the newest; an entry holds one name of 40
bytes for each folder of its version, so tables that are appended to thousands of
times should be compacted (``replace`` by their own rows) now and then.  The next
number is taken by a rename that does not overwrite: atomic on HDFS; on a local
folder, for tests, only one driver may write.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from snapstar.sources import tables as T

FOLDER = "commit_folder"
#: Keys that a merge broadcasts to find their rows; more are joined by a shuffle.
FEW_KEYS = 100_000
HISTORY = "version long, operation string, rows_written long, total_rows long, committed_at timestamp, folders array<string>"


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since the version that a write was made for."""


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, time of change in ms) of what lies in ``folder``."""
    p, fs = _path(spark, folder)
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, base: str) -> list[int]:
    return sorted(int(n[:-5]) for n, _ in _names(spark, f"{base}/_log") if re.fullmatch(r"\d{20}\.json", n))


def latest(spark: SparkSession, base: str) -> int:
    """Number of the newest version; 0 before the first."""
    return max(versions(spark, base), default=0)


def _entry_path(base: str, version: int) -> str:
    return f"{base}/_log/{version:020d}.json"


def entry(spark: SparkSession, base: str, version: int) -> dict:
    p, fs = _path(spark, _entry_path(base, version))
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put_if_absent(spark: SparkSession, path: str, content: str) -> bool:
    """Whether ``path`` now holds ``content`` and did not exist before.  Readers
    never see part of it."""
    jvm = spark._jvm
    waiting, fs = _path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4()}")
    out = fs.create(waiting, False)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    target, _ = _path(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(waiting, target, options)
        return True
    except Exception as e:
        fs.delete(waiting, False)
        if "FileAlreadyExistsException" in str(e):
            return False
        raise


def _written(df: DataFrame, base: str, partition_by: Sequence[str], sort_by: Sequence[str]) -> tuple[str, int]:
    """A new folder with the rows of ``df``, and their number, counted by the write itself."""
    seen, folder = Observation(), str(uuid.uuid4())
    rows = T.laid_out(df, partition_by, sort_by).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("errorifexists").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{base}/data/{FOLDER}={folder}")
    return folder, seen.get["rows"]


def commit(spark: SparkSession, base: str, operation: str, written: tuple[str, int], schema: StructType, keep: bool, expected: int | None = None) -> int:
    """Put the next entry: the written folder, behind the folders of the version
    before if these are kept.  The number of the new version."""
    folder, rows = written
    while True:
        now = latest(spark, base)
        if expected is not None and now != expected:
            raise ConcurrentCommit(f"{base} is at version {now}; the write was made for version {expected}")
        before = entry(spark, base, now) if keep and now else {"folders": [], "total_rows": 0}
        content = {"version": now + 1, "operation": operation, "rows_written": rows, "total_rows": before["total_rows"] + rows,
                   "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(), "folders": [*before["folders"], folder], "schema": schema.jsonValue()}
        if _put_if_absent(spark, _entry_path(base, now + 1), json.dumps(content)):
            return now + 1


def replace(spark: SparkSession, df: DataFrame, base: str, operation: str = "replace", partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
            expected: int | None = None) -> int:
    """The whole table from ``df`` (which may read it), with its schema."""
    return commit(spark, base, operation, _written(df, base, partition_by, sort_by), df.schema, keep=False, expected=expected)


def append(spark: SparkSession, df: DataFrame, base: str, operation: str = "append", partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
           expected: int | None = None) -> int:
    """The rows of ``df`` behind those that are there, in the table's columns."""
    now = latest(spark, base)
    schema = StructType.fromJson(entry(spark, base, now)["schema"]) if now else df.schema
    if sorted(schema.names) != sorted(df.columns):
        raise ValueError(f"columns {df.columns} do not fit the table's {schema.names}")
    df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
    return commit(spark, base, operation, _written(df, base, partition_by, sort_by), schema, keep=True, expected=expected)


def read(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default of the newest one."""
    number = latest(spark, base) if version is None else version
    if number not in versions(spark, base):
        raise ValueError(f"{base} has no version {number}")
    found = entry(spark, base, number)
    schema = StructType.fromJson(found["schema"])
    paths = [f"{base}/data/{FOLDER}={f}" for f in found["folders"]]
    rows = spark.read.option("basePath", f"{base}/data").schema(StructType([*schema.fields]).add(FOLDER, StringType())).parquet(*paths)
    return rows.select(*[F.col(f"`{c}`") for c in schema.names])


def history(spark: SparkSession, base: str) -> DataFrame:
    """One row for each version: operation, rows written, rows in all, time, folders."""
    return spark.read.schema(HISTORY).json(f"{base}/_log/*.json")


def _again(write: Callable[[], int]) -> int:
    while True:
        try:
            return write()
        except ConcurrentCommit:
            continue


def merge_insert_only(spark: SparkSession, source: DataFrame, base: str, keys: Sequence[str], null_safe: Sequence[str] = (), within: Sequence[str] = (), **layout) -> int:
    """Append the source rows whose key is not there yet (one of each key); the
    version reached.  Running it again adds no rows.

    ``within``: partition columns that a key always comes with.  Only their values
    in the source are looked at in the table.

    The keys are compared first, without the rest of the rows; rows are shuffled only
    where a key repeats, or where many but not all are new.  The source is read more
    than once: stage one that may give other rows when it is computed again."""
    def write() -> int:
        now = latest(spark, base)
        if not now:
            return replace(spark, _rows_of_new_keys(source, None, keys, null_safe), base, "create", expected=0, **layout)
        there = read(spark, base, now)
        if within:
            there = there.join(source.select(*within).distinct(), list(within), "left_semi")
        return append(spark, _rows_of_new_keys(source, there.select(*keys), keys, null_safe), base, "merge", expected=now, **layout)

    return _again(write)


def _rows_of_new_keys(source: DataFrame, there: DataFrame | None, keys: Sequence[str], null_safe: Sequence[str]) -> DataFrame:
    """One source row for each key that is not ``there``; null keys are one key."""
    counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    fresh = T.stage(counted if there is None else T.new_rows(there, counted, keys, null_safe), "new-keys")
    got = fresh.agg(F.count(F.lit(1)).alias("keys"), F.sum("_n").alias("rows"), F.count_if(F.col("_n") > 1).alias("repeated")).first()
    if not got["keys"]:
        return source.where(F.lit(False))

    def having(rows: DataFrame, some: DataFrame, number: int, how: str) -> DataFrame:
        some = some.select(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)])
        match = [rows[k].eqNullSafe(some[f"_key{i}"]) for i, k in enumerate(keys)]
        return rows.join(F.broadcast(some) if number <= FEW_KEYS else some, match, how)

    rows = source
    if there is not None and (got["keys"] <= FEW_KEYS or got["rows"] < source.count()):
        rows = having(rows, fresh, got["keys"], "left_semi")
    if not got["repeated"]:
        return rows
    repeated = fresh.where("_n > 1")
    once = having(rows, repeated, got["repeated"], "left_anti")
    return once.unionByName(having(rows, repeated, got["repeated"], "left_semi").dropDuplicates(list(keys)))


def merge_upsert(spark: SparkSession, source: DataFrame, base: str, keys: Sequence[str], null_safe: Sequence[str] = (), **layout) -> int:
    """Replace the rows whose keys the source has, and add the others of the source."""
    T.refuse_repeated(source, keys, base)

    def write() -> int:
        now = latest(spark, base)
        rows = T.upsert_frame(read(spark, base, now), source.select(*StructType.fromJson(entry(spark, base, now)["schema"]).names), keys, null_safe) if now else source
        return replace(spark, rows, base, "upsert" if now else "create", expected=now, **layout)

    return _again(write)


def vacuum(spark: SparkSession, base: str, keep: int = 10, grace: dt.timedelta = dt.timedelta(days=7)) -> list[str]:
    """Remove the entries before the last ``keep`` versions, then the folders that
    no entry names and that are older than ``grace`` (a writer may be filling
    younger ones).  Their names."""
    gone = versions(spark, base)[:-keep] if keep > 0 else []
    for v in gone:
        p, fs = _path(spark, _entry_path(base, v))
        fs.delete(p, False)
    named = {f for v in versions(spark, base) for f in entry(spark, base, v)["folders"]}
    until = (dt.datetime.now(dt.timezone.utc) - grace).timestamp() * 1000
    removed = []
    for name, changed in _names(spark, f"{base}/data"):
        folder = name.removeprefix(f"{FOLDER}=")
        if folder not in named and changed <= until:
            p, fs = _path(spark, f"{base}/data/{name}")
            fs.delete(p, True)
            removed.append(folder)
    return removed
