"""Structured Streaming forms of the bronze load and the insert-only merge.

Both run with ``trigger(availableNow=True)``: each start processes every file
not yet recorded in the checkpoint, then stops, which is the streaming form
of a scheduled incremental batch.  State lives under the shared checkpoint
folder (``spark.checkpoint.dir``), so a restarted driver resumes where the
last committed micro-batch ended.

The insert-only merge runs in ``foreachBatch``: each micro-batch is
deduplicated on the key and anti-joined against the target before it is
appended.  A micro-batch replayed after a failure therefore appends nothing
twice, which makes the sink idempotent without a transactional format.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.operators import quality as Q
from snapstar.session import ensure_checkpoint_dir
from snapstar.sources.landing import BRONZE_SCHEMA, bronze_from_files
from snapstar.sources.tables import new_rows


def _read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        # What the first batch meets: no folder, or one without rows so far.
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _append_new(batch: DataFrame, target_path: str, keys: Sequence[str], partition_by: str | None,
                null_safe: Sequence[str] = (), within_partition: bool = True) -> None:
    """Append the batch rows whose key is not in the target yet.

    With ``partition_by`` the target is partitioned on that column (e.g. the
    ingestion date) and, where a key can only come again with the same value of
    that column (``within_partition``), only the partitions present in the batch
    are read for the existence check.  Otherwise the key columns of the whole
    target are read.
    """
    spark = batch.sparkSession
    src = batch.dropDuplicates(list(keys))
    existing = _read_if_exists(spark, target_path)
    if existing is not None:
        if partition_by and within_partition:
            wanted = src.select(partition_by).distinct()
            existing = existing.join(wanted, on=partition_by, how="left_semi")
        src = new_rows(existing, src, keys, null_safe)
    writer = src.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(target_path)


def insert_only_batch(target_path: str, keys: Sequence[str], partition_by: str | None = None, within_partition: bool = True):
    """foreachBatch function: append the batch's unseen keys to a parquet
    target (created on first use)."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        _append_new(batch, target_path, keys, partition_by, within_partition=within_partition)

    return run


def stream_insert_only(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    checkpoint: str,
    keys: Sequence[str],
    max_files_per_trigger: int | None = None,
    source_dir: str | None = None,
    glob: str | None = None,
    partition_by: str | None = None,
) -> None:
    """Run the parquet file stream to completion (availableNow).

    A file source watches a directory; ``source_dir`` + ``glob`` select
    files inside it (``source_path`` is read once for the schema)."""
    schema = spark.read.parquet(source_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.parquet(source_dir or source_path)
    q = (
        stream.writeStream.foreachBatch(insert_only_batch(target_path, keys, partition_by))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def stream_landing_to_bronze(spark: SparkSession, landing: str, target_path: str, checkpoint: str) -> None:
    """Landing tree -> bronze parquet, one append per micro-batch, keyed on
    ``request_id`` so replays add nothing, also not on another day."""
    raw = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .load(landing)
        .select("value", "_metadata")
    )
    bronze = bronze_from_files(raw)
    q = (
        bronze.writeStream.foreachBatch(insert_only_batch(target_path, ["request_id"], "ingestion_date", within_partition=False))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def silver_batch(transform, rules, keys: Sequence[str], target_path: str, quarantine_path: str,
                 null_safe: Sequence[str] = (), partition_by: str | None = "ingestion_date"):
    """foreachBatch function for bronze -> silver: flatten, split by the
    rules (invalid rows go to a quarantine table with ``failed_rules``), and
    insert the valid rows whose key is new (checked against the target's
    partitions of this batch only).  Replays add nothing."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        rows = transform(batch)
        valid, invalid = Q.split(rows, rules())
        # A row of the quarantine is known by all its values: bad rows may lack
        # their keys.  The array of rules is compared as it is.
        _append_new(invalid, quarantine_path, invalid.columns, partition_by, null_safe=invalid.columns)
        _append_new(valid, target_path, keys, partition_by, null_safe)

    return run


def stream_bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    transform,
    rules,
    keys: Sequence[str],
    target_path: str,
    quarantine_path: str,
    checkpoint: str,
    null_safe: Sequence[str] = (),
) -> None:
    """Bronze parquet files -> silver, incrementally (availableNow).

    ``transform`` is a flattener from :mod:`snapstar.sources.flatten`;
    ``rules`` returns the rule list (built per batch)."""
    stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(bronze_path)
    q = (
        stream.writeStream.foreachBatch(silver_batch(transform, rules, keys, target_path, quarantine_path, null_safe))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def stream_events_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver-table form: stream the events file into an insert-only target
    keyed on ``event_id`` and return the target.  Runs the stream twice; the
    second start finds nothing new, so the target equals one batch load."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    run = f"{base}/stream-insert-only-{uuid.uuid4().hex}"
    target = f"{run}/target"
    ckpt = f"{run}/_checkpoint"
    source = f"{sf_dir}/events.parquet"
    for _ in range(2):
        stream_insert_only(spark, source, target, ckpt, ["event_id"], source_dir=sf_dir, glob="events.parquet")
    cols = spark.read.parquet(source).columns
    return spark.read.parquet(target).select(*[F.col(c) for c in cols])
