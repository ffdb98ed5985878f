"""SparkSession factory and session-level invariants.

Two invariants matter for correct results:

* the session time zone is UTC.  All stored timestamps are UTC instants and
  London-local values are derived with ``from_utc_timestamp``; under any other
  session zone that conversion shifts twice.
* lineage is cut by writing Parquet into the shared folder the cluster names in
  ``spark.checkpoint.dir`` (:func:`stage`).  Staged tables stay for as long as a
  frame may read them; ``unstage`` removes all of a session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that hold at any scale.  Shuffle partition counts are left to AQE:
# it starts from spark.sql.shuffle.partitions and coalesces small partitions
# after each stage, and splits skewed partitions in sort-merge joins.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.ansi.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "snapstar",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (runtime conf, safe to call repeatedly)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: an already-set context folder, else the shared
    folder that ``spark.checkpoint.dir`` names.  There is no fallback: a folder
    of one machine would not be seen by the others."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder that all executors share")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint
    folder (``spark.checkpoint.dir``) and reading it back.

    One computation and one write; readers get column pruning and filter
    pushdown, and the files survive executor loss.  Used between chained
    operators that each read their input in several branches, where the
    recomputation would otherwise multiply.  (An RDD ``checkpoint()``
    computes the plan twice unless it is cached first.)

    ``compression``: the codec of the files, by default the session's; ``zstd``
    halves hexadecimal keys and payloads.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/staged/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).parquet(path)
    # The schema is known: reading it from the files again would be a job for each stage.
    return spark.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession) -> None:
    """Remove what :func:`stage` wrote in this application.  Frames that read it
    can no longer be evaluated."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/staged/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
