"""Landing tree -> bronze.

Raw responses land as one JSON file each under
``<base>/<source>/<dataset>/YYYY/MM/DD/HH/<request_id>.json``.  Bronze keeps
one row per response with the payload as text.  The bulk loader reads the
whole tree as a distributed file scan (``wholetext``) and recovers the
envelope from the file path, so there is no driver loop and no per-response
commit.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

BRONZE_SCHEMA = StructType([
    StructField("request_id", StringType(), False),
    StructField("source", StringType(), False),
    StructField("dataset", StringType(), False),
    StructField("source_endpoint", StringType(), False),
    StructField("ingested_at", TimestampType(), False),
    StructField("ingestion_date", DateType(), False),
    StructField("http_status", IntegerType(), True),
    StructField("payload", StringType(), False),
])

PATH_PATTERN = r"/([^/]+)/([^/]+)/(\d{4})/(\d{2})/(\d{2})/(\d{2})/([^/]+)\.json$"


def landing_path(base: str, source: str, dataset: str, ts, request_id: str) -> str:
    """Path of one landed response (``ts`` is a UTC datetime)."""
    return f"{base}/{source}/{dataset}/{ts:%Y/%m/%d/%H}/{request_id}.json"


# What a landed file may hold beside the payload.  A file without these fields
# is the payload itself.
ENVELOPE = "source_endpoint STRING, http_status INT, ingested_at TIMESTAMP, payload STRING"


def envelope(payload: str, source_endpoint: str, http_status: int, ingested_at) -> str:
    """The content of a landed file (``ingested_at``: a UTC datetime)."""
    return json.dumps({"source_endpoint": source_endpoint, "http_status": http_status,
                       "ingested_at": f"{ingested_at:%Y-%m-%dT%H:%M:%S.%f}Z", "payload": payload})


def bronze_from_files(raw: DataFrame, endpoint: str | None = None) -> DataFrame:
    """Bronze rows from a ``text(wholetext)`` frame with ``_metadata``.

    Endpoint, status and request time come from the landed envelope.  A file
    that holds a bare payload has the path's hour as its time, ``endpoint`` or
    else ``<source>/<dataset>`` as its endpoint, and a null status (the contract
    rules reject it unless the status is known).  File times are not used: a
    copy or a replay must not move a snapshot."""
    path = F.col("_metadata.file_path")
    part = lambda i: F.regexp_extract(path, PATH_PATTERN, i)
    number = lambda i: F.nullif(part(i), F.lit("")).cast("int")
    hour = F.make_timestamp(number(3), number(4), number(5), number(6), F.lit(0), F.lit(0))
    rows = raw.select("value", "_metadata", F.from_json("value", ENVELOPE).alias("_e"))
    wrapped = F.col("_e.payload").isNotNull() & F.col("_e.source_endpoint").isNotNull()
    ingested = F.when(wrapped, F.coalesce("_e.ingested_at", hour)).otherwise(hour)
    return rows.select(
        part(7).alias("request_id"),
        part(1).alias("source"),
        part(2).alias("dataset"),
        F.when(wrapped, F.col("_e.source_endpoint")).otherwise(F.coalesce(F.lit(endpoint), F.concat_ws("/", part(1), part(2)))).alias("source_endpoint"),
        ingested.alias("ingested_at"),
        F.to_date(ingested).alias("ingestion_date"),
        F.when(wrapped, F.col("_e.http_status")).alias("http_status"),
        F.when(wrapped, F.col("_e.payload")).otherwise(F.col("value")).alias("payload"),
    )


def read_landing(spark: SparkSession, base: str, source: str = "*", dataset: str = "*") -> DataFrame:
    """Bulk read of landed responses into bronze rows."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(
        f"{base}/{source}/{dataset}", wholetext=True
    ).select("value", "_metadata")
    return bronze_from_files(raw)

