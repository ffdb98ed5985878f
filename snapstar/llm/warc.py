"""Deterministic sharded WARC writer and reader.

Records are ordered by ``page_id`` and cut into shards of ``shard_bytes`` payload
bytes; both depend on the rows alone, not on the cluster.  A task writes the
records of a shard in order, one gzip member each, and rolls to the next file
when ``roll_bytes`` of compressed data are reached.  Files are written under a
temporary name, renamed when complete, and listed in a manifest beside them that
Spark commits last.  A task that runs again makes the same bytes under the same
names.  Readers take only what the manifest lists, and all of it: an archive
without a committed manifest, or with a listed file that is missing or differs in
bytes, digest or number of records, is an error.

Headers are made anew: record ids from page_id and payload, block and payload
digests (base32 SHA-1) from the bytes.  Of records with equal payloads of at
least ``min_bytes`` the one with the largest page_id is a response, and the
others are revisits that refer to it; smaller payloads are all responses.

Rows: null html is an empty payload; a null ``page_id`` orders first, and such
records revisit a response with an id if there is one; rows that repeat the
largest page_id of their payload are all responses; control characters and
spaces in urls are percent-encoded, a null url becomes ``urn:page:<id>``; an empty
table gives no file and an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snapstar.llm.common import map_arrow
from snapstar.session import ensure_checkpoint_dir, stage

DATE = "2024-01-01T00:00:00Z"
SHARD_BYTES = 16 << 20
ROLL_BYTES = 4 << 20
#: Shards of one archive at most; the shard size grows beyond it.
MAX_SHARDS = 50_000
LEVEL = 5


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id, sha: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{sha}')}>"


def _uri(url: str | None, page_id) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)


def record(page_id, url: str | None, payload: bytes, sha: str, refers_to) -> bytes:
    """One uncompressed record.  A revisit has the response's HTTP headers only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, sha)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_uri(url, page_id)}", f"X-Page-ID: {'' if page_id is None else page_id}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to, sha)}",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha1:{_digest(payload)}", f"WARC-Block-Digest: sha1:{_digest(block)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Files:
    """Rolling files of one shard: temporary names first, renamed when whole."""

    def __init__(self, base: str, shard: int, roll: int):
        self.fs, root = pafs.FileSystem.from_uri(base)
        self.root, self.shard, self.roll, self.part, self.made = root.rstrip("/"), shard, roll, 0, []
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
        self._open()

    def _open(self):
        self.temp = f"{self.root}/_temporary/{uuid.uuid4().hex}"
        self.out, self.size, self.records, self.sha = self.fs.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha256()

    def add(self, data: bytes):
        buffer = io.BytesIO()
        with gzip.GzipFile(fileobj=buffer, mode="wb", compresslevel=LEVEL, mtime=0) as z:
            z.write(data)
        member = buffer.getvalue()
        if self.records and self.size + len(member) > self.roll:
            self.close()
            self._open()
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1

    def close(self):
        self.out.close()
        name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
        self.fs.move(self.temp, f"{self.root}/{name}")
        self.made.append((self.shard, self.part, name, self.records, self.size, self.sha.hexdigest()))
        self.part += 1


_MANIFEST = "shard long, part int, name string, records long, bytes long, sha256 string"


def write_batches(batches, base: str, roll: int):
    """Rows (shard, page_id, tag, sha, refers_to, url, html) sorted by the first
    three: what is to be written about a page comes before its html."""
    files = None
    about: dict[str, object] = {}
    page = object()
    for b in batches:
        cols = [b.column(k) for k in range(7)]
        done = []
        for r in range(b.num_rows):
            shard, page_id, tag = cols[0][r].as_py(), cols[1][r].as_py(), cols[2][r].as_py()
            if files is None or files.shard != shard:
                if files:
                    files.close()
                    done += files.made
                files, page = _Files(base, shard, roll), object()
            if page != page_id:
                page, about = page_id, {}
            if tag == 0:
                about[cols[3][r].as_py()] = cols[4][r].as_py()
                continue
            payload = (cols[6][r].as_py() or "").encode("utf-8", "replace")
            sha = hashlib.sha1(payload).hexdigest()
            files.add(record(page_id, cols[5][r].as_py(), payload, sha, about.get(sha)))
        if done:
            yield _manifest(done)
    if files:
        files.close()
        yield _manifest(files.made)


def _manifest(rows):
    return pa.RecordBatch.from_pylist([dict(zip(("shard", "part", "name", "records", "bytes", "sha256"), r)) for r in rows],
                                      schema=pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("name", pa.string()), ("records", pa.int64()),
                                                        ("bytes", pa.int64()), ("sha256", pa.string())]))


def members(content: bytes):
    """The records of a file, one gzip member after the other."""
    rest = content
    while rest:
        z = zlib.decompressobj(31)
        yield z.decompress(rest) + z.flush()
        rest = z.unused_data


def parsed(data: bytes) -> tuple:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if f"sha1:{_digest(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"a damaged block in {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or _digest(payload) != digest):
        raise ValueError(f"a damaged payload in {fields['WARC-Record-ID']}")
    number = lambda x: int(x) if x else None
    return number(fields["X-Page-ID"]), length, digest, fields["WARC-Type"], number(fields.get("X-Refers-To-Page-ID", "")), fields["WARC-Target-URI"], payload


class IncompleteArchive(RuntimeError):
    """No committed manifest, or files that are not as it lists them."""


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_ROWS = f"{_READ}, name string, records long, bytes long, sha256 string"


def read_batches(batches):
    """The records of each file (name, content), and one row more for the file
    itself with what the manifest should say."""
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "name", "records", "bytes", "sha256"]
    for b in batches:
        for name, content in zip(b.column(0), b.column(1)):
            data = content.as_py()
            try:
                rows = [(*parsed(m)[:5], name.as_py(), None, None, None) for m in members(data)]
            except (ValueError, KeyError, StopIteration, zlib.error):
                rows = []  # what is damaged does not match its manifest
            rows.append((None, None, None, None, None, name.as_py(), len(rows), len(data), hashlib.sha256(data).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _at_or_below(bounds: list[int], x):
    """How many sorted ``bounds`` are at or below ``x``, by halving, in SQL."""
    steps, n = [], 1
    while n <= len(bounds):
        steps.insert(0, n)
        n *= 2
    array = F.array(*[F.lit(v).cast("long") for v in bounds]) if len(bounds) < 200 else F.lit(bounds)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda p, s: F.when(p + s <= len(bounds), F.when(F.element_at(array, F.least(p + s, F.lit(len(bounds)))) <= x, p + s).otherwise(p)).otherwise(p))


def write(pages: DataFrame, out: str, min_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes the archive under ``out`` (a URI that all executors reach) and
    returns its manifest."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    lowest = F.lit(-(1 << 63))
    # Without the html: lengths, digests, which record is the response.
    slim = stage(rows.select("page_id", F.octet_length("html").cast("long").alias("n"), F.sha1("html").alias("sha"))
                 .repartitionByRange(F.coalesce("page_id", lowest)).sortWithinPartitions(F.coalesce("page_id", lowest), "sha")
                 .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "warc-slim")
    parts = slim.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    total, offsets = 0, []
    for r in parts:
        offsets.append((r["part"], total))
        total += r["n"]
    spark = pages.sparkSession
    size = max(shard_bytes, -(-total // MAX_SHARDS))
    offs = F.broadcast(spark.createDataFrame(offsets or [(0, 0)], "part int, off long"))
    # A window partition is one range of page ids, of rows without html.
    before = F.sum("n").over(W.partitionBy("part").orderBy("at").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    shards = (slim.withColumn("before", before).join(offs, "part").groupBy(F.floor((F.col("before") + F.col("off")) / size).alias("s"))
              .agg(F.min(F.coalesce("page_id", lowest)).alias("first")))
    bounds = sorted({r["first"] for r in shards.collect()})
    responses = slim.where(F.col("n") >= min_bytes).groupBy("sha").agg(F.max("page_id").alias("response"), F.count("*").alias("copies")).where("copies > 1 AND response IS NOT NULL")
    about = (slim.join(responses.select("sha", "response"), "sha").where(~F.col("page_id").eqNullSafe(F.col("response")))
             .select("page_id", F.lit(0).alias("tag"), "sha", F.col("response").alias("refers_to"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html")))
    told = about.unionByName(rows.select("page_id", F.lit(1).alias("tag"), F.lit(None).cast("string").alias("sha"), F.lit(None).cast("long").alias("refers_to"), "url", "html"))
    shard = _at_or_below(bounds, F.coalesce("page_id", lowest)).cast("long") if bounds else F.lit(0).cast("long")
    dealt = (told.withColumn("shard", shard).repartitionById(max(1, len(bounds)), F.greatest(F.col("shard") - 1, F.lit(0)).cast("int"))
             .sortWithinPartitions("shard", "page_id", "tag", F.sha1("html"), "url").select("shard", "page_id", "tag", "sha", "refers_to", "url", "html"))
    map_arrow(dealt, "snapstar.llm.warc:write_batches", _MANIFEST, base=out, roll=roll_bytes).write.parquet(f"{out}/manifest")
    return manifest(spark, out)


def manifest(spark, out: str) -> DataFrame:
    """The committed manifest of the archive under ``out``."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/manifest/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        raise IncompleteArchive(f"{out} has no committed manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{out}/manifest")


def read(manifest: DataFrame, out: str) -> DataFrame:
    """The records of the files that the manifest lists, each checked against it.

    Files are read where they lie; only their rows, without payloads, and one row
    for each file are compared with the manifest."""
    spark = manifest.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.warc.gz").load(out)
    rows = stage(map_arrow(files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"), "snapstar.llm.warc:read_batches", _ROWS), "warc-rows")
    found = rows.where("sha256 IS NOT NULL").select("name", "records", "bytes", "sha256")
    listed = manifest.select("name", "records", "bytes", "sha256")
    odd = listed.join(found, ["name", "records", "bytes", "sha256"], "left_anti")
    if (names := [r["name"] for r in odd.select("name").orderBy("name").limit(5).collect()]):
        raise IncompleteArchive(f"{odd.count()} listed files of {out} are missing or altered: {', '.join(names)}, ...")
    records = rows.where("sha256 IS NULL")
    # Files that no manifest lists are left from writers that died.
    if found.join(listed, "name", "left_anti").limit(1).count():
        records = records.join(listed.select("name"), "name", "left_semi")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def archive_folder(spark, name: str = "warc") -> str:
    """A new folder below the shared checkpoint folder, as a URI."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    scheme, colon, path = base.partition(":")
    base = f"{scheme}://{path}" if colon and not path.startswith("//") else base if colon else f"file://{base}"
    return f"{base}/{name}-{uuid.uuid4().hex}"
