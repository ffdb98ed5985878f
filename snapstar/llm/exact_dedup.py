"""Exact deduplication by an extendible-hash index on shared files.

Texts are equal when they are identical after each run of white space
(``[\\x20\\x09-\\x0D]+``) became one space; null counts as empty.  Of equal texts
the row with the smallest ``doc_id`` stays.

The index maps a 64-bit hash of the normalised text to a chain of entries, one
for each different text (told apart by SHA-256), with the smallest ``doc_id`` and
the number of rows.  A directory of the leading hash bits points to buckets; it
doubles until no bucket holds more than ``capacity`` entries or the depth is
``max_depth`` (a bucket that is still overfull is a longer list in the same
file, nothing is left out).  Owner tasks take ranges of buckets and write them to
the shared checkpoint folder.  Every row is then looked up, and rows that share
an entry with another are compared byte by byte with the row that stays.

Only DataFrame operations are used.  Copies are merged map-side before any
shuffle; only texts that have copies are read a second time and shuffled, in
joins that adaptive execution may split.

Rows: a null ``doc_id`` orders after all others; rows that repeat a ``doc_id``
are rows of their own, of which one stays; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.llm.common import WORD_BREAK
from snapstar.session import stage

CAPACITY = 100_000
MAX_DEPTH = 16


def normalised(text):
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WORD_BREAK, " ")


def directory(entries: DataFrame, capacity: int, max_depth: int) -> list[tuple[int, int]]:
    """(leading bits, local depth) of each bucket, by doubling: the driver sees
    the sizes of the 2**max_depth finest cells at most, whatever the input."""
    cell = F.shiftrightunsigned(F.col("h"), 64 - max_depth)
    sizes = {r["c"]: r["n"] for r in entries.groupBy(cell.alias("c")).agg(F.count("*").alias("n")).collect()}
    buckets, depth = {0: sum(sizes.values())}, 0
    done: list[tuple[int, int]] = []
    while buckets:
        done += [(b, depth) for b, n in buckets.items() if n <= capacity or depth == max_depth]
        full = {b for b, n in buckets.items() if n > capacity and depth < max_depth}
        if not full:
            break
        depth += 1
        buckets = {c: 0 for b in full for c in (2 * b, 2 * b + 1)}
        for c, n in sizes.items():
            if (b := c >> (max_depth - depth)) in buckets:
                buckets[b] += n
    return done


def build_index(rows: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Entries (h, sha, keep_id, group_size, bucket) as written to shared files,
    from rows (doc_id, h, sha)."""
    entries = stage(rows.groupBy("h", "sha").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "hash-entries")
    spark = rows.sparkSession
    cells = [(c, number) for number, (bits, depth) in enumerate(sorted(directory(entries, capacity, max_depth), key=lambda x: x[0] << (max_depth - x[1])))
             for c in range(bits << (max_depth - depth), (bits + 1) << (max_depth - depth))]
    # The directory has 2**max_depth pointers, so its size is bounded.
    pointers = F.broadcast(spark.createDataFrame(cells, "_cell int, bucket int"))
    owned = (entries.withColumn("_cell", F.shiftrightunsigned("h", 64 - max_depth).cast("int")).join(pointers, "_cell").drop("_cell")
             .repartitionByRange("bucket", "h").sortWithinPartitions("bucket", "h", "sha"))
    return stage(owned, "hash-index")


def deduplicate(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row."""
    return _looked_up(docs, capacity, max_depth).drop("_row", "_raw")


def keep_first(docs: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    raw = "_".join(["raw", *docs.columns])  # a name that no column of docs has
    found = stage(_looked_up(docs, capacity, max_depth), "dedup-decisions").withColumnRenamed("_raw", raw)
    key = ["doc_id", raw]
    stay, go = found.where("kept").select(key), found.where("NOT kept").select(key).distinct()
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a[raw] == b[raw])
    go = go.join(stay, same(go, stay), "left_anti")
    marked = docs.withColumn(raw, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    left = marked.join(go, same(marked, go), "left_anti")
    # Rows that repeat both doc_id and text are told apart by nothing; one stays.
    again = found.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    if again.limit(1).count():
        left = left.join(again, same(left, again), "left_anti").unionByName(
            left.join(again, same(left, again), "left_semi").dropDuplicates(key))
    return left.drop(raw)


def _looked_up(docs: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(text).alias("t"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_raw"))
    rows = stage(texts.select("doc_id", F.xxhash64("t").alias("h"), F.unhex(F.sha2("t", 256)).alias("sha"), "_raw",
                              F.monotonically_increasing_id().alias("row")), "text-hashes")
    index = build_index(rows.select("doc_id", "h", "sha"), capacity, max_depth)
    found = rows.join(index.select("h", "sha", "keep_id", "group_size"), ["h", "sha"])

    # The byte comparison: rows of one entry against the row that stays.
    shared = index.where("group_size > 1")
    again = texts.withColumn("h", F.xxhash64("t")).join(shared.select("h", "keep_id", "sha"), "h")
    again = stage(again.where(F.unhex(F.sha2("t", 256)) == F.col("sha")), "hash-copies")
    heads = again.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("h", "sha").agg(F.min("t").alias("head"))
    unequal = (again.join(heads, ["h", "sha"]).where(F.col("t") != F.col("head"))
               .groupBy("h", "sha", "t").agg(F.min("doc_id").alias("keep2"), F.count("*").alias("size2")))
    # Entries whose texts differ although both hashes agree are split by their
    # bytes.  There are none short of a SHA-256 collision, so this part is empty.
    odd = stage(unequal, "hash-chains")
    if odd.limit(1).count():
        found = _split(found, texts, odd)

    first = F.col("keep_id").eqNullSafe(F.col("doc_id"))
    # One row stays when a doc_id is repeated: the first of the rows that tie.
    ties = (rows.join(shared.select("h", "sha", "keep_id"), ["h", "sha"]).where(first)
            .groupBy("h", "sha").agg(F.min("row").alias("stays"), F.count("*").alias("n")).where("n > 1"))
    found = found.join(ties.select("h", "sha", "stays"), ["h", "sha"], "left")
    return found.select("doc_id", "keep_id", "group_size", (first & (F.col("stays").isNull() | (F.col("stays") == F.col("row")))).alias("kept"),
                        F.lower(F.hex("sha")).alias("text_sha256"), F.col("row").alias("_row"), "_raw")


def _split(found: DataFrame, texts: DataFrame, odd: DataFrame) -> DataFrame:
    """``found`` with the chains of ``odd`` (different bytes, equal hashes) apart."""
    moved = (texts.withColumn("h", F.xxhash64("t")).join(odd, ["h", "t"]).select("doc_id", "h", "sha", "keep2", "size2").dropDuplicates(["doc_id", "h", "sha"]))
    lost = odd.groupBy("h", "sha").agg(F.sum("size2").alias("lost"))
    return (found.join(moved, ["doc_id", "h", "sha"], "left").join(lost, ["h", "sha"], "left")
            .withColumn("keep_id", F.coalesce("keep2", "keep_id"))
            .withColumn("group_size", F.coalesce("size2", F.col("group_size") - F.coalesce("lost", F.lit(0))))
            .drop("keep2", "size2", "lost"))
