"""Benchmark decontamination: training texts against the n-grams of test items.

Words are runs of ASCII letters and digits and of all characters beyond ASCII,
A-Z lower-cased.  A window is ``size`` consecutive words of an item; an item of
fewer words, but not none, is one window.  The hashes of all different windows
are a broadcast set.  Training texts are scanned once: the hash of each of their
windows probes the set, what hits is compared word by word with the item's
window, and a word inside any window that occurs is hit.  ``remove`` takes the
hit spans, or the documents that have any, out of the corpus.

Only DataFrame and SQL functions are used.  The scan shuffles nothing; what
follows it works on one narrow row per document and one per hit, keyed by row.
The set is broadcast in blocks of ``AT_ONCE`` windows at most (checked by a
count), each block being one more scan, so its size has a bound whatever the
benchmark's.

Rows: a null text has no words; a null ``doc_id`` is kept; rows that repeat a
``doc_id`` are rows of their own; benchmark rows that repeat an ``item_id`` are
one item; a benchmark row without ``item_id`` hits words but is no counted item;
an empty benchmark hits nothing; an empty table gives an empty result; further
columns are ignored by ``scan`` and kept by ``remove``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstar.session import stage

#: Words of a window.
SIZE = 10
#: Windows of one broadcast: some 250 bytes each.
AT_ONCE = 400_000
#: What stands between two words of a lower-cased text, and of any text.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The normalised words of a text.  ``lower`` would change letters beyond
    ASCII too, so A-Z are translated."""
    return F.array_remove(F.split(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), GAP), "")


def windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``item, width, words, h`` for every window of every item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(_text()).alias("w")).where("size(w) > 0")
    items = items.withColumn("width", F.least(F.lit(size), F.size("w")))
    cut = F.expr("transform(sequence(1, size(w) - width + 1), i -> slice(w, i, width))")
    return items.select("item", "width", F.explode(cut).alias("words")).withColumn("h", F.xxhash64("words")).distinct()


def _window_hashes(widths: list[int]) -> Column:
    """The hashes of all windows of each width, one width after the other."""
    each = [f"CASE WHEN size(w) >= {k} THEN transform(sequence(1, size(w) - {k - 1}), i -> xxhash64(slice(w, i, {k}))) "
            "ELSE CAST(array() AS array<bigint>) END" for k in widths]
    return F.expr(f"concat({', '.join(each)})" if len(each) > 1 else each[0])


def _place(widths: list[int]) -> tuple[Column, Column]:
    """Width and first word (from 0) of the window at ``at`` of these hashes."""
    width, start, first = F.lit(widths[0]), F.col("at"), F.lit(0)
    for before, k in zip(widths, widths[1:]):
        first = first + F.greatest(F.lit(0), F.col("n_words").cast("int") - (before - 1))
        width = F.when(F.col("at") >= first, F.lit(k)).otherwise(width)
        start = F.when(F.col("at") >= first, F.col("at") - first).otherwise(start)
    return width, start


def _candidates(docs: DataFrame, wanted: DataFrame, widths: list[int]) -> DataFrame:
    """``row, doc_id, n_words`` once at least for each document, with ``start``
    and ``found`` (the words) where a window's hash is one of ``wanted``.

    The row number is written with the rows, so a task that runs again later
    reads the same."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(_text()).alias("w"))
    rows = rows.select("row", "doc_id", "w", F.size("w").cast("long").alias("n_words"), _window_hashes(widths).alias("hashes"))
    each = rows.select("row", "doc_id", "n_words", "w", F.posexplode_outer("hashes").alias("at", "h"))
    width, start = _place(widths)
    probe = each.join(F.broadcast(wanted.select("h").distinct().withColumn("in_set", F.lit(True))), "h", "left")
    probe = probe.where(F.col("in_set") | (F.coalesce(F.col("at"), F.lit(0)) == 0))
    return probe.select("row", "doc_id", "n_words", F.when(F.col("in_set"), start).alias("start"),
                        F.when(F.col("in_set"), F.slice("w", start + 1, width)).alias("found"))


_COVERED = """
aggregate(array_sort(spans), named_struct('done', CAST(array() AS array<struct<start: int, stop: int>>), 'start', -1, 'stop', -1),
  (s, x) -> CASE WHEN s.start < 0 THEN named_struct('done', s.done, 'start', x.start, 'stop', x.stop)
                 WHEN x.start <= s.stop THEN named_struct('done', s.done, 'start', s.start, 'stop', greatest(s.stop, x.stop))
                 ELSE named_struct('done', concat(s.done, array(named_struct('start', s.start, 'stop', s.stop))), 'start', x.start, 'stop', x.stop) END,
  s -> CASE WHEN s.start < 0 THEN s.done ELSE concat(s.done, array(named_struct('start', s.start, 'stop', s.stop))) END)
"""


def scan(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, at_once: int = AT_ONCE) -> DataFrame:
    """``row, doc_id, n_words, spans, items`` for every document: the hit words as
    disjoint spans [start, stop), and the ids of the items whose windows occur,
    sorted as strings."""
    table = stage(windows(benchmark, size), "test-windows")
    counts = table.select("width", "words", "h").distinct().groupBy("width").agg(F.count("*").alias("n")).collect()
    widths = sorted((r["width"] for r in counts), reverse=True) or [size]
    blocks = max(1, -(-sum(r["n"] for r in counts) // at_once))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    found = []
    for k in range(blocks):
        block = table.where(F.pmod("h", F.lit(blocks)) == k)
        texts = block.select("h", "words").distinct().withColumnRenamed("words", "found")
        rows = stage(_candidates(docs, block, widths), "window-hits")
        # Different windows of one hash are told apart here, word by word.
        found.append(rows.join(F.broadcast(texts), "found", "left"))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    span = F.when(F.col("h").isNotNull(), F.struct(F.col("start").alias("start"), (F.col("start") + F.size("found")).alias("stop")))
    per_doc = rows.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.collect_list(span).alias("spans"))
    per_doc = per_doc.withColumn("spans", F.expr(_COVERED))
    # One row for each window of a document, however often it occurs there.
    items = (rows.where("h IS NOT NULL").select("row", "h", F.col("found").alias("words")).distinct()
             .join(table.where("item IS NOT NULL").select("h", "words", "item"), ["h", "words"]).groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items")))
    return (per_doc.join(items, "row", "left")
            .select("row", "doc_id", "n_words", "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def report(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Counts and verdict of every document."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return scan(docs, benchmark, size).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def _without(cut: str) -> Column:
    """The text without the words of the spans in column ``cut`` and what stands
    between these words."""
    gaps, raw = F.split(_text(), RAW_WORD), F.array_remove(F.split(_text(), RAW_GAP), "")

    def kept(gaps: Column, raw: Column) -> Column:
        starts = F.concat(F.transform(cut, lambda s: s["start"]), F.array(F.size(raw)))
        stops = F.concat(F.array(F.lit(0)), F.transform(cut, lambda s: s["stop"]))
        piece = lambda a, b: F.concat(F.array_join(F.zip_with(F.slice(gaps, a + 1, b - a), F.slice(raw, a + 1, b - a), lambda x, y: F.concat(x, y)), ""), F.element_at(gaps, b + 1))
        return F.array_join(F.zip_with(stops, starts, piece), "")

    # A transform of one element binds both arrays to a name, so each is made once.
    return F.transform(F.array(F.struct(gaps.alias("gaps"), raw.alias("raw"))), lambda t: kept(t["gaps"], t["raw"]))[0]


def remove(docs: DataFrame, benchmark: DataFrame, what: str = "documents", size: int = SIZE) -> DataFrame:
    """``docs`` without the contaminated documents, or with their hit spans cut out
    (``what="spans"``: what stands before and behind a span stays as it is).

    Hits depend on the text alone, so documents meet their spans by the SHA-256
    of the text; clean documents are only compared with the contaminated ones."""
    if what not in ("documents", "spans"):
        raise ValueError(f"what is 'documents' or 'spans', not {what!r}")
    key, cut, kept = ("_".join([name, *docs.columns]) for name in ("digest", "spans", "text"))  # names that no column of docs has
    digest = F.sha2(_text(), 256)
    texts = docs.select(digest.alias(key), "text").dropDuplicates([key])
    texts = stage(texts.withColumn("doc_id", F.monotonically_increasing_id()), "different-texts")
    bad = scan(texts, benchmark, size).where("size(spans) > 0").select("doc_id", F.col("spans").alias(cut))
    bad = bad.join(texts.select("doc_id", key), "doc_id").drop("doc_id")
    keyed = docs.withColumn(key, digest)
    if what == "documents":
        return keyed.join(bad, key, "left_anti").drop(key)
    pieces = keyed.join(bad, key, "left").withColumn(kept, F.when(F.col(cut).isNull(), F.col("text")).otherwise(_without(cut)))
    return pieces.select(*[F.col(kept).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
