"""Jaccard self-join on word n-grams by count vectors in R-trees.

A document's set holds the 64-bit hashes of its distinct shingles (runs of
``words`` words, A-Z in lower case; with fewer words the whole sequence is one
shingle; without words the set is empty and links with nothing).  Two documents
link when ``den * |A and B| >= num * |A or B|``.

1. Equal sets are one node: its number is a fingerprint of the set.
2. Tokens are hashed into groups.  Two linked sets differ in at most K tokens, so
   of K + 1 + s groups s + 1 are equal in both.  The number of groups follows the
   size class; a set takes part in its own class and in those where its smaller
   partners are.  A group's content is a key if it has two tokens or more; empty
   groups, which unrelated sets share, never are.  Groups of one token are keys
   in pairs: they lie in s / 2 ranges, so of s / 2 + 1 equal ones two share a
   range.  This finds all partners of a set with s - s / 2 empty groups at most.
   Sets with more ("scattered", mostly small ones) meet the other scattered sets
   by prefixes instead: their tokens in order of how many scattered sets hold
   them, rare ones first, as many as a partner cannot lack altogether.
3. Nodes that share a group are neighbours; the connected sets of neighbours
   (blocks) hold every link.  Large blocks are cut by size and hash into tiles.
4. Within a tile, or a pair of tiles, the counts of tokens by group are the
   points of an R-tree, bulk-loaded by sort-tile-recursion.  The overlap of two
   nodes of the tree is at most the sum of the smaller of their upper
   coordinates; where this misses the overlap that a link needs, the pair of
   nodes is dropped.  Pairs of documents that survive and are not yet connected
   are verified on their sets.

Nothing is capped: every pair that could change a component is verified.  The
tasks see equal keys as sorted streams; what meets in a task, one tile or a pair
of tiles, holds ``TILE_TOKENS`` tokens (or two documents), and the search of the
trees keeps ``PAIRS`` pairs of nodes and their children for each level.  All decisions cover whole texts.

Rows: null text has no words; rows with a null ``doc_id`` link with nothing and
have a null component; rows that repeat a ``doc_id`` are rows of their own; an
empty table gives an empty result; further columns are ignored.  Components are
told apart by 64-bit fingerprints.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.llm.common import map_arrow
from snapstar.llm.components import components
from snapstar.session import stage

#: Tokens of the documents that one task holds at a time.
TILE_TOKENS = 2_000_000
#: Coordinates of a point, and children of a node of the tree.
GROUPS, FANOUT = 32, 16
#: Pairs of nodes of two trees that are bounded at a time.
PAIRS = 4_000
#: Words whose hashes a Python worker keeps during a task.
WORDS_KEPT = 500_000
#: Sizes of a class, and groups beyond those that may differ, as a part of these.
RATIO, SPARE = 1.3, 0.3

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Hashes()


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes.  bytes.lower and bytes.split know ASCII
    only, as the word rule does."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, parts), np.uint64, len(parts))
    n = min(words, len(parts))
    out = np.full(len(parts) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mixed(out + h[k:len(parts) - n + 1 + k])
    return np.unique(out)


def fingerprint(tokens: np.ndarray) -> int:
    """A signed 64-bit number for the set."""
    total = _mixed(tokens + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(_mixed(np.array([total], np.uint64)).view(np.int64)[0])


def _class_bounds() -> np.ndarray:
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * RATIO)))
    return np.array(bounds, np.int64)


_BOUNDS = _class_bounds()


def size_class(n: int) -> int:
    return int(np.searchsorted(_BOUNDS, n, "right")) - 1


def group_keys(tokens: np.ndarray, num: int, den: int) -> tuple[np.ndarray, bool]:
    """Keys of which a linked set has one, and whether the set is scattered: only
    partners that are so too may have none."""
    n, out, scattered = len(tokens), [], False
    if not n:
        return np.zeros(0, np.uint64), False
    content = _mixed(tokens ^ np.uint64(0xD6E8FEB86659FD93))
    for c in range(size_class(-(-n * num // den)), size_class(n) + 1):
        small = int(_BOUNDS[c + 1]) - 1  # the largest size of the smaller partner
        differ = (small + small * den // num) * (den - num) // (den + num)
        spare = int(differ * SPARE) + 2
        m, ranges = differ + 1 + spare, spare // 2
        g = (_mixed(tokens + np.uint64(0x632BE59BD9B4E019 + c)) % np.uint64(m)).astype(np.int64)
        counts = np.bincount(g, minlength=m)
        sums = np.zeros(m, np.uint64)
        np.add.at(sums, g, content)
        keys = _mixed(sums + _mixed(np.arange(m, dtype=np.uint64) * np.uint64(256) + np.uint64(c)))
        out.append(keys[counts > 1])
        scattered |= int((counts == 0).sum()) > spare - ranges
        ones = np.flatnonzero(counts == 1)
        at = ones * ranges // m
        for apart in range(1, len(ones)):
            near = at[apart:] == at[:-apart]
            if not near.any():
                break
            out.append(_mixed(keys[ones[:-apart][near]] + _mixed(keys[ones[apart:][near]])))
    return np.concatenate(out), scattered


#: Kinds of the rows that a scan gives.
NODE, KEY, TOKEN = 0, 1, 2


def scan_batches(batches, words: int, num: int, den: int):
    """(kind, doc_id, n, node, key): a NODE row for each document; for each set,
    once for the copies within a task's input, its keys and, if it is scattered,
    its tokens."""
    seen: set[int] = set()
    for b in batches:
        ids, sizes, nodes, kinds, of, keys, n_of = [], [], [], [], [], [], []
        size = 0

        def rows():
            found = [len(k) for k in keys]
            columns = (np.r_[np.full(len(nodes), NODE), np.repeat(np.array(kinds, np.int64), found)].astype(np.int32),
                       pa.array(ids + [None] * sum(found), pa.int64()),
                       np.r_[np.array(sizes, np.int64), np.repeat(np.array(n_of, np.int64), found)],
                       np.r_[np.array(nodes, np.int64), np.repeat(np.array(of, np.int64), found)],
                       np.concatenate([np.zeros(len(nodes), np.int64), *[k.view(np.int64) for k in keys]]))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "doc_id", "n", "node", "key"])

        for i, t in zip(b.column(0), b.column(1)):
            s = shingle_set(t.as_py(), words)
            node = fingerprint(s)
            ids.append(i.as_py())
            sizes.append(len(s))
            nodes.append(node)
            if not len(s) or not i.is_valid or node in seen:
                continue
            seen.add(node)
            found, scattered = group_keys(s, num, den)
            for kind, k in ((KEY, found), (TOKEN, s))[:1 + scattered]:
                kinds.append(kind)
                of.append(node)
                keys.append(k)
                n_of.append(len(s))
                size += len(k)
            if size > 200_000:
                yield rows()
                ids, sizes, nodes, kinds, of, keys, n_of = [], [], [], [], [], [], []
                size = 0
        yield rows()
    _WORDS.clear()


def neighbour_batches(batches):
    """From rows sorted by (key, node): each node of a key with the key's first."""
    key = first = last = None
    for b in batches:
        k, v = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
        if not len(k):
            continue
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        lead = v[starts][np.cumsum(np.r_[True, k[1:] != k[:-1]]) - 1]
        if k[0] == key:  # the run goes on from the batch before
            end = starts[1] if len(starts) > 1 else len(k)
            lead[:end] = first
        key, first = k[-1], lead[-1]
        keep = lead != v
        pairs = np.unique(np.stack([lead[keep], v[keep]], 1), axis=0) if keep.any() else np.zeros((0, 2), np.int64)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


class RTree:
    """Points bulk-loaded into levels of ``FANOUT`` children; for each node the
    upper coordinates and the smallest size below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = self._tiled(points, sizes)
        self.levels = [(points[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > 1:
            upper, least = self.levels[-1]
            cut = np.arange(0, len(upper), FANOUT)
            self.levels.append((np.maximum.reduceat(upper, cut, axis=0), np.minimum.reduceat(least, cut)))

    @staticmethod
    def _tiled(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sort by size, cut into slabs, sort each by its next coordinate, ..."""
        order = np.argsort(sizes, kind="stable")
        slabs, axis = [order], 0
        while slabs and max(map(len, slabs)) > FANOUT and axis < points.shape[1]:
            cut = []
            for s in slabs:
                s = s[np.argsort(points[s, axis], kind="stable")] if axis else s
                cut += [s[i:i + max(FANOUT, -(-len(s) // 4))] for i in range(0, len(s), max(FANOUT, -(-len(s) // 4)))]
            slabs, axis = cut, axis + 1
        return np.concatenate(slabs)

    def pairs(self, other: RTree, num: int, den: int):
        """Pairs of points (positions in the input) whose bound allows a link;
        of a tree with itself, each pair once."""
        same = self is other
        stack = [(len(self.levels) - 1, len(other.levels) - 1, np.zeros((1, 2), np.int64))]
        while stack:
            la, lb, at = stack.pop()
            if len(at) > PAIRS:  # the first go down to the leaves before the rest
                stack.append((la, lb, at[PAIRS:]))
            part = at[:PAIRS]
            (ua, na), (ub, nb) = self.levels[la], other.levels[lb]
            i, j = part[:, 0], part[:, 1]
            bound = np.minimum(ua[i], ub[j]).sum(1, dtype=np.int64)
            part = part[bound * (num + den) >= num * (na[i] + nb[j])]
            if la == lb == 0:
                part = part[part[:, 0] < part[:, 1]] if same else part
                if len(part):
                    yield np.stack([self.order[part[:, 0]], other.order[part[:, 1]]], 1)
            elif len(part):
                down_a, down_b = la >= lb and la > 0, lb >= la and lb > 0
                ca = part[:, :1] * FANOUT + np.arange(FANOUT) if down_a else part[:, :1]
                cb = part[:, 1:] * FANOUT + np.arange(FANOUT) if down_b else part[:, 1:]
                x, y = np.repeat(ca, cb.shape[1], 1).ravel(), np.tile(cb, (1, ca.shape[1])).ravel()
                to_a, to_b = la - down_a, lb - down_b
                ok = (x < len(self.levels[to_a][0])) & (y < len(other.levels[to_b][0]))
                if same:
                    ok &= x <= y
                stack.append((to_a, to_b, np.stack([x[ok], y[ok]], 1)))


def points_of(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([np.bincount((_mixed(s) % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS) for s in sets], np.int32).reshape(len(sets), GROUPS)


def joined(sets_a: list, sets_b: list | None, label: np.ndarray, num: int, den: int) -> np.ndarray:
    """Labels after joining the sets (of one tile, or of two): ``label`` numbers
    the components known before, of A and then of B."""
    names, component = np.unique(label, return_inverse=True)
    parent = np.arange(len(names))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def roots() -> np.ndarray:
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up
        return parent[component]

    sizes = np.array([len(s) for s in [*sets_a, *(sets_b or [])]], np.int64)
    sets, first = [*sets_a, *(sets_b or [])], len(sets_a)
    points = points_of(sets)
    a = RTree(points[:first], sizes[:first])
    b = RTree(points[first:], sizes[first:]) if sets_b is not None else a
    for found in a.pairs(b, num, den):
        i, j = found[:, 0], found[:, 1] + (first if sets_b is not None else 0)
        now = roots()
        open_ = now[i] != now[j]
        for x, y in zip(i[open_].tolist(), j[open_].tolist()):
            rx, ry = root(component[x]), root(component[y])
            if rx == ry:
                continue
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if both * (num + den) >= num * int(sizes[x] + sizes[y]):
                parent[max(rx, ry)] = min(rx, ry)
    return names[roots()]


def tile_batches(batches, words: int, num: int, den: int):
    """Rows (tile_a, tile_b, side, node, label, text) sorted by the first two:
    links (label, label) that join components within each group of rows."""
    now, rows, out = None, {}, []

    def links():
        sides = ([], [])
        for node, (side, label, s) in sorted(rows.items()):
            sides[side].append((node, label, s))
        labels = np.array([x[1] for side in sides for x in side], np.int64)
        new = joined([x[2] for x in sides[0]], [x[2] for x in sides[1]] if sides[1] else None, labels, num, den) if sides[0] else labels
        out.extend({(int(o), int(n)) for o, n in zip(labels, new) if o != n})

    for b in batches:
        cols = [b.column(k) for k in range(6)]
        for r in range(b.num_rows):
            key = (cols[0][r].as_py(), cols[1][r].as_py())
            if key != now:
                if len(rows) > 1:
                    links()
                now, rows = key, {}
            s = shingle_set(cols[5][r].as_py(), words)
            node = cols[3][r].as_py()
            if fingerprint(s) == node:  # else another row with the same doc_id
                rows[node] = (cols[2][r].as_py(), cols[4][r].as_py(), s)
        if len(out) > 10_000:
            yield _edges(out)
            out = []
    if len(rows) > 1:
        links()
    if out:
        yield _edges(out)
    _WORDS.clear()


def _edges(out: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])


def _linked(rows: DataFrame, words: int, num: int, den: int) -> DataFrame:
    at = rows.repartition("tile_a", "tile_b").sortWithinPartitions("tile_a", "tile_b").select("tile_a", "tile_b", "side", "node", "label", "text")
    return map_arrow(at, "snapstar.llm.ngram_join:tile_batches", "a long, b long", words=words, num=num, den=den)


def _size_tile(n):
    """Sizes that can link are in the same or in neighbouring numbers."""
    return F.floor(F.log(n.cast("double")) / F.lit(float(np.log(2)))).cast("int")


def _rare_prefixes(tokens: DataFrame, num: int, den: int) -> DataFrame:
    """(key, node): of each scattered set (rows of tokens) so many of its rarest
    tokens that no linked set lacks all of them."""
    each = tokens.select(F.col("key").alias("token"), "node", "n").distinct()
    held = each.groupBy("token").agg(F.count("*").alias("held"))
    order = each.join(held.hint("merge"), "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("order"))
    length = F.expr(f"CAST(n + 1 - (n * {num} + {den - 1}) div {den} AS int)")
    first = order.select("node", F.explode(F.slice("order", F.lit(1), length)).alias("x"))
    return first.select(F.xxhash64(F.col("x.token"), F.lit("rare")).alias("key"), "node")


def similarity_classes(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5, tile_tokens: int = TILE_TOKENS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row, and ``node``, which
    rows with equal sets share."""
    if 2 * num < den:
        raise ValueError("a similarity of 1/2 or more is asked for")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scan = stage(map_arrow(texts, "snapstar.llm.ngram_join:scan_batches", "kind int, doc_id long, n long, node long, key long", words=words, num=num, den=den), "ngram-scan")
    nodes = scan.where(F.col("kind") == NODE).select("doc_id", F.col("n").alias("n_shingles"), "node")
    keys = scan.where(F.col("kind") == KEY).select("key", "node").unionByName(_rare_prefixes(scan.where(F.col("kind") == TOKEN), num, den))
    shared = keys.repartition("key").sortWithinPartitions("key", "node")
    near = map_arrow(shared, "snapstar.llm.ngram_join:neighbour_batches", "a long, b long")
    blocks = components(near, "ngram-blocks")
    blocks = stage(blocks.unionByName(blocks.select(F.col("root").alias("node"), "root").distinct()), "ngram-blocks")

    # One row stands for each node; blocks with too many tokens are cut into
    # tiles by size and, where one size has too many, by hash, of half as many
    # tokens each, since two of them meet.
    heads = nodes.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"))
    members = blocks.join(heads, "node").withColumn("by_size", _size_tile(F.col("n")))
    per_size = members.groupBy("root", "by_size").agg(F.sum("n").alias("tokens"))
    whole = per_size.groupBy("root").agg(F.sum("tokens").alias("all"))
    plan = (per_size.join(whole, "root").select(
        "root", "by_size", F.when(F.col("all") <= tile_tokens, F.lit(-1)).otherwise(F.col("by_size")).alias("size_tile"),
        F.when(F.col("all") <= tile_tokens, F.lit(1)).otherwise(F.ceil(2 * F.col("tokens") / tile_tokens)).cast("int").alias("parts")))
    placed = (members.join(plan, ["root", "by_size"])
              .select("node", "doc_id", "n", "root", "size_tile", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
              .withColumn("tile", F.when(F.col("size_tile") < 0, F.col("root")).otherwise(F.xxhash64("root", "size_tile", "part"))))
    placed = stage(placed, "ngram-tiles")

    # Merged at every size, so that plan and shuffle grow evenly with the input.
    sets = texts.join(placed.hint("merge"), "doc_id")
    links = stage(_linked(sets.select(F.col("tile").alias("tile_a"), F.col("tile").alias("tile_b"), F.lit(0).alias("side"), "node", F.col("node").alias("label"), "text"),
                          words, num, den), "ngram-links")
    cut = placed.where("size_tile >= 0")
    if cut.limit(1).count():
        links = stage(links.unionByName(_across(texts, cut, links, words, num, den, tile_tokens)), "ngram-links")
    found = components(links, "ngram-links")

    named = nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.where("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "root", "left")
    return named.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "node")


def _across(texts: DataFrame, cut: DataFrame, links: DataFrame, words: int, num: int, den: int, tile_tokens: int) -> DataFrame:
    """Links between the tiles of large blocks.

    First one node of each component found within a tile is compared with such
    nodes of other tiles; then each pair of tiles that still holds different
    components is joined as a whole."""
    def labelled(edges: DataFrame) -> DataFrame:
        roots = components(edges, "ngram-labels")
        return cut.join(roots.select("node", F.col("root").alias("label")), "node", "left").withColumn("label", F.coalesce("label", "node"))

    heads = labelled(links).groupBy("root", "size_tile", "label").agg(F.min(F.struct("node", "doc_id", "n")).alias("h"), F.count("*").alias("members"))
    # Heads of components of two or more; near copies have few of them.
    heads = heads.where("members > 1").select("root", "size_tile", "label", "h.node", "h.doc_id", "h.n")
    parts = heads.groupBy("root", "size_tile").agg(F.ceil(F.sum("n") / tile_tokens).alias("parts"))
    meet = heads.join(parts, ["root", "size_tile"]).withColumn("tile", F.xxhash64("root", "size_tile", F.pmod(F.xxhash64("label"), F.col("parts"))))
    quick = _linked(texts.join(meet, "doc_id").select(F.col("tile").alias("tile_a"), F.col("tile").alias("tile_b"), F.lit(0).alias("side"), "node", "label", "text"),
                    words, num, den)
    links = stage(links.unionByName(quick), "ngram-links")

    now = stage(labelled(links), "ngram-labels")
    tiles = now.groupBy("root", "size_tile", "tile").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    a = tiles.select("root", F.explode(F.array(F.col("size_tile"), F.col("size_tile") + 1)).alias("st"), F.col("size_tile").alias("sa"), F.col("tile").alias("tile_a"), F.col("lo").alias("la"), F.col("hi").alias("ha"))
    b = tiles.select("root", F.col("size_tile").alias("st"), F.col("tile").alias("tile_b"), F.col("lo").alias("lb"), F.col("hi").alias("hb"))
    pairs = a.join(b, ["root", "st"]).where("(st > sa OR tile_a < tile_b) AND NOT (la = ha AND lb = hb AND la = lb)").select("tile_a", "tile_b")
    sides = pairs.select("tile_a", "tile_b", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("tile_a").alias("tile")), F.struct(F.lit(1).alias("side"), F.col("tile_b").alias("tile")))).alias("x"))
    rows = sides.select("tile_a", "tile_b", "x.side", "x.tile").join(now.select("tile", "node", "doc_id", "label"), "tile")
    more = _linked(texts.join(rows, "doc_id").select("tile_a", "tile_b", "side", "node", "label", "text"), words, num, den)
    return quick.unionByName(stage(more, "ngram-across"))


def keep_one(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the
    smallest ``doc_id`` (rows without words, or without a ``doc_id``, all stay).
    Rows that repeat a ``doc_id`` with other texts stay or go together; of rows
    that repeat both, one stays."""
    found = stage(similarity_classes(docs, words, num, den), "ngram-classes").where("n_shingles > 0 AND doc_id IS NOT NULL")
    ids = found.groupBy("doc_id").agg(F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("head"), F.count("*").alias("n"))
    left = docs.join(ids.where("head = 0").select("doc_id"), "doc_id", "left_anti")
    again = ids.where("n > 1").select("doc_id")
    if again.limit(1).count():
        left = left.join(again, "doc_id", "left_anti").unionByName(left.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))
    return left.select(docs.columns)
