"""Sharding, exact dedup and WARC archives against brute force."""

import base64
import gzip
import hashlib
import re
import zlib

import pytest
from pyarrow import fs as pafs

from snapstar.llm import exact_dedup, sharding, warc
from tests.llm.conftest import SF, WS, make_docs, rows_of


# --- sharding -------------------------------------------------------------------


def least_capacity(sizes, shards):
    """Plain search for the smallest largest run."""
    def needs(capacity):
        used, fill = 1, 0
        for s in sizes:
            if fill + s > capacity:
                used, fill = used + 1, 0
            fill += s
        return used

    capacity = max(sizes)
    while needs(capacity) > shards:
        capacity += 1
    return capacity


def check_shards(rows, shards):
    groups = {}
    for i, t in rows:
        key = hashlib.sha256((t or "").encode()).digest()[:16]
        groups[key] = groups.get(key, 0) + len((t or "").encode()) + 16
    return least_capacity([groups[k] for k in sorted(groups)], shards)


def verify(got, rows, shards):
    assert len(got) == len(rows)
    by_shard, where = {}, {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r)
        where.setdefault(r["text_crc32"], set()).add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    for part in by_shard.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    assert all(len(x) == 1 for x in where.values())  # equal texts together
    return max(sum(r["size"] for r in part) for part in by_shard.values())


@pytest.mark.parametrize("cells", [65_536, 16])
def test_shards_have_the_least_possible_largest(spark, monkeypatch, cells):
    monkeypatch.setattr(sharding, "CELLS", cells)
    monkeypatch.setattr(sharding, "FINER", 8)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = rows_of(sharding.shard(docs, 10))
    assert verify(got, rows, 10) == check_shards(rows, 10)
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {(i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in rows}


def test_odd_rows_of_shards(spark, odd_texts):
    got = rows_of(sharding.shard(make_docs(spark, odd_texts), 4))
    assert verify(got, odd_texts, 4) == check_shards(odd_texts, 4)
    assert rows_of(sharding.shard(make_docs(spark, []), 4)) == []


# --- exact dedup ----------------------------------------------------------------


def norm(t):
    return WS.sub(" ", t or "")


def test_dedup_against_brute_force(spark, odd_texts):
    found = {}
    for i, t in odd_texts:
        found.setdefault(norm(t), []).append(i)
    got = rows_of(exact_dedup.deduplicate(make_docs(spark, odd_texts), capacity=2, max_depth=4))
    assert len(got) == len(odd_texts)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in found.items()}
    for r in got:
        ids = by_sha[r["text_sha256"]]
        least = min((i for i in ids if i is not None), default=None)
        assert (r["keep_id"], r["group_size"]) == (least, len(ids))
    for sha, ids in by_sha.items():
        assert sum(r["kept"] for r in got if r["text_sha256"] == sha) == 1
    assert rows_of(exact_dedup.deduplicate(make_docs(spark, []))) == []


def test_kept_rows_of_documents(spark, odd_texts):
    docs = make_docs(spark, odd_texts)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    texts = [norm(r["text"]) for r in rows_of(kept)]
    assert sorted(texts) == sorted({norm(t) for _, t in odd_texts})


def test_directory_doubles_only_where_it_is_full(spark):
    entries = spark.range(2000).selectExpr("xxhash64(id) AS h")
    buckets = exact_dedup.directory(entries, 300, 10)
    assert sum(2.0 ** -d for _, d in buckets) == 1 and max(d for _, d in buckets) > min(1, 2)
    assert exact_dedup.directory(entries, 5000, 10) == [(0, 0)]


# --- WARC -----------------------------------------------------------------------


PAGES = "page_id long, url string, html string"


def expected(rows, least):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        last = max(same, default=None)
        revisit = len(data) >= least and len([1 for _, _, g in rows if (g or "") == (h or "")]) > 1 and last is not None and last != i
        out.append((i, len(data), digest, "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


def read_back(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows_of(df)), key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_archive_reads_back(spark, least):
    rows = [(i, f"http://h/{i} x\r\n", f"<p>{i % 7}</p>" * (i % 5)) for i in range(60)] + [(None, None, "<p>1</p>"), (None, None, None), (61, None, "漢字" * 4000), (3, "again", "<p>3</p>" * 3)]
    pages = spark.createDataFrame(rows, PAGES)
    out = warc.archive_folder(spark)
    manifest = warc.write(pages, out, least, shard_bytes=300, roll_bytes=700)
    assert read_back(warc.read(manifest, out)) == expected(rows, least)
    files = rows_of(manifest)
    assert sum(f["records"] for f in files) == len(rows) and len(files) > 3
    # The same rows in another order give the same files.
    again = warc.archive_folder(spark)
    other = rows_of(warc.write(pages.repartition(5), again, least, shard_bytes=300, roll_bytes=700))
    key = lambda f: (f["name"], f["records"], f["bytes"], f["sha256"])
    assert sorted(map(key, other)) == sorted(map(key, files))
    fs, root = pafs.FileSystem.from_uri(out)
    assert not fs.get_file_info(pafs.FileSelector(f"{root}/_temporary"))


def test_records_are_well_formed():
    data = warc.record(5, "http://a/b c", b"<p>x</p>", hashlib.sha1(b"<p>x</p>").hexdigest(), None)
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"\r\n\r\n")
    assert b"WARC-Target-URI: http://a/b%20c\r\n" in data
    assert warc.parsed(data)[:5] == (5, 8, base64.b32encode(hashlib.sha1(b"<p>x</p>").digest()).decode(), "response", None)
    with pytest.raises(ValueError):
        warc.parsed(data.replace(b"<p>x</p>", b"<p>y</p>"))
    assert not re.search(rb"\n[^\r]*\r\n\r\n.*WARC/1.1", data)


def test_empty_pages(spark):
    out = warc.archive_folder(spark)
    assert rows_of(warc.read(warc.write(spark.createDataFrame([], PAGES), out), out)) == []


def test_driver_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    out = warc.archive_folder(spark)
    assert read_back(warc.read(warc.write(pages, out), out)) == expected(rows, 0)


@pytest.mark.parametrize("harm", ["removed", "cut", "altered", "record lost", "manifest lost"])
def test_archives_that_are_not_whole_are_told(spark, tmp_path, harm):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"<p>{i % 5} " + "x" * (i % 50) + "</p>") for i in range(60)], PAGES)
    out = f"file://{tmp_path}/archive"
    manifest = warc.write(pages, out, 0, shard_bytes=300, roll_bytes=700)
    assert warc.read(warc.manifest(spark, out), out).count() == 60
    files = sorted((tmp_path / "archive").glob("shard-*.warc.gz"))
    assert len(files) > 5
    (tmp_path / "archive" / "shard-999999-00000.warc.gz").write_bytes(files[0].read_bytes())  # not listed
    assert warc.read(manifest, out).count() == 60
    data = files[3].read_bytes()
    if harm == "removed":
        files[3].unlink()
    elif harm == "cut":
        files[3].write_bytes(data[:-9])
    elif harm == "altered":
        files[3].write_bytes(data[:40] + bytes([data[40] ^ 1]) + data[41:])
    elif harm == "record lost":
        files[3].write_bytes(b"".join(gzip.compress(m) for m in list(warc.members(data))[1:]))
    else:
        (tmp_path / "archive" / "manifest" / "_SUCCESS").unlink()
        with pytest.raises(warc.IncompleteArchive, match="no committed manifest"):
            warc.manifest(spark, out)
        return
    with pytest.raises(warc.IncompleteArchive, match=files[3].name):
        warc.read(manifest, out)
