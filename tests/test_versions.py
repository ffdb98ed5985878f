"""Versioned tables: history, old versions, races, and death at every step."""

import datetime as dt

import pytest

from snapstar.sources import tables as T
from snapstar.sources import versions as V


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def base(tmp_path):
    return f"file://{tmp_path}/table"


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "k int, v string")


def test_history_and_old_versions(spark, base):
    assert V.latest(spark, base) == 0
    V.replace(spark, frame(spark, [(1, "a"), (2, "b")]), base)
    V.append(spark, frame(spark, [(3, "c")]), base)
    # A replacement may read the table itself, and bring another schema.
    V.replace(spark, V.read(spark, base).where("k > 1").withColumn("w", V.F.col("k") * 10), base, "widen")
    V.append(spark, V.read(spark, base).limit(0), base)
    got = [tuple(r) for r in V.history(spark, base).orderBy("version").select("version", "operation", "rows_written", "total_rows").collect()]
    assert got == [(1, "replace", 2, 2), (2, "append", 1, 3), (3, "widen", 2, 2), (4, "append", 0, 2)]
    assert rows(V.read(spark, base, 1)) == [(1, "a"), (2, "b")] and rows(V.read(spark, base, 2)) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(V.read(spark, base)) == rows(V.read(spark, base, 3)) == [(2, "b", 20), (3, "c", 30)]
    with pytest.raises(ValueError, match="no version 9"):
        V.read(spark, base, 9)
    with pytest.raises(ValueError, match="do not fit"):
        V.append(spark, frame(spark, [(4, "d")]), base)


def test_partitions_are_pruned_across_folders(spark, base):
    for k in range(3):
        V.append(spark, spark.range(10).selectExpr("id AS k", f"CAST(id % 2 + {k} AS int) AS day"), base, partition_by=["day"])
    read = V.read(spark, base)
    assert read.count() == 30 and read.where("day = 3").count() == 5
    assert "PartitionFilters: [isnotnull(day" in read.where("day = 3")._jdf.queryExecution().toString()


def test_an_empty_table_keeps_its_schema(spark, base):
    V.replace(spark, frame(spark, []), base)
    assert V.read(spark, base).columns == ["k", "v"] and V.read(spark, base).count() == 0


def test_merges(spark, base):
    new = frame(spark, [(1, "a"), (1, "a"), (2, "b"), (None, "n")])
    assert V.merge_insert_only(spark, new, base, ["k"], null_safe=["k"]) == 1
    assert V.merge_insert_only(spark, new.unionByName(frame(spark, [(3, "c")])), base, ["k"], null_safe=["k"]) == 2
    V.merge_insert_only(spark, new, base, ["k"], null_safe=["k"])
    assert [r["rows_written"] for r in V.history(spark, base).orderBy("version").collect()] == [3, 1, 0]
    V.merge_upsert(spark, frame(spark, [(2, "B"), (4, "d")]), base, ["k"])
    assert sorted(rows(V.read(spark, base).where("k IS NOT NULL"))) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    with pytest.raises(T.DuplicateSourceKeys):
        V.merge_upsert(spark, frame(spark, [(2, "x"), (2, "y")]), base, ["k"])


class Died(RuntimeError):
    pass


def test_death_before_and_behind_the_commit(spark, base, monkeypatch):
    V.replace(spark, frame(spark, [(1, "a")]), base)
    put = V._put_if_absent

    def before(*a):
        raise Died

    def behind(*a):
        assert put(*a)
        raise Died

    for die, want in ((before, [(1, "a")]), (behind, [(2, "b")])):
        monkeypatch.setattr(V, "_put_if_absent", die)
        with pytest.raises(Died):
            V.replace(spark, frame(spark, [(2, "b")]), base)
        monkeypatch.setattr(V, "_put_if_absent", put)
        assert rows(V.read(spark, base)) == want
    # The folder of the write that died is nobody's; younger ones are left alone.
    assert V.vacuum(spark, base) == []
    assert len(V.vacuum(spark, base, grace=dt.timedelta(0))) == 1
    assert rows(V.read(spark, base)) == [(2, "b")] and rows(V.read(spark, base, 1)) == [(1, "a")]
    V.vacuum(spark, base, keep=1, grace=dt.timedelta(0))
    assert V.versions(spark, base) == [2] and rows(V.read(spark, base)) == [(2, "b")]


def test_the_next_number_is_taken_once(spark, base, monkeypatch):
    V.replace(spark, frame(spark, [(1, "a")]), base)
    assert not V._put_if_absent(spark, V._entry_path(base, 1), "{}")
    assert V.entry(spark, base, 1)["operation"] == "replace"
    with pytest.raises(V.ConcurrentCommit):
        V.append(spark, frame(spark, [(9, "z")]), base, expected=0)

    # Another writer commits between this one's reading and its commit.
    latest, raced = V.latest, []

    def slow(spark, base):
        now = latest(spark, base)
        if not raced:
            raced.append(1)
            V.append(spark, frame(spark, [(2, "other")]), base)
        return now

    monkeypatch.setattr(V, "latest", slow)
    V.merge_insert_only(spark, frame(spark, [(2, "mine"), (3, "mine")]), base, ["k"])
    monkeypatch.setattr(V, "latest", latest)
    assert rows(V.read(spark, base)) == [(1, "a"), (2, "other"), (3, "mine")]


def test_catalog_replace_survives_death_at_each_step(spark, monkeypatch):
    name = "replace_crash"
    for step in range(4):
        for t in (name, f"{name}__staged", f"{name}__old"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
        T.replace(spark, frame(spark, [(1, "old")]), name)
        sql, done = spark.sql, []

        def dying(text, *a, **k):
            # Statements of the second replace, from the first rename on.
            if "RENAME" in text or (done and "DROP" in text):
                if len(done) == step:
                    raise Died
                done.append(text)
            return sql(text, *a, **k)

        monkeypatch.setattr(spark, "sql", dying)
        try:
            T.replace(spark, spark.table(name).selectExpr("k + 1 AS k", "'new' AS v"), name)
        except Died:
            pass
        monkeypatch.setattr(spark, "sql", sql)
        T.recover(spark, name)
        assert rows(spark.table(name)) in ([(1, "old")], [(2, "new")])
        assert not T.table_exists(spark, f"{name}__staged") and not T.table_exists(spark, f"{name}__old")
        T.replace(spark, frame(spark, [(3, "again")]), name)
        assert rows(spark.table(name)) == [(3, "again")]
