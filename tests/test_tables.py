import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fogline.operators.merge import upsert_by_key, upsert_latest
from fogline.sources.tables import CommitConflict, FileTable


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def names(table):
    return {r["file"] for r in table.files(table.state()).collect()}


def on_disk(table):
    from pathlib import Path

    return {str(p.relative_to(f"{table.path}/data")) for p in Path(table.path, "data").rglob("*.parquet")}


def test_reads_what_it_replaces(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.replace(spark.range(3))
    table.replace(table.read().union(table.read()))
    assert table.read().count() == 6 and table.read(0).count() == 3 and table.versions() == [0, 1]
    table.replace(spark.range(0))
    assert table.read().count() == 0 and table.read().schema == spark.range(0).schema


def test_merge_rewrites_only_the_files_it_hits(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "t"), keys=["k"], file_rows=500)
    table.replace(spark.range(100_000).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    before = names(table)
    assert len(before) >= 200
    # 0.1 % of the rows: recent ids, and some new ones.
    staged = spark.range(99_950, 100_050).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    table.merge(staged, lambda old, new: upsert_by_key(old, new, ["k"]))
    kept = before & names(table)
    assert len(before - kept) < 0.05 * len(before)
    got = table.read().groupBy("v").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    assert rows(got) == [("new", 100, 99_950, 100_049), ("old", 99_950, 0, 99_949)]
    # Nothing is hit by keys that no file holds, so nothing is rewritten.
    held = names(table)
    table.merge(spark.createDataFrame([(-5, "x"), (10**9, "x")], "k bigint, v string"), lambda old, new: upsert_by_key(old, new, ["k"]))
    assert held < names(table)
    assert table.sweep(keep=1, older_than_seconds=-1) == len(before - names(table))
    assert on_disk(table) == names(table) and table.read().count() == 100_052
    with pytest.raises(Exception):
        table.read(0).count()


def test_merge_equals_the_merge_of_the_whole_table(spark, tmp_path):
    rng = random.Random(4)
    key = lambda: (rng.choice([None, "a", "b", "c'd", ""]), rng.choice([None, *range(60)]))
    ddl = "k1 string, k2 int, v int"
    whole = [(*k, i) for i, k in enumerate({key() for _ in range(250)})]
    table = FileTable(spark, str(tmp_path / "t"), keys=["k1", "k2"], file_rows=7)
    table.replace(spark.createDataFrame(whole, ddl))
    for step in range(3):
        staged = spark.createDataFrame([(*k, -i - 100 * step) for i, k in enumerate({key() for _ in range(20)})], ddl)
        want = rows(upsert_by_key(table.read(), staged, ["k1", "k2"]))
        table.merge(staged, lambda old, new: upsert_by_key(old, new, ["k1", "k2"]))
        assert rows(table.read()) == want


def test_also_adds_files(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "t"), keys=["k"], file_rows=10)
    table.replace(spark.range(200).select(F.col("id").alias("k"), (F.col("id") == 150).alias("open")))
    before = names(table)
    close = lambda old, new: old.select("k", F.lit(False).alias("open"))
    table.merge(spark.createDataFrame([], "k bigint, open boolean"), close, also=lambda r: r.where("open"))
    assert table.read().where("open").count() == 0 and table.read().count() == 200
    assert len(before - names(table)) == 1


@pytest.mark.parametrize("step", ["_write", "_entries", "_publish"])
def test_a_crash_leaves_the_old_state(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    FileTable(spark, path, partition="d").replace(spark.createDataFrame([(1, "a"), (2, "b")], "k int, d string"))
    whole = getattr(FileTable, step)

    def dies(self, *args):
        if step == "_write":
            whole(self, *args)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(FileTable, step, dies)
        with pytest.raises(KeyboardInterrupt):
            FileTable(spark, path, partition="d").replace_partitions(spark.createDataFrame([(3, "b")], "k int, d string"), ["a", "b"])
    table = FileTable(spark, path, partition="d")
    assert rows(table.read()) == [(1, "a"), (2, "b")] and table.versions() == [0]
    table.replace_partitions(spark.createDataFrame([(3, "b")], "k int, d string"), ["a", "b"])
    assert rows(table.read()) == [(3, "b")]
    table.sweep(keep=1, older_than_seconds=-1)
    assert on_disk(table) == names(table) and rows(table.read()) == [(3, "b")]


def test_a_young_file_is_not_swept(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(3))
    table.replace(spark.range(4))
    assert table.sweep(keep=1) == 0 and len(on_disk(table)) > len(names(table))


def test_one_of_two_writers_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    FileTable(spark, path).replace(spark.range(1))
    write = FileTable._write

    def overtaken(self, df, folder):
        write(self, df, folder)
        monkeypatch.setattr(FileTable, "_write", write)
        FileTable(spark, path).replace(spark.range(20))

    monkeypatch.setattr(FileTable, "_write", overtaken)
    with pytest.raises(CommitConflict):
        FileTable(spark, path).append(spark.range(300))
    table = FileTable(spark, path)
    assert table.versions() == [0, 1] and table.read().count() == 20


def test_partitions_of_any_value(spark, tmp_path):
    ddl = "k int, d string"
    table = FileTable(spark, str(tmp_path / "t"), partition="d")
    values = [None, "", "a b:c/%=ü+", "x", "=", "__HIVE_DEFAULT_PARTITION__"]
    table.replace(spark.createDataFrame(list(enumerate(values)), ddl))
    assert rows(table.read()) == sorted([*enumerate(values)], key=repr)
    for gone in range(len(values)):
        before = names(table)
        table.replace_partitions(spark.createDataFrame([(100 + gone, values[gone])], ddl), [values[gone]])
        assert len(before - names(table)) == 1
    assert rows(table.read()) == sorted([(100 + i, v) for i, v in enumerate(values)], key=repr)
    table.replace_partitions(spark.createDataFrame([], ddl), values[:2])
    assert {r["d"] for r in table.read().collect()} == set(values[2:])


def test_merge_touches_only_the_changed_partitions(spark, tmp_path):
    ddl = "k int, ts timestamp, v string, day date"
    table = FileTable(spark, str(tmp_path / "p"), keys=["k"], partition="day")
    step = lambda old, new: upsert_latest(old, new, ["k", "day"], "ts")
    t = lambda s: dt.datetime(2026, 1, 1, 0, 0, s)
    d = lambda n: dt.date(2026, 1, n)
    assert table.merge_partitions(spark.createDataFrame([(1, t(1), "a", d(1)), (2, t(1), "b", d(2))], ddl), step) == 0
    before = names(table)
    changed = spark.createDataFrame([(2, t(2), "new", d(2)), (3, t(1), "c", d(2)), (4, t(1), "n", None)], ddl)
    for _ in range(2):
        table.merge_partitions(changed, step)
    assert len(before & names(table)) == 1
    assert {(r["k"], r["v"], r["day"]) for r in table.read().collect()} == {(1, "a", d(1)), (2, "new", d(2)), (3, "c", d(2)), (4, "n", None)}
    assert table.merge_partitions(changed.where("false"), step) is None


def test_append_keeps_columns_and_types(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "a"))
    table.append(spark.createDataFrame([(1, "x")], "k bigint, v string"))
    table.append(spark.createDataFrame([("y", 2, 0)], "v string, k int, extra int"))
    assert rows(table.read()) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="v"):
        table.append(spark.range(1).withColumnRenamed("id", "k"))
    with pytest.raises(ValueError, match="columns"):
        FileTable(spark, table.path, partition="k").replace_partitions(spark.range(1).withColumnRenamed("id", "k"), [1])
    with pytest.raises(ValueError, match="laid out"):
        FileTable(spark, table.path, keys=["k"]).append(table.read())
    FileTable(spark, table.path, keys=["k"]).replace(table.read())
    assert FileTable(spark, table.path).read().count() == 2
