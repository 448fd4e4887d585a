"""Writes that fail on the way, writes at the same time, and what is left untouched."""

import threading

import pytest
from pyspark.sql import functions as F

from khodat.operators import maintenance, rows, swap, tables
from khodat.schema import Partition


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(spark, name):
    return {(r[0], r[1]) for r in spark.table(name).select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()}


def plain_table(spark, database, partitioned=False):
    name = f"{database}.t"
    frame = spark.range(0, 40, 1, 8).selectExpr("id as k", "string(id) as v", "int(id % 4) as p")
    (frame.write.partitionBy("p") if partitioned else frame.write).saveAsTable(name)
    return name, {r.k: tuple(r) for r in frame.collect()}


def test_merge_rewrites_only_files_with_a_match(spark, database):
    name, wanted = plain_table(spark, database)
    before = files(spark, name)
    assert len(before) == 8
    changes = spark.createDataFrame([(3, "three", 0), (4, "four", 1), (99, "added", 2)], "k long, v string, p int")
    tables.merge_into(changes, name, ["k"])
    wanted.update({r.k: tuple(r) for r in changes.collect()})
    assert content(spark.table(name)) == sorted(wanted.values(), key=str)
    assert len(before & files(spark, name)) == 7
    now = files(spark, name)
    tables.merge_into(changes.limit(0), name, ["k"])
    assert files(spark, name) == now
    tables.merge_into(spark.createDataFrame([(100, "only added", 1)], changes.schema), name, ["k"])
    assert now < files(spark, name) and spark.table(name).count() == 42


@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("step", ["record", "remove", "move", "remove_empty"])
def test_a_failed_swap_is_made_good(spark, database, monkeypatch, partitioned, step):
    name, rows_before = plain_table(spark, database, partitioned)
    # The last partition is emptied: all of its rows move.
    changes = spark.createDataFrame([(k, "moved", 0) for k in range(3, 40, 4)] + [(99, "added", 7)], "k long, v string, p int")
    after = {**rows_before, **{r.k: tuple(r) for r in changes.collect()}}
    owner, calls = (swap, []) if step == "record" else (swap.Place, [])
    whole = getattr(owner, step)

    def broken(*arguments):
        # Some of the work is done before it fails.
        calls.append(1)
        if step == "record" or len(calls) > 1:
            raise OSError("lost")
        return whole(*arguments)

    monkeypatch.setattr(owner, step, broken)
    if step == "remove_empty" and not partitioned:
        tables.merge_into(changes, name, ["k"])
    else:
        with pytest.raises(OSError):
            tables.merge_into(changes, name, ["k"])
    monkeypatch.undo()
    tables.recover_table(spark, name)
    wanted = rows_before if step == "record" else after
    assert content(spark.table(name)) == sorted(wanted.values(), key=str)
    place = tables._place(spark, name)
    assert not swap.has_journal(place) and not [s for s in place.fs.listStatus(place.root) if s.getPath().getName().startswith("_khodat")]
    tables.merge_into(changes, name, ["k"])
    assert content(spark.table(name)) == sorted(after.values(), key=str)
    if partitioned:
        assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {"p=0", "p=1", "p=2", "p=7"}


@pytest.mark.parametrize("place", ["", "LOCATION '{path}'"])
def test_retype_whose_insert_fails_leaves_the_table(spark, database, scratch, monkeypatch, place):
    name = f"{database}.t"
    spark.sql(f"CREATE TABLE {name} (k string, v string) USING parquet " + place.format(path=scratch("it\\'s a place")))
    tables.insert_append(spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string"), name)

    def broken(*_):
        raise OSError("no space")

    monkeypatch.setattr(swap, "record", broken)
    with pytest.raises(OSError):
        tables.retype_swap(spark, name, {"k": "bigint"})
    monkeypatch.undo()
    assert content(spark.table(name)) == [("1", "a"), ("2", "b")] and not spark.catalog.tableExists(f"{name}__before")
    tables.retype_swap(spark, name, {"k": "bigint"})
    assert content(spark.table(name)) == [(1, "a"), (2, "b")]


def test_overwriting_in_one_thread_does_not_change_another(spark, database):
    """While a table is overwritten again and again, dynamic overwrites of another one keep its other partitions."""
    name, other = f"{database}.t", f"{database}.other"
    spark.range(8).selectExpr("id as k", "int(id % 4) as p").write.partitionBy("p").saveAsTable(other)
    spark.range(3).write.saveAsTable(name)
    stop, failed = threading.Event(), []

    def overwrite():
        while not stop.is_set():
            try:
                tables.insert_overwrite(spark.range(3), name, distinct=False)
            except Exception as error:
                failed.append(error)
                return

    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    thread = threading.Thread(target=overwrite)
    thread.start()
    try:
        for i in range(6):
            spark.createDataFrame([(100 + i, 1)], "k long, p int").write.insertInto(other, overwrite=True)
            assert spark.table(other).select("p").distinct().count() == 4 and spark.table(other).where("p = 1").count() == 1
    finally:
        stop.set()
        thread.join()
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert not failed and spark.table(name).count() == 3


@pytest.mark.parametrize("partitions", [[], [Partition("p", "INTEGER")]])
def test_sorted_files_hold_ranges_and_a_hot_value_is_split(spark, database, partitions):
    name = f"{database}.t"
    many = spark.range(0, 20000, 1, 8).selectExpr("id", "if(id % 3 = 0, 777, id * 7919 % 5000) as k", "int(id % 2) as p")
    tables.create_or_replace_table_as(many, name, partitions, ["k"], distinct=False, num_partitions=12)
    found = spark.table(name).groupBy("p", F.col("_metadata.file_path").alias("f")).agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("*").alias("n")).collect()
    if not partitions:
        found = spark.table(name).groupBy(F.lit(0).alias("p"), F.col("_metadata.file_path").alias("f")).agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in found) == 20000 and max(r.n for r in found) < 5000
    for p in {r.p for r in found}:
        own = sorted((r.a, r.b) for r in found if r.p == p)
        assert all(b <= a for (_, b), (a, _) in zip(own, own[1:]))
    assert len([r for r in found if r.a <= 777 <= r.b]) > 3
    assert len([r for r in found if r.a <= 4000 <= r.b]) <= 2
    assert rows.ranged_for_write(spark.range(10).selectExpr("id", "map(1, id) as m"), ["id"]).count() == 10


def test_orphans_raise_for_each_listed_root_without_a_match(spark):
    listing = spark.sql("select path, timestamp'2024-01-01' as mtime from values ('/a/t/1'), ('/a/t/2'), ('/b/t/1') as t(path)")
    later = F.lit("2024-03-01").cast("timestamp")
    entries = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    with pytest.raises(ValueError, match="below /, referenced ones below /"):
        maintenance.orphan_files(listing, entries("/x/1", "/y/1"), later)
    assert content(maintenance.orphan_files(listing, entries("/a/t/1", None), later).select("path")) == [("/a/t/2",), ("/b/t/1",)]
    with pytest.raises(ValueError, match="below /b/t"):
        maintenance.orphan_files(listing, entries("hdfs://n/a/t/1"), later, roots=["hdfs://n/a/t", "file:/b/"])
    assert content(maintenance.orphan_files(listing, entries("/a/t/1", "/b/t/1", "/c"), later, roots=["/a/t", "/b"]).select("path")) == [("/a/t/2",)]
    assert maintenance.orphan_files(listing, entries(), later, roots=["/a", "/b"]).count() == 3
