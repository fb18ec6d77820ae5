import pytest
from pyspark.sql import functions as F

from conftest import same
from ledgerline.sources.tables import Conflict, Tables

COLUMNS = "k string, n int"


class Broken(Exception):
    pass


def folders(root, name):
    return sorted(p.name for p in (root / name).iterdir() if p.is_dir())


def test_only_touched_buckets_are_written(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), buckets=16)
    rows = spark.range(400).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("n"))
    tables.put("t", rows, tables.bucket("k"))
    before = tables.parts("t")
    change = spark.createDataFrame([("k7", 70), ("k8", None), ("new", 1)], COLUMNS)
    parts = tables.buckets_of(change, "k")
    assert len(parts) <= 3
    kept = tables.read("t", parts=parts).join(change.select("k"), "k", "left_anti")
    tables.put("t", kept.unionByName(change), tables.bucket("k"), parts)
    after = tables.parts("t")
    assert {p for p in after if after[p] != before.get(p)} == set(parts)
    expected = rows.where("k not in ('k7', 'k8')").unionByName(change)
    assert same(tables.read("t"), expected)
    # A bucket that has no rows any more goes.
    tables.put("t", rows.limit(0), tables.bucket("k"), parts)
    assert set(tables.parts("t")) == set(after) - set(parts)
    with pytest.raises(ValueError, match="not replaced"):
        tables.put("t", rows, tables.bucket("k"), parts)


def test_several_tables_in_one_commit(spark, tmp_path):
    tables, reader = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path))
    old = spark.createDataFrame([("a", 1)], COLUMNS)
    new = spark.createDataFrame([("b", 2)], COLUMNS)
    with tables.commit():
        tables.overwrite("x", old)
        tables.overwrite("y", old)
    seen = reader.read("x")
    with pytest.raises(Broken), tables.commit():
        tables.overwrite("x", new)
        assert same(tables.read("x"), new) and same(tables.read("x", before=True), old)
        raise Broken
    assert same(reader.read("x"), old)
    with tables.commit():
        tables.overwrite("x", new)
        assert same(reader.read("x"), old)
        tables.overwrite("y", new)
        tables.append("y", old)
        assert same(reader.read("y"), old)
    assert same(reader.read("x"), new) and same(reader.read("y"), new.union(old))
    # A reader that began earlier keeps its rows.
    assert same(seen, old)


def test_two_writers_cannot_both_commit(spark, tmp_path):
    one, other = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", 1)], COLUMNS)
    with pytest.raises(Conflict), one.commit():
        one.overwrite("x", rows)
        other.overwrite("x", rows.union(rows))
    assert one.read("x").count() == 2
    one.overwrite("x", rows)
    assert other.read("x").count() == 1


def test_vacuum_keeps_what_a_reader_can_hold(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), buckets=4)
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("n"))
    tables.put("t", rows, tables.bucket("k"))
    for _ in range(3):
        tables.put("t", tables.read("t", parts=["0"]), F.lit("0"), ["0"])
    assert len(folders(tmp_path, "t")) == 4
    tables.vacuum()
    assert len(folders(tmp_path, "t")) == 4 and same(tables.read("t"), rows)
    tables.vacuum(older_than=0)
    # The first folder still has the other buckets.
    assert len(folders(tmp_path, "t")) == 2 and same(tables.read("t"), rows)
    assert len([p for p in (tmp_path / "_manifests").iterdir() if p.suffix == ".json"]) == 1


def test_empty_tables_keep_their_columns(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    none = spark.createDataFrame([], COLUMNS)
    tables.put("t", none, tables.bucket("k"))
    tables.overwrite("u", none)
    for name in ("t", "u"):
        assert tables.read(name).schema == none.schema and tables.read(name).count() == 0


def test_upsert(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.upsert("t", spark.createDataFrame([("a", 1), ("b", 2)], COLUMNS), "k", ["n"])
    tables.upsert("t", spark.createDataFrame([("a", 9), ("c", 9)], COLUMNS), "k", ["n"])
    assert sorted(map(tuple, tables.read("t").collect())) == [("a", 9), ("b", 2), ("c", 9)]


def test_parts_are_written_without_a_shuffle(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    rows = spark.range(600).repartition(3).withColumn("task", F.spark_partition_id())
    tables.put("t", rows, tables.bucket("id"))
    kept = tables.read("t").withColumn("file", F.input_file_name())
    assert kept.count() == 600 and kept.select("id").distinct().count() == 600
    assert kept.groupBy("file").agg(F.count_distinct("task").alias("tasks")).where("tasks <> 1").isEmpty()
    assert set(tables.parts("t")) == {str(b) for b in range(tables.buckets)}
