"""Merge rules on tiny tables: upsert, noise, group replacement, snapshot guards, marking."""

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators.merge import mark_missing, mark_orphans, merge, merge_mart
from tidemark.spec import TableSpec

CATALOG = TableSpec("Catalog_X", {"Ref_Key": "String", "Val": "String"}, ("Ref_Key",))
REGISTER = TableSpec("AccumulationRegister_R", {"Recorder": "String", "LineNumber": "Int64", "Qty": "Double", "Comment": "String"}, ("Recorder", "LineNumber"), ("Recorder",), resources=("Qty", "Comment"))


def at(s):
    return F.lit(f"2024-01-{s:02d} 00:00:00").cast("timestamp_ntz")


def catalog(spark, *data, stamp=None):
    df = spark.createDataFrame([(k, v, d, n, ver) for k, v, d, n, ver in data], "Ref_Key string, Val string, is_deleted_or_empty boolean, exchange_message_no long, DataVersion string")
    return df if stamp is None else df.withColumns({"merged_on": at(stamp), "inserted_on": at(stamp)})


def register(spark, *data, stamp=None):
    df = spark.createDataFrame(list(data), "Recorder string, LineNumber long, Qty int, Comment string, is_deleted_or_empty boolean, exchange_message_no long").withColumn("Qty", F.col("Qty").cast("decimal(38,10)"))
    return df if stamp is None else df.withColumns({"merged_on": at(stamp), "inserted_on": at(stamp)})


def day(df):
    return df.withColumn("d", F.dayofmonth("merged_on"))


def test_first_batch_makes_the_table(spark):
    r = merge(None, catalog(spark, ("a", "x", False, 1, "v")), CATALOG, at(2))
    assert rows(day(r.table), "Ref_Key", "Val", "d") == [("a", "x", 2)]
    assert r.rows_modified() == 1


def test_noise_alone_keeps_the_row(spark):
    t = catalog(spark, ("a", "x", False, 1, "v1"), ("b", "x", False, 1, "v1"), stamp=1)
    b = catalog(spark, ("a", "x", False, 2, "v2"), ("b", "y", False, 2, "v2"), ("c", None, False, 2, "v2"))
    r = merge(t, b, CATALOG, at(2))
    assert rows(day(r.table), "Ref_Key", "Val", "exchange_message_no", "DataVersion", "d") == [("a", "x", 1, "v1", 1), ("b", "y", 2, "v2", 2), ("c", None, 2, "v2", 2)]
    touched = merge(t, b, CATALOG, at(2), always_touch=True)
    assert [x[1] for x in rows(day(touched.table), "Ref_Key", "d")] == [2, 2, 2]


def test_two_rows_of_one_key_fail(spark):
    t = catalog(spark, ("a", "x", False, 1, "v"), stamp=1)
    with pytest.raises(PySparkException, match="one key"):
        merge(t, catalog(spark, ("a", "1", False, 2, "v"), ("a", "2", False, 2, "v")), CATALOG, at(2)).table.collect()


def test_missing_columns_stay_and_new_ones_are_told(spark):
    t = catalog(spark, ("a", "x", False, 1, "v"), ("z", "x", False, 1, "v"), stamp=1)
    b = spark.createDataFrame([("a", False, 2, "n"), ("b", False, 2, None)], "Ref_Key string, is_deleted_or_empty boolean, exchange_message_no long, More string")
    r = merge(t, b, CATALOG, at(2))
    assert r.added_fields == ("More",)
    assert rows(r.table, "Ref_Key", "Val", "More") == [("a", "x", "n"), ("b", None, None), ("z", "x", None)]


def test_group_is_replaced_by_marking(spark):
    t = register(spark, ("r1", 1, 5, "c", False, 1), ("r1", 2, 6, "c", False, 1), ("r2", 1, 7, "c", False, 1), stamp=1)
    r = merge(t, register(spark, ("r1", 1, 5, "c", False, 2)), REGISTER, at(2))
    assert rows(day(r.table), "Recorder", "LineNumber", "Qty", "Comment", "is_deleted_or_empty", "d") == [("r1", 1, 5, "c", False, 1), ("r1", 2, None, "c", True, 2), ("r2", 1, 7, "c", False, 1)]
    again = merge(r.table, register(spark, ("r1", 1, 5, "c", False, 3)), REGISTER, at(3))
    assert again.rows_modified() == 0  # a marked row is not marked anew
    back = merge(r.table, register(spark, ("r1", 1, 5, "c", False, 3), ("r1", 2, 6, "c", False, 3)), REGISTER, at(3))
    assert rows(back.table.where("LineNumber = 2"), "Qty", "is_deleted_or_empty") == [(6, False)]


def test_snapshot_leaves_newer_rows(spark):
    t = catalog(spark, ("old", "x", False, 1, "v"), stamp=1).union(catalog(spark, ("new", "x", False, 1, "v"), stamp=9))
    b = catalog(spark, ("old", "s", False, 0, "v"), ("new", "s", False, 0, "v"), ("more", "s", False, 0, "v"))
    r = merge(t, b, CATALOG, at(10), started_at=at(5))
    assert rows(r.table, "Ref_Key", "Val") == [("more", "s"), ("new", "x"), ("old", "s")]


def test_snapshot_adds_nothing_to_a_hot_group(spark):
    t = register(spark, ("hot", 1, 1, "", False, 3), ("own", 1, 1, "", False, 0), stamp=9).union(register(spark, ("cold", 1, 1, "", False, 3), stamp=1))
    b = register(spark, *[(g, n, 2, "", False, 0) for g in ("hot", "own", "cold") for n in (1, 2)])
    r = merge(t, b, REGISTER, at(10), started_at=at(5))
    assert rows(r.table, "Recorder", "LineNumber", "Qty") == [("cold", 1, 2), ("cold", 2, 2), ("hot", 1, 1), ("own", 1, 1), ("own", 2, 2)]


def test_missing_rows_are_marked_once_and_in_scope(spark):
    t = register(spark, ("a", 1, 1, "c", False, 1), ("b", 1, 1, "c", False, 1), ("c", 1, None, "c", True, 1), stamp=1).union(register(spark, ("d", 1, 1, "c", False, 1), stamp=9))
    seen = spark.createDataFrame([("a", 1), ("a", 1)], "Recorder string, LineNumber long")
    r = mark_missing(t, seen, REGISTER, at(10), at(5))
    assert rows(r.table, "Recorder", "Qty", "Comment", "is_deleted_or_empty") == [("a", 1, "c", False), ("b", None, "c", True), ("c", None, "c", True), ("d", 1, "c", False)]
    assert r.rows_modified() == 1
    assert mark_missing(t, seen, REGISTER, at(10), at(5), F.col("Recorder") > "b").rows_modified() == 0


def test_parts_of_marked_owners(spark):
    parts = spark.createDataFrame([("a", 1, False), ("b", 1, False)], "Ref_Key string, LineNumber long, is_deleted_or_empty boolean").withColumn("merged_on", at(1))
    owners = spark.createDataFrame([("a", True), ("b", False)], "Ref_Key string, is_deleted_or_empty boolean")
    spec = TableSpec("Document_D_Rows", {"Ref_Key": "Guid", "LineNumber": "Int64"}, ("Ref_Key", "LineNumber"), ("Ref_Key",), is_table_part=True)
    assert rows(mark_orphans(parts, owners, spec, at(2), at(2)).table, "Ref_Key", "is_deleted_or_empty") == [("a", True), ("b", False)]


def test_mart_scope_by_condition_and_keys(spark):
    t = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("c", None, 3)], "k string, m int, v int").withColumns({"merged_on": at(1), "inserted_on": at(1)})
    fresh = spark.createDataFrame([("a", 1, 9)], "k string, m int, v int")
    assert rows(merge_mart(t, fresh, ["k"], at(2), scope=F.col("m") == 1, delete=True).table, "k", "v") == [("a", 9), ("c", 3)]
    keys = spark.createDataFrame([("c",)], "k string")
    assert rows(merge_mart(t, fresh.where("false"), ["k"], at(2), scope_keys=keys, delete=True).table, "k") == [("a",), ("b",)]
    assert merge_mart(t, t.select("k", "m", "v"), ["k"], at(2), delete=True).rows_modified() == 0
