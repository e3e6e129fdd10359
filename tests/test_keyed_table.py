"""Keyed table with a file index: what a merge touches, versions, equality with a plain upsert."""
import pytest
from pyspark.sql import functions as F

from pacekit.operators.upsert import upsert
from pacekit.sources.keyed_table import KeyedTable
from pacekit.sources.sinks import write_table

SCHEMA = "id int, v string, created_at int, at int, month int"
KEEP = {"insert_only_cols": ["created_at"]}


def rows_of(df):
    return sorted(tuple(r) for r in df.select("id", "v", "created_at", "at", "month").collect())


def test_merge_equals_upsert_and_keeps_files_of_touched_months(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/t", ["id"], "month", rows_per_file=10)
    first = spark.range(200).selectExpr("cast(id as int) id", "concat('a', id) v", "1 created_at", "1 at",
                                        "cast(202401 + id div 100 as int) month")
    assert table.merge(first, ["at"], **KEEP)["rows"] == 200
    before = set(table.files())
    assert len(before) >= 20
    # 7 changes (twice in the batch, the latest wins), 150 moves to another month, 900 is new
    batch = spark.createDataFrame([(7, "b1", 2, 2, 202401), (7, "b2", 2, 3, 202401), (150, "m", 2, 2, 202401),
                                   (900, "n", 2, 2, 202402)], SCHEMA)
    want = rows_of(upsert(first, batch, ["id"], ["at"], **KEEP))
    got = table.merge(batch, ["at"], **KEEP)
    assert (got["rows"], got["rewritten"], got["kept"]) == (3, 2, len(before) - 2)
    assert rows_of(table.read()) == want
    after = set(table.files())
    assert len(before & after) == len(before) - 2          # touched months keep their other files, by name
    assert {f.split("month=")[1][:6] for f in before - after} == {"202401", "202402"}
    table.merge(batch, ["at"], **KEEP)                      # again: nothing changes
    assert rows_of(table.read()) == want
    assert rows_of(table.read(version=1)) == rows_of(first)
    gone = table.vacuum()
    assert len(gone) >= 2 and rows_of(table.read()) == want


def test_inserts_alone_rewrite_nothing(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/t", ["id"], "month")
    table.merge(spark.createDataFrame([(1, "a", 1, 1, 202401), (9, "z", 1, 1, 202401)], SCHEMA), ["at"])
    got = table.merge(spark.createDataFrame([(5, "m", 1, 1, 202401)], SCHEMA), ["at"])   # inside the key range
    assert (got["rewritten"], got["kept"]) == (0, 1) and table.read().count() == 3
    assert table.merge(spark.createDataFrame([], SCHEMA), ["at"])["rows"] == 0


def test_a_failed_merge_is_invisible(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/t", ["id"], "month")
    with pytest.raises(FileNotFoundError):
        table.read()
    table.merge(spark.createDataFrame([(1, "a", 1, 1, 202401)], SCHEMA), ["at"])
    write_table(spark.createDataFrame([(1, "x", 1, 9, 202401)], SCHEMA), f"{tmp_dir}/t/data/_version=2", ["month"])
    assert rows_of(table.read()) == [(1, "a", 1, 1, 202401)]      # data without a manifest
    batch = spark.createDataFrame([(2, "b", 1, 1, 202401)], SCHEMA)
    table.merge(batch, ["at"])
    assert rows_of(table.read()) == [(1, "a", 1, 1, 202401), (2, "b", 1, 1, 202401)]
    with pytest.raises(ValueError):
        table.merge(batch.withColumn("id", F.lit(None).cast("int")), ["at"])


def test_composite_keys(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/t", ["month", "id"], "month")
    table.merge(spark.createDataFrame([(1, "a", 1, 1, 202401), (1, "b", 1, 1, 202402)], SCHEMA), ["at"])
    table.merge(spark.createDataFrame([(1, "c", 1, 2, 202402)], SCHEMA), ["at"])
    assert rows_of(table.read()) == [(1, "a", 1, 1, 202401), (1, "c", 1, 2, 202402)]
