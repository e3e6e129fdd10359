"""Long histories, bucketed catalog tables, anomaly flags, row-level security."""
import random
import uuid

import pytest
from pyspark.sql import functions as F

from pacekit.operators.anomaly import anomaly_flags
from pacekit.operators.asof import merge_asof
from pacekit.operators.scd import interval_join, scd2
from pacekit.operators.upsert import upsert
from pacekit.sources.catalog_table import CatalogTable, TableKeyError
from pacekit.sources.secured_view import declare_viewer, secured_view, set_viewer


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("end", ["exclusive", "inclusive"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_merge_asof_equals_interval_join(spark, end, how):
    random.seed(3)
    day = "date_add(date'2024-01-01', cast(x as int))"
    tests = spark.createDataFrame([(i, x, i * 1000 + x) for i in (1, 2, 3) for x in random.sample(range(120), 25)],
                                  "id int, x int, ftp int").selectExpr("id", f"{day} as test_date", "ftp")
    dim = scd2(tests, ["id"], "test_date", end_offset_days=1 if end == "inclusive" else random.choice([0, 1]))
    facts = spark.createDataFrame([(k, random.choice([1, 2, 3, 4, None]), random.choice([None, *range(-5, 130)]))
                                   for k in range(500)], "k int, id int, x int").selectExpr("k", "id", f"{day} as d")
    want = rows(interval_join(facts, dim, ["id"], "d", ["ftp", "valid_from"], how, end))
    for chunk in (1, 7, 400):
        assert rows(merge_asof(facts, dim, ["id"], "d", ["ftp", "valid_from"], how, end, chunk_days=chunk)) == want


def test_a_long_history_is_many_groups(spark):
    n = 100_000
    dim = spark.range(n).selectExpr("1 as id", "date_add(date'1800-01-01', cast(id as int)) as valid_from",
                                    "date_add(date'1800-01-01', cast(id + 1 as int)) as valid_to", "id as v")
    facts = spark.range(0, n, 10).selectExpr("1 as id", "date_add(date'1800-01-01', cast(id as int)) as d", "id as want")
    j = merge_asof(facts, dim, ["id"], "d", ["v"], chunk_days=50)
    assert j.count() == n // 10 and j.filter("v <> want").count() == 0
    p = j._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in p
    specs = [ln.split("windowspecdefinition(")[1] for ln in p.split("\n") if "Window [" in ln]
    assert any("_chunk" in s.split("ASC")[0] and "_day" in s for s in specs)       # events and versions by chunk


@pytest.fixture()
def tokens(spark, tmp_dir):
    name = f"t_{uuid.uuid4().hex[:8]}"
    t = CatalogTable(spark, name, f"{tmp_dir}/tokens")
    first = spark.range(1000).selectExpr("id", "concat('a', id) as v", "1 as at")
    return t.create(first, ["id"], ["at"], 4), first


def test_catalog_upsert_shuffles_the_batch_only(spark, tokens):
    t, first = tokens
    batch = spark.createDataFrame([(5, "b", 2), (5, "c", 3), (2000, "n", 2)], "id long, v string, at int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = t.merged(batch, ["at"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = p.split("\n")
    scan = next(i for i, ln in enumerate(lines) if "FileScan parquet" in ln and "Bucketed: true" in ln)
    depth = [len(ln) - len(ln.lstrip(" :+-")) for ln in lines]
    join = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln)
    above, d = [], depth[scan]
    for i in range(scan - 1, join, -1):
        if depth[i] < d:
            above.append(lines[i].strip(" :+-"))
            d = depth[i]
    assert not any(x.startswith("Exchange") for x in above), above
    t.merge(batch, ["at"])
    assert rows(t.read()) == rows(upsert(first, batch, ["id"], ["at"]))
    assert t.duplicates().count() == 0 and "Exchange" not in \
        t.duplicates()._jdf.queryExecution().executedPlan().toString()


def test_the_declared_key_is_enforced(spark, tokens):
    t, _ = tokens
    assert t.key() == ["id"] and t.properties()["pacekit.version"] == "1"
    batch = spark.createDataFrame([(None, "b", 2)], "id long, v string, at int")
    with pytest.raises(TableKeyError):
        t.merge(batch, ["at"])
    with pytest.raises(TableKeyError):
        t.merge(batch, ["at"], keys=["v"])
    with pytest.raises(TableKeyError):
        t.create(batch, ["id"], ["at"], 2)
    assert t.read().count() == 1000 and t.properties()["pacekit.version"] == "1"


def test_anomaly_flags(spark):
    day = "date_add(date'2024-01-01', cast(id as int))"
    flat = spark.range(40).selectExpr("1 as e", f"{day} as d", "0.1 as v")
    spike = spark.range(40).selectExpr("2 as e", f"{day} as d", "case when id = 35 then 90.0 else 10.0 + id % 3 end as v")
    huge = spark.range(40).selectExpr("3 as e", f"{day} as d", "123456789.125 as v")
    gap = spark.createDataFrame([(4, "2024-01-01", 5.0), (4, "2024-01-02", None), (4, "2024-06-01", 500.0)],
                                "e int, d string, v double").selectExpr("e", "to_date(d) as d", "v")
    df = flat.unionByName(spike).unionByName(huge).unionByName(gap)
    out = anomaly_flags(df.withColumn("v", F.col("v").cast("double")), ["e"], "d", "v", 28, 5, 3.0)
    flagged = {(r.e, str(r.d)) for r in out.filter("is_anomaly").collect()}
    assert flagged == {(2, "2024-02-05")}
    assert out.filter("e in (1, 3) and base_days > 1 and base_std <> 0").count() == 0     # constant: exactly none
    assert out.filter("e = 4 and z_score is not null").count() == 0


def test_two_viewers_one_view(spark):
    rides = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, None)], "ride int, athlete int")
    who = spark.createDataFrame([("ann", "10"), ("ann", "20"), ("bob", "30"), ("ann", "20"), ("boss", "*")],
                                "viewer string, athlete string")
    declare_viewer(spark)
    name = f"v_{uuid.uuid4().hex[:8]}"
    view = secured_view(spark, name, rides, who, "athlete")

    def seen(viewer):
        set_viewer(spark, viewer)
        return sorted(r.ride for r in spark.table(name).collect())

    assert view.count() == 0                                  # nobody is looking
    assert seen("ann") == [1, 2] and seen("bob") == [3]
    assert seen("boss") == [1, 2, 3, 4] and seen("eve") == [] and seen("*") == []
    set_viewer(spark, None)
