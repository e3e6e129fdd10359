import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from pacekit.sources import ingest as I
from pacekit.sources import sinks as S
from pacekit.streaming.incremental import compact, read_current, start_incremental_upsert

DOCS = [
    {"id": 1, "start_date": "2024-03-01T08:00:00Z", "name": "Zwift – Watopia", "type": "VirtualRide",
     "distance": 30000.5, "moving_time": 3600, "average_speed": 8.33, "weighted_average_watts": 210},
    {"id": 2, "start_date": "2024-02-29T23:30:00Z", "type": "Ride", "distance": 1000,
     "moving_time": "3600.0"},                                      # non-integer INT field
    {"id": None, "start_date": "2024-03-02T08:00:00Z"},              # null id: dropped
    {"start_date": "2024-03-02T08:00:00Z"},                           # no id: dropped
    {"id": 5, "start_date": "2023-12-31T23:59:59Z", "type": "Ride"},  # before min_start
]


def raw(spark):
    rows = [(7, d.get("id") or 0, dt.datetime(2024, 3, 3), json.dumps(d, ensure_ascii=False))
            for d in DOCS]
    return spark.createDataFrame(rows, "athlete_id bigint, activity_id bigint, "
                                       "extracted_at_utc timestamp, payload string")


def test_stage_parses_types_and_missing_keys(spark):
    st = {r.activity_id: r for r in I.stage_activities(raw(spark), "2024-01-01").collect()}
    assert set(st) == {1}              # 2 has a bad integer, two have no id, 5 is too old
    a = st[1]
    assert a.activity_name == "Zwift – Watopia" and a.moving_time_s == 3600
    assert a.distance_km == 30.0005 and a.moving_time_min == 60.0
    assert a.start_date_utc == dt.datetime(2024, 3, 1, 8, 0) and a.avg_hr is None
    assert {r.activity_id for r in I.stage_activities(raw(spark), None).collect()} == {1, 5}


def test_rejects_name_key_field_and_text(spark):
    broken = raw(spark).limit(1).withColumn("payload", F.lit('{"id": 9, "na')).withColumn("activity_id", F.lit(9))
    texty = raw(spark).limit(1).withColumn("payload", F.lit(
        '{"id": "abc", "start_date": "soon", "moving_time": 3600.0}')).withColumn("activity_id", F.lit(10))
    df = raw(spark).unionByName(broken).unionByName(texty)
    got = sorted((r.activity_id, r.field, r.raw_text) for r in I.stage_rejects(df).collect() if r.activity_id)
    assert got == [(2, "moving_time", "3600.0"), (9, "$", '{"id": 9, "na'), (10, "id", "abc"),
                   (10, "moving_time", "3600.0"), (10, "start_date", "soon")]
    assert [(r.field, r.raw_text) for r in I.stage_rejects(df).collect() if not r.activity_id] == [("id", None)] * 2
    audit = {r.field: r.bad_values for r in I.parse_audit(df).collect()}
    assert audit["moving_time"] == 2 and audit["distance"] == 0 and audit["id"] == 3 and audit["$"] == 1
    with pytest.raises(I.RejectedRowsError):
        I.require_clean(I.stage_rejects(df))
    I.require_clean(I.stage_rejects(df), most=8)


def test_direct_staging_equals_parsed_staging(spark):
    from pacekit.plans import analog as A

    ev = spark.range(40).selectExpr("id AS event_id", "id % 5 AS user_id", "CAST(id * 1.37 AS DOUBLE) AS value",
                                    "TIMESTAMP_NTZ '2023-12-31 12:00:00' + make_interval(0,0,0,0,id,0,0.25) AS ts",
                                    "'purchase' AS event_type", "concat('{\"k\": ', id, '}') AS props")
    a, b = A.staged_activities(ev), I.stage_activities(A.landed_activities(ev), A.MIN_START)
    assert a.schema == b.schema or [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str) and a.count() == 28


def test_serialize_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "id int, np double")
    assert df.select(I.serialize_record("id", "np")).first()[0] == '{"id":1,"np":null}'


def test_snapshot_reader_picks_latest_run(spark, tmp_dir):
    for run, ids in (("20240101T000000Z", [1, 2]), ("20240201T000000Z", [2, 3, 4])):
        os.makedirs(f"{tmp_dir}/activities_raw_{run}", exist_ok=True)
        doc = {"extracted_at_utc": run[:4] + "-" + run[4:6] + "-" + run[6:8] + "T00:00:00Z",
               "activities": [{"id": i, "name": "ride é"} for i in ids]}
        with open(f"{tmp_dir}/activities_raw_{run}/part.json", "w") as fh:
            fh.write(json.dumps(doc, ensure_ascii=False) + "\n")
    snap = I.read_snapshot(spark, tmp_dir)
    rows = sorted((r.activity_id, r.snapshot) for r in snap.collect())
    assert rows == [(2, "activities_raw_20240201T000000Z"), (3, "activities_raw_20240201T000000Z"),
                    (4, "activities_raw_20240201T000000Z")]
    assert "é" in snap.first().payload
    assert I.read_snapshot(spark, tmp_dir, latest_only=False).count() == 5
    files = {f.rsplit("/", 2)[-2] for f in snap.inputFiles()}
    assert files == {"activities_raw_20240201T000000Z"}            # the older snapshot is not scanned


def test_snapshot_reader_takes_any_valid_json_and_rejects_the_rest(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/snap")
    ids = [{"id": 1}, {"id": "7"}, {"id": "abc"}, {"name": "no id"}, {"id": None}]
    doc = {"extracted_at_utc": "2024-02-01T00:00:00Z", "activities": ids}
    with open(f"{tmp_dir}/snap/activities_raw_20240201T000000Z.json", "w") as fh:
        fh.write(json.dumps(doc, indent=2))
    rows = I.read_snapshot(spark, f"{tmp_dir}/snap").collect()
    assert sorted(r.activity_id for r in rows) == [1, 7]
    left = I.snapshot_rejects(spark, f"{tmp_dir}/snap").collect()
    assert len(left) == 3 and {r.field for r in left} == {"id"}
    with open(f"{tmp_dir}/snap/activities_raw_20240301T000000Z.json", "w") as fh:
        fh.write('{"extracted_at_utc": "2024-03-01T00:00:00Z", "activities": [{"id"')
    assert I.read_snapshot(spark, f"{tmp_dir}/snap").count() == 0
    assert [r.field for r in I.snapshot_rejects(spark, f"{tmp_dir}/snap").collect()] == ["$"]
    os.makedirs(f"{tmp_dir}/none")
    with open(f"{tmp_dir}/none/other.json", "w") as fh:
        fh.write("{}")
    with pytest.raises(FileNotFoundError):
        I.read_snapshot(spark, f"{tmp_dir}/none")


def test_pages_csv_and_audit(spark, tmp_dir):
    r = raw(spark)
    r.write.option("maxRecordsPerFile", 2).json(f"{tmp_dir}/pages/run=1")
    r.write.json(f"{tmp_dir}/pages/run=2")
    pages = I.read_pages(spark, f"{tmp_dir}/pages", schema=r.schema)
    assert pages.count() == 10 and set(pages.columns) >= {"run", "payload"}
    st = I.stage_activities(r)
    path = S.csv_export(st, f"{tmp_dir}/csv", ["activity_id", "activity_name", "distance_km"])
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 1 and back.columns == ["activity_id", "activity_name", "distance_km"]
    ents = spark.createDataFrame([(7,), (8,)], "athlete_id bigint")
    more = r.limit(1).withColumn("athlete_id", F.lit(99).cast("bigint"))
    audit = I.load_audit(r.unionByName(more), st, "athlete_id", entities=ents, rejects=I.stage_rejects(r))
    got = {a.athlete_id: (a.fetched, a.upserted, a.errors, a.listed, a.ok) for a in audit.collect()}
    assert got == {7: (5, 1, 3, True, False), 8: (0, 0, 0, True, False), 99: (1, 0, 0, False, False)}
    assert I.require_loaded(audit) == {"entities": 2, "fetched": 6, "upserted": 1, "errors": 3, "not_ok": 3}
    with pytest.raises(I.EmptyLoadError):
        I.require_loaded(I.load_audit(r, st, "athlete_id", entities=ents.filter("false")))
    with pytest.raises(I.EmptyLoadError):
        I.require_loaded(I.load_audit(r, st.filter("false"), "athlete_id", entities=ents))


def test_table_view_routing(spark, tmp_dir):
    df = spark.range(5)
    S.write_table(df, f"{tmp_dir}/t")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 5
    S.register_view(df, "pk_view")
    assert spark.sql("select count(*) from pk_view").first()[0] == 5
    assert S.layer_database("staging", "analytics") == "staging"
    assert S.layer_database(None, "analytics") == "analytics"
    S.ensure_database(spark, "pk_staging")
    S.ensure_database(spark, "pk_staging")          # if absent: idempotent


def test_streaming_incremental_upsert_is_latest_batch_wins(spark, tmp_dir):
    landing, table, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    b1 = raw(spark).filter(F.col("activity_id") > 0)
    b1.write.json(f"{landing}/run=1")
    start_incremental_upsert(spark, landing, table, ckpt).awaitTermination()
    b2 = b1.filter("activity_id = 1").withColumn("payload", F.lit('{"id": 1, "name": "v2"}')) \
           .withColumn("extracted_at_utc", F.lit("2024-04-01 00:00:00").cast("timestamp"))
    b2.write.json(f"{landing}/run=2")
    start_incremental_upsert(spark, landing, table, ckpt).awaitTermination()
    cur = {r.activity_id: r.payload for r in read_current(spark, table, ["athlete_id", "activity_id"]).collect()}
    assert set(cur) == {1, 2, 5} and "v2" in cur[1]
    start_incremental_upsert(spark, landing, table, ckpt).awaitTermination()   # nothing new: no-op
    assert read_current(spark, table, ["athlete_id", "activity_id"]).count() == 3
    compact(spark, table, f"{tmp_dir}/compacted", ["athlete_id", "activity_id"])
    assert read_current(spark, f"{tmp_dir}/compacted", ["athlete_id", "activity_id"]).count() == 3


def test_compaction_bounds_the_batches(spark, tmp_dir):
    landing, table, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    for n in range(5):
        df = raw(spark).filter(F.col("activity_id") > 0).withColumn(
            "extracted_at_utc", F.lit(f"2024-04-0{n + 1} 00:00:00").cast("timestamp"))
        df.write.json(f"{landing}/run={n}")
        start_incremental_upsert(spark, landing, table, ckpt, compact_every=2).awaitTermination()
    batches = {r[0] for r in spark.read.parquet(table).select("_batch").distinct().collect()}
    assert batches == {3, 4}
    cur = read_current(spark, table, ["athlete_id", "activity_id"])
    assert cur.count() == 3 and cur.filter("extracted_at_utc = '2024-04-05 00:00:00'").count() == 3


def test_documents_on_lines_are_read_by_many_tasks(spark, tmp_dir):
    """A file of many documents is never one row; files whose document spans lines lie beside it."""
    name = f"{tmp_dir}/snap/activities_raw_20240201T000000Z"
    os.makedirs(name)
    docs = [json.dumps({"extracted_at_utc": "2024-02-01T00:00:00Z", "activities": [{"id": 100 * d + i} for i in range(20)]})
            for d in range(50)]
    docs[7] = '{"extracted_at_utc": "2024-02-01T00:00:00Z", "activities": [{"id": }]}'
    with open(f"{name}/a.json", "w", newline="") as fh:
        fh.write("\r\n".join(docs) + "\r\n\r\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = I.read_snapshot(spark, f"{tmp_dir}/snap")
        assert lines.rdd.getNumPartitions() >= 4
        assert "wholetext" not in lines._jdf.queryExecution().executedPlan().toString().lower()
        assert len({r[0] for r in lines.select(F.spark_partition_id()).distinct().collect()}) >= 4
        want = {100 * d + i for d in range(50) if d != 7 for i in range(20)}
        assert {r.activity_id for r in lines.collect()} == want and lines.count() == len(want)
        with open(f"{name}/b.json", "w") as fh:
            fh.write(json.dumps({"extracted_at_utc": "2024-02-01T00:00:00Z", "activities": [{"id": 9001}, {"x": 1}]}, indent=1))
        open(f"{name}/c.json", "w").close()
        assert {r.activity_id for r in I.read_snapshot(spark, f"{tmp_dir}/snap").collect()} == want | {9001}
        left = sorted((r.field, "".join(r.raw_text.split())) for r in I.snapshot_rejects(spark, f"{tmp_dir}/snap").collect())
        assert left == [("$", "".join(docs[7].split())), ("id", '{"x":1}')]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
