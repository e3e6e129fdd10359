"""The splittable snapshot reader against the whole-document reader."""
import json
import os

import pytest
from pyspark.sql import functions as F

from pacekit.sources import ingest as I
from pacekit.sources import snapshot_split as P


def document(records, at="2024-02-01T00:00:00Z", **kw):
    return json.dumps({"extracted_at_utc": at, "activities": records}, **kw)


RECORDS = [{"id": i, "name": n, "map": {"a": {"b": i}, "l": [{"x": 1}, {"y": "}"}]}} for i, n in enumerate(
    ["plain", "brace } in {text", 'quote " and \\ back', "a\\", '\\"}', "", "ünï", '"', "{{", "}}}", "x" * 300] * 3)]


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as fh:
        fh.write(text)


def rows(df):
    return sorted((r.activity_id, str(r.extracted_at_utc), json.dumps(json.loads(r.payload), sort_keys=True), r.snapshot)
                  for r in df.collect())


@pytest.fixture()
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", open_cost)


@pytest.mark.parametrize("kw", [{}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_one_document_is_read_by_many_tasks(spark, tmp_dir, small_splits, kw):
    folder = f"{tmp_dir}/snap"
    write(folder, "activities_raw_20240101T000000Z.json", document([{"id": 1}]))
    write(folder, "activities_raw_20240201T000000Z.json", document(RECORDS, **kw) + "\n")
    roots = I.snapshot_roots(spark, folder, r"activities_raw_[^/.]*", True)
    cut = P.pieces(spark, roots, r"activities_raw_[^/.]*")
    assert cut.select("block").distinct().count() >= 4
    got = rows(P.read_snapshot_split(spark, folder))
    assert len(got) == len(RECORDS) and got == rows(I.read_snapshot(spark, folder))
    assert P.split_rejects(spark, folder).count() == 0


def test_documents_on_lines_empty_ones_and_ids_that_are_none(spark, tmp_dir, small_splits):
    folder = f"{tmp_dir}/snap"
    docs = [document(RECORDS[:3]), document([]), document([{"id": None, "v": 1}, {"name": "no id"}, {"id": 77}]),
            document(RECORDS[3:9], at=None)]
    write(folder, "activities_raw_20240201T000000Z.json", "\n".join(docs) + "\n\n")
    assert rows(P.read_snapshot_split(spark, folder)) == rows(I.read_snapshot(spark, folder))

    def left(df):
        return sorted((r.field, json.dumps(json.loads(r.raw_text))) for r in df.collect())

    assert left(P.split_rejects(spark, folder)) == left(I.snapshot_rejects(spark, folder))
    # a field after the records
    write(f"{tmp_dir}/tail", "activities_raw_1.json", '{"activities": [{"id": 5}], "extracted_at_utc": "2024-02-01T00:00:00Z"}')
    assert rows(P.read_snapshot_split(spark, f"{tmp_dir}/tail")) == rows(I.read_snapshot(spark, f"{tmp_dir}/tail"))


def test_a_cut_off_document_gives_no_rows_and_one_reject(spark, tmp_dir, small_splits):
    whole = document(RECORDS)
    for n, cut in enumerate((len(whole) // 2, len(whole) - 1, 60, whole.index('}}, {"id": 3') + 2)):
        folder = f"{tmp_dir}/cut{n}"
        write(folder, "activities_raw_1.json", whole[:cut])
        assert P.read_snapshot_split(spark, folder).count() == I.read_snapshot(spark, folder).count() == 0
        assert [r.field for r in P.split_rejects(spark, folder).collect()] == ["$"], n
    with pytest.raises(FileNotFoundError):
        P.read_snapshot_split(spark, f"{tmp_dir}/cut0", name_pattern="other_[^/.]*")


def test_one_pass_audit_equals_the_audit_of_three_scans(spark, tmp_dir):
    raw = spark.createDataFrame([
        (1, 1, '{"id": 1, "moving_time": 60}'), (1, 2, '{"id": 2, "moving_time": "soon", "distance": "far"}'),
        (2, 3, "{cut"), (2, 4, '{"id": null}'), (3, 5, '{"id": 5}'), (9, 6, '{"name": "none"}')],
        "athlete_id long, activity_id long, payload string").withColumn(
        "extracted_at_utc", F.lit("2024-02-01").cast("timestamp"))
    ents = spark.createDataFrame([(1,), (2,), (3,), (4,)], "athlete_id long")
    one = I.audit_landing(raw, "athlete_id", ents)
    three = I.load_audit(raw, I.stage_activities(raw, None), "athlete_id", ents, I.stage_rejects(raw))
    key = lambda r: tuple(r)
    assert sorted(map(key, one.select(*three.columns).collect())) == sorted(map(key, three.collect()))
    p = one._jdf.queryExecution().executedPlan().toString()
    assert p.count("Scan ExistingRDD") <= 2                  # the landing once, the entities once
    got = I.load_staged(raw, f"{tmp_dir}/staged")
    assert got == {"fetched": 6, "errors": I.stage_rejects(raw).count(), "upserted": 2}
    assert spark.read.parquet(f"{tmp_dir}/staged").count() == 2
    with pytest.raises(I.EmptyLoadError):
        I.load_staged(raw.filter("activity_id = 3"), f"{tmp_dir}/none")
