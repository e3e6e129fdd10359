"""Event-time upsert: late, repeated and out-of-order files, bounded state, restart."""
import pytest
from pyspark.sql import functions as F

from pacekit.operators.upsert import latest_per_key
from pacekit.streaming.event_time import EventTimeUpsert

SCHEMA = "id long, seen timestamp, ver int, v string"


def at(day, hour=0):
    return f"2024-01-{day:02d} {hour:02d}:00:00"


def batch(spark, rows):
    return spark.createDataFrame(rows, "id long, seen string, ver int, v string").withColumn(
        "seen", F.col("seen").cast("timestamp"))


BATCHES = [
    [(1, at(1), 1, "a"), (2, at(2), 1, "b"), (2, at(2), 1, "b"), (3, at(5), 2, "new")],
    [(3, at(5), 1, "older"), (2, at(2), 3, "late: before the mark"), (4, at(4), 1, "c"), (5, at(9), 1, "d")],
    [(4, at(8), 2, "c2"), (6, at(7, 1), 1, "e"), (None, at(9), 1, "no key"), (7, None, 1, "no time")],
]


def values(df):
    return sorted((r.id, r.ver, r.v) for r in df.collect())


def land(spark, landing, n):
    batch(spark, BATCHES[n]).coalesce(1).write.json(f"{landing}/n={n}")


def run(spark, table, landing, ckpt, schema):
    table.start(spark.readStream.schema(schema).json(landing), ckpt).awaitTermination()


@pytest.fixture()
def stream(spark, tmp_dir):
    table = EventTimeUpsert(spark, f"{tmp_dir}/t", ["id"], "seen", ["ver"], "2 days")
    schema = batch(spark, BATCHES[0]).schema
    for n in range(3):
        land(spark, f"{tmp_dir}/landing", n)
        run(spark, table, f"{tmp_dir}/landing", f"{tmp_dir}/ckpt", schema)
    return table, schema, tmp_dir


def test_late_repeated_and_out_of_order_rows(spark, stream):
    table, schema, _ = stream
    every = batch(spark, sum(BATCHES, []))
    assert values(table.read(schema, with_late=True).filter("seen is not null")) == values(
        latest_per_key(every.dropna(subset=["id", "seen"]), ["id"], ["ver"]))
    assert values(table.read(schema)) == [(1, 1, "a"), (2, 1, "b"), (3, 2, "new"), (4, 2, "c2"), (5, 1, "d"),
                                          (6, 1, "e")]
    late = {(r.id, r.v) for r in table.read_late(schema).collect()}
    assert late == {(2, "late: before the mark"), (None, "no key"), (7, "no time")}
    written = table._read("table", table._epochs("table"), schema)
    assert written.filter("v = 'older'").count() == 0       # outdated versions cost no write
    assert written.count() == 7


def test_state_is_bounded_by_the_watermark(spark, stream):
    table, schema, _ = stream
    assert str(table.watermark()) == "2024-01-07 00:00:00"
    kept = table.read_state(schema)
    assert sorted(r.id for r in kept.collect()) == [4, 5, 6]    # 1, 2, 3 fell behind
    assert kept.filter(F.col("seen") < F.lit("2024-01-07").cast("timestamp")).count() == 0


def test_an_epoch_run_again_changes_nothing(spark, stream):
    table, schema, base = stream
    before = values(table.read(schema)), sorted(r.id for r in table.read_state(schema).collect()), table.watermark()
    table.write_batch(batch(spark, BATCHES[2]), 2)           # the retry of the last epoch
    assert (values(table.read(schema)), sorted(r.id for r in table.read_state(schema).collect()), table.watermark()) == before
    run(spark, table, f"{base}/landing", f"{base}/ckpt", schema)         # restart with nothing new
    again = EventTimeUpsert(spark, f"{base}/t", ["id"], "seen", ["ver"], "2 days")
    batch(spark, [(5, at(10), 2, "d2")]).write.json(f"{base}/landing/n=9")
    run(spark, again, f"{base}/landing", f"{base}/ckpt", schema)
    assert (5, 2, "d2") in values(again.read(schema))
