"""Incremental rolling sums: daily batches equal one full run, and touch only what they must."""
import random

from pyspark.sql import functions as F

from pacekit.operators.rolling import rolling_sums
from pacekit.operators.rolling_state import RollingState

SPANS = {"s3": 3, "s7": 7}


def rows(df):
    return sorted(tuple(r) for r in df.select("e", "d", "v", "s3", "s7").collect())


def frame(spark, days):
    return spark.createDataFrame(days, "e int, n int, v double").select(
        "e", F.expr("date_add(date'2024-01-25', n)").alias("d"), "v")


def test_daily_batches_equal_one_run(spark, tmp_dir):
    random.seed(2)
    days = [(e, n, float(random.randint(0, 99))) for n in range(6) for e in range(5) if random.random() < .7]
    state = RollingState(spark, f"{tmp_dir}/r", ["e"], "d", "v", SPANS)
    for n in range(6):                                       # over the end of a month
        state.apply(frame(spark, [r for r in days if r[1] == n]))
    want = rows(rolling_sums(frame(spark, days), ["e"], "d", "v", SPANS))
    assert rows(state.read()) == want
    assert state.apply(frame(spark, [])) == {"totals": 0, "sums": 0}
    # a late correction of one athlete: its later days follow, the others are not written
    got = state.apply(frame(spark, [(1, 0, 1000.0)]))
    days = [r for r in days if r[:2] != (1, 0)] + [(1, 0, 1000.0)]
    assert rows(state.read()) == rows(rolling_sums(frame(spark, days), ["e"], "d", "v", SPANS))
    assert got["sums"] == sum(1 for r in days if r[0] == 1)
