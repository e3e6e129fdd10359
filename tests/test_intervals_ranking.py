"""Time in bands over chunked intervals, and exact percent ranks, against plain Python."""
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pacekit.operators.intervals import intervals, next_in_chunks, time_in_bands
from pacekit.operators.ranking import percent_rank, prefix_sums

BANDS = [("low", 100.0, 120.0), ("mid", 120.0, 140.0), ("top", 140.0, None)]


def band_table(spark, ids):
    return spark.createDataFrame([(i, *b) for i in ids for b in BANDS], "id int, band string, low double, high double")


def plain(rows, cap):
    out = {}
    by = {}
    for i, t, n, v in rows:
        if t is not None:
            by.setdefault(i, []).append((t, n, v))
    for i, s in by.items():
        s.sort(key=lambda r: r[:2])
        for (t, _, v), (t2, _, v2) in zip(s, s[1:], strict=False):
            if v is None:
                continue
            gap = (t2 - t).total_seconds()
            a, b = v, v2 if gap <= cap and v2 is not None else v
            for name, low, high in BANDS:
                top = float("inf") if high is None else high
                lo, hi = min(a, b), max(a, b)
                share = (1.0 if low <= a < top else 0.0) if a == b else max(0.0, min(hi, top) - max(lo, low)) / (hi - lo)
                if share * min(gap, cap) >= 1e-6:
                    out[i, name] = out.get((i, name), 0) + share * min(gap, cap)
    return {k: round(v, 3) for k, v in out.items()}


def samples(spark, n=800):
    random.seed(4)
    start = datetime(2024, 1, 1)
    rows = []
    for k in range(n):
        i = 1 if k % 3 else 2
        rows.append((i, start + timedelta(seconds=random.choice([random.randint(0, 9000), 40_000 + 30 * k])), k,
                     random.choice([None, 90.0, 120.0, 140.0, random.uniform(95, 160)])))
    rows += [(3, start, 1, 130.0), (4, None, 1, 130.0), (None, start, 1, 130.0)]
    return rows, spark.createDataFrame(rows, "id int, t timestamp, n int, v double")


def test_time_in_bands_equals_the_plain_way(spark):
    rows, df = samples(spark)
    for chunk in (60, 600, 86_400):                          # edges of chunks change nothing
        spans = intervals(df, ["id"], "t", "v", ["n"], 300, chunk)
        got = time_in_bands(spans, band_table(spark, [1, 2, 3, 4]), ["id"], ["band"], "low", "high")
        have = {(r.id, r.band): round(r.seconds, 3) for r in got.collect()}
        want = plain([r for r in rows if r[0] is not None], 300)
        assert have.keys() == want.keys()
        assert all(abs(have[k] - want[k]) < 0.002 for k in want)


def test_a_long_ride_is_many_groups(spark):
    ride = spark.range(50_000).select(F.lit(1).alias("id"), F.expr("timestamp_seconds(1704067200 + id)").alias("t"),
                                      F.col("id").alias("n"), (F.col("id") % 50 + 100.0).alias("v"))
    spans = intervals(ride, ["id"], "t", "v", ["n"], 30, 3600)
    assert abs(spans.agg(F.sum("seconds")).first()[0] - 49_999) < 1e-6        # every second once
    p = next_in_chunks(ride, ["id"], "t", "v", ["n"], 3600)._jdf.queryExecution().executedPlan().toString()
    windows = [ln for ln in p.split("\n") if "Window [" in ln]
    assert len(windows) == 2 and sum("_chunk" in ln.split("windowspecdefinition")[1] for ln in windows) == 2
    spread = spans.groupBy(F.spark_partition_id()).count().count()
    assert spread > 1 or spans.rdd.getNumPartitions() == 1


def test_empty_samples(spark):
    _, df = samples(spark, 0)
    none = df.filter("false")
    assert intervals(none, ["id"], "t", "v", ["n"], 300).count() == 0


def test_percent_rank_equals_the_window(spark):
    random.seed(5)
    rows = [(g, random.choice([None, 0.5, 0.5, float(random.randint(0, 40))])) for g in (1, 2, 3) for _ in range(150)]
    rows += [(7, 1.0), (8, None)] + [(9, 2.0)] * 300        # one row, only null, one value with all rows
    df = spark.createDataFrame(rows, "g int, x double").withColumn("k", F.monotonically_increasing_id())
    got = {r.k: r.percent_rank for r in percent_rank(df, "x", ["g"]).collect()}
    want = {r.k: r.p for r in df.selectExpr(
        "k", "case when x is not null then percent_rank() over (partition by g, x is null order by x) end as p").collect()}
    assert got == want
    got = {r.k: r.percent_rank for r in percent_rank(df, "x").collect()}
    want = {r.k: r.p for r in df.selectExpr(
        "k", "case when x is not null then percent_rank() over (partition by x is null order by x) end as p").collect()}
    assert got == want


def test_prefix_sums(spark):
    df = spark.createDataFrame([(f"k{i:03d}", i) for i in range(500)] + [(None, 1000)], "k string, w long")
    got = [(r.k, r.before) for r in prefix_sums(df, ["k"], "w").orderBy(F.col("k").asc_nulls_first()).collect()]
    total, want = 0, []
    for k, w in [(None, 1000)] + [(f"k{i:03d}", i) for i in range(500)]:
        want.append((k, total))
        total += w
    assert got == want
