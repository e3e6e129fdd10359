import datetime as dt
import random

from pyspark.sql import functions as F

from pacekit.operators.calendar import date_dim, densify, spine
from pacekit.operators.rolling import load_ratio, rolling_sums

D = dt.date


def bounds(spark, s, e):
    return spark.createDataFrame([(D(*s), D(*e))], "start date, end date")


def test_date_dim_end_exclusive_and_iso_edges(spark):
    cal = date_dim(bounds(spark, (2025, 1, 1), (2030, 12, 31)))
    assert cal.count() == 2190
    rows = {r.date_id: r for r in cal.filter(F.col("date_id").isin(
        D(2027, 1, 1), D(2028, 2, 29), D(2025, 1, 4))).collect()}
    r = rows[D(2027, 1, 1)]
    assert (r.week_of_year, r.year, r.iso_year, r.day_of_week, r.day_of_week_num) == \
        (53, 2027, 2026, "friday   ", 5)
    assert rows[D(2028, 2, 29)].month_name == "february "
    assert rows[D(2025, 1, 4)].is_weekend and not r.is_weekend
    assert cal.agg(F.max("date_id")).first()[0] == D(2030, 12, 30)


def test_densify_keeps_entities_without_facts(spark):
    ent = spark.createDataFrame([(1,), (2,)], "athlete_id bigint")
    facts = spark.createDataFrame([(1, D(2024, 1, 2), 5.0), (1, D(2024, 1, 9), 1.0)],
                                  "athlete_id bigint, activity_date date, tss double")
    d = densify(ent, facts, ["athlete_id"], "2024-01-01", "2024-01-03", "activity_date")
    rows = sorted((r.athlete_id, r.date, r.tss) for r in d.collect())
    assert len(rows) == 6 and (1, D(2024, 1, 2), 5.0) in rows and (2, D(2024, 1, 2), None) in rows
    assert spine(ent, ["athlete_id"], F.lit(None).cast("date"), "2024-01-03").count() == 0


def test_rolling_sums_match_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for a in (1, 2):
        for k in range(60):
            day = D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(0, 50))
            rows.append((a, day, round(rnd.uniform(0, 100), 2)))
    df = spark.createDataFrame(rows, "athlete_id bigint, day date, v double")
    got = {(r.athlete_id, r.day, r.v): (r.s7, r.s28) for r in rolling_sums(
        df, ["athlete_id"], "day", "v", {"s7": 7, "s28": 28}).collect()}
    for a, day, v in rows:
        exp7 = sum(x for b, d2, x in rows if b == a and 0 <= (day - d2).days < 7)
        exp28 = sum(x for b, d2, x in rows if b == a and 0 <= (day - d2).days < 28)
        s7, s28 = got[(a, day, v)]
        assert abs(s7 - exp7) < 1e-6 and abs(s28 - exp28) < 1e-6


def test_load_ratio_labels(spark):
    df = spark.createDataFrame([(70.0, 140.0), (10.0, 280.0), (20.0, 80.0), (0.0, 0.0)],
                               "s double, l double")
    ratio, label = load_ratio("s", "l")
    got = [(r[0], r[1]) for r in df.select(ratio, label).collect()]
    assert got == [(2.0, "over"), (0.143, "under"), (1.0, "optimal"), (None, "no_load")]


def test_generated_days_are_dealt_in_proportion_to_them(spark):
    """Shuffled bytes say nothing of the days made after the shuffle: tasks follow entities x days."""
    from pacekit.operators.calendar import dealt

    ent = spark.range(0, 3000, 1, 4).select(F.col("id").alias("athlete_id"))
    first, last = D(2024, 1, 1), D(2024, 1, 30)
    cores = spark.sparkContext.defaultParallelism
    assert dealt(ent, first, last, rows=3000) == 30 and dealt(ent, first, last) == cores
    assert dealt(ent, None, last) == dealt(ent, D(2024, 2, 2), last) == cores        # no days
    facts = spark.createDataFrame([(1, D(2024, 1, 5), 2.0), (7, D(2024, 1, 9), 1.0)],
                                  "athlete_id bigint, day date, v double")
    whole = densify(ent, facts, ["athlete_id"], "2024-01-01", "2024-01-30", "day")
    parts = densify(ent, facts, ["athlete_id"], "2024-01-01", "2024-01-30", "day", partitions=30)
    sizes = [r["n"] for r in parts.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 30 and max(sizes) < 3 * 3000
    assert sorted(parts.collect(), key=str) == sorted(whole.collect(), key=str)
