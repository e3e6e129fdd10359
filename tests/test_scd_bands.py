import datetime as dt

from pyspark.sql import functions as F

from pacekit.operators.bands import band_join, make_bands
from pacekit.operators.scd import interval_join, retest_gap, scd2
from pacekit.plans import models as MD

D = dt.date


def threshold_rows(spark):
    return spark.createDataFrame(
        [(1, 10, 200, D(2024, 1, 3)), (2, 10, 220, D(2024, 1, 17)),
         (3, 20, 0, D(2024, 1, 5)),
         (4, 30, 250, D(2024, 1, 10)), (5, 30, 260, D(2024, 1, 10))],   # two tests one day
        "ftp_id int, athlete_id bigint, ftp_watts int, test_date date")


def test_scd2_offsets_and_tie_break(spark):
    d = {r.ftp_id: r for r in scd2(threshold_rows(spark), ["athlete_id"], "test_date",
                                   tiebreak=["ftp_id"], end_offset_days=1).collect()}
    assert d[1].valid_to == D(2024, 1, 16) and not d[1].is_current
    assert d[2].valid_to is None and d[2].is_current
    assert d[4].valid_to == D(2024, 1, 9) and d[5].is_current     # same day: id breaks the tie
    e = {r.ftp_id: r for r in scd2(threshold_rows(spark), ["athlete_id"], "test_date",
                                   tiebreak=["ftp_id"], end_offset_days=0).collect()}
    assert e[1].valid_to == D(2024, 1, 17)


def acts(spark):
    return spark.createDataFrame(
        [(100, 10, D(2024, 1, 2)), (101, 10, D(2024, 1, 3)), (102, 10, D(2024, 1, 16)),
         (103, 10, D(2024, 1, 17)), (104, 10, D(2024, 2, 29)), (105, 99, D(2024, 1, 20))],
        "activity_id bigint, athlete_id bigint, activity_date date")


def test_interval_join_modes(spark):
    thr = scd2(threshold_rows(spark), ["athlete_id"], "test_date", tiebreak=["ftp_id"], end_offset_days=1)
    asof = {r.activity_id: r.ftp_id for r in interval_join(
        acts(spark), thr, ["athlete_id"], "activity_date", ["ftp_id"], how="left").collect()}
    assert asof == {100: None, 101: 1, 102: None, 103: 2, 104: 2, 105: None}   # 102: retest eve
    incl = {r.activity_id: r.ftp_id for r in interval_join(
        acts(spark), thr, ["athlete_id"], "activity_date", ["ftp_id"], how="left",
        end="inclusive").collect()}
    assert incl[102] == 1
    cur = {r.activity_id: r.ftp_id for r in interval_join(
        acts(spark), thr, ["athlete_id"], "activity_date", ["ftp_id"], how="left",
        current_only=True).collect()}
    assert cur == {100: None, 101: None, 102: None, 103: 2, 104: 2, 105: None}
    gap = [r.activity_id for r in retest_gap(acts(spark), thr, ["athlete_id"], "activity_date").collect()]
    assert gap == [102]


def test_power_band_bounds_are_floored_and_contiguous(spark):
    z = MD.power_zone_dim(spark.createDataFrame([(1, 10, 201)], "ftp_id int, athlete_id bigint, ftp_watts int"))
    rows = sorted((r.zone_number, r.watts_low, r.watts_high) for r in z.collect())
    assert rows == [(1, 0, 110), (2, 110, 150), (3, 150, 180), (4, 180, 2007)]


def test_keyed_band_join_edges(spark):
    hist = spark.createDataFrame([(10, 200, D(2024, 1, 1))], "athlete_id bigint, max_hr int, added_at date")
    z = MD.hr_zone_dim(hist)   # bounds 100/120/140/160/200
    f = spark.createDataFrame([(1, 10, 100.0), (2, 10, 119.9), (3, 10, 120.0), (4, 10, 99.0),
                               (5, 10, 200.0), (6, 10, 0.0), (7, 11, 130.0)],
                              "activity_id bigint, athlete_id bigint, avg_hr double")
    got = {r.activity_id: r.zone_number for r in band_join(
        f, z, "avg_hr", ["zone_number"], keys=["athlete_id"], low="bpm_low", high="bpm_high").collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: None, 5: None, 6: None, 7: None}


def test_unkeyed_band_join_is_exact_for_any_bucket_count(spark):
    ref = spark.createDataFrame([(190,)], "reference_bpm int")
    bands = make_bands(ref, MD.HR_ZONES, MD.HR_TYPES, "reference_bpm", "hr_pct_low", "hr_pct_high",
                       "bpm_low", "bpm_high")
    f = spark.range(0, 500).selectExpr("id AS activity_id", "CAST(id * 0.5 AS DOUBLE) AS avg_hr")
    want = {}
    for r in f.collect():
        hit = [b.zone_number for b in bands.collect() if b.bpm_low <= r.avg_hr < b.bpm_high]
        want[r.activity_id] = hit[0] if hit else None
    for n in (1, 7, 1024):
        got = band_join(f, bands, "avg_hr", ["zone_number"], low="bpm_low", high="bpm_high", buckets=n)
        assert {r.activity_id: r.zone_number for r in got.collect()} == want
    open_top = spark.createDataFrame([(1, 0, 10), (2, 10, None)], "z int, low int, high int")
    v = spark.createDataFrame([(-1.0,), (0.0,), (9.9,), (10.0,), (1e9,), (None,)], "v double")
    got = band_join(v, open_top, "v", ["z"], open_upper=True).collect()
    assert sorted([(r.v, r.z) for r in got if r.v is not None]) == [(-1.0, None), (0.0, 1), (9.9, 1), (10.0, 2), (1e9, 2)]
    closed = band_join(v, open_top.filter("z = 1"), "v", ["z"], closed_high=True).collect()
    assert {r.v for r in closed if r.z == 1} == {0.0, 9.9, 10.0}


def test_folded_lookup_keeps_every_match_of_the_join(spark):
    """Overlapping versions: same rows as the plain join on key and condition."""
    dim = spark.createDataFrame([(1, "a", 0, 10), (1, "b", 5, 20), (2, "c", 0, None)],
                                "k int, name string, low int, high int")
    f = spark.createDataFrame([(1, 7.0), (1, 2.0), (1, 50.0), (2, 99.0), (3, 1.0), (None, 1.0)], "k int, v double")
    for how in ("left", "inner"):
        got = band_join(f, dim, "v", ["name"], keys=["k"], how=how, open_upper=True)
        x, y = f.alias("x"), dim.alias("y")
        plain = x.join(y, F.expr("x.k = y.k and x.v >= y.low and (y.high is null or x.v < y.high)"), how)
        key = lambda r: str(tuple(r))
        assert sorted(got.collect(), key=key) == sorted(plain.select("x.*", "y.name").collect(), key=key)


def test_hot_athlete_partitions_are_split(spark):
    """A third of the rides on one athlete: AQE splits the one join of the ride stream."""
    keep = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(keep, ("-1", "32k", "48k", "2", "8", "false"), strict=True):
        spark.conf.set(k, v)
    try:
        thr = scd2(threshold_rows(spark), ["athlete_id"], "test_date", tiebreak=["ftp_id"], end_offset_days=1)
        f = spark.range(0, 60_000, 1, 8).selectExpr(
            "id AS activity_id", "CASE WHEN id % 3 = 0 THEN 10 ELSE id % 997 END AS athlete_id",
            "DATE '2024-01-20' AS activity_date", "uuid() AS pad")
        j = interval_join(f, thr, ["athlete_id"], "activity_date", ["ftp_id"], how="left")
        j = j.withColumn("_p", F.spark_partition_id())
        sizes = [r["n"] for r in j.groupBy("_p").agg(F.count(F.lit(1)).alias("n"), F.max("pad")).collect()]
        assert sum(sizes) == 60_000
        assert max(sizes) < 20_000          # the hot athlete alone has 20,000 rows
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_a_folded_dimension_is_never_broadcast(spark):
    """Its size before it runs is guessed from the scan: many entities would be held by every executor."""
    thr = spark.range(0, 1000).selectExpr("id AS athlete_id", "CAST(id AS int) AS ftp_id", "200 AS ftp_watts")
    f = spark.range(0, 2000).selectExpr("id AS activity_id", "CAST(id % 1000 AS int) AS ftp_id", "150.0D AS np")
    j = band_join(f, MD.power_zone_dim(thr), "np", ["zone_number"], keys=["ftp_id"], how="inner",
                  low="watts_low", high="watts_high", open_upper=True)
    assert {r.zone_number for r in j.collect()} == {3} and j.count() == 2000
    p = j._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in p and "Broadcast" not in p
