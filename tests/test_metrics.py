import datetime as dt
import hashlib

from pyspark.sql import functions as F

from pacekit.functions import metrics as M


def one(spark, col, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_round_half_up_on_binary_ties(spark):
    got = one(spark, M.round_half_up("x", 2), "x double", [(1.005,), (2.675,), (-1.005,), (None,)])
    assert got == [1.01, 2.68, -1.01, None]


def test_tss_and_intensity_with_zero_or_null_threshold(spark):
    df = spark.createDataFrame([(3600, 200.0, 200), (3600, 200.0, 0), (3600, None, 200),
                                (1800, 150.0, None)], "t int, np double, ftp int")
    rows = df.select(M.training_stress("t", "np", "ftp").alias("tss"),
                     M.intensity_factor("np", "ftp").alias("if_")).collect()
    assert rows[0].tss == 100.0 and rows[0].if_ == 1.0
    assert rows[1].tss is None and rows[1].if_ is None
    assert rows[2].tss is None and rows[3].tss is None


def test_efficiency_ratios_guard_zero_hr_and_null_np(spark):
    df = spark.createDataFrame([(200.0, 210.0, 150.0), (200.0, 210.0, 0.0), (200.0, None, 150.0),
                                (200.0, 210.0, None)], "p double, np double, hr double")
    rows = df.select(M.watts_per_bpm("p", "hr").alias("w"),
                     M.efficiency_factor("np", "hr").alias("ef")).collect()
    assert (rows[0].w, rows[0].ef) == (1.33, 1.4)
    assert (rows[1].w, rows[1].ef) == (None, None)
    assert (rows[2].w, rows[2].ef) == (1.33, None)
    assert (rows[3].w, rows[3].ef) == (None, None)


def test_weighted_mean_faithful_vs_present_weights(spark):
    df = spark.createDataFrame([(1, 100.0, 60.0), (1, None, 30.0), (2, None, 0.0)],
                               "g int, x double, w double")
    rows = {r.g: r for r in df.groupBy("g").agg(
        M.weighted_mean("x", "w", 2).alias("faithful"),
        M.weighted_mean("x", "w", 2, skip_null_weight=True).alias("present")).collect()}
    assert rows[1].faithful == round(100 * 60 / 90, 2)
    assert rows[1].present == 100.0
    assert rows[2].faithful is None and rows[2].present is None   # zero weight -> NULL, no error


def test_surrogate_key_matches_md5_of_joined_text(spark):
    got = one(spark, M.surrogate_key("a", "d", "z"), "a bigint, d date, z int",
              [(7, dt.date(2024, 1, 2), 3), (7, None, 3)])
    assert got[0] == hashlib.md5(b"7-2024-01-02-3").hexdigest()
    assert got[1] == hashlib.md5(("7-" + M.SURROGATE_NULL + "-3").encode()).hexdigest()


def test_padded_names(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")
    r = df.select(M.padded_day_name("d").alias("a"), M.padded_month_name("d").alias("b")).first()
    assert r.a == "sunday   " and r.b == "january  "
    assert df.select(M.day_number(F.col("d"))).first()[0] == (dt.date(2024, 1, 7) - dt.date(1970, 1, 1)).days
