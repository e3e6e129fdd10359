"""The mart on a hand-made fixture: one row per ride, rest days, load by calendar day."""
import datetime as dt
import json

from pacekit.plans import models as MD
from pacekit.sources import ingest as I

D = dt.date


def doc(i, day, np_=200, hr=150.0, t=3600, typ="VirtualRide"):
    return {"id": i, "start_date": f"{day}T07:00:00Z", "name": f"r{i}", "type": typ,
            "distance": 30000, "moving_time": t, "average_speed": 8.0, "average_watts": 190,
            "weighted_average_watts": np_, "average_heartrate": hr}


def fixture(spark):
    docs = [doc(1, "2024-01-02"), doc(2, "2024-01-05"), doc(3, "2024-01-05", np_=None),
            doc(4, "2024-01-09", hr=0.0), doc(5, "2024-01-10"), doc(6, "2024-01-10", typ="Run")]
    raw = spark.createDataFrame(
        [(1, d["id"], dt.datetime(2024, 2, 1), json.dumps(d)) for d in docs],
        "athlete_id bigint, activity_id bigint, extracted_at_utc timestamp, payload string")
    tests = spark.createDataFrame(
        [(10, 1, 200, 2.9, D(2024, 1, 1), "ramp"), (11, 1, 250, 3.6, D(2024, 1, 10), "ramp")],
        "ftp_id int, athlete_id bigint, ftp_watts int, ftp_wkg double, test_date date, test_type string")
    hist = spark.createDataFrame(
        [(1, "old", 180, D(2024, 1, 1)), (1, "new", 200, D(2024, 1, 8)), (2, "idle", 190, D(2024, 1, 1))],
        "athlete_id bigint, first_name string, max_hr int, added_at date")
    return raw, tests, hist


def test_mart_rows_and_load(spark):
    raw, tests, hist = fixture(spark)
    thr = MD.dim_threshold(tests)
    fact = MD.fact_activities(I.stage_activities(raw), thr, "current_only")
    rides = MD.rides_enriched(fact, thr, MD.power_zone_dim(thr), MD.hr_zone_dim(hist), "VirtualRide")
    mart = MD.mart(MD.latest_athletes(hist), rides, "2024-01-11").collect()
    a1 = [r for r in mart if r.athlete_id == 1]
    # 10 calendar days (01-02 .. 01-11); 01-05 has two rides -> two rows
    assert len(a1) == 11 and len([r for r in mart if r.athlete_id == 2]) == 10
    assert {r.athlete_name for r in a1} == {"new"}                 # newest athlete version
    rest = [r for r in a1 if r.ride_count == 0]
    assert len(rest) == 6 and all(r.activity_date is None and r.tss_total == 0.0 for r in rest)
    by_id = {r.activity_id: r for r in a1 if r.activity_id is not None}
    assert set(by_id) == {1, 2, 3, 4, 5}                           # the Run is not a ride
    # current-only threshold: only 01-10 rides (on/after the latest test) get TSS
    assert by_id[5].tss_total == 64.0 and by_id[1].tss_total == 0.0
    assert by_id[4].watts_per_bpm_wt is None                       # HR 0 -> no ratio
    assert by_id[3].efficiency_factor_wt is None                   # NP NULL -> no EF
    assert by_id[4].hr_zone_label is None                          # HR 0 is below every band
    # retest eve (01-09) has no as-of threshold: the HR fact drops it, the mart keeps the ride
    assert by_id[2].watts_per_bpm_wt == round(190 / 150, 2)
    day10 = [r for r in a1 if r.date == D(2024, 1, 10)][0]
    assert day10.tss_7d == 64.0 and day10.tss_28d == 64.0
    assert all(r.tss_28d >= r.tss_7d for r in mart)


def test_daily_grain_merges_same_day_rides(spark):
    raw, tests, hist = fixture(spark)
    thr = MD.dim_threshold(tests)
    rides = MD.rides_enriched(MD.fact_activities(I.stage_activities(raw), thr), thr,
                              MD.power_zone_dim(thr), MD.hr_zone_dim(hist), "VirtualRide")
    day = {r.activity_date: r for r in MD.daily_rollup(rides, "day").collect()}
    r = day[D(2024, 1, 5)]
    assert r.ride_count == 2 and r.duration_minutes == 120.0 and r.distance_km == 60.0
    # faithful weighted NP: the NULL NP keeps its weight in the denominator
    assert r.normalized_power_wt == 100.0
