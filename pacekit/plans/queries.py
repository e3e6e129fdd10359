"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They read the driver tables through the adapters in ``analog`` and run the
library operators over the whole tables. Output columns are aliased and
typed exactly like the matching SQL in ``pacekit.oracle``.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacekit.functions import metrics as M
from pacekit.operators import quality as Q
from pacekit.operators.anomaly import anomaly_flags
from pacekit.operators.asof import merge_asof
from pacekit.operators.bands import band_join, make_bands
from pacekit.operators.intervals import intervals, time_in_bands
from pacekit.operators.lookup import lookup
from pacekit.operators.ranking import percent_rank
from pacekit.operators.rolling import load_ratio, rolling_sums
from pacekit.operators.scd import interval_join, retest_gap, scd2
from pacekit.operators.upsert import latest_per_key, upsert
from pacekit.plans import analog as A
from pacekit.plans import landing as L
from pacekit.plans import marts as D
from pacekit.plans import models as MD
from pacekit.session import scratch_dir, utc_session
from pacekit.sources import ingest as I
from pacekit.sources.catalog_table import CatalogTable
from pacekit.sources.literals import literal_row, values_relation
from pacekit.sources.secured_view import declare_viewer, secured_view, set_viewer
from pacekit.sources.sinks import materialize


class Inputs:
    """The lazy inputs of one query: nothing is stored, counted or shared between queries.

    ``raw`` is the landing table (JSON documents derived from ``events``); the
    queries about ingestion parse it, and so do the flagship and the mart
    (``landed=True``). The other models read the same activities as typed
    columns (``analog.staged_activities``), so each query scans just the
    columns it needs; their times exclude staging.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, landed: bool = False):
        self.spark, self.sf_dir, self.landed = spark, sf_dir, landed

    def t(self, name: str) -> DataFrame:
        return A.table(self.spark, self.sf_dir, name)

    @cached_property
    def events(self):
        return A.spread(self.t("events"), "event_id")

    @cached_property
    def raw(self):
        return A.landed_activities(self.events)

    @cached_property
    def dirty(self):
        return A.dirty_activities(self.events)

    def parse(self):
        return I.stage_activities(self.raw, A.MIN_START)

    @cached_property
    def staged(self):
        return self.parse() if self.landed else A.staged_activities(self.events)

    @cached_property
    def tests(self):
        return A.threshold_tests(self.t("customer"))

    @cached_property
    def thresholds(self):
        return MD.dim_threshold(self.tests)

    @cached_property
    def history(self):
        return A.athlete_history(self.t("customer"))

    @cached_property
    def athletes(self):
        return MD.latest_athletes(self.history)

    @cached_property
    def hr_zones(self):
        return MD.hr_zone_dim(self.history)

    @cached_property
    def power_zones(self):
        return MD.power_zone_dim(self.thresholds)

    @cached_property
    def fact(self):
        return MD.fact_activities(self.staged, self.thresholds, "current_only")

    @cached_property
    def rides(self):
        return MD.staged_rides(self.staged, self.thresholds, self.power_zones, self.hr_zones,
                               A.RIDE_TYPE)

    @cached_property
    def daily_day(self):
        return MD.daily_rollup(self.rides, "day")

    @cached_property
    def daily_activity(self):
        return MD.daily_rollup(self.rides, "activity")

    def stored(self, daily: DataFrame) -> DataFrame:
        """A daily rollup written once: what follows reads it several times, the rides are
        parsed and looked up once."""
        return materialize(self.spark, daily, "daily")


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


# ------------------------------------------------------------------ staging

def stage_json_typed(spark, sf_dir):
    s = Inputs(spark, sf_dir).parse()
    return s.select(*[_ntz(c) if c in ("start_date_utc", "extracted_at_utc") else F.col(c)
                      for c in s.columns])


def parse_audit(spark, sf_dir):
    return I.parse_audit(Inputs(spark, sf_dir).dirty)


def stage_rejects(spark, sf_dir):
    return I.stage_rejects(Inputs(spark, sf_dir).dirty)


def stage_dirty_rows(spark, sf_dir):
    """The rows that staging keeps of a landing table with bad values."""
    s = I.stage_activities(Inputs(spark, sf_dir).dirty, "2024-01-10")
    return s.select("activity_id", "athlete_id", _ntz("start_date_utc"), "moving_time_s")


DECIMAL_DOC = T.StructType([T.StructField(f.name, T.DecimalType(20, 6) if f.dataType == T.DoubleType() else f.dataType)
                            for f in I.ACTIVITY_DOC.fields])


def stage_json_decimal(spark, sf_dir):
    """Payload numbers as DECIMAL(20,6)."""
    s = I.stage_activities(Inputs(spark, sf_dir).raw, A.MIN_START, DECIMAL_DOC)
    return s.select("activity_id", *[F.col(c).cast("double").alias(c) for c in
                                     ("distance_m", "elevation_m", "avg_power_w", "kilojoules", "avg_hr")])


def serialize_nulls(spark, sf_dir):
    """Records as JSON text, null fields written out."""
    e = A.table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(eid.alias("activity_id"), I.serialize_record(
        eid.alias("id"), F.col("event_type").alias("type"),
        F.when(eid % 11 != 0, 105 + (eid * 7) % 120).alias("np")).alias("payload"))


def ride_projection(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    r = x.staged.filter(F.col("activity_type") == A.RIDE_TYPE)
    a = x.athletes.select("athlete_id", F.col("first_name").alias("athlete_name"))
    j = lookup(r, a, ["athlete_id"])
    return j.select(
        "activity_id", "athlete_id", "athlete_name",
        F.col("start_date_utc").cast("date").alias("activity_date"),
        "activity_name", "distance_km", "moving_time_min", "avg_speed_kmh",
        ((F.col("distance_km") >= 25) & (F.col("moving_time_min") > 30)).alias("is_long_ride"))


# ------------------------------------------------------------------ dimensions

def dim_date(spark, sf_dir):
    return MD.date_dim_between(A.table(spark, sf_dir, "orders"), "o_orderdate")


def inline_values_bands(spark, sf_dir):
    t = Inputs(spark, sf_dir).tests
    return t.select("ftp_id", "athlete_id", "ftp_watts", "ftp_wkg", "test_date", "test_type",
                    F.lit(None).cast("string").alias("test_notes"),
                    F.lit("customer").alias("source"))


def scd2_threshold(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    d = MD.dim_threshold(x.tests, run_ts=A.RUN_TS)
    d = scd2(d, ["athlete_id"], "test_date", tiebreak=["ftp_id"], end_offset_days=0,
             from_col="_vf", to_col="valid_to_exclusive", current_col=None).drop("_vf")
    return d


def power_bands(spark, sf_dir):
    z = MD.power_zone_dim(MD.dim_threshold(Inputs(spark, sf_dir).tests))
    return z.withColumn("ftp_pct_low", F.col("ftp_pct_low").cast("double")) \
            .withColumn("ftp_pct_high", F.col("ftp_pct_high").cast("double"))


def hr_bands_surrogate_key(spark, sf_dir):
    z = MD.hr_zone_dim(Inputs(spark, sf_dir).history)
    return z.withColumn("hr_pct_low", F.col("hr_pct_low").cast("double")) \
            .withColumn("hr_pct_high", F.col("hr_pct_high").cast("double"))


# ------------------------------------------------------------------ facts

def fact_current_threshold(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return MD.fact_activities(x.staged, x.thresholds, "current_only", run_ts=A.RUN_TS)


def fact_as_of_threshold(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    s = x.staged.select("activity_id", "athlete_id",
                        F.col("start_date_utc").cast("date").alias("activity_date"))
    return interval_join(s, x.thresholds, ["athlete_id"], "activity_date",
                         ["ftp_id", "ftp_watts"], how="inner", end="exclusive")


def fact_as_of_inclusive(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    s = x.staged.select("activity_id", "athlete_id",
                        F.col("start_date_utc").cast("date").alias("activity_date"))
    return interval_join(s, x.thresholds, ["athlete_id"], "activity_date",
                         ["ftp_id", "ftp_watts"], how="left", end="inclusive")


def retest_gap_rows(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    s = x.staged.select("activity_id", "athlete_id",
                        F.col("start_date_utc").cast("date").alias("activity_date"))
    return retest_gap(s, x.thresholds, ["athlete_id"], "activity_date")


def power_zone_match(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return MD.fact_power_zone(x.fact, x.power_zones)


def hr_efficiency_keyed(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return MD.fact_hr_efficiency(x.fact, x.thresholds, x.hr_zones)


def hr_band_theta(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    ref = x.history.agg(F.max("max_hr").alias("reference_bpm"))
    bands = make_bands(ref, MD.HR_ZONES, MD.HR_TYPES, "reference_bpm", "hr_pct_low",
                       "hr_pct_high", "bpm_low", "bpm_high")
    return MD.hr_band_theta(x.fact, bands)


# ------------------------------------------------------------------ aggregation

def weighted_means(spark, sf_dir):
    r = Inputs(spark, sf_dir).rides
    dur = "duration_minutes"
    out = r.groupBy("athlete_id", "activity_date").agg(
        F.count(F.lit(1)).alias("ride_count"),
        M.weighted_mean("avg_speed_kmh", dur, 2).alias("avg_speed_kmh_wt"),
        M.weighted_mean("avg_power_w", dur, 0).alias("avg_power_w_wt"),
        M.weighted_mean("normalized_power", dur, 0).alias("np_wt"),
        M.weighted_mean("normalized_power", dur, 0, skip_null_weight=True).alias("np_wt_present"),
        M.weighted_mean("avg_hr", dur, 0).alias("hr_wt"),
        M.weighted_mean("avg_hr", dur, 0, skip_null_weight=True).alias("hr_wt_present"),
        M.weighted_mean("watts_per_bpm", dur, 2).alias("wpb_wt"),
        M.weighted_mean("watts_per_bpm", dur, 2, skip_null_weight=True).alias("wpb_wt_present"),
        M.weighted_mean("efficiency_factor", dur, 3).alias("ef_wt"),
        M.weighted_mean("efficiency_factor", dur, 3, skip_null_weight=True).alias("ef_wt_present"),
        M.round_half_up(F.avg(F.col("intensity_factor").cast("decimal(20,6)")), 3)
         .alias("intensity_factor_avg"))
    return out


def daily_by_activity(spark, sf_dir):
    return Inputs(spark, sf_dir).daily_activity


def daily(spark, sf_dir):
    return Inputs(spark, sf_dir).daily_day


def densified_daily(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return MD.densified(x.athletes, x.stored(x.daily_day), A.AS_OF)


def rolling_load_7_28(spark, sf_dir, landed=False):
    x = Inputs(spark, sf_dir, landed)
    load = x.stored(x.daily_day.select("athlete_id", "activity_date", "tss_total"))
    d = MD.dense_days(x.athletes, load, A.AS_OF).select(
        "athlete_id", "date", F.coalesce(F.col("tss_total"), F.lit(0.0)).alias("tss_total"))
    return rolling_sums(d, ["athlete_id"], "date", "tss_total", MD.LOAD_SPANS)


def rolling_orders_range(spark, sf_dir):
    o = A.table(spark, sf_dir, "orders")
    day = (o.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("order_date"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.sum(F.col("o_totalprice").cast("decimal(38,2)")).alias("day_total")))
    out = rolling_sums(day, ["o_custkey"], "order_date", "day_total",
                       {"total_7d": 7, "total_28d": 28}, decimal_scale=2)
    return out.withColumn("day_total", F.col("day_total").cast("double"))


def load_ratio_label(spark, sf_dir):
    r = rolling_load_7_28(spark, sf_dir, landed=True)
    ratio, label = load_ratio("tss_7d", "tss_28d")
    return r.select("athlete_id", "date", "tss_7d", "tss_28d", ratio.alias("acwr"),
                    label.alias("load_label"))


def zone_share(spark, sf_dir):
    return D.zone_share(Inputs(spark, sf_dir).rides, "power_zone_label")


def hr_zone_share(spark, sf_dir):
    return D.zone_share(Inputs(spark, sf_dir).rides, "hr_zone_label")


def monthly_summary(spark, sf_dir):
    return D.monthly_summary(Inputs(spark, sf_dir).rides)


def recent_log(spark, sf_dir):
    r = Inputs(spark, sf_dir).rides
    top = D.top_k_per_group(r, ["athlete_id"],
                            [F.col("activity_date").desc(), F.col("activity_id").desc()], 10)
    return top.select("athlete_id", "rank", "activity_id", "activity_date", "activity_name",
                      "distance_km", "duration_minutes", "tss", "power_zone_label",
                      "hr_zone_label", "watts_per_bpm")


def efficiency_trend(spark, sf_dir):
    return D.efficiency_trend(Inputs(spark, sf_dir).rides)


# ------------------------------------------------------------------ mart + quality

def mart_full(spark, sf_dir):
    x = Inputs(spark, sf_dir, landed=True)
    return MD.mart(x.athletes, x.rides, A.AS_OF, daily=x.stored(x.daily_activity))


def _stored_mart(spark, sf_dir, *columns: str) -> DataFrame:
    """The mart (or some columns of it) as a stored table, for checks that read it several times."""
    m = mart_full(spark, sf_dir)
    return materialize(spark, m.select(*columns) if columns else m, "mart")


# The declared tests of the daily mart (limits, labels, expressions).
MART_CHECKS = [
    {"name": "athlete_id_not_null", "kind": "not_null", "column": "athlete_id"},
    {"name": "ride_count_values", "kind": "accepted_values", "column": "ride_count", "values": [0, 1]},
    {"name": "distance_km_not_null", "kind": "not_null", "column": "distance_km"},
    {"name": "distance_km_range", "kind": "accepted_range", "column": "distance_km", "min": 0, "max": 300},
    {"name": "duration_minutes_not_null", "kind": "not_null", "column": "duration_minutes"},
    {"name": "duration_minutes_range", "kind": "accepted_range", "column": "duration_minutes", "min": 0, "max": 360},
    {"name": "avg_speed_range", "kind": "accepted_range", "column": "avg_speed_kmh_wt", "min": 0, "max": 60, "where": "ride_count > 0"},
    {"name": "avg_power_range", "kind": "accepted_range", "column": "avg_power_w_wt", "min": 0, "max": 500, "where": "ride_count > 0"},
    {"name": "normalized_power_range", "kind": "accepted_range", "column": "normalized_power_wt", "min": 0, "max": 500, "where": "ride_count > 0"},
    {"name": "avg_hr_range", "kind": "accepted_range", "column": "avg_hr_bpm_wt", "min": 60, "max": 220, "where": "ride_count > 0"},
    {"name": "power_zone_label_values", "kind": "accepted_values", "column": "power_zone_label", "values": ["Z1", "Z2", "Z3", "Z4"], "where": "ride_count > 0"},
    {"name": "hr_zone_label_values", "kind": "accepted_values", "column": "hr_zone_label", "values": ["Z1", "Z2", "Z3", "Z4"], "where": "ride_count > 0"},
    {"name": "watts_per_bpm_range", "kind": "accepted_range", "column": "watts_per_bpm_wt", "min": 0, "max": 5, "where": "ride_count > 0 and watts_per_bpm_wt is not null"},
    {"name": "efficiency_factor_range", "kind": "accepted_range", "column": "efficiency_factor_wt", "min": 0, "max": 3, "where": "ride_count > 0 and efficiency_factor_wt is not null"},
    {"name": "tss_total_not_null", "kind": "not_null", "column": "tss_total"},
    {"name": "tss_total_range", "kind": "accepted_range", "column": "tss_total", "min": 0, "max": 500},
    {"name": "intensity_factor_range", "kind": "accepted_range", "column": "intensity_factor_avg", "min": 0, "max": 2, "where": "ride_count > 0 and intensity_factor_avg is not null"},
    {"name": "is_high_hr_zone_not_null", "kind": "not_null", "column": "is_high_hr_zone"},
    {"name": "is_high_hr_zone_values", "kind": "accepted_values", "column": "is_high_hr_zone", "values": [0, 1]},
    {"name": "is_high_power_zone_not_null", "kind": "not_null", "column": "is_high_power_zone"},
    {"name": "is_high_power_zone_values", "kind": "accepted_values", "column": "is_high_power_zone", "values": [0, 1]},
    {"name": "tss_7d_not_null", "kind": "not_null", "column": "tss_7d"},
    {"name": "tss_7d_range", "kind": "accepted_range", "column": "tss_7d", "min": 0, "max": 3500},
    {"name": "tss_28d_not_null", "kind": "not_null", "column": "tss_28d"},
    {"name": "tss_28d_range", "kind": "accepted_range", "column": "tss_28d", "min": 0, "max": 14000},
    {"name": "unique_athlete_activity_date", "kind": "unique", "columns": ["athlete_id", "activity_date"]},
    {"name": "unique_athlete_date_activity", "kind": "unique", "columns": ["athlete_id", "date", "activity_id"]},
    {"name": "ride_has_distance", "kind": "expression", "expr": "ride_count = 0 OR distance_km > 0", "severity": "warn"},
    {"name": "ride_has_duration", "kind": "expression", "expr": "ride_count = 0 OR duration_minutes > 0", "severity": "warn"},
    {"name": "chronic_ge_acute", "kind": "expression", "expr": "tss_28d >= tss_7d", "severity": "warn"},
    {"name": "efficiency_factor_positive", "kind": "expression", "expr": "efficiency_factor_wt IS NULL OR efficiency_factor_wt > 0", "severity": "error"},
]


def quality_report(spark, sf_dir):
    return Q.quality_report(_stored_mart(spark, sf_dir), MART_CHECKS)


# The mart's declared contract: column types and the declared primary key.
MART_CONTRACT = {
    "athlete_id": "bigint", "athlete_name": "string", "date": "date", "activity_id": "bigint",
    "activity_name": "string", "activity_date": "date", "ride_count": "bigint",
    "distance_km": "double", "duration_minutes": "double", "avg_speed_kmh_wt": "double",
    "avg_power_w_wt": "double", "normalized_power_wt": "double", "avg_hr_bpm_wt": "double",
    "power_zone_label": "string", "power_zone_name": "string", "power_zone_benefit": "string",
    "hr_zone_label": "string", "hr_zone_name": "string", "hr_zone_benefit": "string",
    "watts_per_bpm_wt": "double", "efficiency_factor_wt": "double", "tss_total": "double",
    "intensity_factor_avg": "double", "is_high_hr_zone": "int", "is_high_power_zone": "int",
    "tss_7d": "double", "tss_28d": "double",
}
MART_PRIMARY_KEY = ["athlete_id", "activity_date", "activity_id"]


def mart_contract(spark, sf_dir):
    return Q.contract_report(_stored_mart(spark, sf_dir), MART_CONTRACT, MART_PRIMARY_KEY)


def duplicate_keys(spark, sf_dir):
    return Q.duplicate_keys(_stored_mart(spark, sf_dir, "athlete_id", "activity_date"),
                            ["athlete_id", "activity_date"])


def orphan_entities(spark, sf_dir):
    """Referential checks; rides are first counted per athlete (partial aggregation),
    so the anti joins see one row per athlete, never a hot athlete's rides."""
    x = Inputs(spark, sf_dir)
    per_athlete = (x.fact.filter(F.col("activity_type") == A.RIDE_TYPE)
                   .groupBy("athlete_id").agg(F.count(F.lit(1)).alias("rides")))
    orphan_rides = per_athlete.join(x.athletes, "athlete_id", "left_anti").agg(
        F.coalesce(F.sum("rides"), F.lit(0)).alias("n"))
    idle = x.athletes.join(per_athlete, "athlete_id", "left_anti").agg(
        F.count(F.lit(1)).alias("n"))
    no_threshold = x.athletes.join(x.thresholds, "athlete_id", "left_anti").agg(
        F.count(F.lit(1)).alias("n"))
    return (orphan_rides.select(F.lit("rides_without_athlete").alias("check_name"), "n")
            .unionByName(idle.select(F.lit("athletes_without_rides").alias("check_name"), "n"))
            .unionByName(no_threshold.select(F.lit("athletes_without_threshold")
                                             .alias("check_name"), "n")))


# ------------------------------------------------------------------ upsert / ingest

def _event_rows(spark, sf_dir):
    return A.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type",
                                                   "value")


def upsert_latest_wins(spark, sf_dir):
    ev = _event_rows(spark, sf_dir)
    first = ev.filter(F.col("event_type").isin("view", "signup", "error"))
    batch = ev.filter(F.col("event_type").isin("purchase", "click"))
    old = latest_per_key(first, ["user_id"], ["ts", "event_id"])
    return upsert(old, batch, ["user_id"], ["ts", "event_id"])


def _customer_tokens(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name"),
                    F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("scope"),
                    F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
                    F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"))


def _token_batch(spark, sf_dir):
    o = A.table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("entity_id"),
                     F.col("o_totalprice").alias("balance"),
                     F.when(F.col("o_orderstatus") == "F", F.lit(None))
                      .otherwise(F.col("o_orderpriority")).alias("scope"),
                     F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
                     F.col("o_orderdate"), F.col("o_orderkey"))


def upsert_partial_columns(spark, sf_dir):
    return upsert(_customer_tokens(spark, sf_dir), _token_batch(spark, sf_dir), ["entity_id"], ["o_orderdate", "o_orderkey"],
                  insert_only_cols=["created_at"], keep_if_null_cols=["scope"],
                  touch_col="updated_at", touch_value="2024-02-01 00:00:00")


AS_OF_EPOCH = 1706659200   # 2024-01-31 00:00:00 UTC


def stale_entities(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer")
    last = (A.table(spark, sf_dir, "events").groupBy("user_id")
            .agg(F.max("ts").alias("last_ts")))
    ent = c.select(F.col("c_custkey").alias("entity_id"),
                   F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_name"))
                    .alias("token"))
    j = ent.join(last, ent.entity_id == last.user_id, "left").select(
        "entity_id", "token",
        (F.unix_timestamp(F.col("last_ts").cast("timestamp")) + F.lit(7 * 86400))
        .alias("expires_at"))
    e = I.active_entities(j, required=["entity_id"], defaults={"token": "", "expires_at": 0},
                          casts={"expires_at": "bigint"})
    return e.select("entity_id", "expires_at", (F.col("token") == "").alias("token_missing"),
                    I.stale_flag(F.col("token"), F.col("expires_at"), AS_OF_EPOCH)
                    .alias("is_stale"))


def load_audit(spark, sf_dir):
    """Audit of a load with bad values, in one pass; customers in debt are loaded but not listed."""
    x = Inputs(spark, sf_dir)
    ents = x.t("customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("athlete_id"))
    return I.audit_landing(x.dirty, "athlete_id", entities=ents)


VALUE_BANDS = [("short", 600, 2400), ("medium", 2400, 4200), ("long", 4200, None)]


SAMPLE_CAP_S = 4 * 3600    # a longer gap between samples is a pause


def time_in_zone(spark, sf_dir):
    """Seconds each athlete spent in its heart-rate zones, from samples over time."""
    x = Inputs(spark, sf_dir)
    samples = x.staged.select("athlete_id", "activity_id", "start_date_utc", "avg_hr")
    spans = intervals(samples, ["athlete_id"], "start_date_utc", "avg_hr", ["activity_id"], SAMPLE_CAP_S)
    zones = x.hr_zones.filter("is_current")
    out = time_in_bands(spans, zones, ["athlete_id"], ["zone_number", "zone_label"], "bpm_low", "bpm_high")
    return out.withColumn("seconds", M.round_half_up(F.col("seconds"), 3))


def team_benchmark(spark, sf_dir):
    """Each athlete's mean power, and its percent rank in the team (the customer's nation) and among all."""
    x = Inputs(spark, sf_dir)
    power = x.staged.filter(F.col("activity_type") == A.RIDE_TYPE).groupBy("athlete_id").agg(
        M.round_half_up(F.avg(F.col("weighted_average_watts").cast("decimal(20,6)")), 1).alias("power_w"))
    teams = x.t("customer").select(F.col("c_custkey").alias("athlete_id"), F.col("c_nationkey").alias("team"))
    rows = materialize(spark, teams.join(power, "athlete_id", "left"), "team-power")
    ranked = percent_rank(rows, "power_w", ["team"], "rank_in_team")
    out = percent_rank(ranked, "power_w", [], "rank_in_all")
    return out.select("athlete_id", "team", "power_w", "rank_in_team", "rank_in_all")


def fact_as_of_merge(spark, sf_dir):
    """The as-of join by merging events and versions in time chunks (long histories)."""
    x = Inputs(spark, sf_dir)
    s = x.staged.select("activity_id", "athlete_id", F.col("start_date_utc").cast("date").alias("activity_date"))
    return merge_asof(s, x.thresholds, ["athlete_id"], "activity_date", ["ftp_id", "ftp_watts"])


def load_anomalies(spark, sf_dir):
    """Days whose distance is far from the athlete's days before."""
    d = Inputs(spark, sf_dir).staged.groupBy("athlete_id", F.col("start_date_utc").cast("date").alias("date")).agg(
        M.round_half_up(M.exact_sum("distance_km"), 2).alias("distance_km"))
    return anomaly_flags(d, ["athlete_id"], "date", "distance_km", days=14, least=5, over=2.0)


def virtual_outdoor(spark, sf_dir):
    """Two types of rides side by side per athlete."""
    return D.compare_types(Inputs(spark, sf_dir).fact, "click", A.RIDE_TYPE)


def secured_rides(spark, sf_dir):
    """What two viewers see of the rides through one view: each nation's coach its own athletes."""
    x = Inputs(spark, sf_dir)
    name = f"rides_{uuid.uuid4().hex[:8]}"
    coaches = x.t("customer").select(F.concat(F.lit("coach-"), F.col("c_nationkey")).alias("viewer"),
                                     F.col("c_custkey").alias("athlete_id"))
    declare_viewer(spark)
    secured_view(spark, name, x.staged.select("activity_id", "athlete_id", "distance_km"), coaches, "athlete_id")
    out = None
    for viewer in ("coach-3", "coach-7"):
        set_viewer(spark, viewer)
        seen = materialize(spark, spark.table(name).withColumn("viewer", F.lit(viewer)), "seen")
        out = seen if out is None else out.unionByName(seen)
    set_viewer(spark, None)
    return out


def catalog_keyed_upsert(spark, sf_dir):
    """The partial-column upsert on a catalog table bucketed by its key."""
    name = f"tokens_{uuid.uuid4().hex[:8]}"
    table = CatalogTable(spark, name, scratch_dir(spark, "tokens"))
    table.create(_customer_tokens(spark, sf_dir), ["entity_id"], ["updated_at"], buckets=8)
    table.merge(_token_batch(spark, sf_dir), ["o_orderdate", "o_orderkey"], insert_only_cols=["created_at"],
                keep_if_null_cols=["scope"], touch_col="updated_at", touch_value="2024-02-01 00:00:00")
    return table.read()


def values_bands_join(spark, sf_dir):
    """Activities against a VALUES list of duration bands."""
    bands = values_relation(spark, VALUE_BANDS, "band string, low int, high int")
    a = Inputs(spark, sf_dir).staged.select("activity_id", "moving_time_s")
    return band_join(a, bands, "moving_time_s", ["band"], open_upper=True)


def literal_row_union(spark, sf_dir):
    """A literal one-row athlete table beside the athletes."""
    a = Inputs(spark, sf_dir).athletes.select("athlete_id", "first_name", "max_hr", "added_at")
    one = literal_row(spark, "athlete_id bigint, first_name string, max_hr int, added_at date",
                      athlete_id=-1, first_name="nobody")
    return a.unionByName(one)


def hr_band_closed_upper(spark, sf_dir):
    """Keyed heart-rate bands of the newest athlete version, upper bound included."""
    x = Inputs(spark, sf_dir)
    a = x.staged.select("activity_id", "athlete_id", "avg_hr")
    z = x.hr_zones.filter("is_current")
    return band_join(a, z, "avg_hr", ["zone_number"], keys=["athlete_id"], how="inner",
                     low="bpm_low", high="bpm_high", closed_high=True)


def _pinned(fn):
    """Build the query's plan with the session time zone at UTC, then put it back:
    the zone is bound into casts when a DataFrame is made."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with utc_session(spark):
            return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


REGISTRY = {
    "stage_json_typed": stage_json_typed,
    "parse_audit": parse_audit,
    "stage_rejects": stage_rejects,
    "stage_dirty_rows": stage_dirty_rows,
    "stage_json_decimal": stage_json_decimal,
    "serialize_nulls": serialize_nulls,
    "values_bands_join": values_bands_join,
    "literal_row_union": literal_row_union,
    "ride_projection": ride_projection,
    "dim_date": dim_date,
    "inline_values_bands": inline_values_bands,
    "scd2_threshold": scd2_threshold,
    "power_bands": power_bands,
    "hr_bands_surrogate_key": hr_bands_surrogate_key,
    "fact_current_threshold": fact_current_threshold,
    "fact_as_of_threshold": fact_as_of_threshold,
    "fact_as_of_inclusive": fact_as_of_inclusive,
    "retest_gap_rows": retest_gap_rows,
    "power_zone_match": power_zone_match,
    "hr_efficiency_keyed": hr_efficiency_keyed,
    "hr_band_theta": hr_band_theta,
    "hr_band_closed_upper": hr_band_closed_upper,
    "weighted_means": weighted_means,
    "daily_by_activity": daily_by_activity,
    "daily": daily,
    "densified_daily": densified_daily,
    "rolling_load_7_28": rolling_load_7_28,
    "rolling_orders_range": rolling_orders_range,
    "load_ratio_label": load_ratio_label,
    "zone_share": zone_share,
    "hr_zone_share": hr_zone_share,
    "monthly_summary": monthly_summary,
    "recent_log": recent_log,
    "efficiency_trend": efficiency_trend,
    "mart_full": mart_full,
    "quality_report": quality_report,
    "duplicate_keys": duplicate_keys,
    "mart_contract": mart_contract,
    "orphan_entities": orphan_entities,
    "upsert_latest_wins": upsert_latest_wins,
    "upsert_partial_columns": upsert_partial_columns,
    "stale_entities": stale_entities,
    "load_audit": load_audit,
    "snapshot_explode": L.snapshot_explode,
    "page_union": L.page_union,
    "entity_pages": L.entity_pages,
    "snapshot_rejects": L.snapshot_rejects,
    "full_refresh_layers": L.full_refresh_layers,
    "csv_summary": L.csv_summary,
    "time_in_zone": time_in_zone,
    "fact_as_of_merge": fact_as_of_merge,
    "load_anomalies": load_anomalies,
    "virtual_outdoor": virtual_outdoor,
    "secured_rides": secured_rides,
    "catalog_keyed_upsert": catalog_keyed_upsert,
    "snapshot_split": L.snapshot_split,
    "team_benchmark": team_benchmark,
    "rolling_incremental": L.rolling_incremental,
    "stream_incremental_upsert": L.stream_incremental_upsert,
    "stream_event_time_upsert": L.stream_event_time_upsert,
    "incremental_fact_upsert": L.incremental_fact_upsert,
}
REGISTRY = {name: _pinned(fn) for name, fn in REGISTRY.items()}
