"""The warehouse models as DataFrame functions (staging -> dims -> facts -> mart).

Lineage: landed raw -> ``stage`` -> ``fact_activities`` -> {``fact_power_zone``,
``fact_hr_efficiency``} -> ``daily_*`` -> ``densified`` -> ``mart``; dimensions
``dim_threshold``, ``power_zone_dim``, ``hr_zone_dim`` and ``date_dim`` feed them.

Scale design (the facts are the big side; every dimension is per entity):

* all dimensions a ride looks up are folded to one row per athlete and met in
  one equi-join; versions and bands are picked by higher-order functions;
* the mart attaches zones and efficiency to the ride stream that way, so the
  fact never has to be re-joined to itself on activity_id;
* rolling windows run on (athlete, day) rows - at most one row per calendar day
  per athlete; the day spine is generated below the window and never shuffled,
  and only days with rides meet the activity rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacekit.functions import metrics as M
from pacekit.operators.bands import band_holds, band_join, make_bands
from pacekit.operators.calendar import date_dim, dealt, densify
from pacekit.operators.lookup import first_match, fold_all, meet
from pacekit.operators.rolling import rolling_sums
from pacekit.operators.scd import in_force, interval_join, scd2
from pacekit.operators.upsert import latest_per_key

# The band definitions of the two zone models
# (zone_number, zone_name, zone_label, low pct, high pct, text).
POWER_ZONES = [
    {"zone_number": 1, "zone_name": "Active Recovery", "zone_label": "Z1", "ftp_pct_low": "0.00", "ftp_pct_high": "0.55", "training_benefit": "Recovery, very easy spinning"},
    {"zone_number": 2, "zone_name": "Endurance", "zone_label": "Z2", "ftp_pct_low": "0.55", "ftp_pct_high": "0.75", "training_benefit": "Aerobic endurance, base fitness"},
    {"zone_number": 3, "zone_name": "Tempo", "zone_label": "Z3", "ftp_pct_low": "0.75", "ftp_pct_high": "0.90", "training_benefit": "Muscular endurance, steady hard riding"},
    {"zone_number": 4, "zone_name": "Lactate Threshold", "zone_label": "Z4", "ftp_pct_low": "0.90", "ftp_pct_high": "9.99", "training_benefit": "Increase FTP, sustainable hard efforts"},
]
HR_ZONES = [
    {"zone_number": 1, "zone_name": "Recovery", "zone_label": "Z1", "hr_pct_low": "0.50", "hr_pct_high": "0.60", "fatigue_risk": "Low", "training_focus": "Easy recovery, circulation"},
    {"zone_number": 2, "zone_name": "Endurance", "zone_label": "Z2", "hr_pct_low": "0.60", "hr_pct_high": "0.70", "fatigue_risk": "Low", "training_focus": "Aerobic base, endurance"},
    {"zone_number": 3, "zone_name": "Tempo", "zone_label": "Z3", "hr_pct_low": "0.70", "hr_pct_high": "0.80", "fatigue_risk": "Medium", "training_focus": "Sustainable hard, muscular endurance"},
    {"zone_number": 4, "zone_name": "Threshold", "zone_label": "Z4", "hr_pct_low": "0.80", "hr_pct_high": "1.00", "fatigue_risk": "High", "training_focus": "Raise threshold, controlled discomfort"},
]
POWER_TYPES = {"zone_number": "int", "zone_name": "string", "zone_label": "string",
               "ftp_pct_low": "decimal(5,2)", "ftp_pct_high": "decimal(5,2)",
               "training_benefit": "string"}
HR_TYPES = {"zone_number": "int", "zone_name": "string", "zone_label": "string",
            "hr_pct_low": "decimal(5,2)", "hr_pct_high": "decimal(5,2)",
            "fatigue_risk": "string", "training_focus": "string"}
RETEST_AFTER_DAYS = 42   # six weeks


# ---------------------------------------------------------------- dimensions

def dim_threshold(tests: DataFrame, end_offset_days: int = 1, run_ts: str | None = None) -> DataFrame:
    """SCD2 over threshold tests: valid_to = next test - 1 day (inclusive end).

    ``run_ts`` adds ``created_at``.
    """
    d = scd2(tests, ["athlete_id"], "test_date", tiebreak=["ftp_id"],
             end_offset_days=end_offset_days)
    return d.select("ftp_id", "athlete_id", "ftp_watts", "ftp_wkg", "test_date",
                    "valid_from", "valid_to",
                    F.date_add(F.col("test_date"), RETEST_AFTER_DAYS).alias("next_retest_due"),
                    "test_type", F.lit(None).cast("string").alias("test_notes"),
                    "is_current", *_run_columns(run_ts)[:1])


def power_zone_dim(thresholds: DataFrame) -> DataFrame:
    ref = thresholds.select("ftp_id", "athlete_id", "ftp_watts")
    z = make_bands(ref, POWER_ZONES, POWER_TYPES, "ftp_watts", "ftp_pct_low",
                   "ftp_pct_high", "watts_low", "watts_high")
    return z.select("ftp_id", "athlete_id", "zone_number", "zone_name", "zone_label",
                    "ftp_pct_low", "ftp_pct_high", "watts_low", "watts_high",
                    "training_benefit")


def hr_zone_dim(athletes: DataFrame) -> DataFrame:
    """Athlete history -> SCD2 (exclusive end, valid_to = next added_at) x HR bands."""
    ref = scd2(athletes.select("athlete_id", "added_at", F.col("max_hr").alias("reference_bpm")),
               ["athlete_id"], "added_at", end_offset_days=0, current_col=None)
    z = make_bands(ref, HR_ZONES, HR_TYPES, "reference_bpm", "hr_pct_low", "hr_pct_high",
                   "bpm_low", "bpm_high")
    return z.select(M.surrogate_key("athlete_id", "valid_from", "zone_number").alias("hr_zone_id"),
                    "athlete_id", "zone_number", "zone_name", "zone_label", "hr_pct_low",
                    "hr_pct_high", "bpm_low", "bpm_high", "fatigue_risk", "training_focus",
                    "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def latest_athletes(athletes: DataFrame) -> DataFrame:
    """One row per athlete: its newest version (the entity list of the mart)."""
    return latest_per_key(athletes, ["athlete_id"], ["added_at"])


# ---------------------------------------------------------------- facts

FACT_COLUMNS = ["activity_id", "athlete_id", "activity_date", "ftp_id", "distance_m",
                "distance_km", "duration_minutes", "avg_speed_kmh", "max_speed_kmh",
                "avg_power_w", "max_power_w", "normalized_power", "avg_hr", "max_hr",
                "elevation_gain", "intensity_factor", "tss", "ftp_watts_at_activity",
                "avg_cadence", "activity_name", "activity_type"]


def fact_activities(staged: DataFrame, thresholds: DataFrame, mode: str = "current_only",
                    end: str = "exclusive", run_ts: str | None = None) -> DataFrame:
    """One row per activity with the threshold in force and the derived load.

    ``mode="current_only"``: only the latest threshold, for activities on/after
    its test day (older activities get NULL threshold, IF and TSS).
    ``mode="as_of"``: the threshold whose interval contains the day.
    ``run_ts`` adds ``created_at`` and ``updated_at``.
    """
    s = staged.withColumn("activity_date", F.col("start_date_utc").cast("date"))
    j = interval_join(s, thresholds, ["athlete_id"], "activity_date", ["ftp_id", "ftp_watts"],
                      how="left", end=end, current_only=(mode == "current_only"))
    return j.select(*_fact_columns(), *_run_columns(run_ts))


def _run_columns(run_ts: str | None) -> list[Column]:
    ts = F.lit(run_ts).cast("timestamp_ntz")
    return [] if run_ts is None else [ts.alias("created_at"), ts.alias("updated_at")]


def _fact_columns() -> list:
    np_ = F.col("weighted_average_watts")
    return [
        "activity_id", "athlete_id", "activity_date", "ftp_id", "distance_m", "distance_km",
        M.round_half_up(F.col("moving_time_s") / F.lit(60.0), 2).alias("duration_minutes"),
        "avg_speed_kmh", (F.col("max_speed_mps") * F.lit(3.6)).alias("max_speed_kmh"),
        "avg_power_w", "max_power_w", np_.alias("normalized_power"), "avg_hr", "max_hr",
        F.col("elevation_m").alias("elevation_gain"),
        M.intensity_factor(np_, "ftp_watts").alias("intensity_factor"),
        M.training_stress("moving_time_s", np_, "ftp_watts").alias("tss"),
        M.nullif_zero(F.col("ftp_watts")).alias("ftp_watts_at_activity"),
        F.col("average_cadence").alias("avg_cadence"), "activity_name", "activity_type",
    ]


def fact_power_zone(fact: DataFrame, power_zones: DataFrame) -> DataFrame:
    """Zone of each activity's normalized power under its threshold (inner)."""
    a = fact.filter(F.col("normalized_power").isNotNull() & F.col("ftp_id").isNotNull()) \
            .select("activity_id", "athlete_id", "ftp_id", "normalized_power")
    j = band_join(a, power_zones, "normalized_power",
                  ["watts_low", "watts_high", "zone_number", "zone_label", "zone_name",
                   "training_benefit"],
                  keys=["ftp_id"], how="inner", low="watts_low",
                  high="watts_high", open_upper=True)
    return j.select(
        "activity_id", "ftp_id", F.lit("normalized_power").alias("classification_basis"),
        F.col("normalized_power").cast("decimal(6,2)").cast("double").alias("power_watts"),
        F.col("watts_low").cast("decimal(6,2)").cast("double").alias("zone_watts_low"),
        F.col("watts_high").cast("decimal(6,2)").cast("double").alias("zone_watts_high"),
        "zone_number", "zone_label", "zone_name", "training_benefit")


def fact_hr_efficiency(fact: DataFrame, thresholds: DataFrame, hr_zones: DataFrame) -> DataFrame:
    """Threshold valid at the activity (inner, exclusive end) + keyed HR zone + ratios."""
    a = fact.select("activity_id", "athlete_id", "activity_date", "avg_power_w",
                    "normalized_power", "avg_hr")
    profile = fold_all({"_thresholds": (thresholds, ["valid_from", "valid_to", "ftp_id"]),
                        "_hr": (hr_zones, HR_PICK)}, ["athlete_id"])
    day = F.col("activity_date")
    j = meet(a, profile, ["athlete_id"], "inner").withColumn("_t", first_match(F.col("_thresholds"), in_force(day)))
    z = j.filter(F.col("_t").isNotNull()).withColumn("_z", first_match(F.col("_hr"), _hr_holds()))
    return z.select(
        "activity_id", F.col("_t.ftp_id"), F.col("_z.hr_zone_id"), "avg_power_w", "normalized_power", "avg_hr",
        M.watts_per_bpm("avg_power_w", "avg_hr").alias("watts_per_bpm"),
        M.efficiency_factor("normalized_power", "avg_hr").alias("efficiency_factor"),
        F.col("_z.zone_number").alias("hr_zone_number"))


HR_PICK = ["valid_from", "valid_to", "bpm_low", "bpm_high", "hr_zone_id", "zone_number", "zone_label",
           "zone_name", "training_focus"]
POWER_PICK = ["ftp_id", "watts_low", "watts_high", "zone_number", "zone_label", "zone_name", "training_benefit"]


def _hr_holds():
    """Keyed HR band: version valid on the day, bpm in band."""
    valid = in_force(F.col("activity_date"))
    inside = band_holds(F.col("avg_hr"), "bpm_low", "bpm_high")
    return lambda z: valid(z) & inside(z)


def hr_band_theta(fact: DataFrame, bands: DataFrame) -> DataFrame:
    """Un-keyed band join against one band set (equi-join on value buckets)."""
    a = fact.select("activity_id", "avg_hr")
    return band_join(a, bands, "avg_hr", ["zone_number", "bpm_low", "bpm_high"],
                     keys=(), how="left", low="bpm_low", high="bpm_high")


# ---------------------------------------------------------------- mart

def athlete_profile(thresholds: DataFrame, power_zones: DataFrame, hr_zones: DataFrame) -> DataFrame:
    """Everything a ride looks up, one row per athlete: threshold versions, power bands, HR bands."""
    return fold_all({
        "_thresholds": (thresholds, ["valid_from", "valid_to", "ftp_id", "ftp_watts"]),
        "_power": (power_zones, POWER_PICK), "_hr": (hr_zones, HR_PICK)}, ["athlete_id"])


def staged_rides(staged: DataFrame, thresholds: DataFrame, power_zones: DataFrame,
                 hr_zones: DataFrame, ride_type: str) -> DataFrame:
    """Enriched rides straight from staging: the fact's threshold and all zones from one join."""
    s = (staged.filter(F.col("activity_type") == F.lit(ride_type))
         .withColumn("activity_date", F.col("start_date_utc").cast("date")))
    j = meet(s, athlete_profile(thresholds, power_zones, hr_zones), ["athlete_id"])
    now = first_match(F.col("_thresholds"), in_force(F.col("activity_date"), current_only=True))
    fact = (j.withColumn("_now", now).withColumn("ftp_id", F.col("_now.ftp_id"))
            .withColumn("ftp_watts", F.col("_now.ftp_watts")))
    return _enrich(fact.select(*_fact_columns(), "_thresholds", "_power", "_hr"))


def rides_enriched(fact: DataFrame, thresholds: DataFrame, power_zones: DataFrame,
                   hr_zones: DataFrame, ride_type: str) -> DataFrame:
    """Rides of a stored fact with efficiency ratios and power / HR zones attached.

    Same values as left-joining the power-zone and HR-efficiency facts by
    activity id: the as-of threshold (exclusive end) gates the efficiency
    metrics and HR zone, the current threshold's zone gives the power zone. One
    join to the athlete's profile, so a hot athlete's rides are split by AQE.
    """
    rides = fact.filter(F.col("activity_type") == F.lit(ride_type))
    return _enrich(meet(rides, athlete_profile(thresholds, power_zones, hr_zones), ["athlete_id"]))


def _enrich(df: DataFrame) -> DataFrame:
    day = F.col("activity_date")
    in_power = band_holds(F.col("normalized_power"), "watts_low", "watts_high", open_upper=True)
    df = df.withColumn("asof_ftp_id", first_match(F.col("_thresholds"), in_force(day))["ftp_id"])
    has = F.col("asof_ftp_id").isNotNull()
    df = (df.withColumn("watts_per_bpm", F.when(has, M.watts_per_bpm("avg_power_w", "avg_hr")))
            .withColumn("efficiency_factor", F.when(has, M.efficiency_factor("normalized_power", "avg_hr")))
            .withColumn("_z", F.when(has, first_match(F.col("_hr"), _hr_holds())))
            .withColumn("_p", first_match(F.col("_power"), lambda z: (z["ftp_id"] == F.col("ftp_id")) & in_power(z))))
    keep = [c for c in df.columns if not c.startswith("_")]
    return df.select(
        *keep, F.col("_z.hr_zone_id").alias("hr_zone_id"),
        F.col("_z.zone_number").alias("hr_zone_number"), F.col("_z.zone_label").alias("hr_zone_label"),
        F.col("_z.zone_name").alias("hr_zone_name"), F.col("_z.training_focus").alias("hr_zone_benefit"),
        F.col("_p.zone_number").alias("power_zone_number"), F.col("_p.zone_label").alias("power_zone_label"),
        F.col("_p.zone_name").alias("power_zone_name"), F.col("_p.training_benefit").alias("power_zone_benefit"))


def daily_rollup(rides: DataFrame, grain: str = "activity") -> DataFrame:
    """Group rides per (athlete, day[, activity]) with the mart's measures.

    ``grain="activity"`` groups by athlete, date, activity id and name (one row
    per ride); ``grain="day"`` groups by athlete and date. Labels use ``max``
    as a picker; the ``*_top`` labels take the label of the highest zone.
    """
    keys = ["athlete_id", "activity_date"]
    if grain == "activity":
        keys += ["activity_id", "activity_name"]
    dur = "duration_minutes"
    aggs = [F.max(c).alias(c) for c in LABELS] + [
        F.count(F.lit(1)).alias("ride_count"),
        M.round_half_up(M.exact_sum("distance_km"), 2).alias("distance_km"),
        M.round_half_up(M.exact_sum(dur), 2).alias("duration_minutes"),
        M.weighted_mean("avg_speed_kmh", dur, 2).alias("avg_speed_kmh_wt"),
        M.weighted_mean("avg_power_w", dur, 0).alias("avg_power_w_wt"),
        M.weighted_mean("normalized_power", dur, 0).alias("normalized_power_wt"),
        M.weighted_mean("avg_hr", dur, 0).alias("avg_hr_bpm_wt"),
        M.weighted_mean("watts_per_bpm", dur, 2).alias("watts_per_bpm_wt"),
        M.weighted_mean("efficiency_factor", dur, 3).alias("efficiency_factor_wt"),
        M.round_half_up(M.exact_sum("tss"), 2).alias("tss_total"),
        M.round_half_up(F.avg(F.col("intensity_factor").cast("decimal(20,6)")), 3)
         .alias("intensity_factor_avg"),
        F.max(F.when(F.col("hr_zone_number") == 4, 1).otherwise(0)).alias("is_high_hr_zone"),
        F.max(F.when(F.col("power_zone_number") == 4, 1).otherwise(0)).alias("is_high_power_zone"),
    ]
    if grain == "day":
        aggs += [F.max_by("power_zone_label", "power_zone_number").alias("power_zone_label_top"),
                 F.max_by("hr_zone_label", "hr_zone_number").alias("hr_zone_label_top")]
    return rides.groupBy(*keys).agg(*aggs)


LABELS = ["power_zone_label", "power_zone_name", "power_zone_benefit", "hr_zone_label", "hr_zone_name",
          "hr_zone_benefit"]
MART_MEASURES = ["avg_speed_kmh_wt", "avg_power_w_wt", "normalized_power_wt", "avg_hr_bpm_wt",
                 "power_zone_label", "power_zone_name", "power_zone_benefit", "hr_zone_label",
                 "hr_zone_name", "hr_zone_benefit", "watts_per_bpm_wt", "efficiency_factor_wt"]


def _with_rest_days(d: DataFrame, ids: list[str]) -> DataFrame:
    """Mart columns of dense rows: rest days get zero counts, ``activity_date`` stays NULL."""
    return d.select(
        "athlete_id", "athlete_name", "date", *ids, "activity_date",
        F.coalesce(F.col("ride_count"), F.lit(0)).cast("long").alias("ride_count"),
        F.coalesce(F.col("distance_km"), F.lit(0.0)).alias("distance_km"),
        F.coalesce(F.col("duration_minutes"), F.lit(0.0)).alias("duration_minutes"),
        *MART_MEASURES,
        F.coalesce(F.col("tss_total"), F.lit(0.0)).alias("tss_total"),
        "intensity_factor_avg",
        F.coalesce(F.col("is_high_hr_zone"), F.lit(0)).alias("is_high_hr_zone"),
        F.coalesce(F.col("is_high_power_zone"), F.lit(0)).alias("is_high_power_zone"),
    )


def dense_days(entities: DataFrame, daily: DataFrame, as_of: str) -> DataFrame:
    """Entities x [first ride day .. as_of] with the columns of ``daily`` on days with rides.

    The start is the global first ride day (a scalar subquery over one column).
    ``daily`` is read three times: pass a stored table.
    """
    start = daily.select(F.min("activity_date")).scalar()
    ent = entities.select("athlete_id", F.col("first_name").alias("athlete_name"))
    return densify(ent, daily, ["athlete_id"], start, F.lit(as_of).cast("date"),
                   fact_day="activity_date", day_col="date", carry=["athlete_name"],
                   partitions=_day_partitions(entities, daily, as_of))


def _day_partitions(entities: DataFrame, daily: DataFrame, as_of: str) -> int:
    """Partitions for the days of all entities, in proportion to them."""
    first = daily.select(F.min("activity_date")).first()[0]
    return dealt(entities, first, date.fromisoformat(as_of))


def densified(entities: DataFrame, daily: DataFrame, as_of: str) -> DataFrame:
    """:func:`dense_days` with the mart's measures; rest days get zeros."""
    return _with_rest_days(dense_days(entities, daily, as_of), [])


LOAD_SPANS = {"tss_7d": 7, "tss_28d": 28}


def mart(entities: DataFrame, rides: DataFrame, as_of: str, daily: DataFrame | None = None) -> DataFrame:
    """The daily mart at per-activity grain with rest days and 7/28-day load.

    1. ``daily`` - per-activity rollup of the rides (given, or built here). It is read
       five times, so a caller whose rides are costly (parsed, joined) stores it first;
    2. load per (athlete, day) of days with rides. Rest days add nothing to a
       RANGE frame, so those days get their rolling sums from the days with
       rides alone, and meet the activity rows on (athlete, day);
    3. rest days come from the generated spine, rolled in place: the window
       sits on the partitioning by athlete that the days were generated in, so
       the largest intermediate (entities x days) is never shuffled.
    """
    if daily is None:
        daily = daily_rollup(rides, "activity")
    start = daily.select(F.min("activity_date")).scalar()
    end = F.lit(as_of).cast("date")
    ent = entities.select("athlete_id", F.col("first_name").alias("athlete_name"))
    day_tss = (daily.groupBy("athlete_id", F.col("activity_date").alias("date"))
                    .agg(F.sum(F.col("tss_total").cast("decimal(38,6)")).alias("day_tss"))
                    .filter(F.col("date") <= end))
    active = rolling_sums(ent.join(day_tss, "athlete_id"), ["athlete_id"], "date", "day_tss", LOAD_SPANS)
    r = active.select("athlete_id", "athlete_name", "date", *LOAD_SPANS).alias("_r")
    ridden = r.join(daily.alias("_d"), (F.col("_r.athlete_id") == F.col("_d.athlete_id"))
                    & (F.col("_r.date") == F.col("_d.activity_date")))
    ridden = ridden.select("_r.*", *[F.col(f"_d.{c}") for c in daily.columns if c != "athlete_id"])
    days = densify(ent, day_tss.withColumn("ride_day", F.col("date")), ["athlete_id"], start, end,
                   fact_day="ride_day", day_col="date", carry=["athlete_name"],
                   partitions=_day_partitions(entities, daily, as_of))
    rest = (rolling_sums(days, ["athlete_id"], "date", "day_tss", LOAD_SPANS)
            .filter(F.col("ride_day").isNull())
            .select("athlete_id", "athlete_name", "date", *LOAD_SPANS))
    every = ridden.unionByName(rest, allowMissingColumns=True)
    out = _with_rest_days(every.select("*"), ["activity_id", "activity_name", *LOAD_SPANS])
    return out.select(*[c for c in out.columns if c not in LOAD_SPANS], *LOAD_SPANS)


def date_dim_between(anchor: DataFrame, day_col: str, pad_end_days: int = 1) -> DataFrame:
    """Calendar from the first to the last day present in ``anchor`` (end exclusive)."""
    b = anchor.agg(F.min(F.col(day_col).cast("date")).alias("start"),
                   F.date_add(F.max(F.col(day_col).cast("date")), pad_end_days).alias("end"))
    return date_dim(b)
