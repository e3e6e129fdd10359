"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each statement runs on the driver's pre-registered views and must return the
same rows, column names and types as the Spark query of the same name.
Shared building blocks are CTEs; the derivation rules mirror
``pacekit.plans.analog`` (same expressions, written in SQL).
"""

from __future__ import annotations

# Fixed values, written out here on their own: an error in the code under test cannot hide.
HR_ZONES = [
    {"zone_number": 1, "zone_name": "Recovery", "zone_label": "Z1", "hr_pct_low": "0.50", "hr_pct_high": "0.60", "fatigue_risk": "Low", "training_focus": "Easy recovery, circulation"},
    {"zone_number": 2, "zone_name": "Endurance", "zone_label": "Z2", "hr_pct_low": "0.60", "hr_pct_high": "0.70", "fatigue_risk": "Low", "training_focus": "Aerobic base, endurance"},
    {"zone_number": 3, "zone_name": "Tempo", "zone_label": "Z3", "hr_pct_low": "0.70", "hr_pct_high": "0.80", "fatigue_risk": "Medium", "training_focus": "Sustainable hard, muscular endurance"},
    {"zone_number": 4, "zone_name": "Threshold", "zone_label": "Z4", "hr_pct_low": "0.80", "hr_pct_high": "1.00", "fatigue_risk": "High", "training_focus": "Raise threshold, controlled discomfort"},
]
POWER_ZONES = [
    {"zone_number": 1, "zone_name": "Active Recovery", "zone_label": "Z1", "ftp_pct_low": "0.00", "ftp_pct_high": "0.55", "training_benefit": "Recovery, very easy spinning"},
    {"zone_number": 2, "zone_name": "Endurance", "zone_label": "Z2", "ftp_pct_low": "0.55", "ftp_pct_high": "0.75", "training_benefit": "Aerobic endurance, base fitness"},
    {"zone_number": 3, "zone_name": "Tempo", "zone_label": "Z3", "ftp_pct_low": "0.75", "ftp_pct_high": "0.90", "training_benefit": "Muscular endurance, steady hard riding"},
    {"zone_number": 4, "zone_name": "Lactate Threshold", "zone_label": "Z4", "ftp_pct_low": "0.90", "ftp_pct_high": "9.99", "training_benefit": "Increase FTP, sustainable hard efforts"},
]
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
MART_CONTRACT = [
    "athlete_id",
    "athlete_name",
    "date",
    "activity_id",
    "activity_name",
    "activity_date",
    "ride_count",
    "distance_km",
    "duration_minutes",
    "avg_speed_kmh_wt",
    "avg_power_w_wt",
    "normalized_power_wt",
    "avg_hr_bpm_wt",
    "power_zone_label",
    "power_zone_name",
    "power_zone_benefit",
    "hr_zone_label",
    "hr_zone_name",
    "hr_zone_benefit",
    "watts_per_bpm_wt",
    "efficiency_factor_wt",
    "tss_total",
    "intensity_factor_avg",
    "is_high_hr_zone",
    "is_high_power_zone",
    "tss_7d",
    "tss_28d"
]
MART_PRIMARY_KEY = ["athlete_id", "activity_date", "activity_id"]


def RH(expr: str, n: int) -> str:
    """Half-away-from-zero round through DECIMAL(28,10), as DOUBLE."""
    return f"CAST(round(CAST(CAST(({expr}) AS DOUBLE) AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def WM(x: str, n: int, skip_null_weight: bool = False, w: str = "duration_minutes") -> str:
    num = f"CAST(sum(CAST({x} AS DECIMAL(18,6)) * CAST({w} AS DECIMAL(18,6))) AS DOUBLE)"
    wsel = f"CASE WHEN {x} IS NOT NULL THEN {w} END" if skip_null_weight else w
    den = f"CAST(sum(CAST({wsel} AS DECIMAL(18,6))) AS DOUBLE)"
    return RH(f"{num} / NULLIF({den}, 0)", n)


def XSUM(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"


def _values(rows, cols):
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    body = ",\n    ".join("(" + ", ".join(lit(r[c]) for c in cols) + ")" for r in rows)
    return f"(VALUES\n    {body}) t({', '.join(cols)})"


_HR_COLS = ["zone_number", "zone_name", "zone_label", "hr_pct_low", "hr_pct_high",
            "fatigue_risk", "training_focus"]
_P_COLS = ["zone_number", "zone_name", "zone_label", "ftp_pct_low", "ftp_pct_high",
           "training_benefit"]

STAGED = """
staged AS (
  SELECT event_id AS activity_id, user_id AS athlete_id,
    ts AS start_date_utc, TIMESTAMP '2024-02-01 00:00:00' AS extracted_at_utc,
    'ride ' || CAST(event_id AS VARCHAR) AS activity_name,
    event_type AS activity_type, upper(event_type) AS sport_type,
    value * 1000 AS distance_m,
    CAST(600 + event_id % 5400 AS INTEGER) AS moving_time_s,
    CAST(660 + event_id % 5400 AS INTEGER) AS elapsed_time_s,
    value * 10 AS elevation_m,
    value * 1000 / (600 + event_id % 5400) AS avg_speed_mps,
    value * 1000 / (600 + event_id % 5400) * CAST(1.5 AS DOUBLE) AS max_speed_mps,
    CAST(100 + (event_id * 7) % 120 AS DOUBLE) AS avg_power_w,
    CAST(300 + (event_id * 7) % 120 AS DOUBLE) AS max_power_w,
    (100 + (event_id * 7) % 120) * (600 + event_id % 5400) / CAST(1000.0 AS DOUBLE) AS kilojoules,
    CASE WHEN event_id % 11 = 0 THEN NULL
         ELSE CAST(105 + (event_id * 7) % 120 AS DOUBLE) END AS weighted_average_watts,
    CAST(80 + event_id % 15 AS DOUBLE) AS average_cadence,
    CASE WHEN event_id % 13 = 0 THEN NULL
         ELSE CAST(85 + CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) END AS avg_hr,
    CASE WHEN event_id % 13 = 0 THEN NULL
         ELSE CAST(110 + CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) END AS max_hr,
    value * 1000 / 1000 AS distance_km,
    CAST(600 + event_id % 5400 AS DOUBLE) / 60 AS moving_time_min,
    value * 1000 / (600 + event_id % 5400) * CAST(3.6 AS DOUBLE) AS avg_speed_kmh
  FROM events
  WHERE ts >= TIMESTAMP '2024-01-01 00:00:00')"""

TESTS = f"""
tests AS (
  SELECT CAST(c_custkey * 10 AS INTEGER) AS ftp_id, c_custkey AS athlete_id,
    CAST(130 + (c_custkey * 3) % 70 AS INTEGER) AS ftp_watts,
    {RH("CAST(130 + (c_custkey * 3) % 70 AS INTEGER) / (55 + c_custkey % 30)", 2)} AS ftp_wkg,
    DATE '2024-01-03' AS test_date, 'ramp' AS test_type
  FROM customer WHERE c_acctbal >= 0
  UNION ALL
  SELECT CAST(c_custkey * 10 + 1 AS INTEGER), c_custkey,
    CAST(130 + (c_custkey * 3 + 9) % 70 AS INTEGER),
    {RH("CAST(130 + (c_custkey * 3 + 9) % 70 AS INTEGER) / (55 + c_custkey % 30)", 2)},
    CAST(DATE '2024-01-14' + CAST(c_nationkey % 7 AS INTEGER) AS DATE), '20min'
  FROM customer WHERE c_acctbal >= 4500)"""

THR = """
thr AS (
  SELECT ftp_id, athlete_id, ftp_watts, ftp_wkg, test_date, test_date AS valid_from,
    CAST(lead(test_date) OVER (PARTITION BY athlete_id ORDER BY test_date, ftp_id) - 1 AS DATE) AS valid_to,
    CAST(test_date + 42 AS DATE) AS next_retest_due, test_type,
    CAST(NULL AS VARCHAR) AS test_notes,
    lead(test_date) OVER (PARTITION BY athlete_id ORDER BY test_date, ftp_id) IS NULL AS is_current
  FROM tests)"""

ATH = """
ath_hist AS (
  SELECT c_custkey AS athlete_id, c_name AS first_name, c_mktsegment AS last_name,
    CAST(55 + c_custkey % 30 AS DOUBLE) AS weight_kg, CAST(175 + c_custkey % 20 AS INTEGER) AS max_hr,
    CAST(50 + c_custkey % 15 AS INTEGER) AS resting_hr, DATE '2024-01-01' AS added_at
  FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_mktsegment, CAST(55 + c_custkey % 30 AS DOUBLE),
    CAST(180 + c_custkey % 20 AS INTEGER), CAST(50 + c_custkey % 15 AS INTEGER), DATE '2024-01-15'
  FROM customer WHERE c_mktsegment = 'BUILDING'),
ath AS (
  SELECT * FROM ath_hist
  QUALIFY row_number() OVER (PARTITION BY athlete_id ORDER BY added_at DESC) = 1)"""

HR_DEFS = f"""
hr_defs AS (
  SELECT zone_number, zone_name, zone_label, CAST(hr_pct_low AS DECIMAL(5,2)) AS hr_pct_low,
    CAST(hr_pct_high AS DECIMAL(5,2)) AS hr_pct_high, fatigue_risk, training_focus
  FROM {_values(HR_ZONES, _HR_COLS)})"""

P_DEFS = f"""
p_defs AS (
  SELECT zone_number, zone_name, zone_label, CAST(ftp_pct_low AS DECIMAL(5,2)) AS ftp_pct_low,
    CAST(ftp_pct_high AS DECIMAL(5,2)) AS ftp_pct_high, training_benefit
  FROM {_values(POWER_ZONES, _P_COLS)})"""

HRZ = """
hr_ref AS (
  SELECT athlete_id, max_hr AS reference_bpm, added_at AS valid_from,
    lead(added_at) OVER (PARTITION BY athlete_id ORDER BY added_at) AS valid_to
  FROM ath_hist),
hrz AS (
  SELECT md5(CAST(r.athlete_id AS VARCHAR) || '-' || CAST(r.valid_from AS VARCHAR) || '-'
             || CAST(d.zone_number AS VARCHAR)) AS hr_zone_id,
    r.athlete_id, d.zone_number, d.zone_name, d.zone_label, d.hr_pct_low, d.hr_pct_high,
    CAST(floor(r.reference_bpm * d.hr_pct_low) AS INTEGER) AS bpm_low,
    CAST(floor(r.reference_bpm * d.hr_pct_high) AS INTEGER) AS bpm_high,
    d.fatigue_risk, d.training_focus, r.valid_from, r.valid_to, r.valid_to IS NULL AS is_current
  FROM hr_ref r CROSS JOIN hr_defs d)"""

PZ = """
pz AS (
  SELECT t.ftp_id, t.athlete_id, d.zone_number, d.zone_name, d.zone_label, d.ftp_pct_low,
    d.ftp_pct_high, CAST(floor(t.ftp_watts * d.ftp_pct_low) AS INTEGER) AS watts_low,
    CAST(floor(t.ftp_watts * d.ftp_pct_high) AS INTEGER) AS watts_high, d.training_benefit
  FROM thr t CROSS JOIN p_defs d)"""

FACT = f"""
fact AS (
  SELECT s.activity_id, s.athlete_id, CAST(s.start_date_utc AS DATE) AS activity_date, t.ftp_id,
    s.distance_m, s.distance_km, {RH("s.moving_time_s / CAST(60.0 AS DOUBLE)", 2)} AS duration_minutes,
    s.avg_speed_kmh, s.max_speed_mps * CAST(3.6 AS DOUBLE) AS max_speed_kmh,
    s.avg_power_w, s.max_power_w, s.weighted_average_watts AS normalized_power, s.avg_hr, s.max_hr,
    s.elevation_m AS elevation_gain,
    {RH("s.weighted_average_watts / CAST(NULLIF(t.ftp_watts, 0) AS DOUBLE)", 3)} AS intensity_factor,
    {RH("(CAST(s.moving_time_s AS DOUBLE) * s.weighted_average_watts * s.weighted_average_watts) / (CAST(NULLIF(t.ftp_watts, 0) AS DOUBLE) * CAST(NULLIF(t.ftp_watts, 0) AS DOUBLE) * CAST(3600.0 AS DOUBLE)) * CAST(100.0 AS DOUBLE)", 2)} AS tss,
    NULLIF(t.ftp_watts, 0) AS ftp_watts_at_activity, s.average_cadence AS avg_cadence,
    s.activity_name, s.activity_type
  FROM staged s LEFT JOIN thr t
    ON s.athlete_id = t.athlete_id AND t.valid_to IS NULL
   AND CAST(s.start_date_utc AS DATE) >= t.valid_from)"""

HR_EFF = f"""
hr_eff AS (
  SELECT a.activity_id, f.ftp_id, hz.hr_zone_id, a.avg_power_w, a.normalized_power, a.avg_hr,
    CASE WHEN a.avg_hr > 0 THEN {RH("a.avg_power_w / a.avg_hr", 2)} END AS watts_per_bpm,
    CASE WHEN a.avg_hr > 0 AND a.normalized_power IS NOT NULL
         THEN {RH("a.normalized_power / a.avg_hr", 3)} END AS efficiency_factor,
    hz.zone_number AS hr_zone_number, hz.zone_label AS hr_zone_label,
    hz.zone_name AS hr_zone_name, hz.training_focus AS hr_zone_benefit
  FROM fact a
  JOIN thr f ON a.athlete_id = f.athlete_id AND a.activity_date >= f.valid_from
            AND a.activity_date < coalesce(f.valid_to, DATE '2999-12-31')
  LEFT JOIN hrz hz ON hz.athlete_id = a.athlete_id AND a.activity_date >= hz.valid_from
            AND (hz.valid_to IS NULL OR a.activity_date < hz.valid_to)
            AND a.avg_hr >= hz.bpm_low AND a.avg_hr < hz.bpm_high)"""

PZM = """
pzm AS (
  SELECT a.activity_id, a.ftp_id, 'normalized_power' AS classification_basis,
    CAST(CAST(a.normalized_power AS DECIMAL(6,2)) AS DOUBLE) AS power_watts,
    CAST(CAST(dz.watts_low AS DECIMAL(6,2)) AS DOUBLE) AS zone_watts_low,
    CAST(CAST(dz.watts_high AS DECIMAL(6,2)) AS DOUBLE) AS zone_watts_high,
    dz.zone_number, dz.zone_label, dz.zone_name, dz.training_benefit
  FROM fact a JOIN pz dz ON dz.ftp_id = a.ftp_id AND a.normalized_power >= dz.watts_low
                         AND (dz.watts_high IS NULL OR a.normalized_power < dz.watts_high)
  WHERE a.normalized_power IS NOT NULL AND a.ftp_id IS NOT NULL)"""

RIDES = """
rides AS (
  SELECT r.*, he.watts_per_bpm, he.efficiency_factor, he.hr_zone_id, he.hr_zone_number,
    he.hr_zone_label, he.hr_zone_name, he.hr_zone_benefit,
    p.zone_number AS power_zone_number, p.zone_label AS power_zone_label,
    p.zone_name AS power_zone_name, p.training_benefit AS power_zone_benefit
  FROM fact r
  LEFT JOIN hr_eff he ON r.activity_id = he.activity_id
  LEFT JOIN pzm p ON r.activity_id = p.activity_id
  WHERE r.activity_type = 'purchase')"""


def _daily_select(grain: str) -> str:
    keys = "athlete_id, activity_date" + (", activity_id, activity_name" if grain == "activity" else "")
    top = ""
    if grain == "day":
        top = """,
    arg_max(power_zone_label, power_zone_number) AS power_zone_label_top,
    arg_max(hr_zone_label, hr_zone_number) AS hr_zone_label_top"""
    return f"""
  SELECT {keys},
    max(power_zone_label) AS power_zone_label, max(power_zone_name) AS power_zone_name,
    max(power_zone_benefit) AS power_zone_benefit, max(hr_zone_label) AS hr_zone_label,
    max(hr_zone_name) AS hr_zone_name, max(hr_zone_benefit) AS hr_zone_benefit,
    count(*) AS ride_count,
    {RH(XSUM("distance_km"), 2)} AS distance_km,
    {RH(XSUM("duration_minutes"), 2)} AS duration_minutes,
    {WM("avg_speed_kmh", 2)} AS avg_speed_kmh_wt,
    {WM("avg_power_w", 0)} AS avg_power_w_wt,
    {WM("normalized_power", 0)} AS normalized_power_wt,
    {WM("avg_hr", 0)} AS avg_hr_bpm_wt,
    {WM("watts_per_bpm", 2)} AS watts_per_bpm_wt,
    {WM("efficiency_factor", 3)} AS efficiency_factor_wt,
    {RH(XSUM("tss"), 2)} AS tss_total,
    {RH("avg(CAST(intensity_factor AS DECIMAL(20,6)))", 3)} AS intensity_factor_avg,
    max(CASE WHEN hr_zone_number = 4 THEN 1 ELSE 0 END) AS is_high_hr_zone,
    max(CASE WHEN power_zone_number = 4 THEN 1 ELSE 0 END) AS is_high_power_zone{top}
  FROM rides GROUP BY {keys}"""


def _dense(grain: str) -> str:
    ids = "d.activity_id, d.activity_name, " if grain == "activity" else ""
    return f"""
daily_rows AS ({_daily_select(grain)}),
bounds AS (SELECT min(activity_date) AS s FROM rides),
days AS (
  SELECT CAST(unnest(range(CAST(s AS TIMESTAMP), TIMESTAMP '2024-02-01 00:00:00', INTERVAL 1 DAY)) AS DATE) AS date
  FROM bounds WHERE s IS NOT NULL),
dense AS (
  SELECT a.athlete_id, a.first_name AS athlete_name, ds.date, {ids}d.activity_date,
    CAST(coalesce(d.ride_count, 0) AS BIGINT) AS ride_count,
    coalesce(d.distance_km, 0.0) AS distance_km,
    coalesce(d.duration_minutes, 0.0) AS duration_minutes,
    d.avg_speed_kmh_wt, d.avg_power_w_wt, d.normalized_power_wt, d.avg_hr_bpm_wt,
    d.power_zone_label, d.power_zone_name, d.power_zone_benefit,
    d.hr_zone_label, d.hr_zone_name, d.hr_zone_benefit,
    d.watts_per_bpm_wt, d.efficiency_factor_wt,
    coalesce(d.tss_total, 0.0) AS tss_total, d.intensity_factor_avg,
    coalesce(d.is_high_hr_zone, 0) AS is_high_hr_zone,
    coalesce(d.is_high_power_zone, 0) AS is_high_power_zone
  FROM ath a CROSS JOIN days ds
  LEFT JOIN daily_rows d ON d.athlete_id = a.athlete_id AND d.activity_date = ds.date)"""


def _roll(src: str, value: str, keys: str = "athlete_id", day: str = "date",
          spans=(("tss_7d", 7), ("tss_28d", 28)), scale: int = 6) -> str:
    parts = []
    for name, n in spans:
        parts.append(
            f"CAST(sum(CAST(coalesce({value}, 0) AS DECIMAL(38,{scale}))) OVER (PARTITION BY {keys} "
            f"ORDER BY {day} RANGE BETWEEN INTERVAL {n - 1} DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS {name}")
    return ",\n    ".join(parts)


BASE = [STAGED, TESTS, THR, ATH, HR_DEFS, P_DEFS, HRZ, PZ, FACT, HR_EFF, PZM, RIDES]


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _q(body: str, ctes=None) -> str:
    return _with(*(ctes or BASE)) + "\n" + body


MART = _dense("activity") + f""",
day_load AS (
  SELECT athlete_id, date, sum(CAST(tss_total AS DECIMAL(38,6))) AS day_tss
  FROM dense GROUP BY athlete_id, date),
rolled AS (
  SELECT athlete_id, date,
    {_roll("day_load", "day_tss")}
  FROM day_load),
mart AS (
  SELECT d.*, r.tss_7d, r.tss_28d FROM dense d JOIN rolled r USING (athlete_id, date))"""


def _quality_sql() -> str:
    parts = []
    for c in MART_CHECKS:
        sev = c.get("severity", "error")
        if c["kind"] == "unique":
            cols = ", ".join(c["columns"])
            fail_count = (f"(SELECT count(*) FROM (SELECT {cols} FROM mart GROUP BY {cols} "
                          f"HAVING count(*) > 1))")
            parts.append(f"SELECT '{c['name']}' AS check_name, '{','.join(c['columns'])}' AS column_name, "
                         f"'unique' AS kind, CAST({fail_count} AS BIGINT) AS failures, '{sev}' AS severity")
            continue
        col = c.get("column")
        if c["kind"] == "not_null":
            fail = f"{col} IS NULL"
        elif c["kind"] == "accepted_values":
            vals = ", ".join(repr(v) if isinstance(v, str) else str(v) for v in c["values"])
            fail = f"NOT ({col} IN ({vals}))"
        elif c["kind"] == "accepted_range":
            fail = f"NOT ({col} >= {c['min']} AND {col} <= {c['max']})"
        else:
            fail = f"NOT ({c['expr']})"
        if c.get("where"):
            fail = f"({c['where']}) AND {fail}"
        parts.append(f"SELECT '{c['name']}' AS check_name, '{col or ''}' AS column_name, "
                     f"'{c['kind']}' AS kind, CAST(count(*) FILTER (WHERE {fail}) AS BIGINT) AS failures, "
                     f"'{sev}' AS severity FROM mart")
    body = "\nUNION ALL\n".join(parts)
    return _q(f"""SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn'
  ELSE 'fail' END AS status FROM (
{body})""", BASE + [MART])


def _sd():
    return """
sd AS (SELECT activity_id, athlete_id, CAST(start_date_utc AS DATE) AS activity_date FROM staged)"""


SQL: dict[str, str] = {}

SQL["stage_json_typed"] = _q("SELECT * FROM staged", [STAGED])

SQL["ride_projection"] = _q("""
SELECT r.activity_id, r.athlete_id, a.first_name AS athlete_name,
  CAST(r.start_date_utc AS DATE) AS activity_date, r.activity_name, r.distance_km,
  r.moving_time_min, r.avg_speed_kmh,
  (r.distance_km >= 25 AND r.moving_time_min > 30) AS is_long_ride
FROM staged r JOIN ath a ON r.athlete_id = a.athlete_id
WHERE r.activity_type = 'purchase'""", [STAGED, ATH])

SQL["dim_date"] = """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e FROM orders),
d AS (SELECT CAST(unnest(range(CAST(s AS TIMESTAMP), CAST(e + 1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_id FROM b)
SELECT date_id, rpad(lower(dayname(date_id)), 9, ' ') AS day_of_week,
  CAST(isodow(date_id) AS INTEGER) AS day_of_week_num,
  CAST(week(date_id) AS INTEGER) AS week_of_year,
  CAST(isoyear(date_id) AS INTEGER) AS iso_year,
  CAST(month(date_id) AS INTEGER) AS month,
  rpad(lower(monthname(date_id)), 9, ' ') AS month_name,
  CAST(quarter(date_id) AS INTEGER) AS quarter,
  CAST(year(date_id) AS INTEGER) AS year,
  isodow(date_id) IN (6, 7) AS is_weekend
FROM d"""

SQL["inline_values_bands"] = _q("""
SELECT ftp_id, athlete_id, ftp_watts, ftp_wkg, test_date, test_type,
  CAST(NULL AS VARCHAR) AS test_notes, 'customer' AS source
FROM tests""", [TESTS])

SQL["scd2_threshold"] = _q("""
SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS created_at,
  lead(test_date) OVER (PARTITION BY athlete_id ORDER BY test_date, ftp_id) AS valid_to_exclusive
FROM thr""", [TESTS, THR])

SQL["power_bands"] = _q("""
SELECT ftp_id, athlete_id, zone_number, zone_name, zone_label,
  CAST(ftp_pct_low AS DOUBLE) AS ftp_pct_low, CAST(ftp_pct_high AS DOUBLE) AS ftp_pct_high,
  watts_low, watts_high, training_benefit
FROM pz""", [TESTS, THR, P_DEFS, PZ])

SQL["hr_bands_surrogate_key"] = _q("""
SELECT hr_zone_id, athlete_id, zone_number, zone_name, zone_label,
  CAST(hr_pct_low AS DOUBLE) AS hr_pct_low, CAST(hr_pct_high AS DOUBLE) AS hr_pct_high,
  bpm_low, bpm_high, fatigue_risk, training_focus, valid_from, valid_to, is_current
FROM hrz""", [ATH, HR_DEFS, HRZ])

SQL["fact_current_threshold"] = _q("""
SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS created_at, TIMESTAMP '2024-02-01 00:00:00' AS updated_at
FROM fact""", [STAGED, TESTS, THR, FACT])

SQL["fact_as_of_threshold"] = _q("""
SELECT s.activity_id, s.athlete_id, s.activity_date, t.ftp_id, t.ftp_watts
FROM sd s JOIN thr t ON s.athlete_id = t.athlete_id AND s.activity_date >= t.valid_from
  AND s.activity_date < coalesce(t.valid_to, DATE '2999-12-31')""", [STAGED, _sd(), TESTS, THR])

SQL["fact_as_of_inclusive"] = _q("""
SELECT s.activity_id, s.athlete_id, s.activity_date, t.ftp_id, t.ftp_watts
FROM sd s LEFT JOIN thr t ON s.athlete_id = t.athlete_id AND s.activity_date >= t.valid_from
  AND (t.valid_to IS NULL OR s.activity_date <= t.valid_to)""", [STAGED, _sd(), TESTS, THR])

SQL["retest_gap_rows"] = _q("""
SELECT s.activity_id, s.athlete_id, s.activity_date FROM sd s
WHERE EXISTS (SELECT 1 FROM thr t WHERE t.athlete_id = s.athlete_id
                AND s.activity_date >= t.valid_from AND (t.valid_to IS NULL OR s.activity_date <= t.valid_to))
  AND NOT EXISTS (SELECT 1 FROM thr t WHERE t.athlete_id = s.athlete_id
                AND s.activity_date >= t.valid_from AND (t.valid_to IS NULL OR s.activity_date < t.valid_to))""",
                                [STAGED, _sd(), TESTS, THR])

SQL["power_zone_match"] = _q("SELECT * FROM pzm", [STAGED, TESTS, THR, P_DEFS, PZ, FACT, PZM])

SQL["hr_efficiency_keyed"] = _q("""
SELECT activity_id, ftp_id, hr_zone_id, avg_power_w, normalized_power, avg_hr, watts_per_bpm,
  efficiency_factor, hr_zone_number FROM hr_eff""",
                                    [STAGED, TESTS, THR, ATH, HR_DEFS, HRZ, FACT, HR_EFF])

SQL["hr_band_theta"] = _q("""
SELECT f.activity_id, f.avg_hr, b.zone_number, b.bpm_low, b.bpm_high
FROM fact f LEFT JOIN bands b ON f.avg_hr >= b.bpm_low AND f.avg_hr < b.bpm_high""",
                              [STAGED, TESTS, THR, FACT, ATH, HR_DEFS, """
ref AS (SELECT max(max_hr) AS reference_bpm FROM ath_hist),
bands AS (
  SELECT d.zone_number, CAST(floor(r.reference_bpm * d.hr_pct_low) AS INTEGER) AS bpm_low,
    CAST(floor(r.reference_bpm * d.hr_pct_high) AS INTEGER) AS bpm_high
  FROM ref r CROSS JOIN hr_defs d)"""])

SQL["weighted_means"] = _q(f"""
SELECT athlete_id, activity_date, count(*) AS ride_count,
  {WM("avg_speed_kmh", 2)} AS avg_speed_kmh_wt,
  {WM("avg_power_w", 0)} AS avg_power_w_wt,
  {WM("normalized_power", 0)} AS np_wt,
  {WM("normalized_power", 0, True)} AS np_wt_present,
  {WM("avg_hr", 0)} AS hr_wt,
  {WM("avg_hr", 0, True)} AS hr_wt_present,
  {WM("watts_per_bpm", 2)} AS wpb_wt,
  {WM("watts_per_bpm", 2, True)} AS wpb_wt_present,
  {WM("efficiency_factor", 3)} AS ef_wt,
  {WM("efficiency_factor", 3, True)} AS ef_wt_present,
  {RH("avg(CAST(intensity_factor AS DECIMAL(20,6)))", 3)} AS intensity_factor_avg
FROM rides GROUP BY athlete_id, activity_date""")

SQL["daily_by_activity"] = _q(_daily_select("activity"))
SQL["daily"] = _q(_daily_select("day"))
SQL["densified_daily"] = _q("SELECT * FROM dense", BASE + [_dense("day")])

ROLL = f""",
rolled AS (
  SELECT athlete_id, date, tss_total,
    {_roll("dense", "tss_total")}
  FROM dense)"""

SQL["rolling_load_7_28"] = _q("SELECT * FROM rolled", BASE + [_dense("day") + ROLL])

SQL["rolling_orders_range"] = f"""
WITH day AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_date, count(*) AS orders,
    sum(CAST(o_totalprice AS DECIMAL(38,2))) AS day_total
  FROM orders GROUP BY 1, 2)
SELECT o_custkey, order_date, orders, CAST(day_total AS DOUBLE) AS day_total,
  {_roll("day", "day_total", keys="o_custkey", day="order_date", spans=(("total_7d", 7), ("total_28d", 28)), scale=2)}
FROM day"""

_RATIO = RH("(tss_7d / CAST(7.0 AS DOUBLE)) / NULLIF(tss_28d / CAST(28.0 AS DOUBLE), 0)", 3)
SQL["load_ratio_label"] = _q(f"""
SELECT athlete_id, date, tss_7d, tss_28d, {_RATIO} AS acwr,
  CASE WHEN {_RATIO} IS NULL THEN 'no_load' WHEN {_RATIO} > 1.5 THEN 'over'
       WHEN {_RATIO} < 0.8 THEN 'under' ELSE 'optimal' END AS load_label
FROM rolled""", BASE + [_dense("day") + ROLL])

for _name, _col in (("zone_share", "power_zone_label"), ("hr_zone_share", "hr_zone_label")):
    SQL[_name] = _q(f"""
SELECT {_col} AS zone_label, count(*) AS rides,
  {RH("count(*) / (SELECT count(*) FROM rides)", 4)} AS share
FROM rides GROUP BY {_col}""")

SQL["monthly_summary"] = _q(f"""
SELECT athlete_id, CAST(date_trunc('month', activity_date) AS DATE) AS month, count(*) AS rides,
  {RH(XSUM("distance_km"), 2)} AS distance_km,
  {RH(XSUM("duration_minutes"), 2)} AS duration_minutes,
  {RH(XSUM("tss"), 2)} AS tss_total,
  {RH("avg(CAST(intensity_factor AS DECIMAL(20,6)))", 3)} AS intensity_factor_avg,
  {RH(XSUM("distance_km") + " / count(*)", 2)} AS km_per_ride
FROM rides GROUP BY 1, 2""")

SQL["recent_log"] = _q("""
SELECT athlete_id, rank, activity_id, activity_date, activity_name, distance_km,
  duration_minutes, tss, power_zone_label, hr_zone_label, watts_per_bpm
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY athlete_id
                     ORDER BY activity_date DESC, activity_id DESC) AS INTEGER) AS rank FROM rides)
WHERE rank <= 10""")

SQL["efficiency_trend"] = _q(f"""
SELECT activity_date, count(watts_per_bpm) AS rides_with_hr,
  {RH("avg(CAST(watts_per_bpm AS DECIMAL(20,6)))", 3)} AS watts_per_bpm_avg,
  {RH("avg(CAST(efficiency_factor AS DECIMAL(20,6)))", 3)} AS efficiency_factor_avg
FROM rides GROUP BY activity_date""")

SQL["mart_full"] = _q("SELECT * FROM mart", BASE + [MART])
SQL["quality_report"] = _quality_sql()
SQL["duplicate_keys"] = _q("""
SELECT athlete_id, activity_date, count(*) AS n_rows FROM mart
GROUP BY athlete_id, activity_date HAVING count(*) > 1""", BASE + [MART])

SQL["orphan_entities"] = _q("""
SELECT 'rides_without_athlete' AS check_name,
  (SELECT count(*) FROM fact f WHERE f.activity_type = 'purchase'
     AND NOT EXISTS (SELECT 1 FROM ath a WHERE a.athlete_id = f.athlete_id)) AS n
UNION ALL
SELECT 'athletes_without_rides',
  (SELECT count(*) FROM ath a WHERE NOT EXISTS (
     SELECT 1 FROM fact f WHERE f.activity_type = 'purchase' AND f.athlete_id = a.athlete_id))
UNION ALL
SELECT 'athletes_without_threshold',
  (SELECT count(*) FROM ath a WHERE NOT EXISTS (SELECT 1 FROM thr t WHERE t.athlete_id = a.athlete_id))""",
                                [STAGED, TESTS, THR, FACT, ATH])

SQL["upsert_latest_wins"] = """
WITH ev AS (SELECT user_id, event_id, ts, event_type, value FROM events),
old AS (SELECT * FROM ev WHERE event_type IN ('view', 'signup', 'error')
        QUALIFY row_number() OVER (PARTITION BY user_id
                ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC) = 1),
new AS (SELECT * FROM ev WHERE event_type IN ('purchase', 'click')
        QUALIFY row_number() OVER (PARTITION BY user_id
                ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC) = 1)
SELECT * FROM old WHERE user_id NOT IN (SELECT user_id FROM new)
UNION ALL SELECT * FROM new"""

SQL["upsert_partial_columns"] = """
WITH old AS (
  SELECT c_custkey AS entity_id, c_name AS name, c_acctbal AS balance, c_mktsegment AS scope,
    TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM customer),
b AS (
  SELECT o_custkey AS entity_id, o_totalprice AS balance,
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS scope
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT coalesce(b.entity_id, o.entity_id) AS entity_id, o.name AS name,
  CASE WHEN b.entity_id IS NOT NULL THEN b.balance ELSE o.balance END AS balance,
  CASE WHEN b.entity_id IS NOT NULL THEN coalesce(b.scope, o.scope) ELSE o.scope END AS scope,
  CASE WHEN o.entity_id IS NOT NULL THEN o.created_at ELSE TIMESTAMP '2024-02-01 00:00:00' END AS created_at,
  CASE WHEN b.entity_id IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE o.updated_at END AS updated_at
FROM old o FULL OUTER JOIN b ON o.entity_id = b.entity_id"""

SQL["stale_entities"] = """
WITH last AS (SELECT user_id, max(ts) AS last_ts FROM events GROUP BY user_id),
e AS (
  SELECT c.c_custkey AS entity_id,
    coalesce(CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_name END, '') AS token,
    CAST(coalesce(epoch_ms(l.last_ts) // 1000 + 604800, 0) AS BIGINT) AS expires_at
  FROM customer c LEFT JOIN last l ON c.c_custkey = l.user_id)
SELECT entity_id, expires_at, token = '' AS token_missing,
  (token = '' OR 1706659200 >= expires_at) AS is_stale
FROM e"""

# rows of the dirty landing table: what is wrong with each
_DIRTY = """
dirty AS (
  SELECT event_id, user_id, ts,
    CASE WHEN event_id % 29 = 0 THEN '$' WHEN event_id % 23 = 0 THEN 'id'
         WHEN event_id % 19 = 0 THEN 'moving_time' WHEN event_id % 17 = 0 THEN 'start_date' END AS field
  FROM events)"""

SQL["load_audit"] = _with(_DIRTY) + """,
f AS (SELECT user_id AS athlete_id, count(*) AS fetched, count(*) FILTER (WHERE field IS NULL) AS upserted,
             count(field) AS errors FROM dirty GROUP BY 1),
l AS (SELECT c_custkey AS athlete_id FROM customer WHERE c_acctbal >= 0)
SELECT coalesce(f.athlete_id, l.athlete_id) AS athlete_id, coalesce(fetched, 0) AS fetched,
  coalesce(upserted, 0) AS upserted, coalesce(errors, 0) AS errors, l.athlete_id IS NOT NULL AS listed,
  coalesce(upserted, 0) > 0 AND coalesce(errors, 0) = 0 AS ok
FROM f FULL OUTER JOIN l ON f.athlete_id = l.athlete_id"""

_FIELDS = ["id", "start_date", "name", "type", "sport_type", "distance", "moving_time", "elapsed_time",
           "total_elevation_gain", "average_speed", "max_speed", "average_watts", "max_watts", "kilojoules",
           "weighted_average_watts", "average_cadence", "average_heartrate", "max_heartrate", "$"]
SQL["parse_audit"] = _with(_DIRTY) + f"""
SELECT t.field, (SELECT count(*) FROM dirty d WHERE d.field = t.field) AS bad_values
FROM (VALUES {", ".join(f"('{x}')" for x in _FIELDS)}) t(field)"""

SQL["stage_rejects"] = _with(_DIRTY) + """
SELECT event_id AS activity_id, user_id AS athlete_id, field,
  CASE field WHEN 'start_date' THEN 'soon' WHEN 'moving_time' THEN CAST(600 + event_id % 5400 AS VARCHAR) || '.0'
    WHEN '$' THEN left('{"id":' || CAST(event_id AS VARCHAR) || ',"start_date":"2024', 20) END AS raw_text
FROM dirty WHERE field IS NOT NULL"""

SQL["stage_dirty_rows"] = _with(_DIRTY) + """
SELECT event_id AS activity_id, user_id AS athlete_id, ts AS start_date_utc,
  CAST(600 + event_id % 5400 AS INTEGER) AS moving_time_s
FROM dirty WHERE field IS NULL AND ts >= TIMESTAMP '2024-01-10 00:00:00'"""

SQL["stage_json_decimal"] = _q("""
SELECT activity_id, """ + ", ".join(f"CAST(CAST({c} AS DECIMAL(20,6)) AS DOUBLE) AS {c}" for c in (
    "distance_m", "elevation_m", "avg_power_w", "kilojoules", "avg_hr")) + " FROM staged", [STAGED])

SQL["serialize_nulls"] = """
SELECT event_id AS activity_id, '{"id":' || CAST(event_id AS VARCHAR) || ',"type":"' || event_type || '","np":'
  || CASE WHEN event_id % 11 = 0 THEN 'null' ELSE CAST(105 + (event_id * 7) % 120 AS VARCHAR) END || '}' AS payload
FROM events"""

SQL["values_bands_join"] = _q("""
SELECT activity_id, moving_time_s, CASE WHEN moving_time_s >= 4200 THEN 'long'
  WHEN moving_time_s >= 2400 THEN 'medium' WHEN moving_time_s >= 600 THEN 'short' END AS band
FROM staged""", [STAGED])

SQL["literal_row_union"] = _q("""
SELECT athlete_id, first_name, max_hr, added_at FROM ath
UNION ALL SELECT -1, 'nobody', NULL, NULL""", [ATH])

SQL["hr_band_closed_upper"] = _q("""
SELECT s.activity_id, s.athlete_id, s.avg_hr, z.zone_number
FROM staged s JOIN hrz z ON z.athlete_id = s.athlete_id AND z.is_current
  AND s.avg_hr >= z.bpm_low AND s.avg_hr <= z.bpm_high""", [STAGED, ATH, HR_DEFS, HRZ])

_RUNS = """
run1 AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'),
run2 AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-09 00:00:00')"""

SQL["snapshot_explode"] = _with(_RUNS) + """
SELECT event_id AS activity_id, value * 1000 AS distance_m,
  TIMESTAMP '2024-02-01 00:00:00' AS extracted_at_utc,
  'activities_raw_20240201T000000Z' AS snapshot
FROM run2"""

SQL["page_union"] = _with(_RUNS) + """
SELECT user_id AS athlete_id, event_id AS activity_id, 1 AS run FROM run1
UNION ALL
SELECT user_id, event_id, 2 FROM run2"""

SQL["entity_pages"] = _with(_RUNS) + """
SELECT user_id AS athlete_id, event_id AS activity_id, 'ride ' || CAST(event_id AS VARCHAR) AS activity_name,
  CAST((row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), event_id) - 1) // 200 AS INTEGER) AS page
FROM run2"""

SQL["snapshot_rejects"] = """
SELECT 'activities_raw_20240201T000000Z' AS snapshot, field, n FROM (
  SELECT 'kept' AS field, count(*) AS n FROM events WHERE event_id % 29 <> 0 AND event_id % 23 <> 0
  UNION ALL SELECT 'id', count(*) FROM events WHERE event_id % 29 <> 0 AND event_id % 23 = 0)
WHERE n > 0"""

SQL["full_refresh_layers"] = """
SELECT event_type, count(*) AS n, 'analytics' AS layer FROM events WHERE value > 10 GROUP BY event_type"""

SQL["csv_summary"] = _q("""
SELECT activity_id AS ride_id, activity_name AS name, CAST(start_date_utc AS DATE) AS start_date,
  distance_km, moving_time_min, avg_speed_kmh AS average_speed_kmh, elevation_m,
  avg_power_w AS average_power, max_power_w AS max_power, avg_hr AS average_hr, max_hr,
  kilojoules, sport_type
FROM staged""", [STAGED])

SQL["stream_incremental_upsert"] = """
SELECT user_id AS athlete_id, event_id AS activity_id,
  CASE WHEN ts >= TIMESTAMP '2024-01-09 00:00:00' THEN TIMESTAMP '2024-02-01 00:00:00'
       ELSE TIMESTAMP '2024-01-16 00:00:00' END AS extracted_at_utc,
  value * 1000 AS distance_m
FROM events"""


SQL["stream_event_time_upsert"] = """
WITH seen AS (SELECT * FROM events),
l3 AS (SELECT *, (ts < (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00') - INTERVAL 2 DAY) AS is_late
  FROM seen WHERE ts >= TIMESTAMP '2024-01-18 00:00:00' OR event_id % 7 = 0),
l2 AS (SELECT *, (ts < (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-12 00:00:00') - INTERVAL 2 DAY) AS is_late
  FROM seen WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'),
every AS (
  SELECT user_id, event_id, ts, TIMESTAMP '2024-01-12 00:00:00' AS x, false AS is_late FROM seen WHERE ts < TIMESTAMP '2024-01-12 00:00:00'
  UNION ALL SELECT user_id, event_id, ts, TIMESTAMP '2024-01-20 00:00:00', is_late FROM l2
  UNION ALL SELECT user_id, event_id, ts, TIMESTAMP '2024-02-01 00:00:00', is_late FROM l3)
SELECT user_id AS athlete_id, event_id AS activity_id, max(x) AS extracted_at_utc, any_value(ts) AS start_at, 'table' AS place
FROM every WHERE NOT is_late GROUP BY user_id, event_id
UNION ALL SELECT user_id, event_id, x, ts, 'late' FROM every WHERE is_late"""

SQL["time_in_zone"] = _q("""
SELECT athlete_id, zone_number, zone_label,
  CAST(round(CAST(sum(part) AS DECIMAL(28,10)), 3) AS DOUBLE) AS seconds, count(*) AS intervals
FROM (
  SELECT i.athlete_id, z.zone_number, z.zone_label, CAST(sec * CASE
      WHEN a = b THEN CASE WHEN a >= z.bpm_low AND a < z.bpm_high THEN 1.0 ELSE 0.0 END
      ELSE greatest(least(greatest(a, b), z.bpm_high) - greatest(least(a, b), z.bpm_low), 0.0) / abs(b - a) END
    AS DECIMAL(38,6)) AS part
  FROM (SELECT athlete_id, least((t2 - t) / 1000000.0::DOUBLE, 14400.0::DOUBLE) AS sec, v AS a,
          CASE WHEN (t2 - t) / 1000000.0::DOUBLE <= 14400 AND v2 IS NOT NULL THEN v2 ELSE v END AS b
        FROM (SELECT athlete_id, epoch_us(start_date_utc) AS t, avg_hr AS v,
                lead(epoch_us(start_date_utc)) OVER w AS t2, lead(avg_hr) OVER w AS v2
              FROM staged WINDOW w AS (PARTITION BY athlete_id ORDER BY start_date_utc, activity_id))
        WHERE t2 IS NOT NULL AND v IS NOT NULL) i
  JOIN hrz z ON z.athlete_id = i.athlete_id AND z.is_current)
WHERE part > 0 GROUP BY athlete_id, zone_number, zone_label""", [STAGED, ATH, HR_DEFS, HRZ])

SQL["team_benchmark"] = _q("""
SELECT athlete_id, team, power_w,
  CASE WHEN power_w IS NOT NULL THEN percent_rank() OVER (PARTITION BY team, power_w IS NULL ORDER BY power_w) END AS rank_in_team,
  CASE WHEN power_w IS NOT NULL THEN percent_rank() OVER (PARTITION BY power_w IS NULL ORDER BY power_w) END AS rank_in_all
FROM (SELECT c.c_custkey AS athlete_id, c.c_nationkey AS team,
        CAST(round(avg(CAST(s.weighted_average_watts AS DECIMAL(20,6))), 1) AS DOUBLE) AS power_w
      FROM customer c LEFT JOIN (SELECT * FROM staged WHERE activity_type = 'purchase') s ON s.athlete_id = c.c_custkey
      GROUP BY 1, 2)""", [STAGED])


SQL["fact_as_of_merge"] = SQL["fact_as_of_threshold"]
SQL["catalog_keyed_upsert"] = SQL["upsert_partial_columns"]
SQL["snapshot_split"] = SQL["snapshot_explode"]

SQL["secured_rides"] = _q("""
SELECT s.activity_id, s.athlete_id, s.distance_km, 'coach-' || c.c_nationkey AS viewer
FROM staged s JOIN customer c ON c.c_custkey = s.athlete_id WHERE c.c_nationkey IN (3, 7)""", [STAGED])

SQL["load_anomalies"] = _q("""
SELECT athlete_id, date, distance_km, base_days, round(CAST(mean AS DECIMAL(28,10)), 3)::DOUBLE AS base_mean,
  round(CAST(std AS DECIMAL(28,10)), 3)::DOUBLE AS base_std,
  CASE WHEN base_days >= 5 AND std > 0 THEN round(CAST((distance_km - mean) / std AS DECIMAL(28,10)), 3)::DOUBLE END AS z_score,
  coalesce(CASE WHEN base_days >= 5 AND std > 0 THEN abs((distance_km - mean) / std) > 2.0 END, false) AS is_anomaly
FROM (SELECT *, CASE WHEN base_days > 0 THEN total::DOUBLE / base_days END AS mean,
        CASE WHEN base_days > 1 THEN sqrt((base_days * squares - total * total)::DOUBLE / (base_days * (base_days - 1))) END AS std
      FROM (SELECT *, count(v) OVER w AS base_days, CAST(sum(v) OVER w AS DECIMAL(14,3)) AS total,
              CAST(sum(CAST(v * v AS DECIMAL(24,6))) OVER w AS DECIMAL(28,6)) AS squares
            FROM (SELECT *, CAST(distance_km AS DECIMAL(14,3)) AS v FROM (
              SELECT athlete_id, CAST(start_date_utc AS DATE) AS date,
                round(CAST(sum(CAST(distance_km AS DECIMAL(20,6))) AS DECIMAL(28,10)), 2)::DOUBLE AS distance_km
              FROM staged GROUP BY 1, 2))
            WINDOW w AS (PARTITION BY athlete_id ORDER BY date RANGE BETWEEN INTERVAL 14 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)))""", [STAGED])

SQL["virtual_outdoor"] = _q("""
SELECT *, round(CAST(efficiency_a / nullif(efficiency_b, 0) AS DECIMAL(28,10)), 3)::DOUBLE AS efficiency_ratio
FROM (SELECT athlete_id, """ + ", ".join(f"""count(*) FILTER (WHERE activity_type = '{k}') AS rides_{n},
  round(CAST(avg(CAST(duration_minutes AS DECIMAL(20,6))) FILTER (WHERE activity_type = '{k}') AS DECIMAL(28,10)), 2)::DOUBLE AS minutes_{n},
  round(CAST(avg(CAST(normalized_power AS DECIMAL(20,6))) FILTER (WHERE activity_type = '{k}') AS DECIMAL(28,10)), 1)::DOUBLE AS power_{n},
  round(CAST(avg(CAST(ef AS DECIMAL(20,6))) FILTER (WHERE activity_type = '{k}') AS DECIMAL(28,10)), 3)::DOUBLE AS efficiency_{n}"""
    for n, k in (("a", "click"), ("b", "purchase"))) + """
  FROM (SELECT *, CASE WHEN avg_hr > 0 AND normalized_power IS NOT NULL
        THEN round(CAST(normalized_power / avg_hr AS DECIMAL(28,10)), 3)::DOUBLE END AS ef FROM fact)
  WHERE activity_type IN ('click', 'purchase') GROUP BY athlete_id)""", [STAGED, TESTS, THR, FACT])


SQL["rolling_incremental"] = """
SELECT athlete_id, date, distance_km, CAST(sum(CAST(distance_km AS DECIMAL(38,6))) OVER (
    PARTITION BY athlete_id ORDER BY date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS DOUBLE) AS km_7d,
  CAST(sum(CAST(distance_km AS DECIMAL(38,6))) OVER (
    PARTITION BY athlete_id ORDER BY date RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW) AS DOUBLE) AS km_28d
FROM (SELECT user_id AS athlete_id, CAST(ts AS DATE) AS date,
        round(CAST(sum(CAST(value AS DECIMAL(20,6))) AS DECIMAL(28,10)), 2)::DOUBLE AS distance_km
      FROM events WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY 1, 2)"""


def _contract_sql() -> str:
    schema_rows = " UNION ALL\n".join(
        f"SELECT 'contract_type_{c}' AS check_name, '{c}' AS column_name, 'schema' AS kind, "
        f"CAST(0 AS BIGINT) AS failures, 'error' AS severity" for c in MART_CONTRACT)
    nn = " UNION ALL\n".join(
        f"SELECT 'contract_not_null_{c}', '{c}', 'not_null', "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT), 'error' FROM mart"
        for c in MART_PRIMARY_KEY)
    cols = ", ".join(MART_PRIMARY_KEY)
    pk = (f"SELECT 'contract_primary_key', '{','.join(MART_PRIMARY_KEY)}', 'unique', "
          f"CAST((SELECT count(*) FROM (SELECT {cols} FROM mart GROUP BY {cols} "
          f"HAVING count(*) > 1)) AS BIGINT), 'error'")
    return _q(f"""SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
{schema_rows} UNION ALL
{nn} UNION ALL
{pk})""", BASE + [MART])


SQL["mart_contract"] = _contract_sql()

SQL["incremental_fact_upsert"] = _q("""
SELECT f.activity_id, f.athlete_id, f.activity_date, f.tss,
  CASE WHEN e.ts < TIMESTAMP '2024-01-16 00:00:00' THEN TIMESTAMP '2024-01-16 00:00:00'
       ELSE TIMESTAMP '2024-02-01 00:00:00' END AS created_at,
  CASE WHEN e.ts >= TIMESTAMP '2024-01-09 00:00:00' THEN TIMESTAMP '2024-02-01 00:00:00'
       ELSE TIMESTAMP '2024-01-16 00:00:00' END AS updated_at
FROM fact f JOIN events e ON e.event_id = f.activity_id""", [STAGED, TESTS, THR, FACT])
