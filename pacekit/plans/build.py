"""Build every model as a stored table, in lineage order, then test the mart.

This is the full-refresh build a warehouse user runs daily: each model is
written as a Parquet table under ``root/<layer>/<model>`` (layer routing:
a custom layer name is used verbatim), downstream models read the stored
upstream tables, and the mart checks run last. A failed ``error`` check
raises after the tables are written (warn checks only report).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pacekit.operators import quality as Q
from pacekit.plans import models as MD
from pacekit.sources import ingest as I
from pacekit.sources.sinks import layer_database, write_table

LAYERS = {"stg_activities": "staging", "dim_threshold": "dwh", "dim_power_zones": "dwh",
          "dim_hr_zones": "dwh", "dim_athlete": "dwh", "fact_activities": "dwh",
          "fact_power_zone": "dwh", "fact_hr_efficiency": "dwh", "mart_daily": "analytics"}


def build_warehouse(spark: SparkSession, raw: DataFrame, threshold_tests: DataFrame,
                    athlete_history: DataFrame, root: str, as_of: str, ride_type: str,
                    checks=None, min_start: str | None = None, gate: bool = True,
                    layers: dict | None = None) -> dict:
    """Write all models; return ``{model: path}`` plus ``"quality"`` report rows."""
    layers = {**LAYERS, **(layers or {})}
    paths: dict = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{root}/{layer_database(layers.get(name), 'default')}/{name}"
        paths[name] = write_table(df, path)
        return spark.read.parquet(path)

    staged = store("stg_activities", I.stage_activities(raw, min_start))
    thresholds = store("dim_threshold", MD.dim_threshold(threshold_tests))
    power = store("dim_power_zones", MD.power_zone_dim(thresholds))
    hr = store("dim_hr_zones", MD.hr_zone_dim(athlete_history))
    athletes = store("dim_athlete", MD.latest_athletes(athlete_history))
    fact = store("fact_activities", MD.fact_activities(staged, thresholds, "current_only"))
    store("fact_power_zone", MD.fact_power_zone(fact, power))
    store("fact_hr_efficiency", MD.fact_hr_efficiency(fact, thresholds, hr))
    rides = MD.rides_enriched(fact, thresholds, power, hr, ride_type)
    mart = store("mart_daily", MD.mart(athletes, rides, as_of))
    if checks:
        report = Q.quality_report(mart, checks)
        paths["quality"] = Q.gate(report) if gate else [r.asDict() for r in report.collect()]
    return paths
