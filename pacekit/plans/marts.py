"""Questions the mart answers (trend, load ratio, zone share, monthly KPIs, log)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacekit.functions import metrics as M


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group under ``order`` (which must be total).

    Spark turns ``row_number() <= k`` into a map-side ``WindowGroupLimit``: every map
    task ships at most ``k`` rows per group, so a hot group reaches its task as
    ``k`` rows per task. The limit is the feature (a top-k report).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def zone_share(rides: DataFrame, label: str) -> DataFrame:
    """Ride count and share per zone label (NULL label = unclassified).

    The total is a scalar subquery over the same grouped counts, whose exchange
    Spark reuses, so the rides are scanned once.
    """
    counts = rides.groupBy(F.col(label).alias("zone_label")).agg(
        F.count(F.lit(1)).alias("rides"))
    total = counts.agg(F.sum("rides")).scalar()
    return counts.withColumn("share", M.round_half_up(F.col("rides") / total, 4))


def monthly_summary(rides: DataFrame) -> DataFrame:
    return (rides.groupBy("athlete_id", F.trunc("activity_date", "month").alias("month"))
                 .agg(F.count(F.lit(1)).alias("rides"),
                      M.round_half_up(M.exact_sum("distance_km"), 2).alias("distance_km"),
                      M.round_half_up(M.exact_sum("duration_minutes"), 2).alias("duration_minutes"),
                      M.round_half_up(M.exact_sum("tss"), 2).alias("tss_total"),
                      M.round_half_up(F.avg(F.col("intensity_factor").cast("decimal(20,6)")), 3)
                       .alias("intensity_factor_avg"),
                      M.round_half_up(M.exact_sum("distance_km") / F.count(F.lit(1)), 2)
                       .alias("km_per_ride")))


def efficiency_trend(rides: DataFrame) -> DataFrame:
    return (rides.groupBy("activity_date")
                 .agg(F.count(F.col("watts_per_bpm")).alias("rides_with_hr"),
                      M.round_half_up(F.avg(F.col("watts_per_bpm").cast("decimal(20,6)")), 3)
                       .alias("watts_per_bpm_avg"),
                      M.round_half_up(F.avg(F.col("efficiency_factor").cast("decimal(20,6)")), 3)
                       .alias("efficiency_factor_avg")))


def compare_types(facts: DataFrame, first: str, second: str) -> DataFrame:
    """Two activity types side by side per athlete (e.g. virtual and outdoor rides).

    One pass: both types are summed in one grouped aggregate, partial counts before the
    shuffle. A ratio is null where an athlete lacks one of the types.
    """
    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("activity_type") == F.lit(kind), value)

    aggs = []
    for name, kind in (("a", first), ("b", second)):
        power = of(kind, F.col("normalized_power").cast("decimal(20,6)"))
        per_beat = of(kind, M.efficiency_factor("normalized_power", "avg_hr").cast("decimal(20,6)"))
        aggs += [F.count_if(F.col("activity_type") == F.lit(kind)).alias(f"rides_{name}"),
                 M.round_half_up(F.avg(of(kind, F.col("duration_minutes").cast("decimal(20,6)"))), 2).alias(f"minutes_{name}"),
                 M.round_half_up(F.avg(power), 1).alias(f"power_{name}"),
                 M.round_half_up(F.avg(per_beat), 3).alias(f"efficiency_{name}")]
    out = facts.filter(F.col("activity_type").isin(first, second)).groupBy("athlete_id").agg(*aggs)
    ratio = F.col("efficiency_a") / M.nullif_zero(F.col("efficiency_b"))
    return out.withColumn("efficiency_ratio", M.round_half_up(ratio, 3))
