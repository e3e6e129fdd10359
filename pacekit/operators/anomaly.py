"""Anomaly flags: a day's value against the mean and spread of the entity's days before it.

Sums and sums of squares run as exact decimals in RANGE frames over the day number, so nothing
drifts when a day leaves the frame, and a constant series has a variance of exactly zero.
Feed it (entity, day) totals: an entity has at most one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacekit.functions.metrics import day_number, round_half_up


def anomaly_flags(daily: DataFrame, keys: Sequence[str], day: str, value: str, days: int = 28,
                  least: int = 5, over: float = 3.0) -> DataFrame:
    """``daily`` with ``base_days``, ``base_mean``, ``base_std``, ``z_score`` and ``is_anomaly``.

    The base is the ``days`` days before the day, itself excluded; with fewer than ``least``
    values, or no spread among them, there is no score and no flag. Null values are no base
    and get no score.
    """
    w = Window.partitionBy(*keys).orderBy(day_number(F.col(day))).rangeBetween(-days, -1)
    v = F.col(value).cast("decimal(14,3)")
    n, total = F.count(v).over(w), F.sum(v).over(w)
    squares = F.sum((v * v).cast("decimal(28,6)")).over(w)
    d = daily.withColumns({"base_days": n, "_total": total, "_squares": squares})
    n = F.col("base_days")
    # n * sum(v^2) - sum(v)^2, exact: zero if and only if all values are equal
    spread = (n * F.col("_squares").cast("decimal(30,6)")
              - (F.col("_total").cast("decimal(18,3)") * F.col("_total").cast("decimal(18,3)"))).cast("double")
    mean = F.when(n > 0, F.col("_total").cast("double") / n)
    std = F.when(n > 1, F.sqrt(spread / (n * (n - 1))))
    known = (n >= least) & (std > 0)
    score = F.when(known, (F.col(value) - mean) / std)
    return d.withColumns({
        "base_mean": round_half_up(mean, 3), "base_std": round_half_up(std, 3), "z_score": round_half_up(score, 3),
        "is_anomaly": F.coalesce(F.abs(score) > over, F.lit(False))}).drop("_total", "_squares")
