"""Rolling day-window sums and the acute:chronic load ratio.

Windows run as RANGE frames over an integer day number, so "7 days" means 7
calendar days whatever the number of rows per day, rows of one day are peers
(deterministic), and no densified calendar is needed to get the sums on the
days that exist. All spans share one window spec, so Spark plans a single
exchange + sort + Window node for them.

Scale note: partitioning is by entity only. Callers feed these windows data
pre-aggregated to (entity, day), so one entity contributes at most one row per
calendar day to a window partition, however many events it owns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacekit.functions.metrics import day_number


def rolling_sums(df: DataFrame, keys: Sequence[str], day: str, value: str,
                 spans: Mapping[str, int], null_as_zero: bool = True,
                 decimal_scale: int | None = 6) -> DataFrame:
    """Add ``name = sum(value)`` over the last ``n`` days (inclusive) per entity."""
    w = Window.partitionBy(*keys).orderBy(day_number(F.col(day)))
    v = F.coalesce(F.col(value), F.lit(0)) if null_as_zero else F.col(value)
    if decimal_scale is not None:
        v = v.cast(f"decimal(38,{decimal_scale})")
    cols = {}
    for name, n in spans.items():
        s = F.sum(v).over(w.rangeBetween(-(n - 1), 0))
        cols[name] = s.cast("double") if decimal_scale is not None else s
    return df.withColumns(cols)     # one projection -> one Window node for all spans


def load_ratio(short_sum: str, long_sum: str, short_days: int = 7, long_days: int = 28,
               over: float = 1.5, under: float = 0.8, digits: int = 3) -> tuple[Column, Column]:
    """Acute:chronic ratio of daily means and its label.

    ratio = (short_sum / short_days) / (long_sum / long_days); a raw-sum ratio
    could never exceed 1 because the short window lies inside the long one.
    Label: 'over' when ratio > ``over``, 'under' when < ``under``, 'optimal'
    otherwise, 'no_load' when the long window has no load.
    """
    from pacekit.functions.metrics import round_half_up

    long_mean = F.col(long_sum).cast("double") / F.lit(float(long_days))
    short_mean = F.col(short_sum).cast("double") / F.lit(float(short_days))
    ratio = round_half_up(short_mean / F.when(long_mean == 0, F.lit(None)).otherwise(long_mean),
                          digits)
    label = (F.when(ratio.isNull(), F.lit("no_load"))
              .when(ratio > over, F.lit("over"))
              .when(ratio < under, F.lit("under"))
              .otherwise(F.lit("optimal")))
    return ratio, label
