"""Band (numeric range) dimensions and range joins.

``make_bands`` turns a per-entity reference value (threshold watts, max heart
rate) into one row per band with ``floor(ref * pct)`` integer bounds. The band
definitions are a handful of literals, so they are attached with ``inline`` on
a literal array - a per-row generator, no join and no shuffle.

``band_join`` matches a value to the band containing it:

* keyed: bands folded per entity, one equi-join, the band picked by a
  higher-order function (``operators.lookup``);
* unkeyed (``keys=()``): a pure range join as an equi-join on value buckets
  (each band is exploded into the buckets it overlaps), never a nested loop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacekit.operators.lookup import folded_join


def band_literals(defs: Sequence[Mapping], types: Mapping[str, str]) -> Column:
    """A literal ``array<struct>`` holding the band definitions."""
    def literal(value) -> str:
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'" if value is not None else "null"

    structs = [", ".join(f"'{name}', cast({literal(d[name])} as {typ})" for name, typ in types.items()) for d in defs]
    return F.expr("array(" + ", ".join(f"named_struct({s})" for s in structs) + ")")


def make_bands(ref: DataFrame, defs: Sequence[Mapping], types: Mapping[str, str],
               ref_col: str, pct_low: str, pct_high: str,
               low_name: str, high_name: str) -> DataFrame:
    """One row per (reference row, band) with integer bounds ``floor(ref*pct)``."""
    out = ref.select("*", F.inline(band_literals(defs, types)))
    return (out.withColumn(low_name, F.floor(F.col(ref_col) * F.col(pct_low)).cast("int"))
               .withColumn(high_name, F.floor(F.col(ref_col) * F.col(pct_high)).cast("int")))


def in_band(value: Column, low: Column, high: Column, open_upper: bool = False,
            closed_high: bool = False) -> Column:
    """``low <= value < high``; a NULL ``high`` is unbounded when ``open_upper``."""
    upper = value <= high if closed_high else value < high
    if open_upper:
        upper = high.isNull() | upper
    return (value >= low) & upper


def band_holds(value: Column, low: str = "low", high: str = "high", open_upper: bool = False,
               closed_high: bool = False):
    """Predicate over a folded band: it contains ``value``."""
    return lambda b: in_band(value, b[low], b[high], open_upper, closed_high)


def band_join(facts: DataFrame, bands: DataFrame, value: str, band_cols: Sequence[str],
              keys: Sequence[str] = (), how: str = "left", low: str = "low",
              high: str = "high", open_upper: bool = False, closed_high: bool = False,
              extra=None, extra_cols: Sequence[str] = (), buckets: int = 1024) -> DataFrame:
    """Attach the band that contains ``facts[value]``.

    ``open_upper`` reads a NULL upper bound as unbounded, ``closed_high``
    includes the upper bound. ``extra`` is one more predicate over a band (a
    function of the band, e.g. a validity interval) that reads ``extra_cols``.
    Returns all fact columns plus ``band_cols``.

    Keyed bands are folded per entity and met in one equi-join; without keys the
    join is an equi-join on value buckets (:func:`bucketed_range_join`).
    """
    if not keys:
        return bucketed_range_join(facts, bands, value, band_cols, how, low, high, open_upper,
                                   closed_high, buckets)
    inside = band_holds(F.col(value), low, high, open_upper, closed_high)
    holds = inside if extra is None else (lambda b: inside(b) & extra(b))
    return folded_join(facts, bands, keys, band_cols, holds, [low, high, *extra_cols], how)


def bucketed_range_join(facts, bands, value, band_cols, how="left", low="low", high="high",
                        open_upper=False, closed_high=False, buckets=1024):
    """Range join as an equi-join on buckets of the value.

    The range that the bands span is cut into ``buckets`` equal parts (two scalar
    subqueries inside the plan, nothing is run to build it); values and bounds
    beyond it fall into the first and the last. The bucket never falls as the
    value rises, so a band covers the buckets of its bounds and those between:
    at most ``buckets + 1`` rows per band, whatever its width.
    """
    lo = bands.select(F.min(low).cast("double")).scalar()
    hi = bands.select(F.max(F.coalesce(high, low)).cast("double")).scalar()
    width = F.greatest((hi - lo) / F.lit(float(buckets)), F.lit(1e-9))

    def bucket(x: Column) -> Column:
        at = F.floor((x.cast("double") - lo) / width)
        return F.least(F.greatest(at, F.lit(0)), F.lit(buckets)).cast("int")

    top = F.when(F.col(high).isNull(), F.lit(buckets)).otherwise(bucket(F.col(high)))
    usable = bands if open_upper else bands.filter(F.col(high).isNotNull())
    b = usable.filter(F.col(low).isNotNull()).withColumn(
        "_bucket", F.explode(F.sequence(bucket(F.col(low)), F.greatest(top, bucket(F.col(low))))))
    fa, ba = facts.withColumn("_bucket", bucket(F.col(value))).alias("_f"), b.alias("_b")
    cond = (F.col("_f._bucket") == F.col("_b._bucket")) & in_band(
        F.col(f"_f.{value}"), F.col(f"_b.{low}"), F.col(f"_b.{high}"), open_upper, closed_high)
    return fa.join(ba, cond, how).select(*[F.col(f"_f.{c}") for c in facts.columns],
                                         *[F.col(f"_b.{c}").alias(c) for c in band_cols])
