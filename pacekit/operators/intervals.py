"""Time between samples: capped intervals in (entity, time chunk) groups, split at band crossings.

A stream of samples (heart rate, power, ...) says how long an entity spent in each band: each
sample reaches to the entity's next one, a gap longer than the cap is a pause, and a value
that moves from one sample to the next crosses bands on the way.

A window over an entity would put a long ride, or a device that never stops, into one
task. Samples are grouped by entity and time chunk instead; the first sample of the next
chunk that has any - its *halo* - is added to each chunk, so the interval over the edge is
there and is counted once. Only chunk heads, one row per chunk, are ever ordered by entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacekit.operators.lookup import fold, meet


def _epoch(at: str) -> Column:
    return F.unix_micros(F.col(at).cast("timestamp"))


def next_in_chunks(samples: DataFrame, keys: Sequence[str], at: str, value: str, tiebreak: Sequence[str],
                   chunk_s: int) -> DataFrame:
    """``samples`` with ``_t`` (microseconds) and the entity's next sample as ``_t2``, ``_v2``.

    Samples are ordered by time, then ``tiebreak`` (which tells equal times apart); the
    last sample of an entity has no next one. Samples without a time are left out.
    """
    order = ["_t", *tiebreak]
    s = samples.filter(F.col(at).isNotNull()).withColumn("_t", _epoch(at))
    s = s.withColumn("_chunk", F.floor(F.col("_t") / F.lit(chunk_s * 1_000_000)))
    head = F.min(F.struct(*order, F.col(value).alias("_v"))).alias("_head")
    heads = s.groupBy(*keys, "_chunk").agg(head)                # partial: one row per chunk and map task
    by_entity = Window.partitionBy(*keys).orderBy("_chunk")
    halo = (heads.select(*keys, "_chunk", F.lead("_head").over(by_entity).alias("_head"))
            .filter(F.col("_head").isNotNull())
            .select(*keys, "_chunk", *[F.col(f"_head.{c}").alias(c) for c in order],
                    F.col("_head._v").alias(value), F.lit(True).alias("_halo")))
    rows = s.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy(*order)   # the halo is the last of its chunk
    return (rows.withColumns({"_t2": F.lead("_t").over(in_chunk), "_v2": F.lead(value).over(in_chunk)})
            .filter(~F.col("_halo")).drop("_halo", "_chunk"))


def intervals(samples: DataFrame, keys: Sequence[str], at: str, value: str, tiebreak: Sequence[str],
              cap_s: float, chunk_s: int = 86_400) -> DataFrame:
    """Per sample ``seconds`` up to the next one, and the values ``v_from``, ``v_to`` at its ends.

    After a gap longer than ``cap_s`` the value holds for ``cap_s`` seconds and the rest is a
    pause. A sample without a value, and the last of an entity, count no time; next to
    a sample without a value the value holds.
    """
    j = next_in_chunks(samples, keys, at, value, tiebreak, chunk_s)
    gap = (F.col("_t2") - F.col("_t")).cast("double") / F.lit(1e6)
    moves = (gap <= F.lit(cap_s)) & F.col("_v2").isNotNull()
    out = j.filter(F.col("_t2").isNotNull() & F.col(value).isNotNull()).withColumns({
        "seconds": F.least(gap, F.lit(float(cap_s))), "v_from": F.col(value).cast("double"),
        "v_to": F.when(moves, F.col("_v2")).otherwise(F.col(value)).cast("double")})
    return out.drop("_t", "_t2", "_v2")


def share_in_band(low: Column, high: Column) -> Column:
    """The share of an interval whose value, moving evenly from ``v_from`` to ``v_to``, lies in
    [low, high); a band without an upper bound is open."""
    a, b = F.least("v_from", "v_to"), F.greatest("v_from", "v_to")
    top = F.coalesce(high, F.lit(float("inf")))
    inside = F.greatest(F.least(b, top) - F.greatest(a, low), F.lit(0.0)) / (b - a)
    return F.when(a == b, F.when((a >= low) & (a < top), 1.0).otherwise(0.0)).otherwise(inside)


def time_in_bands(spans: DataFrame, bands: DataFrame, keys: Sequence[str], band_cols: Sequence[str], low: str,
                  high: str) -> DataFrame:
    """Seconds per entity and band: ``spans`` from :func:`intervals`, ``bands`` a handful per entity.

    Every interval is split over the bands it crosses and summed map side before the one
    shuffle by (entity, band), so a hot entity reaches its sum as one row per task and band.
    Sums are exact: shares are taken to the microsecond.
    """
    folded = fold(bands, keys, list(dict.fromkeys([low, high, *band_cols])), "_bands")
    j = meet(spans.select(*keys, "seconds", "v_from", "v_to"), folded, keys, "inner")
    part = F.transform("_bands", lambda z: F.struct(
        *[z[c].alias(c) for c in band_cols],
        (F.col("seconds") * share_in_band(z[low].cast("double"), z[high].cast("double")))
        .cast("decimal(38,6)").alias("_part")))
    each = j.select(*keys, F.inline(F.filter(part, lambda z: z["_part"] > 0)))
    return each.groupBy(*keys, *band_cols).agg(F.sum("_part").cast("double").alias("seconds"),
                                               F.count(F.lit(1)).alias("intervals"))
