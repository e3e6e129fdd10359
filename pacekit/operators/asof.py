"""As-of join for long histories: events and versions merged in time chunks, the last version carried on.

``scd.interval_join`` folds an entity's versions into one row, which suits a handful. An entity
with very many versions is spread here: events and versions are united and grouped by
(entity, time chunk); inside a chunk the last version before an event is a window, and what
was in force when the chunk began is the last version of the nearest earlier chunk that has
one - a window over chunk tails, one row per chunk. No task ever holds a whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacekit.operators.scd import validity_predicate


def merge_asof(facts: DataFrame, dim: DataFrame, keys: Sequence[str], at: str, dim_cols: Sequence[str],
               how: str = "inner", end: str = "exclusive", from_col: str = "valid_from", to_col: str = "valid_to",
               chunk_days: int = 7, order_cols: Sequence[str] = ()) -> DataFrame:
    """``interval_join(facts, dim, keys, at, dim_cols, how, end)`` for versions that do not overlap.

    Of versions that begin on one day the last by ``order_cols`` counts. Facts without a key or a
    day match nothing; versions without a begin are left out.
    """
    if end not in ("exclusive", "inclusive"):
        raise ValueError("end must be 'exclusive' or 'inclusive'")
    kinds = dict(facts.dtypes)

    def chunk(day):
        return F.floor(F.unix_date(day.cast("date")) / F.lit(chunk_days))

    version = F.struct(*[F.col(c) for c in dict.fromkeys([from_col, *order_cols, to_col, *dim_cols])])
    v = dim.filter(F.col(from_col).isNotNull()).select(
        *[F.col(k).cast(kinds[k]).alias(k) for k in keys], F.col(from_col).cast("date").alias("_day"),
        F.lit(0).alias("_kind"), version.alias("_version"))
    f = facts.select(*keys, F.col(at).cast("date").alias("_day"), F.lit(1).alias("_kind"),
                     F.struct(*facts.columns).alias("_fact"))
    rows = f.unionByName(v, allowMissingColumns=True).withColumn("_chunk", chunk(F.col("_day")))
    order = [F.col("_day"), F.col("_kind"), F.col("_version")]       # a version holds from its own day on
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_last", F.last("_version", ignorenulls=True).over(inside))
    # chunk tails: the last version of each (entity, chunk); a chunk takes the nearest earlier one
    tails = (f.select(*keys, chunk(F.col("_day")).alias("_chunk"), F.lit(None).cast(v.schema["_version"].dataType)
                      .alias("_version"))
             .unionByName(v.select(*keys, chunk(F.col("_day")).alias("_chunk"), "_version"))
             .groupBy(*keys, "_chunk").agg(F.max("_version").alias("_tail")))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(*keys, "_chunk", F.last("_tail", ignorenulls=True).over(earlier).alias("_before"))
    events = rows.filter("_kind = 1").select(*keys, "_chunk", "_fact", "_last")
    j = events.join(carried, [*keys, "_chunk"], "left").select(
        "_fact", F.coalesce("_last", "_before").alias("_v"))
    holds = validity_predicate(F.col(f"_fact.{at}"), F.col(f"_v.{from_col}"), F.col(f"_v.{to_col}"), end)
    if how == "inner":
        j = j.filter(holds)
    return j.select("_fact.*", *[F.when(holds, F.col(f"_v.{c}")).alias(c) for c in dim_cols])
