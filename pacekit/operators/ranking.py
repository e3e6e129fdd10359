"""Global order statistics without a global window: range partitions and prefix sums.

``row_number() over (order by x)`` moves the whole table into one task. Here rows are
dealt by ranges of the order (``repartitionByRange``, sampled, so parts are even), summed
per part, and a row's place is the part's offset - a prefix sum over one row per part -
plus its place inside the part. Ties are grouped before anything is dealt, so a value
that holds a third of all rows is one row here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacekit.operators.lookup import meet
from pacekit.sources.sinks import materialize


def prefix_sums(df: DataFrame, order: Sequence[str], weight: str, name: str = "before") -> DataFrame:
    """``df`` (unique on ``order``) with the sum of ``weight`` over all rows that sort before.

    The dealt rows are written once with their part number, so a retried task cannot
    see another dealing than the one that was summed.
    """
    dealt = materialize(df.sparkSession, df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()),
                        "ranges")
    sums = dealt.groupBy("_part").agg(F.sum(weight).alias("_sum"))      # one row per part
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_in", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return (placed.join(offsets, "_part").withColumn(name, F.col("_offset") + F.col("_in"))
            .drop("_part", "_in", "_offset"))


def percent_rank(df: DataFrame, value: str, groups: Sequence[str] = (), name: str = "percent_rank") -> DataFrame:
    """``df`` with the exact percent rank of ``value`` among its group: (rank - 1) / (rows - 1).

    Null values have no rank and are not counted; a group of one row has rank 0; ties share
    the lowest rank. Equal values are counted together first, the distinct values are
    ranked, and rows meet their value's rank in one equi-join that AQE can split.
    """
    known = df.filter(F.col(value).isNotNull())
    counts = known.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_rows"))
    ranked = prefix_sums(counts, [*groups, value], "_rows", "_before")
    if groups:
        first = [F.min("_before").alias("_start"), F.sum("_rows").alias("_all")]
        ranked = ranked.join(ranked.groupBy(*groups).agg(*first), list(groups))
    else:
        ranked = ranked.withColumns({"_start": F.lit(0), "_all": counts.agg(F.sum("_rows")).scalar()})
    share = (F.col("_before") - F.col("_start")).cast("double") / (F.col("_all") - 1)
    ranks = ranked.select(*groups, value, F.when(F.col("_all") == 1, F.lit(0.0)).otherwise(share).alias(name))
    return meet(df, ranks, [*groups, value], "left")
