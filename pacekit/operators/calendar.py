"""Calendar dimension and densified per-entity day series.

Both are built with ``explode(sequence(start, end))``: a per-row generator, so
the day series of each entity is produced where the entity row lives, without
a cross join and without a shuffle. ``sequence`` is inclusive, so an exclusive
end is turned into ``end - 1 day``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacekit.functions.metrics import padded_day_name, padded_month_name


def _col(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x).cast("date") if isinstance(x, str) else F.lit(x)


def day_series(start, end_inclusive) -> Column:
    return F.explode(F.sequence(_col(start).cast("date"), _col(end_inclusive).cast("date"),
                                F.expr("INTERVAL 1 DAY")))


def date_dim(bounds: DataFrame, start: str = "start", end_exclusive: str = "end") -> DataFrame:
    """Calendar rows for ``[start, end)`` taken from a one-row bounds frame.

    Columns: date_id, day_of_week (lower-case, padded to 9), day_of_week_num
    (ISO 1=Mon..7=Sun), week_of_year (ISO week), iso_year, month, month_name,
    quarter, year, is_weekend.
    """
    days = bounds.select(day_series(F.col(start), F.date_sub(F.col(end_exclusive), 1))
                         .alias("date_id"))
    d = F.col("date_id")
    isodow = F.extract(F.lit("DAYOFWEEK_ISO"), d).cast("int")
    return days.select(
        d,
        padded_day_name(d).alias("day_of_week"),
        isodow.alias("day_of_week_num"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        F.month(d).cast("int").alias("month"),
        padded_month_name(d).alias("month_name"),
        F.quarter(d).cast("int").alias("quarter"),
        F.year(d).cast("int").alias("year"),
        isodow.isin(6, 7).alias("is_weekend"),
    )


def spine(entities: DataFrame, keys: Sequence[str], start, end_inclusive,
          day_col: str = "date", carry: Sequence[str] = ()) -> DataFrame:
    """One row per entity and day in ``[start, end_inclusive]``.

    ``start``/``end_inclusive`` may be literals, columns of ``entities`` (per
    entity ranges) or scalar-subquery columns (global ranges).
    """
    return entities.select(*keys, *carry, day_series(start, end_inclusive).alias(day_col))


DENSE_ROWS = 250_000    # generated rows of one task, about


def dealt(entities: DataFrame, start, end_inclusive, rows: int = DENSE_ROWS) -> int:
    """Partitions for entities x days, in proportion to them. Counts the entities (a job)."""
    cores = entities.sparkSession.sparkContext.defaultParallelism
    days = (end_inclusive - start).days + 1 if start is not None else 0
    return max(cores, -(-entities.count() * days // rows))


def densify(entities: DataFrame, facts: DataFrame, keys: Sequence[str], start,
            end_inclusive, fact_day: str, day_col: str = "date",
            carry: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Entities x days with the facts of each (entity, day); rest days have NULL facts.

    Same rows as left-joining the facts onto the spine, without joining it: each
    fact row emits its own day and the rest days up to the entity's next fact day
    (the first one also the days before it). So only the facts are shuffled,
    by entity, and a following per-entity window reuses that partitioning. Facts
    outside ``[start, end_inclusive]`` are left out. Fact columns keep their
    names; the calendar day is ``day_col``.

    Use it on facts aggregated to (entity, day): an entity then has at most one
    row per calendar day in its window partition, however hot it is.

    The days are generated after the shuffle, so its bytes say little about the rows of
    a task: ``partitions`` deals entities and facts over that many (see :func:`dealt`).
    """
    start, end = _col(start).cast("date"), _col(end_inclusive).cast("date")
    fact_cols = [c for c in facts.columns if c not in keys and c != day_col]
    day = F.col(fact_day)
    inside = facts.select(*keys, *fact_cols).filter((day >= start) & (day <= end))
    ent = entities.select(*keys, *carry)
    if partitions:
        ent, inside = ent.repartition(partitions, *keys), inside.repartition(partitions, *keys).hint("merge")
    rows = ent.join(inside, list(keys), "left")
    w = Window.partitionBy(*keys).orderBy(day)
    rows = rows.withColumn("_next", F.lead(day).over(w)).withColumn("_nth", F.row_number().over(w))
    first = F.when(F.col("_nth") == 1, start).otherwise(day)
    last = F.when(F.col("_next").isNull(), end).otherwise(F.greatest(day, F.date_sub(F.col("_next"), 1)))
    # an empty calendar (end before start) has no days, where sequence() would count down
    days = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    dense = rows.withColumn(day_col, F.explode(days))
    own = F.col(day_col) == day
    return dense.select(*keys, *carry, day_col, *[F.when(own, F.col(c)).alias(c) for c in fact_cols])
