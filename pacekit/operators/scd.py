"""Type-2 slowly changing dimensions and the joins that read them.

``scd2`` derives ``valid_from / valid_to / is_current`` from a history of
versions with one window (``lead``) per entity. Versions per entity are few
(a threshold test every few weeks), so the per-entity window partition stays
small even when one entity owns a large share of the *facts*.

``interval_join`` is one equi-join on the entity key to the versions folded into
an array per entity; the version in force is picked by a higher-order function.
Spark sort-merges, never a nested loop, and splits a hot entity's fact partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacekit.operators.lookup import fold, folded_join, meet


def scd2(df: DataFrame, keys: Sequence[str], order_col: str,
         tiebreak: Sequence[str] = (), end_offset_days: int = 0,
         from_col: str = "valid_from", to_col: str = "valid_to",
         current_col: str | None = "is_current") -> DataFrame:
    """Add validity columns to a version history.

    ``valid_from`` is the version's own date; ``valid_to`` is the next version's
    date minus ``end_offset_days`` (1 gives an *inclusive* end as in a
    "day before the retest" convention, 0 an *exclusive* end). The newest
    version gets ``valid_to = NULL`` and ``is_current = true``. Ties on the
    order column are broken by ``tiebreak`` so the result is deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(order_col), *[F.col(c) for c in tiebreak])
    nxt = F.lead(F.col(order_col)).over(w).cast("date")
    out = (df.withColumn(from_col, F.col(order_col).cast("date"))
             .withColumn(to_col, F.date_sub(nxt, end_offset_days) if end_offset_days else nxt))
    if current_col:
        out = out.withColumn(current_col, F.col(to_col).isNull())
    return out


def validity_predicate(at: Column, valid_from: Column, valid_to: Column,
                       end: str = "exclusive") -> Column:
    """``at`` inside ``[valid_from, valid_to)`` (or ``]`` when inclusive); NULL end is open."""
    if end not in ("exclusive", "inclusive"):
        raise ValueError("end must be 'exclusive' or 'inclusive'")
    upper = at < valid_to if end == "exclusive" else at <= valid_to
    return (at >= valid_from) & (valid_to.isNull() | upper)


def in_force(at: Column, from_col: str = "valid_from", to_col: str = "valid_to", end: str = "exclusive",
             current_only: bool = False):
    """Predicate over a folded version: it is in force at ``at`` (see ``interval_join``)."""
    if current_only:
        return lambda v: v[to_col].isNull() & (at >= v[from_col])
    return lambda v: validity_predicate(at, v[from_col], v[to_col], end)


def interval_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], at: str,
                  dim_cols: Sequence[str], how: str = "inner", end: str = "exclusive",
                  current_only: bool = False, from_col: str = "valid_from",
                  to_col: str = "valid_to") -> DataFrame:
    """Attach the dimension version in force at ``facts[at]``.

    * ``current_only=False`` - the version whose interval contains the date
      (as-of semantics; ``end`` names the interval convention).
    * ``current_only=True`` - only the open (latest) version, and only for facts
      on or after its start; older facts get NULLs on a left join.

    Returns all fact columns plus ``dim_cols``. One equi-join to the versions
    folded per entity (``operators.lookup``).
    """
    if end not in ("exclusive", "inclusive"):
        raise ValueError("end must be 'exclusive' or 'inclusive'")
    return folded_join(facts, dim, keys, dim_cols, in_force(F.col(at), from_col, to_col, end, current_only),
                       [from_col, to_col], how)


def retest_gap(facts: DataFrame, dim: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Facts that an exclusive-end join loses but an inclusive-end join keeps.

    With ``valid_to = next_start - 1 day`` the day before each new version is
    such a gap. Both conditions are tested on the folded versions in one join,
    so no fact x version pairs appear.
    """
    def gap(v):
        inside = validity_predicate(F.col(at), v["valid_from"], v["valid_to"], "inclusive")
        return F.struct(inside.alias("i"),
                        validity_predicate(F.col(at), v["valid_from"], v["valid_to"], "exclusive").alias("e"))

    j = meet(facts, fold(dim, keys, ["valid_from", "valid_to"]), keys, "inner")
    seen = F.transform("_versions", gap)
    keep = F.exists(seen, lambda x: x["i"]) & ~F.exists(seen, lambda x: x["e"])
    return j.filter(keep).select(*facts.columns)
