"""How a fact stream meets a per-entity dimension: one join, one plan for every size.

A dimension is folded to one row per entity that holds its versions or bands
in an array (a handful per entity: threshold tests, zone bands). The facts meet
it in a single equi-join on the entity and the row in force is picked by a
higher-order function. Nothing is counted while the plan is built: the join is a
sort-merge join at every size, and AQE splits a hot entity's fact partition, which it
can, because the join stands alone in its stage - several dimensions are folded into
one row (:func:`fold_all`) instead of being joined one after the other. The folded side
grows with the entities, and what Spark expects of its size before it runs (the scan's
bytes; generated rows and their arrays count for nothing) is far too small: as a
broadcast every executor would hold all of it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def meet(facts: DataFrame, folded: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join of facts and folded rows on the keys and a hash of the keys.

    The hash adds nothing to the condition, but a side that is already
    partitioned by the keys (a version window, an earlier step) is then shuffled
    for this join: AQE splits a skewed fact partition only where both sides of a
    join come straight from a shuffle. The folded side is small.
    """
    kinds = dict(facts.dtypes)
    d = folded.withColumns({k: F.col(k).cast(kinds[k]) for k in keys}).withColumn("_h", F.xxhash64(*keys))
    return facts.withColumn("_h", F.xxhash64(*keys)).join(d.hint("merge"), [*keys, "_h"], how).drop("_h")


def fold(dim: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str = "_versions") -> DataFrame:
    """One row per entity with its dimension rows as a sorted ``array<struct<cols>>``."""
    return dim.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))


def fold_all(dims: Mapping[str, tuple[DataFrame, Sequence[str]]], keys: Sequence[str]) -> DataFrame:
    """Several dimensions in one row per entity: an array per dimension, one shuffle for all."""
    rows = None
    for name, (dim, cols) in dims.items():
        part = dim.select(*keys, F.struct(*cols).alias(name))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows.groupBy(*keys).agg(*[F.array_sort(F.collect_list(n)).alias(n) for n in dims])


def matching(versions: Column, holds: Callable[[Column], Column]) -> Column:
    """The rows of a folded dimension for which ``holds`` is true (null counts as false)."""
    return F.filter(versions, lambda v: F.coalesce(holds(v), F.lit(False)))


def first_match(versions: Column, holds: Callable[[Column], Column]) -> Column:
    """The one row in force (the first, should versions overlap), null if there is none."""
    return F.get(matching(versions, holds), F.lit(0))


def folded_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], dim_cols: Sequence[str],
                holds: Callable[[Column], Column], needs: Sequence[str], how: str = "left") -> DataFrame:
    """Facts with the ``dim_cols`` of every dimension row of their entity for which ``holds``.

    Same rows as joining the dimension itself on the keys and the condition:
    ``left`` keeps facts without a match, ``inner`` drops them.
    """
    cols = list(dict.fromkeys([*needs, *dim_cols]))
    j = meet(facts, fold(dim, keys, cols), keys, "left" if how == "left" else "inner")
    found = F.transform(matching(F.col("_versions"), holds),
                        lambda v: F.struct(*[v[c].alias(c) for c in dim_cols]))
    spread = F.inline_outer(found) if how == "left" else F.inline(found)
    return j.select(*[F.col(c) for c in facts.columns], spread)


def lookup(facts: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Plain equi-join to a dimension that is unique on the keys."""
    return facts.join(dim, list(keys), how)
