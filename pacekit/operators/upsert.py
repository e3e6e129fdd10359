"""Keyed upsert (last write wins) for tables stored as plain files.

Parquet has no MERGE, so an upsert is a relational rewrite:

1. ``latest_per_key`` de-duplicates the incoming batch - a duplicate key
   inside one batch keeps the greatest ``order_by`` value and never fails.
   It is a ``groupBy(keys).max(struct(order_by, rest))``: partial aggregation
   collapses a hot key on the map side before the shuffle, and the struct
   ordering breaks ties on every column, so the winner is deterministic.
2. one full outer join of the old table with the de-duplicated batch on the
   keys, choosing per column: new value, old value (``insert_only_cols`` such
   as ``created_at``), or ``coalesce(new, old)`` (``keep_if_null_cols``).

Both inputs are unique on the keys after step 1, so the join cannot fan out
and has no hot key. A NULL in a key equals NULL, so applying the same batch twice
gives the same table. Batch columns that the table lacks are an error.
The caller writes the result to a *new* location (see ``sinks.write_table``),
never over the path it is reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` (ties: greatest row)."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.max(F.struct(*[F.col(c) for c in (*order_by, *rest)])).alias("_r")
    return (df.groupBy(*keys).agg(packed)
              .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in (*order_by, *rest)])
              .select(*df.columns))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order_by: Sequence[str],
           insert_only_cols: Sequence[str] = (), keep_if_null_cols: Sequence[str] = (),
           touch_col: str | None = None, touch_value=None, null_safe: bool = True) -> DataFrame:
    """Rows of ``old`` with keys absent from ``new``, plus merged ``new`` rows.

    The output has ``old``'s columns. Columns of ``old`` missing from ``new``
    keep their old value (partial-column upsert). ``touch_col`` is set to
    ``touch_value`` (e.g. the run timestamp) on every row written by ``new``.
    ``null_safe=False`` joins by plain equality, for keys that are never null: a table
    stored in buckets by the key is then not shuffled.
    """
    unknown = [c for c in new.columns if c not in old.columns and c not in order_by]
    if unknown:
        raise ValueError(f"the table has no columns {unknown}")
    batch = latest_per_key(new, keys, order_by)
    o = old.withColumn("_in_old", F.lit(True)).alias("_o")
    n = batch.withColumn("_in_new", F.lit(True)).alias("_n")
    cond = None
    for k in keys:
        left, right = F.col(f"_o.{k}"), F.col(f"_n.{k}")
        c = left.eqNullSafe(right) if null_safe else left == right
        cond = c if cond is None else cond & c
    j = o.join(n, cond, "full_outer")
    from_new = F.col("_n._in_new").isNotNull()
    cols = []
    for c in old.columns:
        oc = F.col(f"_o.{c}")
        if c in keys:
            v = F.coalesce(F.col(f"_n.{c}"), oc)
        elif touch_col is not None and c == touch_col:
            v = F.when(from_new, F.lit(touch_value).cast(old.schema[c].dataType)).otherwise(oc)
        elif c not in batch.columns:
            v = oc
        elif c in insert_only_cols:
            v = F.when(F.col("_o._in_old").isNotNull(), oc).otherwise(F.col(f"_n.{c}"))
        elif c in keep_if_null_cols:
            v = F.when(from_new, F.coalesce(F.col(f"_n.{c}"), oc)).otherwise(oc)
        else:
            v = F.when(from_new, F.col(f"_n.{c}")).otherwise(oc)
        cols.append(v.cast(old.schema[c].dataType).alias(c))
    return j.select(*cols)
