"""Mixing sources to target weights by systematic sampling.

The sources' targets are a share of the corpus by weight, capped at twice the
source's own size, the excess shared again by weight (water filling). Within a
source every document expects target / size copies. Documents are laid out in
size order, their expected copies are prefix-summed, one random offset is
added, and a document is emitted once per integer boundary it crosses. In
size order each boundary step is followed by documents of about the same size,
so a source's taken words stay near its target whatever the offset.

The order is cut into blocks of at most about 20,000 rows (size band, then a
hash range, each block in size order), so a source with a third of all rows is ranked by many tasks and
joined by one prefix sum over the blocks. Only the source table (one row per
source) is ordered as a whole. The texts are read once, to store every document's size.

Defined cases: null texts have size 0; sources with no words have target 0 and
are taken 0 times; null sources form one source, ordered last; repeated rows
are separate listings, each with its own copies; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacekit.llm.common import add_blocks, blocked_rank, n_words, null_safe_join, stored, whole_text

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pos = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighted = sizes.withColumn(
        "w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), pos.cast("int")))
    weighted = (weighted.withColumn("cap", F.col("source_size") * F.lit(most))
                .withColumn("total", F.sum("source_size").over(Window.partitionBy()) * F.lit(share)))
    # sources reach their cap in the order cap / w; the level is what the others leave by weight,
    # and it is highest at the first source that stays under its cap
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("w").over(rest))
    leveled = weighted.withColumn("level", level)
    capped = F.col("level") * F.col("w") >= F.col("cap")
    final = F.max(F.when(~capped, F.col("level"))).over(Window.partitionBy())
    return leveled.withColumn("final", final).select(
        "source", "source_size",
        F.when(capped, F.col("cap")).otherwise(F.col("final") * F.col("w")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: Sequence[int] = WEIGHTS, share: float = SHARE,
        most: float = MOST, seed: str = "mix-1") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, source."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       n_words(whole_text(text_col)).alias("size"))
    # sizes, bands, ranks and copies are all read from this; the texts are read once, here
    rows = stored(rows, "mix-sizes")
    rows = rows.withColumn("band", F.floor(F.sqrt(F.col("size").cast("double"))).cast("long"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    rows = rows.withColumn("h", key).withColumn(
        "unit", F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / F.lit(4294967296.0))
    bands = rows.groupBy("source", "band").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("size").alias("words"))
    sizes = bands.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = targets(sizes, weights, share, most)
    blocked = add_blocks(rows, ["source", "band"], bands.select("source", "band", "_n"), "unit")
    ranked = blocked_rank(blocked, ["source"], ["band", "_block"], ["size", "h", "doc_id"])
    out = null_safe_join(ranked, plan, ["source"])
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = F.md5(F.concat(F.lit(f"{seed}:offset:"), F.coalesce(F.col("source"), F.lit("-"))))
    offset = F.conv(F.substring(start, 1, 4), 16, 10).cast("double") / F.lit(65536.0)
    out = out.withColumn("copies", (F.floor((F.col("_rank") + 1) * each + offset)
                                    - F.floor(F.col("_rank") * each + offset)).cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", **kw) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Listings of one id with the same source and size are told apart by no more
    than their place, so they all get the copies of the one that gets most.
    """
    taken = (mix(docs, id_col, text_col, source_col, **kw).groupBy("doc_id", "source", "size")
             .agg(F.max("copies").alias("copies")).filter("copies > 0")
             .toDF("_id", "_source", "_size", "_copies"))
    names = docs.columns
    rows = docs.withColumn("_words", n_words(whole_text(text_col)))
    cond = (F.col(id_col).eqNullSafe(F.col("_id")) & F.col(source_col).cast("string").eqNullSafe(F.col("_source"))
            & (F.col("_words") == F.col("_size")))
    again = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return rows.join(taken, cond).withColumn("_again", again).select(*names)
