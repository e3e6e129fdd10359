"""Exact duplicates through an extendible-hash index on shared files.

1. Every text gets a 64-bit key. A histogram of distinct keys over at most
   ``2**MAX_DEPTH`` key prefixes is the finest directory there can be.
2. The directory doubles only where a bucket is overfull: a prefix keeps the
   smallest depth at which its bucket holds at most ``capacity`` distinct keys.
   The directory has at most ``2**MAX_DEPTH`` rows (about 2.5 MB), a bound that
   does not depend on the data, so it is broadcast. Buckets still overfull at
   the last depth keep all their entries (overflow), so nothing is lost.
3. Texts are grouped by (bucket, key, whole text): equal keys are chained and
   told apart by their bytes. Copies collapse on the map side, so a hot group
   reaches its owner as one row per task.
4. Owner tasks take whole buckets, number the chain of each key and write the
   index to the shared folder.
5. Every row is routed through the same directory to its bucket, finds its key
   there and walks the key's chain to the entry with its digest.

Defined cases: a null text equals the empty one; in an empty table nothing is
returned; of rows with the largest doc_id repeated (same id, same text) one is
kept; null ids lose against any other id, and if all ids of a group are null
one row is kept with a null keep_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacekit.llm.common import stored, whole_text

MAX_DEPTH = 16
CAPACITY = 4096


def directory(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(cell, depth): the local depth of the bucket each key prefix belongs to."""
    cell = F.shiftrightunsigned(F.col("key"), 64 - max_depth)
    hist = (keys.select("key").distinct().groupBy(cell.alias("cell"))
            .agg(F.count(F.lit(1)).alias("n")))
    levels = hist.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth"))
    prefix = F.expr(f"shiftrightunsigned(cell, {max_depth} - depth)")
    filled = levels.withColumn(
        "filled", F.sum("n").over(Window.partitionBy("depth", prefix)))
    fits = F.when(F.col("filled") <= capacity, F.col("depth")).otherwise(F.lit(max_depth))
    return filled.groupBy("cell").agg(F.min(fits).alias("depth"))


def routed(rows: DataFrame, cells: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``rows`` (with a key) and the ``depth`` and ``bucket`` that the directory gives them."""
    cell = F.shiftrightunsigned(F.col("key"), 64 - max_depth)
    bucket = F.expr(f"shiftrightunsigned(cell, {max_depth} - depth)")
    return (rows.withColumn("cell", cell).join(F.broadcast(cells), "cell")      # at most 2**max_depth cells
            .withColumn("bucket", bucket).drop("cell"))


def build_index(rows: DataFrame, cells: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The stored index: one entry per distinct text.

    ``rows`` has (doc_id, text, key), ``cells`` is the directory. Entries: depth, bucket, key, chain,
    entry_sha256, keep_id, group_size.
    """
    placed = routed(rows.select("doc_id", "text", "key"), cells, max_depth)
    entries = (placed.groupBy("bucket", "depth", "key", "text")
               .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .select("bucket", "depth", "key", F.sha2(F.col("text"), 256).alias("entry_sha256"),
                       "keep_id", "group_size"))
    chain = F.row_number().over(Window.partitionBy("depth", "bucket", "key").orderBy("entry_sha256"))
    owned = entries.repartition("depth", "bucket").withColumn("chain", chain)
    return stored(owned, "dedup-index")


def look_up(probe: DataFrame, index: DataFrame) -> DataFrame:
    """Rows with (depth, bucket, key, text_sha256) and their entry: the bucket and key lead to a chain,
    the digest of the bytes to the entry in it."""
    return probe.join(index, ["depth", "bucket", "key"]).filter("text_sha256 = entry_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    cells = stored(directory(rows, capacity), "dedup-directory")
    index = build_index(rows, cells)
    probe = routed(rows.select("doc_id", "key", F.sha2(F.col("text"), 256).alias("text_sha256")), cells)
    found = look_up(probe, index)
    # a listing of one document twice must not survive twice
    again = F.row_number().over(Window.partitionBy("doc_id", "text_sha256").orderBy("key"))
    return found.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (again == 1)).alias("kept"),
        "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns; one listing of each kept document. The id and
    the text must be unambiguous column names."""
    for name in (id_col, text_col):
        if docs.columns.count(name) != 1:
            raise ValueError(f"{name} must name one column")
    kept = exact_dedup(docs, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    rows = docs.withColumn("_sha", F.sha2(whole_text(text_col), 256))
    cond = F.col(id_col).eqNullSafe(F.col("_kept_id")) & (F.col("_sha") == F.col("_kept_sha"))
    left = rows.join(kept, cond, "left_semi")
    w = Window.partitionBy(id_col, "_sha").orderBy(F.lit(0))
    left = left.withColumn("_again", F.row_number().over(w)).filter("_again = 1").drop("_again")
    return left.drop("_sha")
