"""Helpers shared by the corpus operators: stored tables, whole-text rules, blocked ranks, memory of Python workers.

Every operator takes only the columns it needs under internal names, so extra
columns of the caller, clashing names included, never reach its joins.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pacekit.session import scratch_dir

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_ROWS = 20_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    w = df.write.partitionBy(*partition_by) if partition_by else df.write
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage: shuffle files go once nothing there refers to their plan.

    Left to themselves they stay until a collection happens to run, and what the steps of a long
    operator have shuffled adds up on disk. Events that listeners have not taken yet refer to plans too.
    """
    gc.collect()
    try:
        with suppress(Exception):                  # they may take longer; what they hold stays for now
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        spark.sparkContext._jvm.System.gc()
    except Exception:  # noqa: BLE001 - no JVM context (e.g. Spark Connect)
        pass


@contextmanager
def arrow_batches(spark: SparkSession, limit: int):
    """What is written inside the block reaches Python in Arrow batches of about ``limit`` bytes of rows.

    By Spark's own limits (64 MB, 10,000 rows) a batch is a whole input split, held by the JVM, on its way
    and by the worker; the caller's limit comes back after the block.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


_malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc's; other C libraries have none


def release_memory() -> None:
    """Give this process's freed memory back to the system: idle workers stand beside the next stage's tasks."""
    pa.default_memory_pool().release_unused()
    if _malloc_trim:
        _malloc_trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow that gives back what ``run`` freed once the task's batches are through."""

    def task(batches):
        yield from run(batches)
        release_memory()                           # the batches and arrays of ``run`` are gone with its frame

    return task


def whole_text(col: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs: word starts, counted without building the words."""
    starts = F.regexp_replace(text, r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]++", "\u0001")
    return F.length(F.rtrim(F.translate(starts, "\t\n\u000b\f\r", "     "))).cast("long")


def text_crc32(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def unit_hash(*cols) -> Column:
    """A reproducible number in [0, 1) with 53 bits, from a 64-bit hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def add_blocks(df: DataFrame, group: Sequence[str], counts: DataFrame, unit: str,
               block: str = "_block", rows: int = BLOCK_ROWS) -> DataFrame:
    """Cut every group into ceil(n / rows) blocks by ranges of ``unit`` (a number in [0, 1)).

    ``counts`` has one row per group with its size ``_n``. A hot group gets
    more blocks, so no later task holds more than about ``rows`` of its rows.
    """
    n = counts.select(*group, F.ceil(F.col("_n") / F.lit(rows)).cast("long").alias("_nb"))
    j = null_safe_join(df, n, group)
    return j.withColumn(block, F.floor(F.col(unit) * F.col("_nb")).cast("long")).drop("_nb")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the right keys are dropped."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def blocked_rank(df: DataFrame, group: Sequence[str], blocks: Sequence[str], order: Sequence,
                 out: str = "_rank") -> DataFrame:
    """0-based rank within ``group`` in the order (blocks..., order...).

    Rows are ranked inside their block; the block's offset is a prefix sum over
    one row per block, so no task ever sorts a whole group.
    """
    keys = [*group, *blocks]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*group).orderBy(*blocks) if group else Window.orderBy(*blocks)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    inner = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    ranked = df.withColumn("_in", inner)
    return (null_safe_join(ranked, offsets, keys)
            .withColumn(out, (F.col("_off") + F.col("_in")).cast("long")).drop("_in", "_off"))
