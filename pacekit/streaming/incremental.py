"""Incremental keyed upsert with Structured Streaming (merge on read).

Landed raw records arrive as files; ``start_incremental_upsert`` reads them
with ``readStream`` and, per micro-batch (``foreachBatch``):

1. de-duplicates the batch on the keys (latest ``order_by`` wins, partial
   aggregation before the shuffle);
2. writes it into ``table_path/_batch=<epoch>`` with dynamic partition
   overwrite, so a retried epoch replaces its own output (idempotent,
   exactly-once together with the checkpointed source offsets).

Readers call ``read_current`` - the latest version of every key across all
batch partitions (last batch wins, then ``order_by``). ``compact`` rewrites
the current state into a fresh folder when the batch count grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacekit.operators.upsert import latest_per_key
from pacekit.sources.sinks import drop_folder, materialize

RAW_RECORD = T.StructType([
    T.StructField("athlete_id", T.LongType()),
    T.StructField("activity_id", T.LongType()),
    T.StructField("extracted_at_utc", T.TimestampType()),
    T.StructField("payload", T.StringType()),
])

BATCH_COL = "_batch"


def start_incremental_upsert(spark: SparkSession, landing_dir: str, table_path: str,
                             checkpoint: str, keys: Sequence[str] = ("athlete_id", "activity_id"),
                             order_by: Sequence[str] = ("extracted_at_utc",),
                             schema: T.StructType = RAW_RECORD, file_format: str = "json",
                             available_now: bool = True, compact_every: int = 16):
    """Start the stream; returns the ``StreamingQuery``.

    Every ``compact_every`` batches the current state is rewritten as one batch,
    so a reader merges at most that many batches, however long the stream runs.
    """
    src = spark.readStream.schema(schema).format(file_format).load(landing_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        (latest_per_key(batch, list(keys), list(order_by))
         .withColumn(BATCH_COL, F.lit(epoch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL).parquet(table_path))
        if (epoch_id + 1) % compact_every == 0:
            compact_in_place(spark, table_path, epoch_id, list(keys), list(order_by))

    w = src.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_current(spark: SparkSession, table_path: str, keys: Sequence[str],
                 order_by: Sequence[str] = ("extracted_at_utc",)) -> DataFrame:
    """Current table state: per key, the row of the newest batch (then ``order_by``)."""
    all_rows = spark.read.parquet(table_path)
    cur = latest_per_key(all_rows, list(keys), [BATCH_COL, *order_by])
    return cur.drop(BATCH_COL)


def compact(spark: SparkSession, table_path: str, new_path: str, keys: Sequence[str],
            order_by: Sequence[str] = ("extracted_at_utc",)) -> str:
    """Write the current state as a single batch 0 into ``new_path``."""
    (read_current(spark, table_path, keys, order_by).withColumn(BATCH_COL, F.lit(0).cast("long"))
     .write.mode("overwrite").partitionBy(BATCH_COL).parquet(new_path))
    return new_path


def compact_in_place(spark: SparkSession, table_path: str, epoch_id: int, keys: Sequence[str],
                     order_by: Sequence[str]) -> None:
    """Make ``epoch_id`` hold the current state and drop the batches before it.

    The state replaces the newest batch first; older batches then hold nothing
    that it lacks, so a failure in between (and the batch's retry) loses nothing.
    """
    state = materialize(spark, read_current(spark, table_path, keys, order_by), "compacted")
    older = [r[0] for r in spark.read.parquet(table_path).select(BATCH_COL).distinct().collect()
             if r[0] < epoch_id]
    (state.withColumn(BATCH_COL, F.lit(epoch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COL).parquet(table_path))
    for b in older:
        drop_folder(spark, f"{table_path}/{BATCH_COL}={b}")
