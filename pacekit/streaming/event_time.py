"""Event-time keyed upsert: a watermark, bounded keyed state, and a side table of late rows.

Files may bring rows late, twice or in any order. Per micro-batch (``foreachBatch``):

1. the watermark is the greatest event time of all *earlier* batches less ``delay``;
   rows before it go to the side table ``late`` and touch nothing else;
2. of the others the newest version per key (``order_by``) meets the keyed state, which holds
   the newest version seen of every key at or after the watermark; only a newer version is
   written to the table, so a repeated or outdated row costs no write;
3. the state is rewritten without the keys that fell behind the watermark: its size is
   that of the event-time window, however long the stream runs.

Everything of a batch lies in folders named by its epoch and is overwritten when the epoch is
run again, and a batch reads only epochs before its own: a restart gives the same tables.
Rows without an event time or a key have no place in event time; they go to ``late`` too.

Layout under ``path``: ``table``, ``late``, ``state``, ``marks``, each with ``_batch=<epoch>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacekit.operators.upsert import latest_per_key
from pacekit.sources.sinks import _folder, drop_folder
from pacekit.streaming.incremental import BATCH_COL


class EventTimeUpsert:
    """A keyed table at ``path`` fed by a stream. ``event_time`` is a timestamp column, ``order_by`` says
    which version of a key is newer, ``delay`` is an interval such as ``"2 days"``."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], event_time: str,
                 order_by: Sequence[str], delay: str):
        self.spark, self.path, self.delay = spark, path.rstrip("/"), delay
        self.keys, self.event_time, self.order_by = list(keys), event_time, list(order_by)

    # ------------------------------------------------------------ epochs of a part

    def _epochs(self, part: str, before: int | None = None) -> list[int]:
        fs, folder = _folder(self.spark, f"{self.path}/{part}")
        if not fs.exists(folder):
            return []
        found = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(folder)
                 if s.getPath().getName().startswith(f"{BATCH_COL}=")]
        return sorted(e for e in found if before is None or e < before)

    def _read(self, part: str, epochs: Sequence[int], schema: T.StructType) -> DataFrame:
        if not epochs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{part}/{BATCH_COL}={e}" for e in epochs])

    def _write(self, df: DataFrame, part: str, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{part}/{BATCH_COL}={epoch}")

    def watermark(self, before: int | None = None):
        """The watermark that holds for epoch ``before`` (or for the next one); None at the start."""
        epochs = self._epochs("marks", before)
        schema = T.StructType([T.StructField("mark", T.TimestampType())])
        return self._read("marks", epochs[-1:], schema).agg(F.max("mark")).first()[0]

    # ------------------------------------------------------------ one micro-batch

    def write_batch(self, batch: DataFrame, epoch: int) -> None:
        schema = batch.schema
        at = F.col(self.event_time)
        mark = self.watermark(epoch)
        placed = at.isNotNull()
        for k in self.keys:
            placed = placed & F.col(k).isNotNull()
        in_time = placed if mark is None else placed & (at >= F.lit(mark))
        batch = batch.persist()
        try:
            self._write(batch.filter(~in_time), "late", epoch)
            # a batch cannot lower the mark: the greatest of the old one and this batch less the delay
            reached = batch.filter(in_time).agg(F.max(at).alias("top")).select(
                (F.col("top") - F.expr(f"INTERVAL {self.delay}")).alias("mark"))
            news = latest_per_key(batch.filter(in_time), self.keys, self.order_by)
            known = self._state(epoch, schema)
            newer = self._newer(news, known)
            self._write(newer, "table", epoch)
            written = self._read("table", [epoch], schema)
            now = reached.select(F.greatest("mark", F.lit(mark).cast("timestamp")).alias("mark"))
            self._write(now, "marks", epoch)
            bound = self.watermark(epoch + 1)
        finally:
            batch.unpersist()
        cols = self._state_columns()
        state = latest_per_key(known.unionByName(written.select(*cols)), self.keys, self.order_by)
        if bound is not None:
            state = state.filter(at >= F.lit(bound))
        self._write(state, "state", epoch)
        for e in self._epochs("state", epoch - 1):            # the one before stays for a rerun of this epoch
            drop_folder(self.spark, f"{self.path}/state/{BATCH_COL}={e}")

    def _state_columns(self) -> list[str]:
        return list(dict.fromkeys([*self.keys, self.event_time, *self.order_by]))

    def _state(self, epoch: int, schema: T.StructType) -> DataFrame:
        kinds = T.StructType([schema[c] for c in self._state_columns()])
        return self._read("state", self._epochs("state", epoch)[-1:], kinds)

    def _newer(self, news: DataFrame, known: DataFrame) -> DataFrame:
        """Rows of ``news`` (one per key) that the state does not have in the same or a newer version."""
        old = known.select(*self.keys, F.struct(*self.order_by).alias("_known"))
        fresh: Column = F.col("_known").isNull() | (F.struct(*self.order_by) > F.col("_known"))
        return news.join(old, self.keys, "left").filter(fresh).drop("_known")

    # ------------------------------------------------------------ stream and readers

    def start(self, source: DataFrame, checkpoint: str, available_now: bool = True):
        """Start the stream on a ``readStream`` DataFrame; returns the ``StreamingQuery``."""
        w = source.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        return w.start()

    def read(self, schema: T.StructType, with_late: bool = False) -> DataFrame:
        """The newest version of every key; ``with_late`` folds the side table in."""
        rows = self._read("table", self._epochs("table"), schema)
        if with_late:
            rows = rows.unionByName(self.read_late(schema).dropna(subset=self.keys))
        return latest_per_key(rows, self.keys, self.order_by)

    def read_late(self, schema: T.StructType) -> DataFrame:
        return self._read("late", self._epochs("late"), schema)

    def read_state(self, schema: T.StructType) -> DataFrame:
        return self._state(1 << 62, schema)
