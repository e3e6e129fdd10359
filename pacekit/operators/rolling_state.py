"""Rolling sums kept up to date by batches: only the tails of touched entities are computed again.

Two keyed tables: the day totals, and their rolling sums. A batch of day totals changes the sums of
its own days and of the days whose frame reaches back to them, and nothing before. So of each
touched entity the days from its first changed day on are computed, from the totals since
the longest frame before that day; other entities are not read beyond the index, and files
and months before the batch's reach are not read at all. A late day is a batch like others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacekit.operators.rolling import rolling_sums
from pacekit.sources.keyed_table import KeyedTable
from pacekit.sources.sinks import materialize

MONTH = "_month"


class RollingState:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], day: str, value: str,
                 spans: Mapping[str, int]):
        self.spark, self.keys, self.day, self.value = spark, list(keys), day, value
        self.spans, self.reach = dict(spans), max(spans.values()) - 1
        self.totals = KeyedTable(spark, f"{path}/totals", [*keys, day], MONTH)
        self.sums = KeyedTable(spark, f"{path}/sums", [*keys, day], MONTH)

    def _by_month(self, df: DataFrame) -> DataFrame:
        return df.withColumn(MONTH, F.date_format(self.day, "yyyyMM").cast("int"))

    def apply(self, batch: DataFrame) -> dict:
        """Take in new or corrected day totals (one row per entity and day; a total replaces the old one)."""
        own = materialize(self.spark, self._by_month(batch.select(*self.keys, self.day, self.value)), "day-totals")
        touched = own.groupBy(*self.keys).agg(F.min(self.day).alias("_from"))
        first = own.agg(F.min(self.day)).first()[0]
        if first is None:
            return {"totals": 0, "sums": 0}
        taken = self.totals.merge(own, [self.value])
        since = F.date_sub(F.lit(first), self.reach)
        near = self.totals.read().filter(                      # months before the reach are not listed for reading
            (F.col(MONTH) >= F.date_format(since, "yyyyMM").cast("int")) & (F.col(self.day) >= since))
        tail = near.join(touched, self.keys).filter(F.col(self.day) >= F.date_sub("_from", self.reach))
        rolled = rolling_sums(tail, self.keys, self.day, self.value, self.spans).filter(F.col(self.day) >= F.col("_from"))
        put = self.sums.merge(self._by_month(rolled.select(*self.keys, self.day, self.value, *self.spans)), [self.value])
        return {"totals": taken["rows"], "sums": put["rows"]}

    def read(self) -> DataFrame:
        return self.sums.read().drop(MONTH)
