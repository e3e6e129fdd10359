"""A keyed catalog table, bucketed by its key: an upsert shuffles the batch only.

The stored rows lie in buckets by a hash of the key, so a join on the key reads them
where they are; only the batch is dealt out to the buckets. The result of the join
is dealt the same way and is written as buckets again without another shuffle.

``name`` is a view over the newest version table ``name_v<n>``; a merge writes the next version
and then replaces the view, so a reader sees one version or the other. The key is declared in
the table's properties and enforced: a merge takes the newest row per key, refuses null
keys and batches by another key, and :meth:`CatalogTable.duplicates` verifies a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacekit.operators.upsert import latest_per_key, upsert
from pacekit.sources.sinks import materialize

KEY, VERSION = "pacekit.key", "pacekit.version"


class TableKeyError(ValueError):
    """A batch that does not fit the declared key."""


class CatalogTable:
    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def properties(self) -> dict[str, str]:
        """The declared properties of the newest version."""
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}

    def key(self) -> list[str]:
        return self.properties()[KEY].split(",")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def create(self, rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], buckets: int) -> CatalogTable:
        """Create the table from ``rows`` (the newest row per key)."""
        if self.exists():
            raise TableKeyError(f"{self.name} exists")
        first = self._checked(rows, keys, order_by)
        self._write(first.repartition(buckets, *keys), list(keys), buckets, 1)
        return self

    def merge(self, batch: DataFrame, order_by: Sequence[str], keys: Sequence[str] | None = None, **rules) -> None:
        """Upsert a batch on the declared key; ``rules`` go to ``operators.upsert.upsert``."""
        own = self.key()
        if keys is not None and list(keys) != own:
            raise TableKeyError(f"{self.name} is keyed by {own}, not {list(keys)}")
        merged = self.merged(self._checked(batch, own, order_by), order_by, **rules)
        p = self.properties()
        self._write(merged, own, int(p["pacekit.buckets"]), int(p[VERSION]) + 1)

    def merged(self, batch: DataFrame, order_by: Sequence[str], **rules) -> DataFrame:
        """The table's rows after a batch without null keys; no exchange on the stored side."""
        return upsert(self.read(), batch, self.key(), order_by, null_safe=False, **rules)

    def duplicates(self) -> DataFrame:
        """Key values that occur more than once (counted inside the buckets)."""
        return self.read().groupBy(*self.key()).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")

    def _checked(self, rows: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
        stored = materialize(self.spark, latest_per_key(rows, keys, order_by), "catalog-batch")
        missing = F.lit(False)
        for k in keys:
            missing = missing | F.col(k).isNull()
        if not stored.filter(missing).isEmpty():
            raise TableKeyError("the batch has rows without a key")
        return stored

    def _write(self, rows: DataFrame, keys: list[str], buckets: int, version: int) -> None:
        table = f"{self.name}_v{version}"
        (rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{self.path}/v{version}")
         .format("parquet").saveAsTable(table))
        properties = {KEY: ",".join(keys), VERSION: version, "pacekit.buckets": buckets}
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")
        # the switch: the view carries the properties too
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ({listed}) AS SELECT * FROM {table}")
