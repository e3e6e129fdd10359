"""A keyed table with a file index: a merge reads and rewrites only files that hold its keys.

Layout under ``path``::

    data/_version=<n>/<partition>=<value>/part-*.parquet    written once, never changed
    manifest/_version=<n>/                                  one row per live file: partition, rows, lowest and highest key

A version is the set of files its manifest lists. A merge writes its files under a new
``_version`` and then the manifest that replaces the old one, so a reader sees the table before
the merge or after it, whatever fails in between; two merges that start from one version
cannot both write its successor. Files are dealt by ranges of the key, so their key ranges
are narrow and the index rules most of them out; of the rest only the key columns are
read to find the files that really hold a key of the batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pacekit.operators.upsert import latest_per_key, upsert
from pacekit.session import scratch_dir
from pacekit.sources.sinks import _folder, drop_folder, folder_exists


class KeyedTable:
    """A table at ``path`` that is unique on ``keys``, in folders by ``partition_col`` (a column of the row)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partition_col: str,
                 rows_per_file: int = 1_000_000):
        self.spark, self.path, self.partition_col = spark, path.rstrip("/"), partition_col
        self.keys, self.rows_per_file = list(keys), rows_per_file

    # ------------------------------------------------------------ reading

    def version(self) -> int:
        """The newest complete version, 0 if there is none."""
        fs, folder = _folder(self.spark, f"{self.path}/manifest")
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        done = [int(n.split("=")[1]) for n in names if n.startswith("_version=") and folder_exists(
            self.spark, f"{self.path}/manifest/{n}/_SUCCESS")]
        return max(done, default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """(file, part, rows, low, high) of the live files; ``low`` and ``high`` are key structs."""
        v = self.version() if version is None else version
        if not v:
            raise FileNotFoundError(f"no keyed table at {self.path}")
        return self.spark.read.parquet(f"{self.path}/manifest/_version={v}")

    def files(self, version: int | None = None) -> list[str]:
        return sorted(r["file"] for r in self.manifest(version).select("file").collect())

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.files(version))

    def _rows(self, files: Sequence[str]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*files).drop("_version")

    # ------------------------------------------------------------ writing

    def _key(self) -> Column:
        return F.struct(*self.keys)

    def _take_in(self, new: DataFrame, order_by: Sequence[str]) -> tuple[DataFrame, dict]:
        """The batch, latest row per key, written once; its counts are observed by that write."""
        seen = Observation()
        nulls = F.count_if(F.greatest(*[F.col(k).isNull().cast("int") for k in self.keys], F.lit(0)) > 0)
        batch = latest_per_key(new, self.keys, order_by).observe(
            seen, F.count(F.lit(1)).alias("n"), nulls.alias("without_key"),
            F.min(self._key()).alias("low"), F.max(self._key()).alias("high"))
        path = scratch_dir(self.spark, "merge-batch")
        batch.write.parquet(path)
        if seen.get["without_key"]:
            raise ValueError("the batch has rows without a key")
        return self.spark.read.schema(batch.schema).parquet(path), seen.get

    def holding(self, batch: DataFrame, low, high, version: int) -> list[str]:
        """The live files that hold a key of ``batch``, whose keys lie between ``low`` and ``high``."""
        def bound(row) -> Column:
            return F.struct(*[F.lit(row[k]).alias(k) for k in self.keys])

        near = self.manifest(version).filter((F.col("low") <= bound(high)) & (F.col("high") >= bound(low)))
        files = [r["file"] for r in near.select("file").collect()]
        if not files:
            return []
        found = (self._rows(files).select(*self.keys, F.col("_metadata.file_path").alias("file"))
                 .join(batch.select(*self.keys), self.keys, "left_semi").select("file").distinct())
        return sorted(r["file"] for r in found.collect())

    def merge(self, new: DataFrame, order_by: Sequence[str], **rules) -> dict:
        """Upsert a batch; ``rules`` go to ``operators.upsert.upsert``. NULL keys are an error.

        Returns ``rows`` written by key, and ``kept``, ``rewritten`` and ``added`` files. A row
        whose partition value changed moves without a duplicate: the file that held it is
        one of those rewritten.
        """
        batch, seen = self._take_in(new, order_by)
        version = self.version()
        live = set(self.files(version)) if version else set()
        if not seen["n"]:
            return {"rows": 0, "kept": len(live), "rewritten": 0, "added": 0}
        hit = self.holding(batch, seen["low"], seen["high"], version) if version else []
        columns = self._rows(sorted(live)[:1]).columns if version else batch.columns
        out = batch
        if version:
            old = self._rows(hit) if hit else self.spark.createDataFrame([], self._rows(sorted(live)[:1]).schema)
            out = upsert(old, batch, self.keys, order_by, null_safe=False, **rules)
        added = self._write(out.select(*columns), version + 1, self.manifest(version) if version else None, hit)
        return {"rows": seen["n"], "kept": len(live) - len(hit), "rewritten": len(hit), "added": added}

    def _write(self, rows: DataFrame, version: int, before: DataFrame | None, gone: list[str]) -> int:
        data = f"{self.path}/data/_version={version}"
        if folder_exists(self.spark, data) and not folder_exists(self.spark, f"{self.path}/manifest/_version={version}"):
            drop_folder(self.spark, data)                     # left by a merge that failed
        (rows.repartitionByRange(self.partition_col, *self.keys).sortWithinPartitions(self.partition_col, *self.keys)
         .write.option("maxRecordsPerFile", self.rows_per_file).partitionBy(self.partition_col).parquet(data))
        written = self.spark.read.option("basePath", f"{self.path}/data").parquet(data)
        index = written.groupBy(F.col("_metadata.file_path").alias("file"),
                                F.col(self.partition_col).cast("string").alias("part")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(self._key()).alias("low"), F.max(self._key()).alias("high"))
        new = index.collect()                                 # one row per written file
        kept = [] if before is None else [r for r in before.collect() if r["file"] not in set(gone)]
        manifest = self.spark.createDataFrame([*kept, *new], index.schema).coalesce(1)
        manifest.write.mode("errorifexists").parquet(f"{self.path}/manifest/_version={version}")
        return len(new)

    def vacuum(self) -> list[str]:
        """Delete data files that the newest version does not list and older manifests; readers of old
        versions must be done. Returns the deleted files."""
        version = self.version()
        live = set(self.files(version))
        every = (self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .option("pathGlobFilter", "*.parquet").load(f"{self.path}/data").select("path"))
        gone = [r["path"] for r in every.collect() if _name(r["path"]) not in {_name(f) for f in live}]
        for f in gone:
            drop_folder(self.spark, f)
        fs, folder = _folder(self.spark, f"{self.path}/manifest")
        for s in fs.listStatus(folder):
            if s.getPath().getName() != f"_version={version}":
                fs.delete(s.getPath(), True)
        return gone


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]
