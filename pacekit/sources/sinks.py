"""Sinks and materialisation: tables, views, CSV export, layer routing.

* ``write_table`` - full-refresh table (Parquet), always to a fresh path;
  upserts never overwrite the path they read (see ``sources.keyed_table``).
* ``materialize`` - write a DataFrame into the shared checkpoint folder and
  read it back: cuts lineage durably (survives executor loss, unlike a local
  checkpoint).
* ``register_view`` - view materialisation (``createOrReplaceTempView``).
* ``csv_export`` - header CSV of a fixed column list.
* ``layer_database`` - layer-to-database routing: a custom name is used
  verbatim, otherwise the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from pacekit.session import scratch_dir


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(spark, name)
    write_table(df, path)
    return spark.read.parquet(path)


def _folder(spark: SparkSession, path: str):
    """(Hadoop file system, path): works wherever Spark reads and writes."""
    jvm = spark._jvm.org.apache.hadoop.fs
    p = jvm.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def csv_export(df: DataFrame, path: str, columns: Sequence[str]) -> str:
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)
    return path


def layer_database(custom: str | None, default: str) -> str:
    """Database (schema) for a model: the custom layer name verbatim, else the default."""
    return default if custom is None else custom.strip()


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
