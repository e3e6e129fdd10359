"""Spark session defaults and the shared scratch location.

Every pipeline in this package assumes:

* ``spark.sql.session.timeZone = UTC`` so ``cast(ts as date)`` and ``year(ts)``
  never depend on the machine running the job;
* AQE on, so small dimension sides become broadcasts at run time from their
  measured size, shuffle partitions are coalesced, and skewed join partitions
  are split;
* no Spark UI (no extra server / port).

On a cluster the session already carries ``spark.checkpoint.dir`` pointing at
a shared folder; :func:`scratch_dir` only invents one (under the system temp
folder) when the setting is absent, i.e. in local tests.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call sites for error messages cost a round trip per function; plans here have thousands
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "pacekit", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def utc_session(spark: SparkSession):
    """The session time zone is UTC inside the block; the caller's value comes back after it."""
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    if before != "UTC":
        spark.conf.set(key, "UTC")
    try:
        yield
    finally:
        if before != "UTC":
            spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session; sets a local one only when
    it is unset (tests, laptops).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = _context_checkpoint_dir(spark)
    if not base:
        _require_local(spark)
        base = tempfile.mkdtemp(prefix="pacekit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:  # noqa: BLE001 - no JVM context (e.g. Spark Connect)
            pass
    return f"{base.rstrip('/')}/{name or 'run'}-{uuid.uuid4().hex[:12]}"


def _require_local(spark: SparkSession) -> None:
    """A machine-local temp folder is only acceptable when everything runs on this machine."""
    try:
        master = spark.sparkContext.master
    except Exception:  # noqa: BLE001
        master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def _context_checkpoint_dir(spark: SparkSession):
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001
        return None
