"""Session helpers: a tuned local session for tests/bench and a shared scratch folder.

On a cluster the caller owns the session; nothing here overrides settings that are
already present. The scratch folder always lives under ``spark.checkpoint.dir`` (a
shared, fault-tolerant location on a cluster); a private folder is created only for a
local master where that setting is unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job relies on. Applied by ``get_spark`` only; on a cluster they belong in
# the job configuration.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(cores: int | str = "*", shuffle_partitions: int = 8,
              app_name: str = "retailpulse", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder ``spark.checkpoint.dir``. Where it is unset, a local master gets a
    private folder; on a cluster executors would each write to their own disks, so that is
    an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no driver-side context (e.g. Spark Connect)
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        root = tempfile.mkdtemp(prefix="retailpulse-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root for written intermediate tables."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


_TABLES: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A read-only input table. Resolving a Parquet path runs a footer/schema job and
    a file listing; the resolved DataFrame is reused per (session, path), so a query
    that reads one table in several branches resolves it once. (Only for inputs that
    do not change while the session lives.)"""
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (id(spark), path)
    hit = _TABLES.get(key)
    if hit is not None and hit[0] is spark:
        return hit[1]
    df = spark.read.parquet(path)
    _TABLES[key] = (spark, df)
    return df
