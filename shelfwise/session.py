"""Session helpers.

``local_session`` is for tests and the bench.  On a cluster the session is
given; ``ensure_checkpoint_dir`` only sets a checkpoint folder when the
cluster did not name one (``spark.checkpoint.dir``), which is the shared
folder lineage cuts and state are written under.
"""

from __future__ import annotations

import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "shelfwise",
                  conf: dict | None = None) -> SparkSession:
    spark = (
        SparkSession.builder.config(map=conf or {}).master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return spark.checkpoint.dir, setting a scratch one only where it is unset (tests)."""
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if d:
        if not current:
            sc.setCheckpointDir(d)
        return d
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="shelfwise-ckpt-", dir="/tmp")   # one machine: tests and the bench
    spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d


#: Frees the shuffle files of a write when it is done; else they stay until the driver happens to collect its garbage.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Writes inside leave no shuffle files behind: nothing reads them again."""
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)
