"""Session helpers: the one place where Spark settings are chosen."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from measured shuffle sizes
# (runtime broadcast of a small side, skew split of a hot key, partition
# coalescing), so no job hard-codes a join strategy.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Per-call Python call-site capture costs several JVM round trips per
    # Column function; plans here are built from hundreds of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Generated methods above the JVM's 8000-byte JIT limit run interpreted;
    # at this limit Spark splits such stages into per-operator code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A refresh runs a few dozen plans of ~25 stages; keep their compiled
    # classes instead of recompiling on every run (default keeps 100).
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerline") -> SparkSession:
    """A local-mode session for tests and the bench (never for a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder and is used as
    is. Only when it is unset (local tests) a scratch folder is created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name
