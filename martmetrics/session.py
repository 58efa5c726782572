"""SparkSession helpers: one place for the SQL confs the operators assume."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL confs the operators rely on. All are session-settable, so they are applied
# to a session the caller hands in as well as to one built here.
RUNTIME_CONF = {
    # Local days are derived explicitly from UTC; keep the session clock neutral.
    "spark.sql.session.timeZone": "UTC",
    # Integer money sums rely on overflow raising instead of wrapping.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# A task's share, at most: aggregates and sorts hold ten times the bytes that are read or
# shuffled (both are compressed), so Spark's own 128 and 64 MB would be a gigabyte a task.
MOST_BYTES = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _bytes(text: str) -> int:
    """Bytes of a size as Spark writes it: 16777216, 16777216b, 16m, 16MB."""
    n, unit = re.fullmatch(r"\s*(\d+)\s*([kmgt]?)b?\s*", text.lower()).groups()
    return int(n) * _UNITS[unit]


def pin(spark: SparkSession) -> SparkSession:
    """Apply the runtime confs the operators assume (UTC clock, AQE, skew join, a task's share;
    a smaller share that the session already has stays)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, most in MOST_BYTES.items():
        if _bytes(spark.conf.get(k)) > most:
            spark.conf.set(k, str(most))
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "martmetrics", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        **RUNTIME_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "16g",
        # local runs have small shuffles; keep AQE from folding them onto a few cores
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin(spark)
    checkpoint_dir(spark)
    return spark


_FALLBACK_DIRS: dict = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised stage tables.

    On a cluster this is ``spark.checkpoint.dir`` (set by whoever runs the cluster), and it
    is an error if it is unset; only a local master gets a local folder per application.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _FALLBACK_DIRS:
            _FALLBACK_DIRS[app] = tempfile.mkdtemp(prefix="martmetrics-ckpt-",
                                                   dir=os.environ.get("TMPDIR", "/tmp"))
        d = _FALLBACK_DIRS[app]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
