"""Shared folder for intermediate tables, and small frame helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and the whole application is one local JVM (tests) is a
    temporary folder chosen; on any other master an unset folder is an error, because a
    machine-local folder would silently lose the parts written elsewhere.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _LOCAL:
        _LOCAL[sc.applicationId] = tempfile.mkdtemp(prefix="martmetrics-llm-")
    return _LOCAL[sc.applicationId]


def stage_table(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a table in the shared folder and return the reader of it.

    Cuts the lineage: a lost executor makes Spark re-read files, not recompute the work.
    The folder is deleted when the driver process ends (or by ``release``).
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/martmetrics-llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession | None = None) -> None:
    """Delete the stage tables written so far (results read from them become unreadable)."""
    kept = []
    for session, path in _WRITTEN:
        if spark is not None and session is not spark:
            kept.append((session, path))
            continue
        try:
            p = session.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session is gone: nothing left to delete with
            pass
    _WRITTEN[:] = kept


atexit.register(release)


def held_out(doc_id: Column) -> Column:
    """True for the evaluation fold: crc32 of the id's decimal text has remainder 2 mod 4.

    A null id counts as the empty text.
    """
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has the name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
