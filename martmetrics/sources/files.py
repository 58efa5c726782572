"""File sources and sinks: CSV export/import with a fixed schema, stage-table
materialisation, and the per-sheet CSV layout of report workbooks.

Everything is written under the shared checkpoint folder (``spark.checkpoint.dir``),
never a machine-local temp folder, so a lost executor can re-read it. Scratch folders lie in
a folder of their application; they go when its driver ends, and those of drivers that were
killed go with ``remove_old_scratch``.
"""

from __future__ import annotations

import atexit
import contextlib
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas
from ..session import checkpoint_dir
from . import stage

SNAPSHOT_CSV_SCHEMA = schemas.snapshot_csv(T.LongType())


_SCRATCH: dict[str, SparkSession] = {}


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/martmetrics/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, removed when the driver ends."""
    mine = f"{_scratch_root(spark)}/{spark.sparkContext.applicationId}"
    _SCRATCH[mine] = spark
    return f"{mine}/{name}-{uuid.uuid4().hex}"


def release_scratch() -> None:
    """Removes this application's scratch folders (frames that read them become unreadable)."""
    for path, spark in list(_SCRATCH.items()):
        with contextlib.suppress(Exception):  # the session may be gone already
            fs, p = stage._path(spark, path)
            fs.delete(p, True)
        del _SCRATCH[path]


atexit.register(release_scratch)


def remove_old_scratch(spark: SparkSession, older_than_s: float = 7 * 24 * 3600) -> list[str]:
    """Removes scratch folders of other applications that have not changed for so long."""
    removed = []
    for st in stage._children(spark, _scratch_root(spark)):
        name = st.getPath().getName()
        newest = max([st.getModificationTime(), *(x.getModificationTime() for x in stage._children(spark, st.getPath().toString()))])
        if name != spark.sparkContext.applicationId and time.time() - newest / 1000 >= older_than_s:
            fs, p = stage._path(spark, st.getPath().toString())
            fs.delete(p, True)
            removed.append(name)
    return sorted(removed)


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV scan with an explicit schema (no inference pass over the data)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def materialise(df: DataFrame, name: str, path: str | None = None,
                partition_by: list[str] | None = None, database: str | None = None,
                as_table: bool = False) -> DataFrame:
    """``DROP TABLE IF EXISTS; CREATE TABLE AS``: replace a parquet stage table and
    return a frame reading it back — this also cuts the lineage, so a lost executor
    re-reads the table instead of recomputing the whole upstream plan.

    By default the table is a stage table (see ``stage``) under the shared checkpoint folder,
    or at ``path``: its readers keep the old version until the new one is complete, and the
    version before stays for them. With ``as_table=True`` it is a catalog table
    ``database.name`` (``USE db`` becomes the ``database`` argument) in the session's
    warehouse. (Spark refuses to create a managed table over a leftover folder its catalog
    does not know — e.g. after an in-memory catalog is gone — so use a persistent catalog for
    this form.)
    """
    spark = df.sparkSession
    if as_table:
        w = df.write.mode("overwrite").format("parquet")
        if partition_by:
            w = w.partitionBy(*partition_by)
        ident = f"{database}.{name}" if database else name
        w.saveAsTable(ident)   # overwrite = DROP + CREATE for a table the catalog knows
        return spark.table(ident)
    base = path or scratch_path(spark, name)
    out = stage.publish(df, base, partition_by or ())
    stage.vacuum(spark, base)
    return out
