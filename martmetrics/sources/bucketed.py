"""A fact table bucketed by buyer, for month-end jobs that run often.

Rows of a buyer lie in one bucket file, so aggregations, windows and joins that group by the
buyer find them together and exchange nothing on the buyer. The table is written once (one
exchange) under the shared folder and registered in the session's catalog. One buyer's rows are
in one bucket: where a buyer may hold a large share of all rows, use the plain table, whose
operators fold a buyer's rows before they exchange them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir, pin

BUYER = "buyer_org_id"
BUCKETS = 16   # at least; a large table has spark.sql.shuffle.partitions


def write_bucketed(df: DataFrame, buckets: int | None = None, key: str = BUYER, name: str | None = None,
                   path: str | None = None) -> str:
    """Writes ``df`` as a table bucketed and sorted by ``key``, at ``path`` (by default a folder
    that stays under the shared folder); returns the table's name. ``buckets``: by default as many
    as a shuffle has partitions, since a bucket is one task's work in all that follows."""
    spark = df.sparkSession
    buckets = buckets or max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = name or f"martmetrics_by_{key}_{uuid.uuid4().hex}"
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/martmetrics/bucketed/{name}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))
    return name


def co_located(spark: SparkSession) -> SparkSession:
    """A session in which a join on several keys may use tables bucketed by one of them.

    Spark asks both sides of a join to be partitioned by all its keys, because one key alone may
    be skewed. The setting is made in a session of its own, so no other plan changes.
    """
    s = pin(spark.newSession())
    for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"):
        s.conf.set(k, spark.conf.get(k))
    s.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return s
