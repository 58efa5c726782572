"""Join helpers. Broadcasts are left to Spark, which decides from static and run-time sizes, but
for the category mapping: an exchange of the facts on a handful of categories is never wanted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_by(df: DataFrame, key: str) -> DataFrame:
    """``df`` with one row per ``key``; a repeated key raises when the plan runs.

    Joining a dimension with repeated keys would multiply the facts' money. The check is
    part of the plan (an aggregate over the dimension), so building a query starts no job.
    """
    rest = [c for c in df.columns if c != key]
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(c) for c in rest])
    repeated = F.raise_error(F.concat(F.lit(f"repeated {key} in a mapping: "), F.col(key).cast("string")))
    return g.filter(F.when((F.col("_rows") > 1) & F.col(key).isNotNull(), repeated.cast("boolean"))
                    .otherwise(F.lit(True))).select(*df.columns)


def with_mapping(df: DataFrame, mapping: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """``df`` with the mapping's attributes of its category (left join).

    The mapping has one row a category and is broadcast, however large the table is that its
    categories are read from: joined by a shuffle, all facts would go to as many tasks as there
    are categories, and the placement on the buyer would be lost.
    """
    return df.join(F.broadcast(unique_by(mapping.select("category", *attrs), "category")), "category", "left")


def placed_by(df: DataFrame, key: str, times: int = 1) -> DataFrame:
    """``df`` exchanged on ``key`` into ``times`` x ``spark.sql.shuffle.partitions`` partitions.

    The number is given, so adaptive execution does not put partitions together: it goes by the
    shuffled bytes, and the sorts and folds that follow hold many times as much.
    """
    return df.repartition(times * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
