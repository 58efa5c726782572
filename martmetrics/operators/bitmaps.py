"""Exact distinct counts that merge: bitmaps over dense ids, rolled up by OR.

A distinct count cannot be summed over cells, a set of keys can be united. Keys get small
whole numbers ("dense ids"), and a cell's set is a few bitmaps of 32,768 ids each, so that a
roll-up reads bitmaps of cells instead of one copy of every line for each level it is in.

Dense ids: keys are dealt to buckets by hash and numbered inside their bucket; an id is
bucket * ``STRIDE`` + number. Rows are folded to (cell, key) first (a partial aggregation, so
a hot key is one row a cell), then exchanged on the bucket, where numbering and the building
of bitmaps need no other exchange. (Building bitmaps before that exchange would send one 4 KB
bitmap for nearly every row.) Bitmaps of one run merge with each other; for bitmaps that merge
over runs a ``dictionary`` keeps the ids, and grows with new keys without changing the old ones.

NULL keys are in no bitmap, as ``count(DISTINCT)`` leaves them out, but their cells exist.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ids of one bucket; a multiple of the 32,768 ids of a bitmap.
STRIDE = 1 << 36
ID, BUCKET, CHUNK = "_id", "_bucket", "_chunk"


def bucket_count(df: DataFrame) -> int:
    """As many buckets as a shuffle has partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def fold(df: DataFrame, by: Sequence[str], key: str, flags: Mapping[str, str], buckets: int | None = None) -> DataFrame:
    """(by, key, bucket, one 0/1 flag a measure): whether any row of the cell and key meets the
    condition."""
    n = buckets or bucket_count(df)
    rows = df.select(*by, key, _bucket(key, n).alias(BUCKET),
                     *[F.expr(f"CASE WHEN {c} THEN 1 ELSE 0 END").alias(name) for name, c in flags.items()])
    return rows.groupBy(*by, key, BUCKET).agg(*[F.max(name).alias(name) for name in flags])


def with_dense_ids(folded: DataFrame, key: str) -> DataFrame:
    """Adds the id of this run: the key's rank inside its bucket."""
    rank = F.dense_rank().over(Window.partitionBy(BUCKET).orderBy(key))
    return folded.withColumn(ID, F.col(BUCKET).cast("bigint") * F.lit(STRIDE) + rank)


def dictionary(keys: DataFrame, key: str, known: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """(key, _id): dense ids of all keys; those of ``known`` keep theirs, new ones follow.

    ``buckets`` must be the same for a dictionary's whole life.
    """
    n = buckets or bucket_count(keys)
    new = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    if known is not None:
        new = new.join(known.select(key), key, "left_anti")
    new = new.withColumn(BUCKET, _bucket(key, n))
    rank = F.row_number().over(Window.partitionBy(BUCKET).orderBy(key))
    base = F.col(BUCKET).cast("bigint") * F.lit(STRIDE)
    if known is None:
        return new.select(key, (base + rank).alias(ID))
    last = known.groupBy(F.floor((F.col(ID) - 1) / F.lit(STRIDE)).cast("int").alias(BUCKET)).agg(F.max(ID).alias("_last"))
    grown = new.join(F.broadcast(last), BUCKET, "left")  # one row a bucket
    return known.select(key, ID).unionByName(grown.select(key, (F.coalesce("_last", base) + rank).alias(ID)))


def with_ids(folded: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Adds the ids of a ``dictionary``; a key it lacks raises."""
    missing = F.raise_error(F.concat(F.lit(f"no id for {key} "), F.col(key).cast("string"))).cast("bigint")
    return folded.join(ids.select(key, ID), key, "left").withColumn(
        ID, F.when(F.col(ID).isNull() & F.col(key).isNotNull(), missing).otherwise(F.col(ID)))


def bitmap_cells(numbered: DataFrame, by: Sequence[str], key: str, flags: Sequence[str]) -> DataFrame:
    """(by, _chunk, one bitmap a flag): the keys of each cell on which the flag is set."""
    rows = numbered.select(*by, F.bitmap_bucket_number(ID).alias(CHUNK),
                           *[F.when((F.col(f) == 1) & F.col(key).isNotNull(), F.bitmap_bit_position(ID)).alias(f)
                             for f in flags],
                           *([BUCKET] if BUCKET in numbered.columns else []))
    over = [*by, *([BUCKET] if BUCKET in numbered.columns else []), CHUNK]
    return rows.groupBy(*over).agg(*[F.bitmap_construct_agg(f).alias(f) for f in flags]).drop(BUCKET)


def merge(cells: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The union of cells: bitmaps ORed by (by, _chunk)."""
    return cells.groupBy(*by, CHUNK).agg(*[F.bitmap_or_agg(n).alias(n) for n in names])


def counts(cells: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(by, distinct keys of each set); chunks hold different ids, so their counts add up."""
    return merge(cells, by, names).groupBy(*by).agg(*[F.sum(F.bitmap_count(n)).alias(n) for n in names])
