"""Sharding by jump consistent hashing, in DataFrame functions only.

The shard of a key follows Lamping and Veach's jump hash: a 64-bit linear congruential
generator seeded with the key proposes ever larger buckets, and the last one below the
number of shards is the answer. No ring table exists, and appending a shard moves rows
only into the new one. Spark's ``bigint`` product raises on overflow (ANSI), so the
generator runs on two 32-bit halves whose partial products always fit in 63 bits.

Cases: a null id counts as id 0, a null text as no text (0 bytes), an empty table gives
an empty result, repeated rows land in the same shard and get different slots; a column
of the input that is not asked for is ignored, whatever its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JUMP_MULTIPLIER = 2862933555777941757
BLOCK_MULTIPLIER = 6364136223846793005
LOW32 = 0xFFFFFFFF
#: Slots are numbered inside this many blocks of each shard, then shifted by block.
SLOT_BLOCK_BITS = 12


def _halves(key: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(LOW32))


def _advance(hi: Column, lo: Column, multiplier: int, add: int) -> tuple[Column, Column]:
    """Both halves of (hi:lo) * multiplier + add modulo 2**64."""
    m_hi, m_lo = multiplier >> 32, multiplier & LOW32
    low = lo.bitwiseAND(F.lit(0xFFFF)) * F.lit(m_lo)
    mid = F.shiftrightunsigned(lo, 16) * F.lit(m_lo)
    total = low + F.shiftleft(mid.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(add)
    carry = F.shiftrightunsigned(total, 32) + F.shiftrightunsigned(mid, 16)
    if m_hi < 1 << 30:
        cross = lo * F.lit(m_hi)
    else:
        cross = (lo.bitwiseAND(F.lit(0xFFFF)) * F.lit(m_hi)
                 + F.shiftleft((F.shiftrightunsigned(lo, 16) * F.lit(m_hi)).bitwiseAND(F.lit(0xFFFF)), 16))
    top = (hi.bitwiseAND(F.lit(0xFFFF)) * F.lit(m_lo)
           + F.shiftleft((F.shiftrightunsigned(hi, 16) * F.lit(m_lo)).bitwiseAND(F.lit(0xFFFF)), 16))
    return (carry + cross + top).bitwiseAND(F.lit(LOW32)), total.bitwiseAND(F.lit(LOW32))


def jump_hash(key: Column, shards: int) -> Column:
    """The shard (0 to shards - 1) of a ``bigint`` key; each step is one accepted jump."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    hi, lo = _advance(*_halves(key), JUMP_MULTIPLIER, 1)
    start = F.struct(hi.alias("hi"), lo.alias("lo"), F.lit(-1).cast("bigint").alias("b"),
                     F.lit(0).cast("bigint").alias("j"))

    def step(s: Column, _i: Column) -> Column:
        nhi, nlo = _advance(s["hi"], s["lo"], JUMP_MULTIPLIER, 1)
        jump = ((s["j"] + 1).cast("double")
                * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(s["hi"], 1) + 1).cast("double")))
        return F.when(s["j"] >= F.lit(shards), s).otherwise(F.struct(
            nhi.alias("hi"), nlo.alias("lo"), s["j"].alias("b"), F.floor(jump).alias("j")))

    def steps(s: Column, _i: Column) -> Column:
        inner = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, 16))), s, step)
        return F.when(s["j"] >= F.lit(shards), s).otherwise(inner)

    # at most `shards` jumps can be accepted; finished rows leave after a round of 16
    rounds = -(-shards // 16)
    out = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, steps, lambda s: s["b"])
    return out.cast("int")


def _block(key: Column) -> Column:
    hi, _lo = _advance(*_halves(key), BLOCK_MULTIPLIER, 1442695040888963407 & LOW32)
    return F.shiftrightunsigned(hi, 32 - SLOT_BLOCK_BITS).cast("int")


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document with its shard, its slot there and its shard with one more.

    Slots count from 0 without gaps. They are numbered inside 4096 id-hashed blocks of a
    shard and shifted by the rows of the blocks before, so neither a shard nor the row
    count of one has to pass through one task.
    """
    from pyspark.sql import Window

    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(0).cast("bigint"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # only digests of the text are shuffled
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        jump_hash(key, shards).alias("shard"),
        jump_hash(key, shards + 1).alias("grown_shard"),
        _block(key).alias("_block"))
    counts = (docs.select(jump_hash(key, shards).alias("shard"), _block(key).alias("_block"))
              .groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # at most 4096 rows a shard: bounded by the two constants, whatever the input
    offsets = counts.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_block").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("_rank", F.row_number().over(inside))
    return (numbered.join(offsets, ["shard", "_block"], "left")
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_before") + F.col("_rank") - 1).cast("bigint").alias("slot"), "grown_shard"))


