"""Collapse of cumulative conversation snapshots, then chat rendering by turn.

Chat logs often store a conversation again after each turn. Every turn gets a digest of
its position, role and text; the digests' running sums are the rolling hash of each
prefix (128 bits in four sums, so no step overflows). A conversation is dropped when a
longer one has its full hash as a prefix hash, or when an equal one has a smaller id: an
anti-join on pre-aggregated hashes, in which the most common first turn is one row.

Running counts and sums are taken in blocks of ``BLOCK`` turn numbers and shifted by the
blocks before, so one conversation with very many turns spreads over many tasks. The
result stays one row per rendered turn for the same reason.

Cases: turns sort by number (null first), ties by role and text; null role and null text
are values of their own for the comparison and render as empty; rows without conv_id form
one conversation; repeated rows are repeated turns; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_SUMS = [f"_s{i}" for i in range(4)]


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with position (from 1) and the rolling hash up to there."""
    t = turns.select("conv_id", "turn", "role", "text",
                     F.coalesce(F.floor(F.col("turn") / F.lit(BLOCK)), F.lit(-(1 << 62))).alias("_block"))
    starts = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", "_block").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    counts = t.groupBy("conv_id", "_block").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(F.col("conv_id").alias("_c"), F.col("_block").alias("_b"),
                           F.coalesce(F.sum("_n").over(
                               Window.partitionBy("conv_id").orderBy("_block")
                               .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_block") == F.col("_b"))
    t = t.withColumn("_r", F.row_number().over(inside)).join(counts, same, "left").drop("_c", "_b")
    t = t.withColumn("position", F.col("_before") + F.col("_r"))

    def part(c):  # null and empty differ
        return F.when(c.isNull(), F.lit("n")).otherwise(
            F.concat(F.lit("v"), F.char_length(c).cast("string"), F.lit(":"), c))

    digest = F.md5(F.concat_ws("|", F.col("position").cast("string"), part(F.col("role")),
                               part(F.col("text"))).cast("binary"))
    t = t.withColumn("_d", digest)
    t = t.withColumns({s: F.conv(F.substring("_d", 8 * i + 1, 8), 16, 10).cast("bigint")
                       for i, s in enumerate(_SUMS)}).drop("_d", "_r", "_before")
    sums = t.groupBy("conv_id", "_block").agg(*[F.sum(s).alias(s) for s in _SUMS])
    sums = sums.select(F.col("conv_id").alias("_c"), F.col("_block").alias("_b"),
                       *[F.coalesce(F.sum(s).over(starts), F.lit(0)).alias(f"{s}b") for s in _SUMS])
    run = Window.partitionBy("conv_id", "_block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumns({s: F.sum(s).over(run) for s in _SUMS}).join(sums, same, "left")
    return t.select("conv_id", "turn", "role", "text", "position",
                    *[(F.col(s) + F.col(f"{s}b")).alias(s) for s in _SUMS])


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """conv_id and n_turns of the conversations that no other one contains as a prefix.

    ``prefixes`` is the result of ``turn_prefixes`` (give a written table of it).
    """
    key = ["position", *_SUMS]
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("_l"))
    full = last.select("conv_id", *[F.col(f"_l.{k}").alias(k) for k in key])
    # one row per distinct conversation, and one per distinct proper prefix
    distinct = full.groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    ends = full.select(F.col("conv_id").alias("_c"), F.col("position").alias("_n"))
    proper = (prefixes.select("conv_id", *key)
              .join(ends, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("position") < F.col("_n")), "left_semi")
              .select(*key).distinct())
    return distinct.join(proper, key, "left_anti").select("conv_id", F.col("position").alias("n_turns"))


def render(role, text):
    """One turn of the chat template."""
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")),
                    F.lit(CLOSE), F.lit("\n"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """The rendered turns of the maximal conversations, with whether a turn bears loss."""
    from .common import stage_table

    prefixes = stage_table(turn_prefixes(turns), "chat-prefixes")
    keep = maximal_conversations(prefixes).select(F.col("conv_id").alias("_c"), "n_turns")
    return (prefixes.join(keep, F.col("conv_id").eqNullSafe(F.col("_c")))
            .select("conv_id", F.col("position").cast("bigint").alias("position"),
                    F.col("n_turns").cast("bigint").alias("n_turns"), "role",
                    F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("bears_loss"),
                    render(F.col("role"), F.col("text")).alias("rendered")))
