"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Every source wants a share of the mixture in proportion to its weight, but may be
repeated at most ``max_epochs`` times. Sources sorted by cap / weight fill up in that
order, so the clamped ones are a prefix of the order and the rest share what is left by
weight: one pass of running sums replaces the repeated clamp-and-redistribute loop.

A source taken r = target / size times gives every document floor(r) whole repetitions; the
rest goes to single documents in the order of a seeded hash of id and text. They are taken
while they fit. The one that does not would overshoot; what is then missing is filled from
the documents after it that are no larger than the gap, again in hash order while they fit,
and so on for ``PASSES`` passes. At the end the smallest document left is taken too if that
comes nearer, so a source misses its target by at most half of the smallest document left.

Rows that share id and text share the hash and are taken one by one: a hash at which a pass
ends is given out to the first k of its rows, which are numbered by file and place in a
written table, never in one task.

Cases: a null text has size 0, sources sort by code point with null last, an empty table
gives an empty result, repeated rows are separate documents, null ids count as the word
null in the hash, other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
#: Hex digits of the seeded hash that split a source into prefix-sum buckets (4096).
BUCKET_DIGITS = 3
PASSES = 4
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def fill_targets(sources: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
                 weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Targets of a (source, source_size) table: source, source_size, target.

    The table has one row per source name, which is what the two global windows see.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    t = sources.select("source", "source_size", weight.alias("w"),
                       (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"))
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = (t.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
         .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
         .withColumn("w_all", F.sum("w").over(everything)))
    t = t.withColumn("full", F.col("cap") * (F.col("w_all") - F.col("w_before"))
                     <= F.col("w") * (F.col("total") - F.col("cap_before")))
    t = (t.withColumn("cap_full", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything))
         .withColumn("w_full", F.sum(F.when(F.col("full"), F.col("w")).otherwise(0.0)).over(everything)))
    target = F.when(F.col("full"), F.col("cap")).otherwise(
        F.col("w") * (F.col("total") - F.col("cap_full")) / (F.col("w_all") - F.col("w_full")))
    return t.select("source", "source_size", target.alias("target"))


def _order(id_col: str, text_col: str, seed: str):
    """The seeded hash that orders a source's documents for the fractional repetition."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"),
                    F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit("null")))
    return F.md5(text.cast("binary"))


def _fill(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    """Where one pass ends, a row a source: (_g, _end, _k, _got).

    ``gaps``: (_g, gap), the words missing from each source; ``rows`` those of the documents
    that may fill them. All rows with a hash before ``_end`` are taken and ``_k`` rows with it
    (all rows, if it is null), which is ``_got`` words. A source's hash order is cut into
    4096 buckets; only the one in which the pass ends is sorted, equal rows as one.
    """
    same = F.col("source").eqNullSafe(F.col("_g"))
    rows = rows.withColumn("_bucket", F.substring("_h", 1, BUCKET_DIGITS))
    buckets = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_in"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("_start", F.coalesce(F.sum("_in").over(before), F.lit(0))).join(gaps, same)
    whole = starts.groupBy("_g").agg(F.sum("_in").alias("_all"), F.max("gap").alias("gap"))
    ends = starts.filter("_start <= gap AND gap < _start + _in").select(
        F.col("_g").alias("_eg"), F.col("_bucket").alias("_eb"), "_start", "gap")
    equal = (rows.join(ends, F.col("source").eqNullSafe(F.col("_eg")) & (F.col("_bucket") == F.col("_eb")))
             .groupBy("_eg", "_start", "gap", "_h", "size").agg(F.count(F.lit(1)).alias("_rows")))
    earlier = Window.partitionBy("_eg").orderBy("_h", "size").rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("size") * F.col("_rows")
    equal = equal.withColumn("_at", F.col("_start") + F.coalesce(F.sum(words).over(earlier), F.lit(0)))
    stop = (equal.filter(F.col("_at") + words > F.col("gap"))
            .withColumn("_fit", F.floor((F.col("gap") - F.col("_at")) / F.col("size")).cast("bigint"))
            .withColumn("_fit", F.when(F.col("_at") + F.col("_fit") * F.col("size") > F.col("gap"), F.col("_fit") - 1)  # rounding
                        .otherwise(F.col("_fit")))
            .groupBy("_eg").agg(F.min(F.struct("_h", "size", "_fit", "_at")).alias("e")))
    return whole.join(stop, F.col("_g").eqNullSafe(F.col("_eg")), "left").select(
        "_g", F.col("e._h").alias("_end"), F.col("e._fit").alias("_k"),
        F.when(F.col("e").isNull(), F.col("_all")).otherwise(F.col("e._at") + F.col("e._fit") * F.col("e.size")).alias("_got"))


def mix_plan(rows: DataFrame, share: float, max_epochs: int, weights: tuple[int, ...]) -> DataFrame:
    """One row per source: source_size, target, whole repetitions, for each pass the largest
    size it takes (``_gap<p>``), the hash at which it ends and how many rows of that hash it
    takes, and the hash of which one more row is taken at the end, with the number it is.

    ``rows`` has source, size, _h.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = fill_targets(sizes, share, max_epochs, weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = (targets.withColumn("whole", whole.cast("bigint"))
            .withColumn("gap", F.col("target") - F.col("whole") * F.col("source_size")).withColumnRenamed("source", "_s"))
    left = rows
    for p in range(PASSES):
        plan = stage_table(plan, "mix-plan")
        gaps = plan.filter("gap > 0").select(F.col("_s").alias("_g"), "gap")
        if p:  # what the pass before has left, and no larger than the gap
            last = plan.filter("gap > 0").select(F.col("_s").alias("_o"), F.col("gap").alias("_room"), F.col(f"_end{p - 1}").alias("_last"))
            left = rows.join(last, F.col("source").eqNullSafe(F.col("_o"))).filter(
                (F.col("size") <= F.col("_room")) & (F.col("_h") > F.col("_last"))).select("source", "size", "_h")
        found = _fill(left, gaps)
        plan = (plan.join(found, F.col("_s").eqNullSafe(F.col("_g")), "left")
                .withColumn(f"_gap{p}", F.when(F.col("gap") > 0, F.col("gap") if p else F.lit(float("inf"))).otherwise(F.lit(-1.0)))
                .withColumn("gap", F.col("gap") - F.coalesce("_got", F.lit(0)))
                # a pass that takes all it may ends nowhere (a null hash), and leaves nothing for another
                .withColumnsRenamed({"_end": f"_end{p}", "_k": f"_k{p}"}).drop("_g", "_got"))
    plan = stage_table(plan, "mix-plan")
    same = F.col("source").eqNullSafe(F.col("_s"))
    spare = (rows.filter("size > 0").join(plan.filter("gap > 0"), same).filter(~_taken_before_end())
             .groupBy(F.col("_s").alias("_g")).agg(F.min(F.struct("size", "_h")).alias("c")))
    near = F.col("c.size") < 2 * F.col("gap")
    k = F.lit(0)
    for p in range(PASSES):
        k = F.when(F.col("c._h") == F.col(f"_end{p}"), F.col(f"_k{p}")).otherwise(k)
    return (plan.join(spare, F.col("_s").eqNullSafe(F.col("_g")), "left")
            .withColumn("_close", F.when(near, F.col("c._h"))).withColumn("_close_k", F.when(near, k + 1)).drop("gap", "c", "_g"))


def _taken_before_end():
    """Whether some pass takes the row without looking at others of its hash."""
    return _any(lambda p: (F.col("size") <= F.col(f"_gap{p}")) & F.coalesce(F.col("_h") < F.col(f"_end{p}"), F.lit(True)))


def _any(test):
    out = F.lit(False)
    for p in range(PASSES):
        out = out | test(p)
    return out


def _numbered_equals(edge: DataFrame) -> DataFrame:
    """``edge``, a written table, with ``_number``: the place of each row among those of its
    source and hash. Rows are numbered inside their file; files follow each other by name."""
    e = edge.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    own = ["source", "_h", "_file"]
    files = e.groupBy(*own).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("source", "_h").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(F.col("source").alias("_fs"), F.col("_h").alias("_fh"), F.col("_file").alias("_ff"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*own).orderBy("_row"))
    at = F.col("source").eqNullSafe(F.col("_fs")) & (F.col("_h") == F.col("_fh")) & (F.col("_file") == F.col("_ff"))
    return (e.withColumn("_inside", inside).join(files, at)
            .withColumn("_number", F.col("_inside") + F.col("_offset")).drop("_file", "_row", "_fs", "_fh", "_ff", "_inside", "_offset"))


def _with_repetitions(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (source, size, _h and more) with the plan's columns and ``repetitions``."""
    met = rows.join(plan, F.col("source").eqNullSafe(F.col("_s")))
    ends = F.coalesce(F.col("_h") == F.col("_close"), F.lit(False)) | F.coalesce(
        _any(lambda p: F.coalesce(F.col("_h") == F.col(f"_end{p}"), F.lit(False))), F.lit(False))
    plain = met.filter(~ends).withColumn("_more", _taken_before_end())
    edge = _numbered_equals(stage_table(met.filter(ends), "mix-edge"))
    k = _any(lambda p: (F.col("size") <= F.col(f"_gap{p}")) & F.coalesce(
        (F.col("_h") < F.col(f"_end{p}")) | ((F.col("_h") == F.col(f"_end{p}")) & (F.col("_number") <= F.col(f"_k{p}"))), F.lit(True)))
    k = k | F.coalesce((F.col("_h") == F.col("_close")) & (F.col("_number") <= F.col("_close_k")), F.lit(False))
    both = plain.unionByName(edge.withColumn("_more", k).drop("_number"))
    return both.withColumn("repetitions", (F.col("whole") + F.col("_more").cast("int")).cast("int")).drop("_more")


def _sized(docs: DataFrame, seed: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), _order(id_col, text_col, seed).alias("_h"))


def mix_documents(docs: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
                  weights: tuple[int, ...] = WEIGHTS, seed: str = SEED, id_col: str = "doc_id",
                  text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, repetitions, taken for every document."""
    rows = stage_table(_sized(docs, seed, id_col, text_col, source_col), "mix-rows")
    plan = stage_table(mix_plan(rows.select("source", "size", "_h"), share, max_epochs, weights), "mix-plan")
    return _with_repetitions(rows, plan).select(
        "doc_id", "source", "size", "source_size", "target", "repetitions",
        (F.col("size") * F.col("repetitions")).cast("bigint").alias("taken"))


def repeat_documents(docs: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
                     weights: tuple[int, ...] = WEIGHTS, seed: str = SEED, id_col: str = "doc_id",
                     text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture itself: the rows of ``docs``, each as often as it is taken.

    Texts are not shuffled: only the plan, one row per source, meets them (those of the few
    hashes at which a pass ends are written once more, to be numbered).
    """
    sized = stage_table(_sized(docs, seed, id_col, text_col, source_col).select("source", "size", "_h"), "mix-rows")
    plan = stage_table(mix_plan(sized, share, max_epochs, weights), "mix-plan")
    names = docs.columns
    rows = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)], F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), _order(id_col, text_col, seed).alias("_h"))
    r = _with_repetitions(rows, plan)
    return (r.filter("repetitions > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("repetitions"))))
            .select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)]))
