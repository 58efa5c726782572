"""New / Repeat buyer classification.

Source semantics: for a buyer, month and segment value, the cell is *New* when it holds the
buyer's first-ever purchase in that segment (row ranked first in the month *and* without a
previous purchase in the segment), else *Repeat*. Because ``order_month`` rises with
``order_date``, that is exactly ``order_month == min(order_month)`` over the buyer's
history in the segment — one ``min`` per segment instead of a lag, a rank and a
collect_set window each. Rows with a NULL ``order_date`` must be dropped first (they would
make two rows "first" under the lag form).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import placed_by, with_mapping

# (segment column, output flag column) of the report's table — the HNK flag is computed by the
# source but not carried into its output table; ``ALL_SEGMENTS`` has it.
SEGMENTS = (
    ("category", "buyer_cat_month_newrep"),
    ("cust_cat_phones", "buyer_cust_cat_phones_month_newrep"),
    ("business_unit", "buyer_bu_month_newrep"),
    ("business_group", "buyer_business_group_month_newrep"),
    (None, "buyer_month_newrep"),
)
ALL_SEGMENTS = (*SEGMENTS, ("cust_cat_hnk", "buyer_cust_cat_hnk_month_newrep"))
ATTRS = ("business_unit", "cust_cat_phones", "cust_cat_hnk", "business_group")


def _newrep(new: Column) -> Column:
    return F.when(new, F.lit("New")).otherwise(F.lit("Repeat"))


def newrep_flags(txn: DataFrame, mapping: DataFrame, buyer: str = "buyer_org_id") -> DataFrame:
    """Distinct (buyer, month, category + mapping attributes) with the five New/Repeat flags,
    over the whole history of base rows (``include IS NULL``).

    Plan: one partial aggregation to distinct (buyer, category, month), the join with the
    broadcast mapping, one hash exchange on the buyer, then per-segment ``min`` windows that all
    reuse that partitioning. A category has one business unit, so one sort by buyer, unit and
    category serves three of them. A buyer's rows after de-duplication are
    bounded by categories x months, so a hot buyer cannot swamp a task.
    """
    d = (txn.filter(F.col("include").isNull() & F.col("order_date").isNotNull())
         .select(buyer, "category", "order_month").distinct())
    d = placed_by(with_mapping(d, mapping, ATTRS), buyer).sortWithinPartitions(buyer, "business_unit", "category")
    month = F.col("order_month")
    parts = {"category": ("business_unit", "category"), None: ()}
    for seg, name in sorted(SEGMENTS, key=lambda s: s[0] in ("cust_cat_phones", "business_group")):
        w = Window.partitionBy(buyer, *parts.get(seg, (seg,)))
        d = d.withColumn(name, month == F.min(month).over(w))
    return d.select(buyer, "order_month", "category", *ATTRS, *[_newrep(F.col(name)).alias(name) for _, name in SEGMENTS])


def newrep_all_segments(txn: DataFrame, mapping: DataFrame, buyer: str = "buyer_org_id",
                        segments=ALL_SEGMENTS, placed: bool = False) -> DataFrame:
    """The New/Repeat table with the flags of all six segments, from one window.

    Every (buyer, category, month) becomes one row a segment with that segment's value, so
    one specification — buyer, segment, value — serves all segments with one sort; the rows
    are then folded back to one a cell, on the same partitioning, and get the mapping's
    attributes again, which the sorted rows do not carry. ``placed``: the fact is
    already partitioned by buyer (a bucketed table), and no exchange is added.
    """
    d = (txn.filter(F.col("include").isNull() & F.col("order_date").isNotNull())
         .select(buyer, "category", "order_month").distinct())
    if not placed:
        d = placed_by(d, buyer)
    values = F.array(*[F.struct(F.lit(i).alias("_segment"), (F.col(seg) if seg else F.lit("")).cast("string").alias("_value"))
                       for i, (seg, _) in enumerate(segments)])
    long = with_mapping(d, mapping, ATTRS).select(buyer, "order_month", "category", F.inline(values))
    first = F.min("order_month").over(Window.partitionBy(buyer, "_segment", "_value"))
    flagged = long.withColumn("_new", F.col("order_month") == first)
    flags = [_newrep(F.max(F.when(F.col("_segment") == i, F.col("_new")))).alias(name)
             for i, (_, name) in enumerate(segments)]
    cells = flagged.groupBy(buyer, "order_month", "category").agg(*flags)
    return with_mapping(cells, mapping, ATTRS).select(buyer, "order_month", "category", *ATTRS, *[name for _, name in segments])


def newrep_flags_windowed(txn: DataFrame, mapping: DataFrame, buyer: str = "buyer_org_id",
                          segments=SEGMENTS) -> DataFrame:
    """The same table computed the long way (lag / rank / collect_set windows per segment),
    kept to check the closed form and for callers that need the gap and rank columns.

    A cell is New when some row in it is ranked first in its month *and* has no earlier
    purchase in the segment; the set of per-row markers is concatenated and searched for
    'NEW', as the source does. All windows partition by the buyer first and the input is
    exchanged once on the buyer, so they share that partitioning. The three windows of a
    segment also share one sort — buyer, segment, month, day: ``order_month`` rises with
    ``order_date`` (see above), so the lag may look at both, and a category has one business
    unit. A segment's markers go before the next one is sorted.
    """
    d = (txn.filter(F.col("include").isNull() & F.col("order_date").isNotNull())
         .select(buyer, "category", "order_date", "order_month").distinct())
    d = placed_by(with_mapping(d, mapping, ATTRS), buyer, times=2)
    od = F.col("order_date")
    parts = {"category": ("business_unit", "category"), None: ()}
    for seg, name in sorted(segments, key=lambda s: s[0] is not None):   # the widest partition first
        keys = (buyer, *parts.get(seg, (seg,)))
        cell = Window.partitionBy(*keys, "order_month")
        gap = F.datediff(od, F.lag(od, 1).over(Window.partitionBy(*keys).orderBy("order_month", od)))
        rk = F.rank().over(cell.orderBy(od))
        d = d.withColumn("_m", F.when((rk == 1) & gap.isNull(), F.lit("NEW")).otherwise(F.lit("REPEAT")))
        s = F.concat_ws("+", F.collect_set("_m").over(cell))
        d = d.withColumn(name, s.like("%NEW%")).drop("_m")
    return d.select(buyer, "order_month", "category", *ATTRS,
                    *[_newrep(F.col(name)).alias(name) for _, name in segments]).distinct()


def buyer_gaps(txn: DataFrame, buyer: str = "buyer_org_id", segment: str = "category") -> DataFrame:
    """Per buyer and segment, each purchase day with the previous one and the gap in days
    (``lag`` + ``datediff``) and its rank within the month."""
    d = (txn.filter(F.col("include").isNull() & F.col("order_date").isNotNull())
         .select(buyer, segment, "order_date", "order_month").distinct()
         .repartition(buyer))   # both windows below reuse this buyer partitioning
    od = F.col("order_date")
    w = Window.partitionBy(buyer, segment).orderBy(od)
    prev = F.lag(od, 1).over(w)
    return d.select(buyer, segment, "order_date", "order_month", prev.alias("prev_order_date"),
                    F.datediff(od, prev).alias("gap_days"),
                    F.rank().over(Window.partitionBy(buyer, "order_month").orderBy(od)).alias("month_rank"))
