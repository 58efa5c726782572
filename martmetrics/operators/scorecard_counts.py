"""The scorecard's distinct counts from bitmaps of its finest cells.

All six cuts are functions of a line's category (and of whether it has a buyer), so orders
and buyers are collected once for each (category, attributes) cell, as bitmaps, and every cut
is an OR of a few cells. No line is copied for a cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import predicates as P
from . import bitmaps
from .scorecard import (_ORDER_FLAG_SQL, _label_sql, _past_label_sql, ATTRS, BUYER, BUYER_FLAGS, ORDER_FLAGS, SEG_COL, dims,
                        first_purchase_cells, period_lines)

CELL = ("category", *ATTRS)
COUNTS = ("placed_orders", *ORDER_FLAGS, *BUYER_FLAGS, "past_buyers")


def flag_segments(cuts: C.CustomCuts) -> dict[str, str]:
    """cut -> the segment whose New/Repeat flag it counts."""
    return {seg: ("cust_cat_phones" if seg == "cust_cat_hnk" and cuts.hnk_flag != "own" else seg) for seg in SEG_COL}


def order_cells(lines: DataFrame) -> DataFrame:
    """Orders of the period by cell: one bitmap for placed orders and one for each order flag."""
    flags = {"placed_orders": "true", **_ORDER_FLAG_SQL}
    folded = bitmaps.fold(lines, CELL, "order_id", flags)
    return bitmaps.bitmap_cells(bitmaps.with_dense_ids(folded, "order_id"), CELL, "order_id", tuple(flags))


def buyer_cells(cells: DataFrame, start) -> DataFrame:
    """Buyers by cell, from ``first_purchase_cells``: New and Repeat under every segment and on
    credit in the period, and any purchase before it (cells with ``_h``)."""
    seg = {f"{k}_{s}": f"_src = 'p' AND _mapped AND order_month {op} _first_{s}"
           for s in SEG_COL for k, op in (("new", "="), ("rep", "<>"))}
    flags = {**seg, "credit": "_src = 'p' AND _credit = 1", "past": "_src = 'h'"}
    rows = cells.filter(f"_src = 'p' OR _fd < DATE {P.sql_lit(start)}")
    folded = bitmaps.fold(rows.withColumn("_h", F.expr("_src = 'h'")), (*CELL, "_h"), BUYER, flags)
    return bitmaps.bitmap_cells(bitmaps.with_dense_ids(folded, BUYER), (*CELL, "_h"), BUYER, tuple(flags))


def scorecard_counts(txn: DataFrame, mapping: DataFrame, cnc: DataFrame, start, end, codes: C.FulfilmentCodes,
                     cuts: C.CustomCuts = C.CustomCuts(), state: DataFrame | None = None, state_upto=None) -> DataFrame:
    """(dim, entity, ten distinct counts): those of ``entity_scorecard``, by OR of cell bitmaps."""
    mp, cn = dims(mapping, cnc)
    lines = period_lines(txn, mp, cn, start, end, codes)
    segments = flag_segments(cuts)
    orders = order_cells(lines)
    o_cuts = ", ".join(f"named_struct('dim', '{d}', 'entity', {_label_sql(d, p, nl)})" for d, p, nl in C.SCORECARD_DIMS)
    names = ("placed_orders", *ORDER_FLAGS)
    by_order = bitmaps.counts(orders.selectExpr(f"inline(array({o_cuts}))", bitmaps.CHUNK, *names), ("dim", "entity"), names)

    buyers = buyer_cells(first_purchase_cells(txn, mp, start, end, state, state_upto), start)
    b_cuts = ", ".join(
        f"named_struct('dim', '{d}', 'entity', CASE WHEN _h THEN {_past_label_sql(d, p)} ELSE {_label_sql(d, p, nl)} END, "
        f"'new_buyers', new_{segments[d]}, 'repeat_buyers', rep_{segments[d]})" for d, p, nl in C.SCORECARD_DIMS)
    sets = ("new_buyers", "repeat_buyers", "credit_buyers", "past_buyers")
    spread = (buyers.selectExpr(f"inline(array({b_cuts}))", "_h", bitmaps.CHUNK, "credit AS credit_buyers", "past AS past_buyers")
              .filter("entity IS NOT NULL"))
    # both kinds of rows in one aggregation: two filtered uses of it would scan the history twice
    merged = spread.groupBy("dim", "entity", bitmaps.CHUNK).agg(
        *[F.bitmap_or_agg(n).alias(n) for n in sets], F.max(F.col("_h").cast("int")).alias("_h"))
    by_buyer = merged.groupBy("dim", "entity").agg(*[F.sum(F.bitmap_count(n)).alias(n) for n in sets],
                                                   F.max("_h").alias("_h"))
    zero = F.lit(0).cast("bigint")
    return by_order.join(by_buyer, ["dim", "entity"], "left").select(
        "dim", "entity", *names, *[F.coalesce(n, zero).alias(n) for n in BUYER_FLAGS],
        F.when(F.col("_h") == 1, F.col("past_buyers")).alias("past_buyers"))
