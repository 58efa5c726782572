"""Month-end entity scorecard: six cuts x 17 measures, past buyers, long format.

Plan of ``entity_scorecard`` (one scan of the history, one of the period slice):

1. orders: the period's base lines + cash-and-carry orgs are folded to (order, category,
   whether there is a buyer) with all order flags and money sums — a partial aggregation, so
   a hot order is combined before it moves — then placed by order; the mapping, the six cuts
   and the fold to (dim, entity, order) all happen on that placement;
2. buyers: base lines up to the period's end are folded to (buyer, category, month of the
   period or none) with first month and day and the credit flag, then placed by buyer;
   ``min`` windows per segment give each period cell's New/Repeat flag, and the six cuts and
   the fold to (dim, entity, buyer) again need no other exchange (a buyer's rows are bounded
   by categories x months, so a hot buyer cannot swamp a task);
3. keys are counted per (dim, entity) in each task; only those counts move once more.

No line is copied for a cut before it is folded, and no copy is shuffled. This replaces six
multi-distinct aggregates over a stage table, six past-buyer scans and a join; ``dim`` is
carried so cuts sharing a label prefix never collide.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import predicates as P
from ..sources import stage
from .joins import placed_by, unique_by, with_mapping

ATTRS = ("business_unit", "cust_cat_phones", "cust_cat_hnk", "business_group")
BUYER = "buyer_org_id"
# segment -> column holding its value (None: the whole history of the buyer)
SEG_COL = {"category": "category", "business_unit": "business_unit", "cust_cat_phones": "cust_cat_phones",
           "cust_cat_hnk": "cust_cat_hnk", "business_group": "business_group", "overall": None}
ORDER_FLAGS = ("shipped_orders", "delivered_orders", "cnc_orders", "seller_fulfilled_orders",
               "warehouse_fulfilled_orders")
SUMS = ("rto_gmv", "credit_gmv", "placed_gmv", "shipped_gmv", "delivered_gmv", "cnc_gmv",
        "seller_fulfilled_gmv", "warehouse_fulfilled_gmv")
BUYER_FLAGS = ("new_buyers", "repeat_buyers", "credit_buyers")
OUTPUT = ("placed_orders", "shipped_orders", "delivered_orders", "rto_gmv", "credit_gmv", "placed_gmv",
          "shipped_gmv", "delivered_gmv", "cnc_gmv", "seller_fulfilled_gmv", "warehouse_fulfilled_gmv",
          "new_buyers", "repeat_buyers", "credit_buyers", "cnc_orders", "seller_fulfilled_orders",
          "warehouse_fulfilled_orders", "past_buyers")


def _d(x) -> Column:
    return x if isinstance(x, Column) else F.lit(str(x)).cast("date")


def dims(mapping: DataFrame, cnc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mapping (with a ``_mapped`` marker; a repeated category raises when the plan
    runs) and the CNC org set, de-duplicated so a repeated org id cannot multiply GMV. The mapping
    is broadcast, as in ``with_mapping``."""
    mp = unique_by(mapping.select("category", *ATTRS), "category").withColumn("_mapped", F.lit(True))
    return F.broadcast(mp), cnc.select(F.col("org_id").alias("_cnc_org")).distinct()


def _fulfilment_sql(codes: C.FulfilmentCodes) -> str:
    return (f"CASE WHEN {P.sql_in('fulfillment_center', codes.seller)} THEN 'seller' "
            f"WHEN {P.sql_in('fulfillment_center', codes.warehouse)} THEN 'wh' END")


def period_lines(txn: DataFrame, mp: DataFrame, cn: DataFrame, start, end,
                 codes: C.FulfilmentCodes) -> DataFrame:
    """Base lines of the period with mapping attributes, CNC tag, fulfilment type and
    line-level ``gmv`` / ``shipped_gmv`` (shipped = ``first_shipped`` present).
    ``mp`` / ``cn`` come from ``dims``."""
    t = txn.filter(F.col("include").isNull() & P.month_prune(start, end)
                   & F.col("order_date").between(_d(start), _d(end)))
    j = t.join(mp, "category", "left").join(cn, F.col("seller_org_id") == F.col("_cnc_org"), "left")
    return j.selectExpr(
        # attributes come with the buyer: a line without one belongs to the null entities
        BUYER, "category", *[f"CASE WHEN {BUYER} IS NOT NULL THEN {a} END AS {a}" for a in ATTRS],
        f"{BUYER} IS NOT NULL AND coalesce(_mapped, false) AS _mapped", "order_id", "order_status",
        "shipment_status", "payment_mode", "order_month", "seller_org_id",
        f"{_fulfilment_sql(codes)} AS fulfillment_type",
        "CASE WHEN _cnc_org IS NOT NULL THEN 'CNC' END AS cnc_tag",
        "CASE WHEN first_shipped IS NOT NULL THEN total_line_amount END AS shipped_gmv",
        "total_line_amount AS gmv")


def first_purchases(txn: DataFrame, upto, since=None) -> DataFrame:
    """(buyer_org_id, category, first_month, first_date) over base rows dated in
    (``since``, ``upto``] — the state the New/Repeat and past-buyer measures need.

    ``min`` is associative, so a table built once can be carried forward with
    ``merge_first_purchases(old, first_purchases(txn, upto=new_end, since=old_end))``,
    reading only the new slice of the fact instead of the whole history every run.
    """
    c = F.col("include").isNull() & F.col("order_date").isNotNull() & P.month_prune(since, upto) \
        & (F.col("order_date") <= _d(upto))
    if since is not None:
        c = c & (F.col("order_date") > _d(since))
    return txn.filter(c).groupBy(BUYER, "category").agg(F.min("order_month").alias("first_month"),
                                                         F.min("order_date").alias("first_date"))


def merge_first_purchases(*tables: DataFrame) -> DataFrame:
    """Union of first-purchase tables, reduced to the earliest purchase per pair."""
    u = tables[0]
    for t in tables[1:]:
        u = u.unionByName(t)
    return u.groupBy(BUYER, "category").agg(F.min("first_month").alias("first_month"),
                                            F.min("first_date").alias("first_date"))


def carry_first_purchases(txn: DataFrame, base: str, upto) -> DataFrame:
    """Brings the first-purchase state table at ``base`` forward to ``upto`` and returns it.

    The state is a stage table that knows the day it reaches to: only the fact after that day
    is read, and readers of the earlier state are not disturbed. With no table yet the history
    is read once; a table that already reaches to ``upto`` is returned as it is.
    """
    spark, upto = txn.sparkSession, str(upto)
    now = stage.current(spark, base)
    if now is None:
        return stage.publish(first_purchases(txn, upto), base, about={"upto": upto})
    since = now.about["upto"]
    if since > upto:
        raise ValueError(f"the state at {base} already reaches to {since}")
    old = stage.read(spark, base, now)
    if since == upto:
        return old
    return stage.publish(merge_first_purchases(old, first_purchases(txn, upto, since=since)), base, about={"upto": upto})


def first_purchase_cells(txn: DataFrame, mp: DataFrame, start, end,
                         state: DataFrame | None = None, state_upto=None) -> DataFrame:
    """One scan of the history as cells: (buyer, category) outside the period (``_src='h'``) and
    (buyer, category, month) in it (``_src='p'``, with a credit-and-shipped flag), each with its
    first month and day, and the buyer's first month in every segment (``_first_<segment>``).

    ``state``: an optional ``first_purchases`` table covering history up to
    ``state_upto`` (<= ``end``); only the fact after it, and the period, are read.
    One hash exchange on the buyer, then ``min`` windows per segment that all reuse it.
    """
    since = None
    if state is not None:
        if state_upto is None or str(state_upto) > str(end):
            raise ValueError("a first-purchase state must cover history up to a date <= the period end")
        before = str(date.fromisoformat(str(start)[:10]) - timedelta(days=1))
        since = min(str(state_upto)[:10], before)  # days read twice change no minimum
    c = F.col("include").isNull() & F.col("order_date").isNotNull() & P.month_prune(since, end) & (F.col("order_date") <= _d(end))
    if since is not None:
        c = c & (F.col("order_date") > _d(since))
    inside = f"(order_date >= DATE {P.sql_lit(start)})"
    rows = txn.filter(c).selectExpr(
        BUYER, "category", f"CASE WHEN {inside} THEN 'p' ELSE 'h' END AS _src",
        f"CASE WHEN {inside} THEN CAST(order_month AS INT) END AS _pm", "order_month AS _m", "order_date AS _d",
        f"CASE WHEN {inside} THEN {P.sql_flag(f'{P.CREDIT_SQL} AND {P.SHIP_SQL}')} END AS _c")
    u = rows.groupBy(BUYER, "category", "_src", F.col("_pm").alias("order_month")).agg(
        F.min("_m").alias("_fm"), F.min("_d").alias("_fd"), F.max("_c").alias("_credit"))
    if state is not None:
        u = u.unionByName(state.selectExpr(
            BUYER, "category", "'h' AS _src", "CAST(NULL AS INT) AS order_month", "first_month AS _fm", "first_date AS _fd",
            "CAST(NULL AS INT) AS _credit"))
    u = u.join(mp, "category", "left").withColumn("_mapped", F.coalesce(F.col("_mapped"), F.lit(False)))
    u = u.repartition(BUYER)
    wins = [f"min(_fm) OVER (PARTITION BY {BUYER}{', ' + col if col else ''}) AS _first_{seg}"
            for seg, col in SEG_COL.items()]
    return u.selectExpr("*", *wins)


def _flag(cells: DataFrame, seg: str) -> Column:
    return F.expr(f"CASE WHEN _mapped THEN CASE WHEN order_month = _first_{seg} THEN 'New' ELSE 'Repeat' END END")


FLAG_COLUMNS = (
    ("buyer_cat_month_newrep", "category"),
    ("buyer_bu_month_newrep", "business_unit"),
    ("buyer_month_newrep", "overall"),
    ("buyer_cust_cat_phones_month_newrep", "cust_cat_phones"),
    ("buyer_business_group_month_newrep", "business_group"),
)
RAW_KEYS = (BUYER, "category", *ATTRS, *[n for n, _ in FLAG_COLUMNS], "order_status", "order_id",
            "shipment_status", "payment_mode", "fulfillment_type", "cnc_tag")


def buyer_cuts_raw(txn: DataFrame, mapping: DataFrame, cnc: DataFrame, start, end,
                   codes: C.FulfilmentCodes, state: DataFrame | None = None, state_upto=None) -> DataFrame:
    """The 17-key period pre-aggregate with New/Repeat flags (flags NULL for an unmapped
    category, as the flag table is joined on the mapped category). ``state`` as in
    ``entity_scorecard``."""
    mp, cn = dims(mapping, cnc)
    lines = period_lines(txn, mp, cn, start, end, codes)
    cells = first_purchase_cells(txn, mp, start, end, state, state_upto).filter(F.col("_src") == "p")
    flags = cells.select(BUYER, "category", "order_month", *[_flag(cells, s).alias(n) for n, s in FLAG_COLUMNS])
    pre = lines.groupBy(BUYER, "category", "order_month", *ATTRS, "order_status", "order_id", "shipment_status",
                        "payment_mode", "fulfillment_type", "cnc_tag").agg(
        F.sum("shipped_gmv").alias("shipped_gmv"), F.sum("gmv").alias("gmv"))
    j = pre.join(flags, [BUYER, "category", "order_month"], "left")
    return (j.groupBy(*RAW_KEYS).agg(F.sum("shipped_gmv").alias("shipped_gmv"), F.sum("gmv").alias("gmv"))
            .withColumns({"shipped_gmv": F.col("shipped_gmv").cast("double"), "gmv": F.col("gmv").cast("double")}))


def _past_label_sql(dim: str, prefix: str | None) -> str:
    """Past-buyer label: concat (NULL for a NULL value); 'Ignore' custom cuts are NULL."""
    if prefix is None:
        return "'Overall'"
    col = SEG_COL[dim]
    lab = f"concat({P.sql_lit(prefix)}, CAST({col} AS STRING))"
    if dim in ("cust_cat_phones", "cust_cat_hnk"):
        lab = f"CASE WHEN {col} <> {P.sql_lit(C.IGNORE_VALUE)} THEN {lab} END"   # NOT IN ('Ignore')
    return lab


def _label_sql(dim: str, prefix: str | None, null_label: str) -> str:
    """Scorecard label: ``CASE WHEN v IS NULL THEN null_label ELSE concat(prefix, v) END``."""
    if prefix is None:
        return P.sql_lit(null_label)
    col = SEG_COL[dim]
    return f"CASE WHEN {col} IS NULL THEN {P.sql_lit(null_label)} ELSE concat({P.sql_lit(prefix)}, CAST({col} AS STRING)) END"


def past_buyers(txn: DataFrame, mapping: DataFrame, start) -> DataFrame:
    """Distinct buyers before ``start`` per (dim, entity), six cuts; a NULL segment value
    gives a NULL entity (it never matches a scorecard label), 'Ignore' is left out."""
    h = txn.filter(F.col("include").isNull() & P.month_prune(None, start) & (F.col("order_date") < _d(start)))
    # folded to (buyer, category) and placed by buyer: the copies for the cuts stay in their task
    h = with_mapping(placed_by(h.select(BUYER, "category").distinct(), BUYER), mapping, ATTRS)
    arr = ", ".join(f"named_struct('dim', '{dim}', 'entity', {_past_label_sql(dim, prefix)})"
                    for dim, prefix, _ in C.SCORECARD_DIMS)
    x = h.selectExpr(f"inline(array({arr}))", BUYER)
    # 'Ignore' (and NULL) custom-cut rows are filtered out, not labelled NULL
    x = x.filter("NOT (dim IN ('cust_cat_phones', 'cust_cat_hnk') AND entity IS NULL)")
    # two-level distinct: (dim, entity, buyer) de-duplicated where the buyer lies, then counted
    return x.distinct().groupBy("dim", "entity").agg(F.count(BUYER).alias("past_buyers"))


_ORDER_FLAG_SQL = {
    "shipped_orders": P.SHIP_SQL,
    "delivered_orders": P.DELIVERED_SQL,
    "cnc_orders": f"cnc_tag IS NOT NULL AND {P.SHIP_SQL}",
    "seller_fulfilled_orders": f"fulfillment_type = 'seller' AND cnc_tag IS NULL AND {P.SHIP_SQL}",
    "warehouse_fulfilled_orders": f"fulfillment_type = 'wh' AND cnc_tag IS NULL AND {P.SHIP_SQL}",
}
_SUM_SQL = {
    "rto_gmv": f"CASE WHEN {P.RTO_SQL} THEN gmv END",
    "credit_gmv": f"CASE WHEN {P.CREDIT_SQL} THEN shipped_gmv END",
    "placed_gmv": "gmv",
    "shipped_gmv": "shipped_gmv",
    "delivered_gmv": f"CASE WHEN {P.DELIVERED_SQL} AND {P.NOT_CANCELLED_SQL} THEN gmv END",
    "cnc_gmv": "CASE WHEN cnc_tag IS NOT NULL THEN shipped_gmv END",
    "seller_fulfilled_gmv": "CASE WHEN fulfillment_type = 'seller' AND cnc_tag IS NULL THEN shipped_gmv END",
    "warehouse_fulfilled_gmv": "CASE WHEN fulfillment_type = 'wh' AND cnc_tag IS NULL THEN shipped_gmv END",
}


def entity_scorecard(txn: DataFrame, mapping: DataFrame, cnc: DataFrame, start, end,
                     codes: C.FulfilmentCodes, cuts: C.CustomCuts = C.CustomCuts(),
                     state: DataFrame | None = None, state_upto=None) -> DataFrame:
    """(dim, entity, 17 measures, past_buyers) for the six cuts of the period.

    ``state`` / ``state_upto``: optional ``first_purchases`` table carried from an earlier
    run (see ``first_purchase_cells``); the result is identical, the history is not re-read.
    """
    mp, cn = dims(mapping, cnc)
    orders = _order_counts(txn, mp, cn, start, end, codes)
    buyers = _buyer_counts(first_purchase_cells(txn, mp, start, end, state, state_upto), start, cuts)
    # two small tables of counts, stacked and added up: their groups meet without a join
    names = {f.name: f.dataType.simpleString() for df in (orders, buyers) for f in df.schema if f.name not in ("dim", "entity")}
    stacked = [df.selectExpr("dim", "entity", *[n if n in df.columns else f"CAST(NULL AS {t}) AS {n}" for n, t in names.items()])
               for df in (orders, buyers)]
    out = stacked[0].unionByName(stacked[1]).groupBy("dim", "entity").agg(*[F.max(n).alias(n) for n in names])
    zero = {n: f"coalesce({n}, 0L) AS {n}" for n in BUYER_FLAGS}
    return out.filter("_has_o > 0").selectExpr(
        "dim", "entity", *[zero.get(n, n) for n in OUTPUT if n != "past_buyers"],
        "CASE WHEN _has_h > 0 THEN _past END AS past_buyers")


def _order_counts(txn: DataFrame, mp: DataFrame, cn: DataFrame, start, end, codes: C.FulfilmentCodes) -> DataFrame:
    """(dim, entity, order counts, money) of the period; ``_has_o`` > 0 marks that there are lines."""
    t = txn.filter(F.col("include").isNull() & P.month_prune(start, end)
                   & F.col("order_date").between(_d(start), _d(end)))
    amount = t.schema["total_line_amount"].dataType
    cents = 10 ** (amount.scale if hasattr(amount, "scale") else 2)
    lines = t.join(cn, F.col("seller_org_id") == F.col("_cnc_org"), "left").selectExpr(
        "order_id", "category", f"{BUYER} IS NOT NULL AS _buyer", "order_status", "shipment_status", "payment_mode",
        f"{_fulfilment_sql(codes)} AS fulfillment_type", "CASE WHEN _cnc_org IS NOT NULL THEN 'CNC' END AS cnc_tag",
        "CASE WHEN first_shipped IS NOT NULL THEN total_line_amount END AS shipped_gmv", "total_line_amount AS gmv")
    # money as exact integer cents: bigint sums stay on the fast aggregation path (ANSI mode
    # raises on overflow instead of wrapping)
    folded = lines.selectExpr(
        "order_id", "category", "_buyer", *[f"{P.sql_flag(c)} AS f_{n}" for n, c in _ORDER_FLAG_SQL.items()],
        *[f"CAST(({_SUM_SQL[n]}) * {cents} AS BIGINT) AS s_{n}" for n in SUMS]).groupBy("order_id", "category", "_buyer")

    def fold() -> list[Column]:
        return [*[F.max(f"f_{n}").alias(f"f_{n}") for n in ORDER_FLAGS], *[F.sum(f"s_{n}").alias(f"s_{n}") for n in SUMS]]

    values = [*[f"f_{n}" for n in ORDER_FLAGS], *[f"s_{n}" for n in SUMS]]
    placed = folded.agg(*fold()).repartition("order_id").join(mp, "category", "left").selectExpr(
        "order_id", "category", *values,
        # attributes come with the buyer: a line without one belongs to the null entities
        *[f"CASE WHEN _buyer THEN {a} END AS {a}" for a in ATTRS])
    o_cuts = ", ".join(f"named_struct('dim', '{d}', 'entity', {_label_sql(d, p, nl)})" for d, p, nl in C.SCORECARD_DIMS)
    each = (placed.selectExpr("order_id", f"inline(array({o_cuts}))", *values)
            .groupBy("dim", "entity", "order_id").agg(*fold()))
    return each.groupBy("dim", "entity").agg(*[F.expr(e) for e in (
        "count(1) AS _has_o", "count(order_id) AS placed_orders",
        *[f"count(CASE WHEN f_{n} = 1 THEN order_id END) AS {n}" for n in ORDER_FLAGS],
        *[f"CAST(sum(CAST(s_{n} AS DECIMAL(28, 0))) / {cents} AS DOUBLE) AS {n}" for n in SUMS])])


def _buyer_counts(cells: DataFrame, start, cuts: C.CustomCuts) -> DataFrame:
    """(dim, entity, buyer counts, ``_past`` and ``_has_h``): New, Repeat and credit buyers from the
    period's cells, past buyers from the cells before it."""
    flag_seg = {"category": "category", "business_unit": "business_unit", "cust_cat_phones": "cust_cat_phones",
                "cust_cat_hnk": "cust_cat_hnk" if cuts.hnk_flag == "own" else "cust_cat_phones",
                "business_group": "business_group", "overall": "overall"}
    bh_cuts = ", ".join(
        f"named_struct('dim', '{d}', "
        f"'entity', CASE WHEN _src = 'p' THEN {_label_sql(d, p, nl)} ELSE {_past_label_sql(d, p)} END, "
        f"'f_new_buyers', {P.sql_flag(f'_src = {P.sql_lit("p")} AND _mapped AND order_month = _first_{flag_seg[d]}')}, "
        f"'f_repeat_buyers', {P.sql_flag(f'_src = {P.sql_lit("p")} AND _mapped AND order_month <> _first_{flag_seg[d]}')})"
        for d, p, nl in C.SCORECARD_DIMS)
    flags = {**{f"f_{n}": f"f_{n}" for n in BUYER_FLAGS[:2]}, "f_credit_buyers": P.sql_flag("_src = 'p' AND _credit = 1"),
             "f_past": P.sql_flag("_src = 'h'")}
    each = (cells.filter(f"_src = 'p' OR _fd < DATE {P.sql_lit(start)}")
            .selectExpr(BUYER, f"inline(array({bh_cuts}))", *[f"{e} AS {n}" for n, e in flags.items() if n != e])
            .filter("entity IS NOT NULL").groupBy("dim", "entity", BUYER).agg(*[F.max(n).alias(n) for n in flags]))
    return each.groupBy("dim", "entity").agg(
        *[F.expr(f"count(CASE WHEN f_{n} = 1 THEN {BUYER} END) AS {n}") for n in BUYER_FLAGS],
        F.expr(f"count(CASE WHEN f_past = 1 THEN {BUYER} END) AS _past"), F.expr("count(CASE WHEN f_past = 1 THEN 1 END) AS _has_h"))


def with_percentages(sc: DataFrame) -> DataFrame:
    """The scorecard with ``rto_pct`` and ``credit_gmv_pct``, which the long format's rows named "%"
    do not hold (they carry the amounts): returned value of all placed, and shipped value on
    credit of all shipped, in percent; NULL where there is nothing to divide by."""
    return sc.withColumns({"rto_pct": F.try_divide(F.lit(100.0) * F.col("rto_gmv"), F.col("placed_gmv")),
                           "credit_gmv_pct": F.try_divide(F.lit(100.0) * F.col("credit_gmv"), F.col("shipped_gmv"))})


def scorecard_long(sc: DataFrame, month_label: str,
                   particulars: tuple[tuple[str, str], ...] = C.PARTICULARS) -> DataFrame:
    """Long format: one row per entity and particular (particular, month, category,
    rprt_category, remarks, value, dim, and the particular's place as ``row_rank``) — one
    ``unpivot`` instead of 18 scans."""
    measures = {m for _, m in particulars}
    wide = sc.withColumn("total_buyers", F.col("new_buyers") + F.col("repeat_buyers"))
    cols = {f"m{i}": F.col(m).cast("double") for i, (_, m) in enumerate(particulars) if m in measures}
    wide = wide.select("dim", F.col("entity").alias("category"), *[c.alias(k) for k, c in cols.items()])
    long = wide.unpivot(["dim", "category"], list(cols), "_m", "value")
    names = F.create_map(*[x for i, (p, _) in enumerate(particulars) for x in (F.lit(f"m{i}"), F.lit(p))])
    return long.select(names[F.col("_m")].alias("particular"), F.lit(month_label).alias("month"), "category",
                       F.lit("").alias("rprt_category"), F.lit("").alias("remarks"), "value", "dim",
                       (F.substring("_m", 2, 9).cast("int") + 1).alias("row_rank"))
