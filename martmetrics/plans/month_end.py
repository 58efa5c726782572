"""Month-end scorecard queries (new/repeat flags, pre-aggregate, past buyers, scorecard).

Each entry: name -> (build(spark, sf_dir) -> DataFrame, oracle SQL or None). The oracle SQL
shares no expression, list or label with the operators it checks.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bitmaps, newrep, scorecard, scorecard_counts
from ..sources import bucketed, files
from ..sources import testdata as td
from .params import CFG, MONTH_LABEL, SC_END, SC_MONTHS, SC_START

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def q_newrep_flags(spark: SparkSession, sf: str) -> DataFrame:
    return newrep.newrep_flags(td.txn(spark, sf), td.custom_mapping(spark, sf))


def q_newrep_all_segments(spark: SparkSession, sf: str) -> DataFrame:
    return newrep.newrep_all_segments(td.txn(spark, sf), td.custom_mapping(spark, sf))


def q_newrep_windowed_all(spark: SparkSession, sf: str) -> DataFrame:
    return newrep.newrep_flags_windowed(td.txn(spark, sf), td.custom_mapping(spark, sf), segments=newrep.ALL_SEGMENTS)


def _bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The fact as a table bucketed by buyer, in a session that joins bucketed tables in place."""
    name = td.bucketed_txn(spark, sf)
    return bucketed.co_located(spark).table(name)


def q_newrep_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    t = _bucketed(spark, sf)
    return newrep.newrep_all_segments(t, td.custom_mapping(t.sparkSession, sf), placed=True)


def q_join_composite_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The period's lines with their New/Repeat flag: scan, window and join on one placement."""
    t = _bucketed(spark, sf)
    flags = newrep.newrep_all_segments(t, td.custom_mapping(t.sparkSession, sf), placed=True).select(
        "buyer_org_id", "category", "order_month", "buyer_cat_month_newrep", "buyer_cust_cat_hnk_month_newrep")
    lines = t.filter(F.col("order_date").between(F.to_date(F.lit(SC_START)), F.to_date(F.lit(SC_END))))
    return lines.join(flags, ["buyer_org_id", "category", "order_month"], "left").select(
        "order_id", "listing_id", "buyer_org_id", "category", "buyer_cat_month_newrep", "buyer_cust_cat_hnk_month_newrep")


def q_buyer_cuts_raw(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.buyer_cuts_raw(td.txn(spark, sf), td.custom_mapping(spark, sf), td.cnc_org(spark, sf),
                                    SC_START, SC_END, CFG.fulfilment)


def q_past_buyers(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.past_buyers(td.txn(spark, sf), td.custom_mapping(spark, sf), SC_START)


def q_entity_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.entity_scorecard(td.txn(spark, sf), td.custom_mapping(spark, sf), td.cnc_org(spark, sf),
                                      SC_START, SC_END, CFG.fulfilment, CFG.cuts)


def q_scorecard_percentages(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.with_percentages(q_entity_scorecard(spark, sf)).select("dim", "entity", "rto_pct", "credit_gmv_pct")


def q_scorecard_long(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.scorecard_long(q_entity_scorecard(spark, sf), MONTH_LABEL)


def q_scorecard_carried_state(spark: SparkSession, sf: str) -> DataFrame:
    """Scorecards of consecutive months, each from the first-purchase state carried by the one
    before: the history is read once, for the first state, and then a month at a time."""
    t, mp, cn = td.txn(spark, sf), td.custom_mapping(spark, sf), td.cnc_org(spark, sf)
    base = files.scratch_path(spark, "first_purchases")
    months, reached = [], str(date.fromisoformat(SC_MONTHS[0][0]) - timedelta(days=1))
    for start, end in SC_MONTHS:
        state = scorecard.carry_first_purchases(t, base, reached)
        sc = scorecard.entity_scorecard(t, mp, cn, start, end, CFG.fulfilment, CFG.cuts, state=state, state_upto=reached)
        months.append(sc.withColumn("month", F.lit(start[:7])))
        reached = end
    return months[0].unionByName(months[1]).unionByName(months[2])


def q_scorecard_distinct_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard_counts.scorecard_counts(td.txn(spark, sf), td.custom_mapping(spark, sf), td.cnc_org(spark, sf),
                                             SC_START, SC_END, CFG.fulfilment, CFG.cuts)


def q_buyers_by_year_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Buyers of each year and category, and of each year, from monthly bitmaps. The months up
    to ``SC_START`` and those after it are two runs; the second only adds to the dictionary."""
    t = td.txn(spark, sf).filter("include IS NULL AND order_date IS NOT NULL")
    cell = ("order_month", "category")
    ids, months = None, []
    for run in (t.filter(F.col("order_date") < SC_START), t.filter(F.col("order_date") >= SC_START)):
        ids = bitmaps.dictionary(run, "buyer_org_id", ids)
        folded = bitmaps.fold(run, cell, "buyer_org_id", {"buyers": "true"}).drop(bitmaps.BUCKET)
        months.append(bitmaps.bitmap_cells(bitmaps.with_ids(folded, "buyer_org_id", ids), cell, "buyer_org_id", ["buyers"]))
    cells = months[0].unionByName(months[1]).withColumn("year", F.floor(F.col("order_month") / 100).cast("int"))
    levels = F.array(F.struct(F.lit("category").alias("level"), F.col("category").alias("entity")),
                     F.struct(F.lit("total").alias("level"), F.lit("All").alias("entity")))
    return bitmaps.counts(cells.select("year", F.inline(levels), bitmaps.CHUNK, "buyers"), ("year", "level", "entity"), ["buyers"])


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB): first purchase dates by ``min``, one long table of cuts, one list of
# measures; expected labels are written out here, not taken from the configuration
# ---------------------------------------------------------------------------

_FLAGS = {  # New/Repeat flag -> the column whose first purchase it looks at (None: any)
    "buyer_cat_month_newrep": "category",
    "buyer_cust_cat_phones_month_newrep": "cust_cat_phones",
    "buyer_bu_month_newrep": "business_unit",
    "buyer_business_group_month_newrep": "business_group",
    "buyer_month_newrep": None,
}


_ALL_FLAGS = {**_FLAGS, "buyer_cust_cat_hnk_month_newrep": "cust_cat_hnk"}


def newrep_sql(flags: dict = _FLAGS) -> str:
    """``buyer_months``: a buyer's cell is New in the month of their first day in the segment."""
    def flag(name: str, seg: str | None) -> str:
        who = "buyer_org_id" + (f", {seg}" if seg else "")
        return (f"CASE WHEN min(first_day) OVER (PARTITION BY {who}, order_month) = "
                f"min(first_day) OVER (PARTITION BY {who}) THEN 'New' ELSE 'Repeat' END AS {name}")

    return f"""bought AS (
  SELECT t.buyer_org_id, t.category, t.order_month, min(t.order_date) AS first_day,
         any_value(cmap.business_unit) AS business_unit, any_value(cmap.business_group) AS business_group,
         any_value(cmap.cust_cat_phones) AS cust_cat_phones, any_value(cmap.cust_cat_hnk) AS cust_cat_hnk
  FROM txn t LEFT JOIN custom_mapping cmap USING (category)
  WHERE t.include IS NULL GROUP BY 1, 2, 3
), buyer_months AS (
  SELECT * EXCLUDE (first_day), {", ".join(flag(n, s) for n, s in flags.items())} FROM bought
)"""


def _cells_sql(start: str = SC_START, end: str = SC_END) -> str:
    fc = CFG.fulfilment
    codes = [(c, "seller") for c in fc.seller] + [(c, "wh") for c in fc.warehouse]
    return f"""centre (code, kind) AS (VALUES {", ".join(str(c) for c in codes)}),
period_cells AS (
  SELECT p.buyer_org_id, p.category, f.business_unit, f.cust_cat_phones, f.cust_cat_hnk, f.business_group,
         {", ".join("f." + n for n in _FLAGS)},
         p.order_status, p.order_id, p.shipment_status, p.payment_mode, centre.kind AS fulfillment_type,
         CASE WHEN p.seller_org_id IN (SELECT org_id FROM cnc_org) THEN 'CNC' END AS cnc_tag,
         sum(p.total_line_amount) FILTER (WHERE p.first_shipped IS NOT NULL) AS shipped_gmv,
         sum(p.total_line_amount) AS gmv
  FROM (SELECT * FROM txn WHERE include IS NULL
        AND order_date >= DATE '{start}' AND order_date <= DATE '{end}') p
  LEFT JOIN centre ON centre.code = p.fulfillment_center
  LEFT JOIN (SELECT b.* FROM buyer_months b SEMI JOIN custom_mapping USING (category)) f
         ON f.buyer_org_id = p.buyer_org_id AND f.category = p.category AND f.order_month = p.order_month
  GROUP BY ALL
)"""


_CUTS = (  # cut, label prefix, label where it is NULL, New/Repeat flag
    ("category", "category-", "category-null", "buyer_cat_month_newrep"),
    ("business_unit", "BU-", "BU-Null", "buyer_bu_month_newrep"),
    ("cust_cat_phones", "Custom Category-", "Custom_category_phones-Null", "buyer_cust_cat_phones_month_newrep"),
    ("cust_cat_hnk", "Custom Category-", "Custom_category_HNK-Null", "buyer_cust_cat_phones_month_newrep"),
    ("business_group", "Business Group-", "Business Group-NULL", "buyer_business_group_month_newrep"),
)


def _past_sql(start: str = SC_START) -> str:
    rows = [f"SELECT '{c}' AS dim, '{prefix}' || {c} AS entity, buyer_org_id FROM earlier"
            + (f" WHERE {c} <> 'Ignore'" if c.startswith("cust_cat") else "") for c, prefix, _, _ in _CUTS]
    return f"""earlier AS (
  SELECT t.buyer_org_id, t.category, cmap.* EXCLUDE (category) FROM txn t LEFT JOIN custom_mapping cmap USING (category)
  WHERE t.include IS NULL AND t.order_date < DATE '{start}'
), past AS (
  SELECT dim, entity, count(DISTINCT buyer_org_id) AS past_buyers
  FROM ({" UNION ALL ".join(rows)} UNION ALL SELECT 'overall', 'Overall', buyer_org_id FROM earlier)
  GROUP BY dim, entity
)"""


_SHIPPED = "(shipment_status <> 'SHIPMENT_RTS')"
_CREDIT = "(payment_mode IN ('CREDIT', 'PAY_LATER', 'CREDIT_PAY_LATER'))"
_DELIVERED = "(shipment_status = 'SHIPMENT_DELIVERED')"
_BY = {"cnc": "(cnc_tag = 'CNC')", "seller_fulfilled": "(fulfillment_type = 'seller' AND cnc_tag IS NULL)",
       "warehouse_fulfilled": "(fulfillment_type = 'wh' AND cnc_tag IS NULL)"}
_MEASURES = {  # measure -> (what, on which rows)
    "placed_orders": ("order_id", "true"), "shipped_orders": ("order_id", _SHIPPED),
    "delivered_orders": ("order_id", _DELIVERED),
    **{f"{k}_orders": ("order_id", f"{c} AND {_SHIPPED}") for k, c in _BY.items()},
    "new_buyers": ("buyer_org_id", "flag = 'New'"), "repeat_buyers": ("buyer_org_id", "flag = 'Repeat'"),
    "credit_buyers": ("buyer_org_id", f"{_CREDIT} AND {_SHIPPED}"),
    "placed_gmv": ("gmv", "true"), "shipped_gmv": ("shipped_gmv", "true"),
    "rto_gmv": ("gmv", "starts_with(shipment_status, 'SHIPMENT_RTO')"), "credit_gmv": ("shipped_gmv", _CREDIT),
    "delivered_gmv": ("gmv", f"{_DELIVERED} AND order_status NOT IN ('SELLER_ORDER_EXPIRED', "
                             "'SELLER_ORDER_BUYER_CANCEL', 'SELLER_ORDER_SELLER_CANCEL')"),
    **{f"{k}_gmv": ("shipped_gmv", c) for k, c in _BY.items()},
}


def _scorecard_sql() -> str:
    rows = [f"SELECT '{c}' AS dim, coalesce('{prefix}' || {c}, '{missing}') AS entity, {flag} AS flag, * FROM period_cells"
            for c, prefix, missing, flag in _CUTS]
    rows.append("SELECT 'overall', 'Overall', buyer_month_newrep, * FROM period_cells")
    values = [f"count(DISTINCT {what}) FILTER (WHERE {cond}) AS {name}" if what.endswith("_id") else
              f"CAST(sum({what}) FILTER (WHERE {cond}) AS DOUBLE) AS {name}" for name, (what, cond) in _MEASURES.items()]
    return f"""scored AS (
  SELECT s.*, past.past_buyers
  FROM (SELECT dim, entity, {", ".join(values)} FROM ({" UNION ALL ".join(rows)}) GROUP BY dim, entity) s
  LEFT JOIN past USING (dim, entity)
)"""


SQL_NEWREP_FLAGS = td.with_adapter("SELECT * FROM buyer_months", newrep_sql())
SQL_NEWREP_ALL = td.with_adapter("SELECT * FROM buyer_months", newrep_sql(_ALL_FLAGS))
SQL_JOIN_COMPOSITE = td.with_adapter(
    "SELECT t.order_id, t.listing_id, t.buyer_org_id, t.category, r.buyer_cat_month_newrep, r.buyer_cust_cat_hnk_month_newrep "
    "FROM txn t LEFT JOIN buyer_months r USING (buyer_org_id, category, order_month) "
    f"WHERE t.order_date BETWEEN DATE '{SC_START}' AND DATE '{SC_END}'", newrep_sql(_ALL_FLAGS))
SQL_BUYER_CUTS_RAW = td.with_adapter(
    "SELECT * REPLACE (CAST(shipped_gmv AS DOUBLE) AS shipped_gmv, CAST(gmv AS DOUBLE) AS gmv) FROM period_cells",
    newrep_sql(), _cells_sql())
SQL_PAST_BUYERS = td.with_adapter("SELECT * FROM past", _past_sql())
_SC_CTES = (newrep_sql(), _cells_sql(), _past_sql(), _scorecard_sql())
SQL_ENTITY_SCORECARD = td.with_adapter("SELECT * FROM scored", *_SC_CTES)
SQL_SCORECARD_PERCENTAGES = td.with_adapter(
    "SELECT dim, entity, CASE WHEN placed_gmv <> 0 THEN 100.0::DOUBLE * rto_gmv / placed_gmv END AS rto_pct, "
    "CASE WHEN shipped_gmv <> 0 THEN 100.0::DOUBLE * credit_gmv / shipped_gmv END AS credit_gmv_pct FROM scored", *_SC_CTES)
SQL_SCORECARD_MONTHS = td.with_adapter(" UNION ALL ".join(
    f"SELECT *, '{start[:7]}' AS month FROM (WITH {_cells_sql(start, end)}, {_past_sql(start)}, {_scorecard_sql()} "
    "SELECT * FROM scored)" for start, end in SC_MONTHS), newrep_sql())
SQL_SCORECARD_COUNTS = td.with_adapter(
    f"SELECT dim, entity, {', '.join(n for n, (what, _) in _MEASURES.items() if what.endswith('_id'))}, past_buyers "
    "FROM scored", *_SC_CTES)
_YEARS = "SELECT CAST(year(order_date) AS INTEGER) AS year, {} AS level, {} AS entity, count(DISTINCT buyer_org_id) AS buyers FROM txn GROUP BY 1, 3"
SQL_BUYERS_BY_YEAR = td.with_adapter(
    _YEARS.format("'category'", "category") + " UNION ALL " + _YEARS.format("'total'", "'All'"))

# expected rows of the long format, in output order
_LONG = """(1, 'Placed GMV', placed_gmv), (2, 'Shipped GMV', shipped_gmv), (3, 'Delivered GMV', delivered_gmv),
  (4, 'Cash and Carry - GMV', cnc_gmv), (5, 'Marketplace fullfilled from WH - GMV', warehouse_fulfilled_gmv),
  (6, 'Marketplace fullfilled from Seller - GMV', seller_fulfilled_gmv), (7, 'New Buyers', new_buyers),
  (8, 'Repeat Buyers', repeat_buyers), (9, 'Total Buyers', new_buyers + repeat_buyers), (10, 'Placed Orders', placed_orders),
  (11, 'Shipped Orders', shipped_orders), (12, 'Delivered Orders', delivered_orders), (13, 'Cash and Carry', cnc_orders),
  (14, 'Marketplace fullfilled from WH', warehouse_fulfilled_orders),
  (15, 'Marketplace fullfilled from Seller', seller_fulfilled_orders), (16, 'RTO %', rto_gmv), (17, 'Credit GMV %', credit_gmv),
  (18, '# of Buyers on Credit', credit_buyers)"""


def _long_sql() -> str:
    return (f"SELECT r.particular, '{MONTH_LABEL}' AS month, entity AS category, '' AS rprt_category, '' AS remarks, "
            f"CAST(r.value AS DOUBLE) AS value, dim, r.row_rank FROM scored, LATERAL (VALUES {_LONG}) "
            f"r (row_rank, particular, value)")


SQL_SCORECARD_LONG = td.with_adapter(_long_sql(), *_SC_CTES)

QUERIES = {
    "newrep_flags": (q_newrep_flags, SQL_NEWREP_FLAGS),
    "buyer_cuts_raw": (q_buyer_cuts_raw, SQL_BUYER_CUTS_RAW),
    "past_buyers": (q_past_buyers, SQL_PAST_BUYERS),
    "entity_scorecard": (q_entity_scorecard, SQL_ENTITY_SCORECARD),
    "scorecard_long": (q_scorecard_long, SQL_SCORECARD_LONG),
    "scorecard_percentages": (q_scorecard_percentages, SQL_SCORECARD_PERCENTAGES),
    "scorecard_carried_state": (q_scorecard_carried_state, SQL_SCORECARD_MONTHS),
    "newrep_all_segments": (q_newrep_all_segments, SQL_NEWREP_ALL),
    "newrep_bucketed": (q_newrep_bucketed, SQL_NEWREP_ALL),
    "join_composite_bucketed": (q_join_composite_bucketed, SQL_JOIN_COMPOSITE),
    "newrep_windowed_all": (q_newrep_windowed_all, SQL_NEWREP_ALL),
    "scorecard_distinct_bitmaps": (q_scorecard_distinct_bitmaps, SQL_SCORECARD_COUNTS),
    "buyers_by_year_merged": (q_buyers_by_year_merged, SQL_BUYERS_BY_YEAR),
}
