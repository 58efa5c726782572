"""Single-operator queries: scans, projections, filters, joins, aggregates, windows and
scalar functions as the report jobs use them, each over the whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import predicates as P
from ..functions.hierarchy import tag
from ..functions.scalars import (entity_label, iso_date, local_date_from_epoch_ms, local_stamp_from_epoch_ms,
                                 safe_ratio, weekday_label)
from ..operators import categorise as cat
from ..operators import explore, newrep
from ..operators import overrides as ov
from ..sources import files, stage
from ..sources import testdata as td
from . import ladders
from .month_end import newrep_sql
from .params import AS_OF_OFFSET, CFG, N_OFFSET, PERIOD_END, PERIOD_START, REPORT_DAY, SC_END, SC_START
from .reports import overrides_sql

_Q: dict = {}


def q(name: str, sql: str | None):
    def deco(fn):
        _Q[name] = (fn, sql)
        return fn
    return deco


W = td.with_adapter
_PARAM_RANGE = f"order_date BETWEEN DATE '{SC_START}' AND DATE '{SC_END}'"

# --- scans / sources ----------------------------------------------------------------


@q("scan_txn", W("SELECT * FROM txn"))
def scan_txn(spark: SparkSession, sf: str) -> DataFrame:
    return td.txn(spark, sf)


@q("param_period_filter", W(f"SELECT order_id, buyer_org_id, category, order_date, total_line_amount FROM txn "
                            f"WHERE {_PARAM_RANGE}"))
def param_period_filter(spark: SparkSession, sf: str) -> DataFrame:
    return (td.txn(spark, sf).filter(P.month_prune(SC_START, SC_END) & F.col("order_date").between(F.to_date(F.lit(SC_START)), F.to_date(F.lit(SC_END))))
            .select("order_id", "buyer_org_id", "category", "order_date", "total_line_amount"))


_PROFILED = (  # columns of the fact, in order, with their types
    ("order_id", "bigint"), ("buyer_org_id", "bigint"), ("seller_org_id", "bigint"), ("listing_id", "bigint"),
    ("category", "string"), ("order_status", "string"), ("shipment_status", "string"), ("payment_mode", "string"),
    ("fulfillment_center", "string"), ("first_shipped", "date"), ("total_line_amount", "decimal(18,2)"),
    ("order_date", "date"), ("order_month", "int"), ("order_date_time", "bigint"), ("include", "string"))


@q("txn_profile", W(" UNION ALL ".join(
    f"SELECT {i} AS place, '{c}' AS column_name, '{t}' AS type, count(*) AS rows, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_values, min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value FROM txn"
    for i, (c, t) in enumerate(_PROFILED, 1))))
def txn_profile(spark: SparkSession, sf: str) -> DataFrame:
    return explore.profile(td.txn(spark, sf))


@q("txn_shape", W(f"SELECT count(*) AS n_rows, {len(_PROFILED)} AS n_columns FROM txn"))
def txn_shape(spark: SparkSession, sf: str) -> DataFrame:
    return explore.shape(td.txn(spark, sf))


@q("txn_head", W("SELECT * FROM txn ORDER BY total_line_amount NULLS FIRST, order_id, listing_id, seller_org_id, "
                 "first_shipped NULLS FIRST LIMIT 5"))
def txn_head(spark: SparkSession, sf: str) -> DataFrame:
    return explore.head(td.txn(spark, sf), ["total_line_amount", "order_id", "listing_id", "seller_org_id", "first_shipped"])


@q("distinct_categories", W("SELECT DISTINCT category FROM txn"))
def distinct_categories(spark: SparkSession, sf: str) -> DataFrame:
    return td.txn(spark, sf).select("category").distinct()


@q("ctas_roundtrip", W("SELECT * FROM txn WHERE " + _PARAM_RANGE))
def ctas_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf).filter(P.month_prune(SC_START, SC_END) & F.col("order_date").between(F.to_date(F.lit(SC_START)), F.to_date(F.lit(SC_END))))
    return files.materialise(t, "txn_period", partition_by=["order_month"]).select(*t.columns)


@q("stage_partition_overwrite", W(
    "SELECT order_id, listing_id, order_month, CASE WHEN " + _PARAM_RANGE + " THEN 2 * total_line_amount "
    "ELSE total_line_amount END::DECIMAL(20,2) AS total_line_amount FROM txn"))
def stage_partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf).select("order_id", "listing_id", "order_month",
                                 F.col("total_line_amount").cast("decimal(20,2)").alias("total_line_amount"))
    base = files.scratch_path(spark, "txn_by_month")
    stage.publish(t, base, ["order_month"])
    month = int(SC_START[:4]) * 100 + int(SC_START[5:7])
    again = t.filter(F.col("order_month") == month).withColumn(
        "total_line_amount", (F.col("total_line_amount") * 2).cast("decimal(20,2)"))
    return stage.publish_partitions(again, base, ["order_month"])


# --- projections / CASE ---------------------------------------------------------------


@q("project_alias", W(f"SELECT order_date_time AS order_date, order_id, order_status, seller_org_id, buyer_org_id, "
                      f"listing_id FROM rt_txn WHERE order_date_time = DATE '{REPORT_DAY}'"))
def project_alias(spark: SparkSession, sf: str) -> DataFrame:
    t = td.rt_txn(spark, sf).filter(P.on_day(REPORT_DAY))
    return t.select(F.col("order_date_time").alias("order_date"), "order_id", "order_status", "seller_org_id",
                    "buyer_org_id", "listing_id")


@q("case_hierarchy", W(f"SELECT order_id, listing_id, category, {ladders.DAILY_TYPE} AS type, "
                       f"{ladders.DAILY_TYPE2} AS type2, {ladders.PERIOD_TYPE2} AS type2_period "
                       f"FROM (SELECT *, CAST(NULL AS VARCHAR) AS include FROM txn)"))
def case_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf)
    return t.select("order_id", "listing_id", "category", tag(CFG.daily_type).alias("type"),
                    tag(CFG.daily_type2).alias("type2"), tag(CFG.period_type2).alias("type2_period"))


_LABELS = """coalesce('category-' || category, 'category-null') AS category_label,
  coalesce('BU-' || business_unit, 'BU-Null') AS business_unit_label,
  coalesce('Custom Category-' || cust_cat_phones, 'Custom_category_phones-Null') AS cust_cat_phones_label,
  coalesce('Custom Category-' || cust_cat_hnk, 'Custom_category_HNK-Null') AS cust_cat_hnk_label,
  coalesce('Business Group-' || business_group, 'Business Group-NULL') AS business_group_label"""


@q("entity_null_label", W(f"SELECT order_id, listing_id, {_LABELS} FROM txn LEFT JOIN custom_mapping USING (category)"))
def entity_null_label(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf).join(td.custom_mapping(spark, sf), "category", "left")
    return t.select("order_id", "listing_id", *[entity_label(F.col(d), p, nl).alias(f"{d}_label")
                                                 for d, p, nl in C.SCORECARD_DIMS if p is not None])


@q("tag_from_lookup", W("SELECT t.order_id, t.listing_id, t.seller_org_id, "
                        "CASE WHEN k.org_id IS NOT NULL THEN 'CNC' END AS cnc_tag "
                        "FROM txn t LEFT JOIN cnc_org k ON t.seller_org_id = k.org_id"))
def tag_from_lookup(spark: SparkSession, sf: str) -> DataFrame:
    k = td.cnc_org(spark, sf).select(F.col("org_id").alias("_org")).distinct()
    # one id an organisation: broadcast, so the fact is not exchanged to be tagged
    t = td.txn(spark, sf).join(F.broadcast(k), F.col("seller_org_id") == F.col("_org"), "left")
    return t.select("order_id", "listing_id", "seller_org_id",
                    F.when(F.col("_org").isNotNull(), F.lit("CNC")).alias("cnc_tag"))


# --- filters ----------------------------------------------------------------------------


@q("filter_eq", W(f"SELECT * FROM rt_txn WHERE order_date_time = DATE '{REPORT_DAY}'"))
def filter_eq(spark: SparkSession, sf: str) -> DataFrame:
    return td.rt_txn(spark, sf).filter(P.on_day(REPORT_DAY))


@q("filter_lower_eq", W(f"SELECT listing_id, brand, vertical, own AS rt_mis_category FROM ov_base "
                        f"WHERE brand = '{CFG.brand_rule.brand}' AND own ILIKE '{CFG.brand_rule.category}'",
                        overrides_sql("ov", False)))
def filter_lower_eq(spark: SparkSession, sf: str) -> DataFrame:
    cm = td.category_map(spark, sf).withColumnRenamed("vertical", "cm_vertical")
    j = td.listing(spark, sf).join(cm, F.col("vertical") == F.col("cm_vertical"), "left")
    j = j.filter((F.col("brand") == CFG.brand_rule.brand)
                 & (F.lower(F.col("rt_mis_category")) == CFG.brand_rule.category.lower()))
    return j.select("listing_id", "brand", F.col("cm_vertical").alias("vertical"), "rt_mis_category")


@q("filter_in_list", W("SELECT order_id, listing_id, payment_mode, total_line_amount FROM txn "
                       "WHERE payment_mode IN ('CREDIT_PAY_LATER', 'CREDIT', 'PAY_LATER')"))
def filter_in_list(spark: SparkSession, sf: str) -> DataFrame:
    return td.txn(spark, sf).filter(P.credit()).select("order_id", "listing_id", "payment_mode", "total_line_amount")


@q("filter_not_in_list", W("SELECT order_id, listing_id, order_status FROM txn "
                           "WHERE order_status NOT IN ('SELLER_ORDER_BUYER_CANCEL')"))
def filter_not_in_list(spark: SparkSession, sf: str) -> DataFrame:
    return td.txn(spark, sf).filter(P.not_buyer_cancelled()).select("order_id", "listing_id", "order_status")


@q("filter_null", W("SELECT order_id, listing_id, shipment_status FROM txn WHERE first_shipped IS NULL "
                    "AND shipment_status IS NOT NULL"))
def filter_null(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf)
    return t.filter(F.col("first_shipped").isNull() & F.col("shipment_status").isNotNull()).select(
        "order_id", "listing_id", "shipment_status")


@q("having_cap", W(f"SELECT order_id, listing_id, CAST(sum(total_line_amount) AS DOUBLE) AS gmv FROM txn "
                   f"GROUP BY 1, 2 HAVING sum(total_line_amount) < {CFG.cap}"))
def having_cap(spark: SparkSession, sf: str) -> DataFrame:
    g = td.txn(spark, sf).groupBy("order_id", "listing_id").agg(F.sum("total_line_amount").alias("gmv"))
    return g.filter(F.col("gmv") < CFG.cap).withColumn("gmv", F.col("gmv").cast("double"))


@q("day_offset_filter", W(f"SELECT order_id, listing_id, order_date_time FROM rt_txn WHERE order_date_time = "
                          f"CAST(CAST(TIMESTAMP '{AS_OF_OFFSET}' + INTERVAL 19800 SECOND AS DATE) "
                          f"- INTERVAL {N_OFFSET} DAY AS DATE)"))
def day_offset_filter(spark: SparkSession, sf: str) -> DataFrame:
    t = td.rt_txn(spark, sf)
    return t.filter(P.on_day(cat.report_day(AS_OF_OFFSET, N_OFFSET))).select(
        "order_id", "listing_id", "order_date_time")


# --- joins ------------------------------------------------------------------------------


@q("join_left_dim", W("SELECT t.order_id, t.listing_id, t.category, m.business_unit, m.business_group "
                      "FROM txn t LEFT JOIN custom_mapping m ON t.category = m.category"))
def join_left_dim(spark: SparkSession, sf: str) -> DataFrame:
    m = td.custom_mapping(spark, sf).select("category", "business_unit", "business_group")
    return td.txn(spark, sf).join(m, "category", "left").select(
        "order_id", "listing_id", "category", "business_unit", "business_group")


@q("join_left_composite", W(
    f"SELECT t.order_id, t.listing_id, t.buyer_org_id, t.category, r.buyer_cat_month_newrep FROM txn t "
    f"LEFT JOIN buyer_months r ON r.buyer_org_id = t.buyer_org_id AND r.category = t.category "
    f"AND r.order_month = t.order_month WHERE t.{_PARAM_RANGE}", newrep_sql()))
def join_left_composite(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf).filter(P.month_prune(SC_START, SC_END) & F.col("order_date").between(F.to_date(F.lit(SC_START)), F.to_date(F.lit(SC_END))))
    flags = newrep.newrep_flags(td.txn(spark, sf), td.custom_mapping(spark, sf)).select(
        "buyer_org_id", "category", "order_month", "buyer_cat_month_newrep")
    return t.join(flags, ["buyer_org_id", "category", "order_month"], "left").select(
        "order_id", "listing_id", "buyer_org_id", "category", "buyer_cat_month_newrep")


@q("join_null_rejecting", W("SELECT t.order_id, t.listing_id, m.cust_cat_phones FROM txn t "
                            "LEFT JOIN custom_mapping m ON t.category = m.category "
                            "WHERE m.cust_cat_phones NOT IN ('Ignore')"))
def join_null_rejecting(spark: SparkSession, sf: str) -> DataFrame:
    # A left join whose right side is then filtered null-rejectingly is an inner join.
    m = td.custom_mapping(spark, sf).filter(F.col("cust_cat_phones") != C.IGNORE_VALUE).select(
        "category", "cust_cat_phones")
    return td.txn(spark, sf).join(m, "category", "inner").select("order_id", "listing_id", "cust_cat_phones")


@q("semi_allow_list", W("SELECT * FROM listing WHERE vertical IN ("
                        + ", ".join(f"'{v}'" for v in CFG.allow_rule.verticals) + ")"))
def semi_allow_list(spark: SparkSession, sf: str) -> DataFrame:
    # the allow list is configuration (bounded by construction): broadcast semi join
    allow = spark.createDataFrame([(v,) for v in CFG.allow_rule.verticals], "vertical string")
    return td.listing(spark, sf).join(F.broadcast(allow), "vertical", "left_semi")


@q("join_fanout_overrides", W(
    "SELECT order_id, listing_id, o.rt_mis_category, o.include, total_line_amount "
    f"FROM (SELECT * EXCLUDE (include) FROM rt_txn WHERE order_date_time = DATE '{REPORT_DAY}') "
    "LEFT JOIN ov_daily o USING (listing_id)", overrides_sql("ov_daily", False)))
def join_fanout_overrides(spark: SparkSession, sf: str) -> DataFrame:
    t = td.rt_txn(spark, sf).filter(P.on_day(REPORT_DAY)).drop("include")
    o = ov.sku_overrides(td.listing(spark, sf), td.category_map(spark, sf), CFG.brand_rule)
    # one line meets every label row of its listing (1-3 rows): the fan-out is the point
    o = o.select("listing_id", "rt_mis_category", "include")
    return t.join(o, "listing_id", "left").select(
        "order_id", "listing_id", "rt_mis_category", "include", "total_line_amount")


# --- aggregates -------------------------------------------------------------------------


@q("agg_sum", W("SELECT category, CAST(sum(total_line_amount) AS DOUBLE) AS gmv FROM txn GROUP BY 1"))
def agg_sum(spark: SparkSession, sf: str) -> DataFrame:
    return td.txn(spark, sf).groupBy("category").agg(F.sum("total_line_amount").cast("double").alias("gmv"))


@q("agg_count_distinct", W("SELECT category, count(DISTINCT order_id) AS orders, count(DISTINCT buyer_org_id) "
                           "AS buyers FROM txn GROUP BY 1"))
def agg_count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return td.txn(spark, sf).groupBy("category").agg(F.count_distinct("order_id").alias("orders"),
                                                      F.count_distinct("buyer_org_id").alias("buyers"))


_SHIP_SQL = "shipment_status IS NOT NULL AND shipment_status <> 'SHIPMENT_RTS'"


@q("agg_cond_sum", W(f"SELECT category, CAST(sum(CASE WHEN {_SHIP_SQL} THEN total_line_amount END) AS DOUBLE) "
                     f"AS shipped_gmv FROM txn GROUP BY 1"))
def agg_cond_sum(spark: SparkSession, sf: str) -> DataFrame:
    return td.txn(spark, sf).groupBy("category").agg(
        F.sum(F.when(P.shipped(), F.col("total_line_amount"))).cast("double").alias("shipped_gmv"))


@q("agg_cond_count_distinct", W(f"SELECT category, count(DISTINCT CASE WHEN {_SHIP_SQL} THEN order_id END) AS "
                                f"shipped_orders, count(DISTINCT CASE WHEN shipment_status = 'SHIPMENT_DELIVERED' "
                                f"THEN order_id END) AS delivered_orders FROM txn GROUP BY 1"))
def agg_cond_count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return td.txn(spark, sf).groupBy("category").agg(
        F.count_distinct(F.when(P.shipped(), F.col("order_id"))).alias("shipped_orders"),
        F.count_distinct(F.when(P.delivered(), F.col("order_id"))).alias("delivered_orders"))


@q("agg_ratio_aov", W("SELECT category, CASE WHEN count(DISTINCT order_id) = 0 THEN NULL ELSE "
                      "CAST(sum(total_line_amount) AS DOUBLE) / count(DISTINCT order_id) END AS aov, "
                      "CAST(sum(total_line_amount) AS DOUBLE) / count(DISTINCT buyer_org_id) AS abs_value "
                      "FROM txn GROUP BY 1"))
def agg_ratio_aov(spark: SparkSession, sf: str) -> DataFrame:
    g = td.txn(spark, sf).groupBy("category").agg(F.sum("total_line_amount").alias("gmv"),
                                                   F.count_distinct("order_id").alias("o"),
                                                   F.count_distinct("buyer_org_id").alias("b"))
    return g.select("category", safe_ratio(F.col("gmv"), F.col("o")).alias("aov"),
                    safe_ratio(F.col("gmv"), F.col("b")).alias("abs_value"))


@q("agg_grand_total", W(f"SELECT 'Grand Total' AS entity, count(DISTINCT order_id) AS orders, "
                        f"count(DISTINCT buyer_org_id) AS buyers, CAST(sum(total_line_amount) AS DOUBLE) AS gmv "
                        f"FROM txn WHERE {_PARAM_RANGE}"))
def agg_grand_total(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf).filter(P.month_prune(SC_START, SC_END) & F.col("order_date").between(F.to_date(F.lit(SC_START)), F.to_date(F.lit(SC_END))))
    return t.agg(F.lit("Grand Total").alias("entity"), F.count_distinct("order_id").alias("orders"),
                 F.count_distinct("buyer_org_id").alias("buyers"),
                 F.sum("total_line_amount").cast("double").alias("gmv"))


@q("agg_overall_const", W(f"SELECT 'Overall' AS entity, count(DISTINCT buyer_org_id) AS past_buyers FROM txn "
                          f"WHERE order_date < DATE '{SC_START}' AND include IS NULL GROUP BY 1"))
def agg_overall_const(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf).filter(P.month_prune(None, SC_START) & (F.col("order_date") < F.to_date(F.lit(SC_START)))
                                 & F.col("include").isNull())
    # GROUP BY a constant: no row at all on empty input (unlike a global aggregate)
    return t.groupBy(F.lit("Overall").alias("entity")).agg(F.count_distinct("buyer_org_id").alias("past_buyers"))


@q("agg_by_expr", W("SELECT 'category-' || category AS entity, count(DISTINCT buyer_org_id) AS buyers "
                    f"FROM txn WHERE order_date < DATE '{SC_START}' GROUP BY 1"))
def agg_by_expr(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf).filter(P.month_prune(None, SC_START) & (F.col("order_date") < F.to_date(F.lit(SC_START))))
    return t.groupBy(F.concat(F.lit("category-"), F.col("category")).alias("entity")).agg(
        F.count_distinct("buyer_org_id").alias("buyers"))


@q("select_distinct", W("SELECT DISTINCT buyer_org_id, category, order_month FROM txn WHERE include IS NULL"))
def select_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return td.txn(spark, sf).filter(F.col("include").isNull()).select(
        "buyer_org_id", "category", "order_month").distinct()


# --- windows ----------------------------------------------------------------------------

_GAPS_SQL = W("""SELECT buyer_org_id, category, order_date, order_month,
  lag(order_date, 1) OVER (PARTITION BY buyer_org_id, category ORDER BY order_date) AS prev_order_date,
  CAST(date_diff('day', lag(order_date, 1) OVER (PARTITION BY buyer_org_id, category ORDER BY order_date),
                 order_date) AS INTEGER) AS gap_days,
  CAST(rank() OVER (PARTITION BY buyer_org_id, order_month ORDER BY order_date) AS INTEGER) AS month_rank
FROM (SELECT DISTINCT buyer_org_id, category, order_date, order_month FROM txn WHERE include IS NULL)""")


def _gaps(spark, sf):
    return newrep.buyer_gaps(td.txn(spark, sf))


@q("win_lag", None)
def win_lag(spark: SparkSession, sf: str) -> DataFrame:
    return _gaps(spark, sf).select("buyer_org_id", "category", "order_date", "prev_order_date")


@q("win_gap_days", None)
def win_gap_days(spark: SparkSession, sf: str) -> DataFrame:
    return _gaps(spark, sf).select("buyer_org_id", "category", "order_date", "gap_days")


@q("win_rank", None)
def win_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _gaps(spark, sf).select("buyer_org_id", "category", "order_date", "order_month", "month_rank")


_Q["win_lag"] = (win_lag, f"SELECT buyer_org_id, category, order_date, prev_order_date FROM ({_GAPS_SQL})")
_Q["win_gap_days"] = (win_gap_days, f"SELECT buyer_org_id, category, order_date, gap_days FROM ({_GAPS_SQL})")
_Q["win_rank"] = (win_rank, f"SELECT buyer_org_id, category, order_date, order_month, month_rank FROM ({_GAPS_SQL})")


@q("newrep_windowed", W("SELECT * FROM buyer_months", newrep_sql()))
def newrep_windowed(spark: SparkSession, sf: str) -> DataFrame:
    return newrep.newrep_flags_windowed(td.txn(spark, sf), td.custom_mapping(spark, sf))


# --- scalar functions -------------------------------------------------------------------


@q("epoch_ms_to_ist", W(f"""SELECT order_id, listing_id, order_date_time,
  strftime(make_timestamp(CAST((order_date_time + 19800000) / 1000 AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')
    AS local_stamp,
  CAST(make_timestamp((order_date_time + 19800000) * 1000) AS DATE) AS local_date
FROM txn WHERE order_date BETWEEN DATE '{PERIOD_START}' AND DATE '{PERIOD_END}'"""))
def epoch_ms_to_ist(spark: SparkSession, sf: str) -> DataFrame:
    t = cat.local_day_filter(td.txn(spark, sf), PERIOD_START, PERIOD_END)
    return t.select("order_id", "listing_id", "order_date_time",
                    local_stamp_from_epoch_ms(F.col("order_date_time")).alias("local_stamp"),
                    local_date_from_epoch_ms(F.col("order_date_time")).alias("local_date"))


@q("weekday_label", W("SELECT DISTINCT order_date, strftime(order_date, '%a') AS dow, "
                      "strftime(order_date, '%Y-%m-%d') AS iso_date FROM txn"))
def weekday_label_q(spark: SparkSession, sf: str) -> DataFrame:
    d = td.txn(spark, sf).select("order_date").distinct()
    return d.select("order_date", weekday_label(F.col("order_date")).alias("dow"),
                    iso_date(F.col("order_date")).alias("iso_date"))


QUERIES = dict(_Q)
