"""Latest-day snapshot queries (the notebook job) and its building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hierarchy import tag
from ..functions.scalars import fill_blank, format_indian
from ..operators import categorise as cat
from ..operators import overrides as ov
from ..operators import snapshot as sn
from ..sources import exports, files
from ..sources import testdata as td
from . import ladders
from .params import CFG

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def _raw(spark, sf) -> DataFrame:
    return td.snapshot_csv_frame(spark, sf)


def q_hourly_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return sn.hourly_snapshot(td.snapshot_csv_frame(spark, sf, month=True), CFG, "order_month")


def q_anti_high_orders(spark: SparkSession, sf: str) -> DataFrame:
    return cat.drop_high_orders(_raw(spark, sf), CFG.snapshot_cap)


def q_latest_day_filter(spark: SparkSession, sf: str) -> DataFrame:
    return sn.latest_day(td.snapshot_csv_frame(spark, sf, month=True), month_col="order_month").drop("order_month")


def q_relabel_subset(spark: SparkSession, sf: str) -> DataFrame:
    x = cat.drop_high_orders(_raw(spark, sf), CFG.snapshot_cap)
    return ov.relabelled_copies(x, CFG.snapshot_brand_rule, CFG.snapshot_allow_rule).filter(F.col("include") == 0)


def q_union_adjustments(spark: SparkSession, sf: str) -> DataFrame:
    x = cat.drop_high_orders(_raw(spark, sf).withColumn("category", fill_blank("category")), CFG.snapshot_cap)
    return ov.relabelled_copies(x, CFG.snapshot_brand_rule, CFG.snapshot_allow_rule)


def q_literal_tag(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select("order_id", "category", F.lit("overall").alias("overall"),
                                  F.lit(1).alias("include"))


def q_bg_map_native(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select("order_id", "category", tag(CFG.snapshot_bg, "category").alias("bg"))


def q_bu_map_native(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select("order_id", "category", tag(CFG.snapshot_bu, "category").alias("bu"))


def q_format_indian(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf)
    g = t.groupBy("category").agg(F.sum("total_line_amount").alias("gmv"), F.count_distinct("order_id").alias("n"))
    return g.select("category", format_indian(F.col("gmv")).alias("gmv_text"),
                    format_indian(F.try_divide(F.col("gmv"), F.col("n"))).alias("aov_text"))


def q_fill_blank(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf).select("order_id", "listing_id", "category")
    m = td.custom_mapping(spark, sf).select("category", "business_unit")
    return t.join(m, "category", "left").select(
        "order_id", "listing_id", "category", fill_blank("business_unit").alias("business_unit"))


def q_scan_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = files.scratch_path(spark, "snapshot_csv")
    files.write_csv(_raw(spark, sf), path)
    return files.read_csv(spark, path, files.SNAPSHOT_CSV_SCHEMA)


def _mixed_exports(spark: SparkSession, sf: str) -> exports.Export:
    """The export as two systems would write it: even orders in the usual column order with a
    column more, odd ones in another order and unquoted. Some amounts are no numbers, some have
    an unquoted thousands separator."""
    t = _raw(spark, sf)
    names = t.columns
    amount, odd = F.col("total_line_amount").cast("string"), F.col("order_id") % 2 == 1
    first = t.filter(~odd).withColumn("total_line_amount", F.when(F.col("order_id") % 7 == 0, F.lit("n/a")).otherwise(amount))
    second = t.filter(odd).withColumn(
        "total_line_amount", F.when(F.col("order_id") % 21 == 0, F.concat(F.lit("1,"), amount)).otherwise(amount))
    path = files.scratch_path(spark, "exports")
    first.select(*names[:3], F.lit("x, y").alias("note"), *names[3:]).write.option("header", True).csv(f"{path}/a")
    second.select(*reversed(names)).write.option("header", True).option("quote", "").csv(f"{path}/b")
    return exports.read_export(spark, path, files.SNAPSHOT_CSV_SCHEMA)


def q_csv_by_header(spark: SparkSession, sf: str) -> DataFrame:
    return _mixed_exports(spark, sf).rows


def q_csv_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _mixed_exports(spark, sf).bad.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------


def sql_indian(n: str) -> str:
    """Indian grouping of a non-negative integer expression (DuckDB's RE2 has no
    look-ahead, so the head is grouped in pairs from the right via reverse)."""
    s = f"CAST({n} AS VARCHAR)"
    head = f"left({s}, length({s}) - 3)"
    grouped = f"ltrim(reverse(regexp_replace(reverse({head}), '(\\d\\d)', '\\1,', 'g')), ',')"
    return f"CASE WHEN {n} IS NULL THEN NULL WHEN length({s}) <= 3 THEN {s} ELSE {grouped} || ',' || right({s}, 3) END"


def _cents_div(gmv_dec: str, den: str) -> str:
    # exact half-up cents of gmv / den, then whole units (non-negative values)
    return f"((CAST(round({gmv_dec} * 100) AS BIGINT) * 2 + {den}) // (2 * {den})) // 100"


_BR, _AR = CFG.snapshot_brand_rule, CFG.snapshot_allow_rule
_SNAP_CTES = (
    "snap_raw AS (SELECT * REPLACE (coalesce(category, 'Blank') AS category) FROM snapshot_csv)",
    f"""snap_high AS (SELECT order_id FROM snap_raw WHERE order_id IS NOT NULL GROUP BY order_id
                 HAVING sum(total_line_amount) > {CFG.snapshot_cap})""",
    "snap_kept AS (SELECT * FROM snap_raw r WHERE NOT EXISTS (SELECT 1 FROM snap_high h WHERE h.order_id = r.order_id))",
    f"""snap_all AS (
  SELECT *, 1 AS include FROM snap_kept
  UNION ALL SELECT * REPLACE ('{_BR.target}' AS rt_mis_category), 0 AS include FROM snap_kept
    WHERE brand = '{_BR.brand}' AND rt_mis_category = '{_BR.category}'
  UNION ALL SELECT * REPLACE ('{_AR.target}' AS rt_mis_category), 0 AS include FROM snap_kept
    WHERE seller_org_id IN ({', '.join(map(str, _AR.orgs))}) AND vertical IN ({', '.join(f"'{v}'" for v in _AR.verticals)})
      AND (rt_mis_category IS NULL OR rt_mis_category NOT IN ('{_AR.target}'))
)""",
    f"""snap_day AS (
  SELECT *, {ladders.SNAPSHOT_BU} AS bu, {ladders.SNAPSHOT_BG} AS bg, 'overall' AS overall
  FROM snap_all WHERE order_date = (SELECT max(order_date) FROM snap_all)
)""",
    "snap_blocks AS (" + " UNION ALL ".join(
        f"SELECT '{lv}' AS level, {lv} AS entity, count(DISTINCT buyer_org_id) AS buyers, "
        f"count(DISTINCT order_id) AS orders, coalesce(sum(total_line_amount), 0) AS gmv FROM snap_day "
        f"{'' if lv == 'category' else 'WHERE include = 1 '}GROUP BY 2" for lv in sn.LEVEL_ORDER) + ")",
)

SQL = {
    "hourly_snapshot": td.with_adapter(
        f"SELECT level, entity, {sql_indian('buyers')} AS buyers, {sql_indian('orders')} AS orders, "
        f"{sql_indian('CAST(trunc(gmv) AS BIGINT)')} AS gmv, {sql_indian(_cents_div('gmv', 'orders'))} AS \"AOV\", "
        f"{sql_indian(_cents_div('gmv', 'buyers'))} AS \"ABS\", "
        "CASE level WHEN 'overall' THEN 1 WHEN 'bu' THEN 2 WHEN 'bg' THEN 3 ELSE 4 END AS level_rank FROM snap_blocks", *_SNAP_CTES),
    "anti_high_orders": td.with_adapter(
        "SELECT r.* FROM snapshot_csv r WHERE NOT EXISTS (SELECT 1 FROM (SELECT order_id FROM snapshot_csv "
        f"GROUP BY order_id HAVING sum(total_line_amount) > {CFG.snapshot_cap}) h WHERE h.order_id = r.order_id)"),
    "latest_day_filter": td.with_adapter(
        "SELECT * FROM snapshot_csv WHERE order_date = (SELECT max(order_date) FROM snapshot_csv)"),
    "relabel_subset": td.with_adapter(
        "SELECT * EXCLUDE (include), include FROM snap_all WHERE include = 0",
        "snap_raw AS (SELECT * FROM snapshot_csv)", *_SNAP_CTES[1:4]),
    "union_adjustments": td.with_adapter("SELECT * FROM snap_all", *_SNAP_CTES[:4]),
    "literal_tag": td.with_adapter("SELECT order_id, category, 'overall' AS overall, 1 AS include FROM snapshot_csv"),
    "bg_map_native": td.with_adapter(
        f"SELECT order_id, category, {ladders.SNAPSHOT_BG} AS bg FROM snapshot_csv"),
    "bu_map_native": td.with_adapter(
        f"SELECT order_id, category, {ladders.SNAPSHOT_BU} AS bu FROM snapshot_csv"),
    "format_indian": td.with_adapter(
        f"SELECT category, {sql_indian('CAST(trunc(gmv) AS BIGINT)')} AS gmv_text, "
        f"{sql_indian(_cents_div('gmv', 'n'))} AS aov_text "
        "FROM (SELECT category, sum(total_line_amount) AS gmv, count(DISTINCT order_id) AS n FROM txn GROUP BY 1)"),
    "fill_blank": td.with_adapter(
        "SELECT t.order_id, t.listing_id, t.category, coalesce(m.business_unit, 'Blank') AS business_unit "
        "FROM txn t LEFT JOIN custom_mapping m ON t.category = m.category"),
    "scan_csv_roundtrip": td.with_adapter("SELECT * FROM snapshot_csv"),
    "csv_by_header": td.with_adapter(
        "SELECT * FROM snapshot_csv WHERE CASE WHEN order_id % 2 = 0 THEN order_id % 7 <> 0 ELSE order_id % 21 <> 0 END"),
    "csv_bad_lines": td.with_adapter(
        "SELECT CASE WHEN order_id % 2 = 0 THEN 'not of its type: total_line_amount' ELSE 'number of cells' END AS reason, "
        "count(*) AS lines FROM snapshot_csv WHERE order_id % 14 = 0 OR order_id % 42 = 21 GROUP BY 1"),
}

QUERIES = {
    "hourly_snapshot": (q_hourly_snapshot, SQL["hourly_snapshot"]),
    "anti_high_orders": (q_anti_high_orders, SQL["anti_high_orders"]),
    "latest_day_filter": (q_latest_day_filter, SQL["latest_day_filter"]),
    "relabel_subset": (q_relabel_subset, SQL["relabel_subset"]),
    "union_adjustments": (q_union_adjustments, SQL["union_adjustments"]),
    "literal_tag": (q_literal_tag, SQL["literal_tag"]),
    "bg_map_native": (q_bg_map_native, SQL["bg_map_native"]),
    "bu_map_native": (q_bu_map_native, SQL["bu_map_native"]),
    "format_indian": (q_format_indian, SQL["format_indian"]),
    "fill_blank": (q_fill_blank, SQL["fill_blank"]),
    "scan_csv_roundtrip": (q_scan_csv_roundtrip, SQL["scan_csv_roundtrip"]),
    "csv_by_header": (q_csv_by_header, SQL["csv_by_header"]),
    "csv_bad_lines": (q_csv_bad_lines, SQL["csv_bad_lines"]),
}
