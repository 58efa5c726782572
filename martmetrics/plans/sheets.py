"""Workbook queries: the period's daily metrics per category laid out as report sheets
(one sheet per category plus a skipped 'Summary' sheet), written as per-sheet CSVs,
read back and normalised."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.predicates import month_prune
from ..functions.scalars import iso_date, weekday_label
from ..operators import sheets as sh
from ..sources import files
from ..sources import testdata as td
from .params import PERIOD_END, PERIOD_START

N_DATES = (date.fromisoformat(PERIOD_END) - date.fromisoformat(PERIOD_START)).days + 1


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    t = td.txn(spark, sf).filter(month_prune(PERIOD_START, PERIOD_END) & F.col("order_date").between(
        F.to_date(F.lit(PERIOD_START)), F.to_date(F.lit(PERIOD_END))))
    by_cat = t.groupBy(F.col("category").alias("sheet"), "order_date")
    summary = t.groupBy(F.lit("Summary").alias("sheet"), "order_date")
    aggs = [F.count_distinct("order_id").alias("orders"), F.count_distinct("buyer_org_id").alias("buyers"),
            F.sum("total_line_amount").alias("gmv")]
    m = by_cat.agg(*aggs).unionByName(summary.agg(*aggs))
    d = F.col("order_date")
    rows = F.array(
        F.struct(F.lit(0).alias("row_no"), F.lit(sh.DATE_LABEL).alias("label"), iso_date(d).alias("value")),
        F.struct(F.lit(1).alias("row_no"), F.lit("Target").alias("label"), F.lit("0").alias("value")),
        F.struct(F.lit(2).alias("row_no"), F.lit(None).cast("string").alias("label"), weekday_label(d).alias("value")),
        F.struct(F.lit(3).alias("row_no"), F.lit("Orders").alias("label"), F.col("orders").cast("string").alias("value")),
        F.struct(F.lit(4).alias("row_no"), F.lit("Buyers").alias("label"), F.col("buyers").cast("string").alias("value")),
        F.struct(F.lit(5).alias("row_no"), F.lit("GMV").alias("label"), F.col("gmv").cast("string").alias("value")),
    )
    return m.select("sheet", (F.date_diff(d, F.lit(PERIOD_START).cast("date")) + 1).alias("pos"), F.explode(rows).alias("c")).select(
        "sheet", "pos", "c.row_no", "c.label", "c.value")


def _workbook(spark: SparkSession, sf: str) -> DataFrame:
    path = files.scratch_path(spark, "workbook")
    files.write_csv(sh.to_sheets(_cells(spark, sf), N_DATES), path, partition_by=["sheet"])
    return sh.read_sheets(spark, path)


def q_sheets_union(spark: SparkSession, sf: str) -> DataFrame:
    return sh.kept_sheets(_workbook(spark, sf))


def q_transpose_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return sh.normalise_sheets(_workbook(spark, sf))


#: Days laid out on the sheets of the raw workbook, by the category's place in the alphabet.
RAW_DAYS = (3, 40, 400)


def _raw_workbook(spark: SparkSession, sf: str) -> str:
    """A folder of sheets as a workbook program exports them: a header line, five columns that
    the report does not use, and a date column for each day with orders; sheets of up to 3, 40
    and 400 days stand side by side. Returns the folder."""
    place = F.dense_rank().over(Window.orderBy("category")) - 1   # a few categories
    days = F.array(*[F.lit(d) for d in RAW_DAYS])
    t = td.txn(spark, sf)
    named = t.select("category").distinct().select("category", days[place % len(RAW_DAYS)].alias("days"))
    last = str(date.fromisoformat(PERIOD_START) + timedelta(days=max(RAW_DAYS) - 1))
    t = (t.filter(month_prune(PERIOD_START, last) & F.col("order_date").between(F.to_date(F.lit(PERIOD_START)), F.to_date(F.lit(last))))
         .join(named, "category").filter(F.date_diff("order_date", F.lit(PERIOD_START).cast("date")) < F.col("days")))
    d = F.col("order_date")
    m = t.groupBy("category", d).agg(F.count_distinct("order_id").alias("orders"), F.sum("total_line_amount").alias("gmv"))
    first = ('"no, use"', sh.DATE_LABEL, "a", "b", "c", "d")
    lines = F.array(  # the header, then the data rows: label and the cells of a day
        F.struct(F.lit(0).alias("k"), F.lit(",".join(first)).alias("start"), F.concat(F.lit('"Day, '), d.cast("string"), F.lit('"')).alias("cell")),
        F.struct(F.lit(1).alias("k"), F.lit('0,Parameter,,,,').alias("start"), iso_date(d).alias("cell")),
        F.struct(F.lit(2).alias("k"), F.lit('1,Target,,"x,y",,').alias("start"), F.lit("0").alias("cell")),
        F.struct(F.lit(3).alias("k"), F.lit("2,,,,,").alias("start"), weekday_label(d).alias("cell")),
        F.struct(F.lit(4).alias("k"), F.lit('3,"Orders, placed",,,,').alias("start"), F.col("orders").cast("string").alias("cell")),
        F.struct(F.lit(5).alias("k"), F.lit("4,GMV,,,,").alias("start"), F.concat(F.lit('"'), F.col("gmv").cast("string"), F.lit('"')).alias("cell")))
    each = m.select(F.col("category").alias("sheet"), d.alias("day"), F.inline(lines))
    cells = F.transform(F.array_sort(F.collect_list(F.struct("day", "cell"))), lambda c: c["cell"])   # a line of one sheet
    rows = each.groupBy("sheet", "k", "start").agg(F.concat_ws(",", F.col("start"), cells).alias("line"))
    text = F.concat_ws("\r\n", F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda c: c["line"]))
    path = files.scratch_path(spark, "raw_workbook")
    rows.groupBy("sheet").agg(text.alias("value")).write.partitionBy("sheet").text(path)
    return path


def q_transpose_raw_workbook(spark: SparkSession, sf: str) -> DataFrame:
    return sh.normalise_cells(sh.raw_cells(spark, _raw_workbook(spark, sf)), labels=["Orders, placed", "GMV"])


_PERIOD = f"order_date BETWEEN DATE '{PERIOD_START}' AND DATE '{PERIOD_END}'"
_METRICS = ("SELECT category AS sheet, order_date, count(DISTINCT order_id) AS orders, "
            "count(DISTINCT buyer_org_id) AS buyers, sum(total_line_amount) AS gmv "
            f"FROM txn WHERE {_PERIOD} GROUP BY 1, 2")

SQL_TRANSPOSE = td.with_adapter(
    "SELECT sheet, strftime(order_date, '%Y-%m-%d') AS order_date, strftime(order_date, '%a') AS dow, "
    "CAST(orders AS VARCHAR) AS \"Orders\", CAST(buyers AS VARCHAR) AS \"Buyers\", "
    f"CAST(gmv AS VARCHAR) AS \"GMV\" FROM ({_METRICS})")

_CELLS = (f"cells AS (SELECT sheet, date_diff('day', DATE '{PERIOD_START}', order_date) + 1 AS pos, r.row_no, r.label, r.value FROM ({_METRICS}) m, "
          "LATERAL (VALUES (0, 'Parameter', strftime(m.order_date, '%Y-%m-%d')), (1, 'Target', '0'), "
          "(2, NULL, strftime(m.order_date, '%a')), (3, 'Orders', CAST(m.orders AS VARCHAR)), "
          "(4, 'Buyers', CAST(m.buyers AS VARCHAR)), (5, 'GMV', CAST(m.gmv AS VARCHAR))) r(row_no, label, value))")
SQL_SHEETS_UNION = td.with_adapter(
    "SELECT sheet, row_no, label, "
    + ", ".join(f"max(CASE WHEN pos = {i} THEN value END) AS v{i}" for i in range(1, N_DATES + 1))
    + " FROM cells GROUP BY 1, 2, 3", _CELLS)

SQL_TRANSPOSE_RAW = td.with_adapter(
    "SELECT category AS sheet, strftime(order_date, '%Y-%m-%d') AS order_date, strftime(order_date, '%a') AS dow, "
    "CAST(count(DISTINCT order_id) AS VARCHAR) AS \"Orders, placed\", CAST(sum(total_line_amount) AS VARCHAR) AS \"GMV\" "
    f"FROM txn JOIN width USING (category) WHERE order_date >= DATE '{PERIOD_START}' "
    f"AND date_diff('day', DATE '{PERIOD_START}', order_date) < days GROUP BY category, order_date",
    f"width AS (SELECT category, list_value{RAW_DAYS}[(row_number() OVER (ORDER BY category) - 1) % {len(RAW_DAYS)} + 1] AS days "
    "FROM (SELECT DISTINCT category FROM txn))")

QUERIES = {
    "sheets_union": (q_sheets_union, SQL_SHEETS_UNION),
    "transpose_sheet": (q_transpose_sheet, SQL_TRANSPOSE),
    "transpose_raw_workbook": (q_transpose_raw_workbook, SQL_TRANSPOSE_RAW),
}
