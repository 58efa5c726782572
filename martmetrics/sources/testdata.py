"""Adapter from the driver's TPC-H-like parquet tables to the canonical retail tables.

The report operators take canonical frames (see ``martmetrics.schemas``); this module
derives them from ``lineitem / orders / part / supplier`` so that every query's work
grows with those tables. The same mapping is expressed as DuckDB SQL in
``ADAPTER_SQL`` for the oracle side, and the two must stay in step.

Mapping (canonical <- test data):
  order_id, buyer_org_id, seller_org_id, listing_id <- o_orderkey, o_custkey, l_suppkey, l_partkey
  brand, vertical, category                          <- p_brand, p_name, 2nd word of p_name
  listing.org_id                                     <- p_size
  order_status    <- o_orderstatus F/O/P -> COMPLETED / BUYER_CANCEL / EXPIRED
  shipment_status <- (l_linestatus, l_returnflag)
  first_shipped   <- l_shipdate when l_linestatus = 'F'
  payment_mode    <- first character of o_orderpriority
  fulfillment_center <- l_suppkey % 3 (seller code / warehouse code / NULL)
  cnc_org         <- suppliers of nations 3 and 7
  custom_mapping  <- rule over the category names (one category left unmapped)
"""

from __future__ import annotations

import hashlib
import inspect
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import TESTDATA
from ..session import checkpoint_dir
from . import bucketed, files

FC_SELLER, FC_WAREHOUSE = TESTDATA.fulfilment.seller[0], TESTDATA.fulfilment.warehouse[0]

# Custom-mapping rule for the eight test categories (category -> attributes).
MAPPING_RULES = (
    # category, business_unit, cust_cat_phones, cust_cat_hnk, business_group
    ("anvil", "Staples", "Ignore", "Ignore", "Food"),
    ("bolt", "Staples", "Ignore", "Ignore", "Food"),
    ("gear", "Electronics", "Phones", "Ignore", "Mario"),
    ("gizmo", "Electronics", "Ignore", "Ignore", "Mario"),
    ("plate", "GM", "Ignore", "HNK", "Mario"),
    ("ring", "GM", "Ignore", "Ignore", "Mario"),
    ("rod", "GM", "Ignore", "Ignore", "Mario"),
)
CNC_NATIONS = (3, 7)


# Frames over immutable inputs (the read-only test tables and the published canonical
# table), reused within a session so each query does not list and open them again.
_FRAMES: dict = {}


def _memo(spark: SparkSession, key: str, build) -> DataFrame:
    # application id + the JVM session's identity: stable for a live session, never reused
    k = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode(), key)
    if k not in _FRAMES:
        _FRAMES[k] = build()
    return _FRAMES[k]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return _memo(spark, path, lambda: spark.read.parquet(path))


def _category(p_name: Column) -> Column:
    return F.split_part(p_name, F.lit(" "), F.lit(2))


def _order_status(o_orderstatus: Column) -> Column:
    return (F.when(o_orderstatus == "F", "SELLER_ORDER_COMPLETED")
            .when(o_orderstatus == "O", "SELLER_ORDER_BUYER_CANCEL")
            .when(o_orderstatus == "P", "SELLER_ORDER_EXPIRED"))


def _shipment_status(ls: Column, rf: Column) -> Column:
    return (F.when((ls == "O") & (rf == "A"), "SHIPMENT_RTS")
            .when((ls == "O") & (rf == "R"), "SHIPMENT_RTO")
            .when((ls == "F") & (rf == "R"), "SHIPMENT_RTO_DELIVERED")
            .when(ls == "F", "SHIPMENT_DELIVERED"))


def _payment_mode(prio: Column) -> Column:
    first = F.substring(prio, 1, 1)
    return (F.when(first == "1", "CREDIT").when(first == "2", "PAY_LATER")
            .when(first == "3", "CREDIT_PAY_LATER").otherwise("CASH"))


def _fulfillment(suppkey: Column) -> Column:
    m = suppkey % 3
    return F.when(m == 0, FC_SELLER).when(m == 1, FC_WAREHOUSE)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with their order and category, columns as they are read: what the joins and the
    writer's exchange move. The part join comes first, on lines without their order's columns."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus",
        "l_shipdate")
    o = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("_date"), "o_orderpriority")
    p = _read(spark, sf_dir, "part").select("p_partkey", _category(F.col("p_name")).alias("_category"))
    j = (li.join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
         .join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner"))
    return (j.withColumn("_month", F.year("_date") * 100 + F.month("_date"))
            .drop("l_orderkey", "p_partkey"))


def _canonical_columns(j: DataFrame) -> DataFrame:
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("buyer_org_id"),
        F.col("l_suppkey").alias("seller_org_id"),
        F.col("l_partkey").alias("listing_id"),
        F.col("_category").alias("category"),
        _order_status(F.col("o_orderstatus")).alias("order_status"),
        _shipment_status(F.col("l_linestatus"), F.col("l_returnflag")).alias("shipment_status"),
        _payment_mode(F.col("o_orderpriority")).alias("payment_mode"),
        _fulfillment(F.col("l_suppkey")).alias("fulfillment_center"),
        F.when(F.col("l_linestatus") == "F", F.to_date("l_shipdate")).alias("first_shipped"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("total_line_amount"),
        F.col("_date").alias("order_date"),
        F.col("_month").alias("order_month"),
        # epoch milliseconds of the order's UTC midnight (the period job's clock column)
        (F.datediff("_date", F.lit("1970-01-01").cast("date")).cast("bigint") * 86400000)
        .alias("order_date_time"),
        F.lit(None).cast("string").alias("include"),
    )


def txn_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-grain transaction fact joined from the test tables."""
    return _canonical_columns(_joined(spark, sf_dir))


TXN_SCHEMA = schemas.txn(T.LongType())
TXN_COLUMNS = ("order_id", "buyer_org_id", "seller_org_id", "listing_id", "category", "order_status",
               "shipment_status", "payment_mode", "fulfillment_center", "first_shipped", "total_line_amount",
               "order_date", "order_month", "order_date_time", "include")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Of the source files and of the code that derives the table from them."""
    h = hashlib.sha1(sf_dir.encode())
    for fn in (_joined, _canonical_columns, _category, _order_status, _shipment_status, _payment_mode, _fulfillment):
        h.update(inspect.getsource(fn).encode())
    for name in ("lineitem", "orders", "part"):
        fs, p = _fs(spark, f"{sf_dir}/{name}.parquet")
        st = fs.getFileStatus(p)
        h.update(f"{name}:{st.getLen()}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:20]


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical fact table for ``sf_dir``: a parquet table partitioned by
    ``order_month`` in the shared checkpoint folder, written once from the test tables
    (keyed by their sizes, times and the deriving code) and read by every query.

    This stands in for the warehouse table the report jobs read: period filters prune
    month partitions, and scans split across files instead of one row group. The write
    range-partitions on (order_month, order_id), so a large month spreads over several
    tasks and files; only a folder with its writer's success marker is ever read.
    """
    return _canonical(spark, sf_dir).select(*TXN_COLUMNS)


def _complete(spark: SparkSession, base: str) -> str | None:
    """The first finished table under ``base``: one whose writer has left its marker."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return None
    names = sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())
    return next((f"{base}/{n}" for n in names if fs.exists(_fs(spark, f"{base}/{n}/_SUCCESS")[1])), None)


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"{checkpoint_dir(spark).rstrip('/')}/martmetrics/canonical/{_fingerprint(spark, sf_dir)}"

    def build() -> DataFrame:
        # every writer has a folder of its own, so a crashed or concurrent one is never read
        path = _complete(spark, base)
        if path is None:
            # exchanged as read, the canonical columns (labels in full) are made after that
            (_canonical_columns(_joined(spark, sf_dir).repartitionByRange("_month", "o_orderkey"))
             .write.partitionBy("order_month").parquet(f"{base}/txn-{uuid.uuid4().hex}"))
            path = _complete(spark, base)
        return spark.read.schema(TXN_SCHEMA).parquet(path)

    return _memo(spark, base, build)


_BUCKETED: dict = {}


def bucketed_txn(spark: SparkSession, sf_dir: str) -> str:
    """The name of the fact's table bucketed by buyer, written once a session's application."""
    k = (spark.sparkContext.applicationId, _fingerprint(spark, sf_dir))
    if k not in _BUCKETED:
        _BUCKETED[k] = bucketed.write_bucketed(txn(spark, sf_dir), path=files.scratch_path(spark, "by_buyer"))
    return _BUCKETED[k]


def rt_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily table : ``order_date_time`` is a date-valued day."""
    t = _canonical(spark, sf_dir)
    return t.select(*[F.col("order_date").alias(c) if c == "order_date_time" else F.col(c) for c in TXN_COLUMNS])


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("listing_id"), F.col("p_brand").alias("brand"),
        F.col("p_name").alias("vertical"), F.col("p_size").alias("org_id"))


def category_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_read(spark, sf_dir, "part")
            .select(F.col("p_name").alias("vertical"), _category(F.col("p_name")).alias("rt_mis_category"))
            .distinct())


def custom_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    cats = _read(spark, sf_dir, "part").select(_category(F.col("p_name")).alias("category")).distinct()
    cols = ("business_unit", "cust_cat_phones", "cust_cat_hnk", "business_group")
    exprs = [f"{_sql_case('category', i)} AS {name}" for i, name in enumerate(cols, start=1)]
    mapped = F.col("category").isin([r[0] for r in MAPPING_RULES])
    return cats.filter(mapped).selectExpr("category", *exprs)


def cnc_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_read(spark, sf_dir, "supplier").filter(F.col("s_nationkey").isin(list(CNC_NATIONS)))
            .select(F.col("s_suppkey").alias("org_id")))


def snapshot_csv_frame(spark: SparkSession, sf_dir: str, month: bool = False) -> DataFrame:
    """The snapshot job's CSV export shape, derived from the daily table; ``month``: with the
    table's partition column."""
    t = rt_txn(spark, sf_dir)
    lst = listing(spark, sf_dir)
    return (t.join(lst.select("listing_id", "brand", "vertical"), "listing_id", "left")
            .select("order_id", F.col("order_date_time").alias("order_date"), "category", "brand",
                    F.col("category").alias("rt_mis_category"), "seller_org_id", "buyer_org_id",
                    "vertical", "total_line_amount", *(["order_month"] if month else [])))


# ---------------------------------------------------------------------------
# The same adapter as DuckDB SQL (prefix for every oracle query).
# ---------------------------------------------------------------------------


def _sql_case(col: str, i: int) -> str:
    arms = " ".join(f"WHEN {col} = '{r[0]}' THEN '{r[i]}'" for r in MAPPING_RULES)
    return f"CASE {arms} END"


ADAPTER_SQL = f"""
txn AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS buyer_org_id, l.l_suppkey AS seller_org_id,
         l.l_partkey AS listing_id, split_part(p.p_name, ' ', 2) AS category,
         CASE o.o_orderstatus WHEN 'F' THEN 'SELLER_ORDER_COMPLETED' WHEN 'O' THEN 'SELLER_ORDER_BUYER_CANCEL'
              WHEN 'P' THEN 'SELLER_ORDER_EXPIRED' END AS order_status,
         CASE WHEN l.l_linestatus = 'O' AND l.l_returnflag = 'A' THEN 'SHIPMENT_RTS'
              WHEN l.l_linestatus = 'O' AND l.l_returnflag = 'R' THEN 'SHIPMENT_RTO'
              WHEN l.l_linestatus = 'F' AND l.l_returnflag = 'R' THEN 'SHIPMENT_RTO_DELIVERED'
              WHEN l.l_linestatus = 'F' THEN 'SHIPMENT_DELIVERED' END AS shipment_status,
         CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'CREDIT' WHEN '2' THEN 'PAY_LATER'
              WHEN '3' THEN 'CREDIT_PAY_LATER' ELSE 'CASH' END AS payment_mode,
         CASE l.l_suppkey % 3 WHEN 0 THEN '{FC_SELLER}' WHEN 1 THEN '{FC_WAREHOUSE}' END AS fulfillment_center,
         CASE WHEN l.l_linestatus = 'F' THEN CAST(l.l_shipdate AS DATE) END AS first_shipped,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_line_amount,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS INTEGER) AS order_month,
         CAST(date_diff('day', DATE '1970-01-01', CAST(o.o_orderdate AS DATE)) AS BIGINT) * 86400000
           AS order_date_time,
         CAST(NULL AS VARCHAR) AS include
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
rt_txn AS (
  SELECT * REPLACE (order_date AS order_date_time) FROM txn
),
listing AS (
  SELECT p_partkey AS listing_id, p_brand AS brand, p_name AS vertical, p_size AS org_id FROM part
),
category_map AS (
  SELECT DISTINCT p_name AS vertical, split_part(p_name, ' ', 2) AS rt_mis_category FROM part
),
custom_mapping AS (
  SELECT category, {_sql_case('category', 1)} AS business_unit, {_sql_case('category', 2)} AS cust_cat_phones,
         {_sql_case('category', 3)} AS cust_cat_hnk, {_sql_case('category', 4)} AS business_group
  FROM (SELECT DISTINCT split_part(p_name, ' ', 2) AS category FROM part)
  WHERE category IN ({', '.join(f"'{r[0]}'" for r in MAPPING_RULES)})
),
cnc_org AS (
  SELECT s_suppkey AS org_id FROM supplier WHERE s_nationkey IN ({', '.join(map(str, CNC_NATIONS))})
),
snapshot_csv AS (
  SELECT t.order_id, t.order_date_time AS order_date, t.category, l.brand, t.category AS rt_mis_category,
         t.seller_org_id, t.buyer_org_id, l.vertical, t.total_line_amount
  FROM rt_txn t LEFT JOIN listing l ON t.listing_id = l.listing_id
)
"""


def with_adapter(body: str, *ctes: str) -> str:
    """Prefix an oracle query with the adapter CTEs (plus any extra named CTEs)."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {ADAPTER_SQL.strip()}{extra}\n{body}"
