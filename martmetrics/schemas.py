"""Canonical schemas of the tables the report operators read and write.

Id columns are text in the source warehouse; the test-data adapter uses whole numbers, so
the builders take the id type as an argument.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I = T.StringType(), T.DateType(), T.IntegerType()
MONEY = T.DecimalType(18, 2)


def txn(id_type: T.DataType = S) -> T.StructType:
    """Line-grain transaction fact. ``order_date_time`` is epoch milliseconds in the
    period job and a date in the daily job; ``include`` NULL marks a base row."""
    return T.StructType([
        T.StructField("order_id", id_type), T.StructField("buyer_org_id", id_type),
        T.StructField("seller_org_id", id_type), T.StructField("listing_id", id_type),
        T.StructField("category", S), T.StructField("order_status", S), T.StructField("shipment_status", S),
        T.StructField("payment_mode", S), T.StructField("fulfillment_center", S),
        T.StructField("first_shipped", D), T.StructField("total_line_amount", MONEY),
        T.StructField("order_date", D), T.StructField("order_date_time", T.LongType()),
        T.StructField("include", S), T.StructField("order_month", I),
    ])


def listing(id_type: T.DataType = S, org_type: T.DataType = S) -> T.StructType:
    return T.StructType([T.StructField("listing_id", id_type), T.StructField("brand", S),
                         T.StructField("vertical", S), T.StructField("org_id", org_type)])


CATEGORY_MAP = T.StructType([T.StructField("vertical", S), T.StructField("rt_mis_category", S)])

CUSTOM_MAPPING = T.StructType([T.StructField("category", S), T.StructField("business_unit", S),
                               T.StructField("cust_cat_phones", S), T.StructField("cust_cat_hnk", S),
                               T.StructField("business_group", S)])


def cnc_org(id_type: T.DataType = S) -> T.StructType:
    return T.StructType([T.StructField("org_id", id_type)])


def snapshot_csv(id_type: T.DataType = S) -> T.StructType:
    """The snapshot job's CSV export."""
    return T.StructType([
        T.StructField("order_id", id_type), T.StructField("order_date", D), T.StructField("category", S),
        T.StructField("brand", S), T.StructField("rt_mis_category", S), T.StructField("seller_org_id", id_type),
        T.StructField("buyer_org_id", id_type), T.StructField("vertical", S),
        T.StructField("total_line_amount", MONEY),
    ])


def sheet(n_dates: int) -> T.StructType:
    """One workbook sheet as CSV: data-row number, parameter label, one column per date."""
    return T.StructType([T.StructField("row_no", I), T.StructField("label", S)]
                        + [T.StructField(f"v{i}", S) for i in range(1, n_dates + 1)])
