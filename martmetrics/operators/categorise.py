"""Categorised transaction facts for the daily and period reports, and outlier removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Hierarchy
from ..functions import predicates as P
from ..functions.hierarchy import alias_category, tag
from ..functions.scalars import epoch_ms_bounds, local_stamp_from_epoch_ms, local_today


def report_day(as_of=None, n: int = 0) -> Column:
    """The report day: local date of ``as_of`` (UTC instant) minus ``n`` days."""
    return F.date_sub(local_today(as_of), n)


def _join_overrides(t: DataFrame, overrides: DataFrame) -> DataFrame:
    # listing-sized: Spark picks broadcast or shuffle from the sizes it sees when it runs
    ov = overrides.select("listing_id", F.col("vertical").alias("ov_vertical"), F.col("brand").alias("ov_brand"),
                   F.col("include").alias("ov_include"), "rt_mis_category")
    return t.join(ov, "listing_id", "left")


def categorise_daily(rt_txn: DataFrame, overrides: DataFrame, day, type_h: Hierarchy,
                     type2_h: Hierarchy, cap: float) -> DataFrame:
    """One day's line facts summed on 10 keys, ``gmv < cap`` kept, tagged type/type2.

    ``day``: a date (string/``date``/Column) matched against ``order_date_time``.
    Rows with NULL gmv fail ``gmv < cap`` and drop out, as in ``HAVING``.
    """
    t = rt_txn.filter(P.on_day(day))
    j = _join_overrides(t, overrides)
    g = (j.groupBy(F.col("order_date_time").alias("order_date"), "order_id", "order_status", "seller_org_id",
                   "buyer_org_id", "listing_id", F.col("ov_vertical").alias("vertical"),
                   F.col("ov_brand").alias("brand"), F.col("ov_include").alias("include"),
                   alias_category(F.col("rt_mis_category")).alias("category"))
         .agg(F.sum("total_line_amount").alias("gmv"))
         .filter(F.col("gmv") < F.lit(cap)))
    return g.select("order_date", "order_id", "order_status", "seller_org_id", "buyer_org_id", "listing_id",
                    "category", "vertical", "brand", "include", "gmv",
                    tag(type_h).alias("type"), tag(type2_h).alias("type2"))


def categorise_period(txn: DataFrame, overrides: DataFrame, start, end, type_h: Hierarchy,
                      type2_h: Hierarchy, cap: float) -> DataFrame:
    """Local-day range version: 11 keys, plus ``shipped_gmv`` (SHIP-conditional sum).

    ``order_date_time`` is epoch milliseconds; the local (UTC+05:30) day is filtered with
    an equivalent plain range on the raw column so the predicate reaches the scan.
    Base rows only (``include IS NULL``).
    """
    lo, hi = epoch_ms_bounds(str(start), str(end))
    t = txn.filter(P.between_instants(lo, hi) & F.col("include").isNull())
    j = _join_overrides(t.drop("include"), overrides)
    amt = F.col("total_line_amount")
    g = (j.groupBy(local_stamp_from_epoch_ms(F.col("order_date_time")).alias("order_date"), "order_id",
                   "order_status", "shipment_status", "seller_org_id", "buyer_org_id", "listing_id",
                   F.col("ov_vertical").alias("vertical"), F.col("ov_brand").alias("brand"),
                   F.col("ov_include").alias("include"),
                   alias_category(F.col("rt_mis_category")).alias("category"))
         .agg(F.sum(amt).alias("gmv"), F.sum(F.when(P.shipped(), amt)).alias("shipped_gmv"))
         .filter(F.col("gmv") < F.lit(cap)))
    return g.select("order_date", "order_id", "order_status", "shipment_status", "seller_org_id",
                    "buyer_org_id", "listing_id", "category", "vertical", "brand", "include", "gmv",
                    "shipped_gmv", tag(type_h).alias("type"), tag(type2_h).alias("type2"))


def local_day_filter(df: DataFrame, start, end, col: str = "order_date_time") -> DataFrame:
    """Rows whose epoch-ms ``col`` falls on a local day in [start, end]."""
    return df.filter(P.between_instants(*epoch_ms_bounds(str(start), str(end)), col))


def drop_high_orders(df: DataFrame, cap: float, order_key: str = "order_id",
                     amount: str = "total_line_amount") -> DataFrame:
    """Remove every line of orders whose total amount exceeds ``cap``.

    The order totals are a partial (map-side) aggregate; whether the over-cap ids are
    broadcast to the anti join is decided by Spark when their size is known. Lines with a NULL order id
    survive, as they do in pandas (``~isin``) — the anti join never matches a NULL key.
    """
    high = (df.groupBy(order_key).agg(F.sum(amount).alias("_tot"))
            .filter(F.col("_tot") > F.lit(cap)).select(order_key))
    return df.join(high, order_key, "left_anti")
