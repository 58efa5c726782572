"""Row predicates of the report measures, as Column factories.

All follow SQL three-valued logic: a NULL status makes the predicate NULL, which
``F.when`` treats as false — the same as the source's ``CASE WHEN``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shipped(shipment_status: str | Column = "shipment_status") -> Column:
    """SHIP: shipment started and not ready-to-ship."""
    s = _c(shipment_status)
    return s.isNotNull() & (s != C.SHIPMENT_RTS)


def delivered(shipment_status: str | Column = "shipment_status") -> Column:
    return _c(shipment_status) == C.SHIPMENT_DELIVERED


def rto(shipment_status: str | Column = "shipment_status") -> Column:
    return _c(shipment_status).isin(list(C.RTO_STATUSES))


def credit(payment_mode: str | Column = "payment_mode") -> Column:
    return _c(payment_mode).isin(list(C.CREDIT_MODES))


def cancelled(order_status: str | Column = "order_status") -> Column:
    """CANCEL: buyer cancel, seller cancel or expiry."""
    return _c(order_status).isin(list(C.CANCEL_STATUSES))


def not_cancelled(order_status: str | Column = "order_status") -> Column:
    """``order_status NOT IN (cancel statuses)`` — NULL for a NULL status."""
    return ~cancelled(order_status)


def not_buyer_cancelled(order_status: str | Column = "order_status") -> Column:
    """NB: ``order_status NOT IN ('SELLER_ORDER_BUYER_CANCEL')`` — NULL for a NULL status."""
    return ~_c(order_status).isin([C.BUYER_CANCEL])


def flag(p: Column) -> Column:
    """1 where the predicate holds, else 0 (NULL counts as false)."""
    return F.when(p, F.lit(1)).otherwise(F.lit(0))


# ---------------------------------------------------------------------------
# The same predicates as SQL expression text, for ``F.expr`` / ``selectExpr``: a whole
# projection then costs one JVM call instead of one per Column node.
# ---------------------------------------------------------------------------


def sql_lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def sql_in(col: str, values) -> str:
    return f"{col} IN ({', '.join(sql_lit(v) for v in values)})"


SHIP_SQL = f"(shipment_status IS NOT NULL AND shipment_status <> {sql_lit(C.SHIPMENT_RTS)})"
DELIVERED_SQL = f"(shipment_status = {sql_lit(C.SHIPMENT_DELIVERED)})"
RTO_SQL = f"({sql_in('shipment_status', C.RTO_STATUSES)})"
CREDIT_SQL = f"({sql_in('payment_mode', C.CREDIT_MODES)})"
NOT_CANCELLED_SQL = f"(NOT {sql_in('order_status', C.CANCEL_STATUSES)})"
NOT_BUYER_CANCELLED_SQL = f"(NOT {sql_in('order_status', [C.BUYER_CANCEL])})"


def sql_flag(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS INT)"


def _month(x) -> int:
    d = str(x)[:10]
    return int(d[:4]) * 100 + int(d[5:7])


def month_prune(lo=None, hi=None):
    """``order_month`` bounds implied by an ``order_date`` range (typed days, ISO text).

    ``order_month`` is the yyyymm of ``order_date`` and the fact table's partition column,
    so this predicate lets the scan skip month partitions. Rows without a month are kept:
    only the date decides.
    """
    c = F.lit(True)
    if lo is not None:
        c = c & (F.col("order_month") >= _month(lo))
    if hi is not None:
        c = c & (F.col("order_month") <= _month(hi))
    return F.col("order_month").isNull() | c


def on_day(day, column: str = "order_date_time"):
    """Rows of one day (ISO text, ``date`` or a foldable Column), with the month it implies."""
    from pyspark.sql import Column

    d = day if isinstance(day, Column) else F.lit(str(day)).cast("date")
    month = F.year(d) * 100 + F.month(d)
    return (F.col(column) == d) & (F.col("order_month").isNull() | (F.col("order_month") == month))


def between_instants(lo: int, hi: int, column: str = "order_date_time"):
    """Rows with ``lo`` <= epoch milliseconds < ``hi``, with the UTC months they imply."""
    import datetime as dt

    epoch = dt.datetime(1970, 1, 1)
    first, last = (epoch + dt.timedelta(milliseconds=x) for x in (lo, hi - 1))
    return (F.col(column) >= lo) & (F.col(column) < hi) & month_prune(first.date(), last.date())
