"""Latest-day snapshot: the notebook job as one Spark plan.

clean (NULL category -> 'Blank', hierarchy tags) -> drop orders over the cap -> append
relabelled copies -> keep the latest day -> overall / business-unit / business-group
(base rows only) and category (all rows) blocks -> AOV, ABS -> Indian-format text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ReportConfig
from ..functions.hierarchy import tag
from ..functions.scalars import fill_blank, format_indian
from .categorise import drop_high_orders
from .levels import Measures, distinct_measures, level_rank, stack_levels
from .overrides import relabelled_copies

LEVEL_ORDER = ("overall", "bu", "bg", "category")


def read_export(spark, path: str, id_type=None) -> DataFrame:
    """The rows of the snapshot job's CSV export, its columns found by the header's names
    (``sources.exports`` has the lines that do not parse as well)."""
    from pyspark.sql import types as T

    from .. import schemas
    from ..sources import exports
    return exports.read_export(spark, path, schemas.snapshot_csv(id_type or T.StringType())).rows


def listed_months(df: DataFrame, month_col: str = "order_month") -> list[int]:
    """The months that a frame's files lie in, from their folders' names: the listing that the
    scan has anyway, no job. Empty where the frame reads no table partitioned by ``month_col``."""
    at = re.compile(rf"/{re.escape(month_col)}=(\d+)/")
    return sorted({int(m[1]) for m in map(at.search, df.inputFiles()) if m})


def _last_date(df: DataFrame, col: str) -> Column:
    return df.agg(F.max(col)).scalar()


def latest_day(df: DataFrame, col: str = "order_date", month_col: str | None = None) -> DataFrame:
    """Rows on the latest ``col`` value.

    With ``month_col`` (the yyyymm of ``col`` and the table's partition column) only the newest
    month of the listing is read, twice: for its last day, a one-row subquery, and for that
    day's rows. Older months are read only if it holds no date: their partition filter waits
    for that subquery and is empty otherwise. Rows without a month are looked at with the newest.
    Without it, the maximum over all rows is a one-row aggregate, joined back as a broadcast.
    """
    months = listed_months(df, month_col) if month_col else []
    if not months:
        day = df.agg(F.max(col).alias("_day"))
        return df.join(F.broadcast(day), F.col(col) == F.col("_day"), "inner").drop("_day")
    month = F.col(month_col)
    newest = df.filter(month.isNull() | (month == months[-1]))
    found = _last_date(newest, col)
    older = df.filter(month <= F.when(found.isNull(), F.lit(months[-1] - 1)).otherwise(F.lit(-1)))
    return newest.filter(F.col(col) == found).unionByName(latest_day(older, col))


def prepare(raw: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Clean, remove outlier orders, and append the relabelled copies (all days)."""
    x = raw.withColumn("category", fill_blank("category"))
    x = drop_high_orders(x, cfg.snapshot_cap)
    return _tagged(x, cfg)


def _tagged(x: DataFrame, cfg: ReportConfig) -> DataFrame:
    x = relabelled_copies(x, cfg.snapshot_brand_rule, cfg.snapshot_allow_rule)
    return x.withColumns({"bu": tag(cfg.snapshot_bu, "category"), "bg": tag(cfg.snapshot_bg, "category"),
                          "overall": F.lit("overall")})


def _latest_kept_day(x: DataFrame, cap: float) -> DataFrame:
    """The latest day's rows without the orders over the cap, from one aggregate by order over
    all rows: an order's total and last date give both the orders over the cap and the latest
    day among the others."""
    per_order = x.groupBy("order_id").agg(F.sum("total_line_amount").alias("_tot"),
                                          F.max("order_date").alias("_last"))
    over = (F.col("_tot") > F.lit(cap)) & F.col("_last").isNotNull()
    # orders over the cap (a NULL id never matches in the anti join, so NULL-id rows stay)
    high = per_order.filter(over).select("order_id")
    day = per_order.filter(~F.coalesce(over & F.col("order_id").isNotNull(), F.lit(False))) \
        .agg(F.max("_last").alias("_day"))
    rows = x.join(F.broadcast(day), F.col("order_date") == F.col("_day"), "inner").drop("_day")
    return rows.join(high, "order_id", "left_anti")


def latest_day_prepared(raw: DataFrame, cfg: ReportConfig, month_col: str | None = None) -> DataFrame:
    """``latest_day(prepare(raw, cfg))`` without working on the whole history.

    With ``month_col`` (see ``latest_day``): the last day of the newest month is taken, and the
    history, of which two columns are read, is first reduced to that day's orders by a semi-join
    — the aggregate by order sees nothing else. If every order of that day is over the cap, the
    day before counts, and so on: then, and only then, the partition filter of a second branch
    opens, which aggregates all orders. Without it (a CSV export) that branch is the plan.
    """
    x = raw.withColumn("category", fill_blank("category"))
    months = listed_months(raw, month_col) if month_col else []
    if not months:
        return _tagged(_latest_kept_day(x, cfg.snapshot_cap), cfg)
    month = F.col(month_col)
    newest = x.filter(month.isNull() | (month == months[-1]))
    day = newest.filter(F.col("order_date") == _last_date(newest, "order_date"))
    asked = day.filter(F.col("order_id").isNotNull()).select("order_id").distinct()
    high = (x.select("order_id", "total_line_amount").join(asked, "order_id", "left_semi")
            .groupBy("order_id").agg(F.sum("total_line_amount").alias("_tot"))
            .filter(F.col("_tot") > F.lit(cfg.snapshot_cap)).select("order_id"))
    kept = day.join(high, "order_id", "left_anti")
    any_kept = kept.select(F.lit(1).alias("k")).limit(1).agg(F.count("k")).scalar()
    rest = x.filter(F.coalesce(month, F.lit(0)) <= F.when(any_kept > 0, F.lit(-1)).otherwise(F.lit(months[-1])))
    return _tagged(kept.unionByName(_latest_kept_day(rest, cfg.snapshot_cap)), cfg)


def snapshot_measures() -> Measures:
    return Measures(order_flags={"orders": "true"}, buyer_flags={"buyers": "true"},
                    sums={"gmv": "total_line_amount"}, order=("orders", "buyers", "gmv"))


def snapshot_numbers(raw: DataFrame, cfg: ReportConfig, month_col: str | None = None, exact: bool = False) -> DataFrame:
    """(level, entity, buyers, orders, gmv, aov, abs, level_rank) for the latest day, numeric.
    ``month_col`` as in ``latest_day_prepared``; ``exact``: money stays decimal.

    The category block keeps the relabelled copies (``include=0``), the others do not —
    as in the source, so a copy counts under its *original* category a second time.
    """
    x = latest_day_prepared(raw, cfg, month_col)
    st = stack_levels(x, [(lv, F.col(lv)) for lv in LEVEL_ORDER])
    st = st.filter((F.col("level") == "category") | (F.col("include") == 1)).filter(F.col("entity").isNotNull())
    m = distinct_measures(st, ["level", "entity"], snapshot_measures(), exact=exact)
    gmv = F.coalesce(F.col("gmv"), F.lit(0).cast(m.schema["gmv"].dataType))   # all-NULL amounts sum to 0 in pandas
    return m.select("level", "entity", "buyers", "orders", gmv.alias("gmv"),
                    F.try_divide(gmv, F.col("orders")).alias("aov"),
                    F.try_divide(gmv, F.col("buyers")).alias("abs"), level_rank(LEVEL_ORDER))


def hourly_snapshot(raw: DataFrame, cfg: ReportConfig, month_col: str | None = None) -> DataFrame:
    """The formatted snapshot: (level, entity, buyers, orders, gmv, AOV, ABS) as text, and level_rank."""
    n = snapshot_numbers(raw, cfg, month_col, exact=True)
    # ratios in decimal, so the cent rounding is exact half-up
    gmv = F.col("gmv").cast("decimal(38,2)")
    return n.select("level", "entity", *[format_indian(F.col(c)).alias(c) for c in ("buyers", "orders")],
                    format_indian(gmv).alias("gmv"),
                    format_indian(F.try_divide(gmv, F.col("orders"))).alias("AOV"),
                    format_indian(F.try_divide(gmv, F.col("buyers"))).alias("ABS"), "level_rank")
