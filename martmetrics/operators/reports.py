"""Daily and period reports: single-level roll-ups, stacked reports, vertical cut."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import STAMP_LABEL
from ..functions.scalars import report_stamp
from .levels import Measures, daily_measures, distinct_measures, period_measures, stacked_report

LEVEL_COLUMNS = ("category", "type", "type2")


def level_metrics(categorised: DataFrame, level: str, m: Measures) -> DataFrame:
    """One level of the report: ``level`` column + measures (``GROUP BY level``)."""
    return distinct_measures(categorised, [level], m)


def daily_level(categorised: DataFrame, level: str) -> DataFrame:
    return level_metrics(categorised, level, daily_measures())


def period_level(categorised: DataFrame, level: str) -> DataFrame:
    return level_metrics(categorised, level, period_measures())


def _levels():
    return [(c, F.col(c)) for c in LEVEL_COLUMNS]


def daily_report(categorised: DataFrame, exact: bool = False) -> DataFrame:
    """Grand Total + category + type + type2 blocks: (level, entity, orders, buyers, gmv, aov,
    level_rank). ``exact``: ``gmv`` stays decimal, for ``text_report``.

    No include filter: relabelled copies count in every block, as in the source job.
    """
    return stacked_report(categorised, _levels(), daily_measures(), exact=exact)


def period_report(categorised: DataFrame) -> DataFrame:
    """Grand Total + category + type + type2 with the eight period measures."""
    return stacked_report(categorised, _levels(), period_measures())


def vertical_summary(categorised: DataFrame) -> DataFrame:
    """The first six period measures by (vertical, brand, category)."""
    return distinct_measures(categorised, ["vertical", "brand", "category"], period_measures(full=False))


def text_report(report: DataFrame, as_of=None) -> DataFrame:
    """The stacked report as text with the run-stamp row on top (entity, orders, buyers,
    gmv, aov all strings): the source unions a text stamp into numeric columns, which an
    ANSI engine rejects, so every measure is rendered as text first. Money is shown with
    two decimals, ``aov`` rounded half-up to the cent; from an ``exact`` report it never goes
    through double. The stamp has ``level_rank`` 0.
    """
    money = lambda c: F.col(c).cast("decimal(38,2)").cast("string")
    body = report.select(
        "level", "entity", F.col("orders").cast("string").alias("orders"),
        F.col("buyers").cast("string").alias("buyers"), money("gmv").alias("gmv"),
        F.round(F.try_divide(F.col("gmv").cast("decimal(38,2)"), F.col("orders")), 2)
        .cast("decimal(38,2)").cast("string").alias("aov"), "level_rank")
    spark = report.sparkSession
    stamp = spark.range(1).select(F.lit("stamp").alias("level"), F.lit(STAMP_LABEL).alias("entity"),
                                  report_stamp(as_of).alias("orders"), F.lit("1").alias("buyers"),
                                  F.lit("1").alias("gmv"), F.lit("1").alias("aov"),
                                  F.lit(0).alias("level_rank"))
    return stamp.unionByName(body)
