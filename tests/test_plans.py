"""Plan-shape checks: no Python in the hot path, pushed filters, broadcast dimensions."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from martmetrics.plans import catalog

QUERIES = {k: v for k, v in E.queries().items() if k in catalog.QUERIES}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, f"{name} runs Python: {node}"


def test_scorecard_plan(spark):
    plan = _plan(QUERIES["entity_scorecard"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan            # mapping / CNC orgs, small here
    assert "SortMergeJoin" not in plan            # no shuffle join on the fact
    # fact read twice: the history once, the (month-pruned) period slice once
    fact_scans = [ln for ln in plan.splitlines() if "FileScan parquet [" in ln and "/canonical/" in ln]
    assert len(fact_scans) == 2
    # four exchanges of folded rows (two folds, by order, by buyer); the rest holds counts and dimensions
    moved = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert len([ln for ln in moved if "order_id" in ln]) == 2 and len([ln for ln in moved if "buyer_org_id" in ln]) == 2
    assert "PartitionFilters: [(isnull(order_month" in plan


def test_period_filter_reaches_scan(spark):
    plan = _plan(QUERIES["param_period_filter"](spark, SF_SMALL)).replace(" ", "")
    assert "PushedFilters:[IsNotNull(order_date),GreaterThanOrEqual(order_date" in plan


PRUNED = ("txns_categorised_daily", "txns_categorised_period", "daily_retail_metrics", "period_retail_metrics",
          "param_period_filter", "day_offset_filter", "filter_eq", "project_alias", "epoch_ms_to_ist",
          "join_fanout_overrides")


@pytest.mark.parametrize("name", PRUNED)
def test_dated_queries_prune_months(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet [" in ln and "/canonical/" in ln]
    assert scans and all("order_month" in ln.split("PartitionFilters: [")[1].split("]")[0] for ln in scans)


@pytest.mark.parametrize("name", ("daily_retail_metrics", "period_retail_metrics", "entity_scorecard", "buyer_cuts_raw",
                                  "hourly_snapshot", "anti_high_orders"))
def test_building_a_query_starts_no_job(spark, name):
    QUERIES["scan_txn"](spark, SF_SMALL)  # the fact table is published once
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        QUERIES[name](spark, SF_SMALL)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unfinished_table_is_never_read(spark, tmp_path):
    from martmetrics.sources import testdata as td
    base = str(tmp_path / "t")
    assert td._complete(spark, base) is None
    spark.range(5).write.parquet(f"{base}/b")
    spark.range(3).write.parquet(f"{base}/a")
    (tmp_path / "t" / "a" / "_SUCCESS").unlink()
    assert td._complete(spark, base).endswith("/b")
