"""What one task holds: shares of reads and shuffles, placement by buyer, shared sorts, broadcast mapping."""

import pytest
from pyspark.sql import functions as F

from martmetrics import session
from martmetrics.operators import newrep, scorecard
from martmetrics.operators.joins import placed_by
from martmetrics.plans import catalog
from martmetrics.sources import bucketed
from martmetrics.sources import testdata as td
from conftest import SF_SMALL
from test_month_end import plan_of, same
from test_operators import MAP_DDL, D, _random_history, txn_rows


@pytest.fixture
def no_small_side(spark):
    """Spark broadcasts nothing of its own accord, as with a mapping read from a large table."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def moved_on(df, column):
    return [ln for ln in plan_of(df).splitlines() if "Exchange hashpartitioning(" + column + "#" in ln]


def test_a_given_number_of_partitions_is_kept(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert placed_by(spark.range(10), "id").rdd.getNumPartitions() == n
    assert placed_by(spark.range(10), "id", times=2).rdd.getNumPartitions() == 2 * n


def test_windowed_form_sorts_once_a_segment(spark, no_small_side):
    t, m = _random_history(spark, 11)
    plan = plan_of(newrep.newrep_flags_windowed(t, m, segments=newrep.ALL_SEGMENTS))
    assert plan.count("Window [") == 18
    assert plan.count("Sort [buyer_org_id") == 6


def test_flags_share_a_sort_of_unit_and_category(spark, no_small_side):
    t, m = _random_history(spark, 12)
    plan = plan_of(newrep.newrep_flags(t, m))
    assert plan.count("Window [") == 5 and plan.count("Sort [buyer_org_id") == 3


@pytest.mark.parametrize("form", [newrep.newrep_flags, newrep.newrep_all_segments, newrep.newrep_flags_windowed])
def test_facts_are_not_exchanged_on_the_category(spark, no_small_side, form):
    t, m = _random_history(spark, 13)
    got = form(t, m)
    # one exchange folds the lines, one places them by buyer; the other is the mapping's own fold
    assert "SortMergeJoin" not in plan_of(got)
    assert len(moved_on(got, "buyer_org_id")) == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert same(got, newrep.newrep_all_segments(t, m).select(*got.columns))


def test_buckets_follow_the_shuffle_partitions(spark, tmp_path):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        name = bucketed.write_bucketed(spark.range(50).withColumnRenamed("id", "buyer_org_id"), path=str(tmp_path / "b"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert about["Num Buckets"] == "24" and spark.table(name).count() == 50


@pytest.mark.parametrize("name", ["newrep_bucketed", "join_composite_bucketed"])
def test_bucketed_plans_exchange_nothing_whatever_the_mapping(spark, no_small_side, name):
    df = catalog.QUERIES[name][0](spark, SF_SMALL)
    df.collect()
    assert not moved_on(df, "buyer_org_id") and not moved_on(df, "category, buyer_org_id")
    assert not [ln for ln in plan_of(df).splitlines() if "Exchange hashpartitioning" in ln and "buyer_org_id" in ln]


def test_past_buyers_copies_for_the_cuts_stay_where_the_buyer_is(spark, no_small_side):
    m = spark.createDataFrame([("c1", "BU", "P", "Ignore", "G")], MAP_DDL)
    t = txn_rows(spark, [dict(order_id=f"o{i}", buyer_org_id=b, category=c, order_date=D(2020, 1, 1 + i))
                         for i, (b, c) in enumerate([("b1", "c1"), ("b1", "c1"), ("b2", "c1"), ("b2", None), (None, "c2"), (None, "c2")])])
    got = scorecard.past_buyers(t, m, "2020-07-01")
    assert not moved_on(got, "dim") or "buyer_org_id" not in "".join(moved_on(got, "dim"))
    assert {(r.dim, r.entity): r.past_buyers for r in got.collect()} == {
        ("category", "category-c1"): 2, ("category", "category-c2"): 0, ("category", None): 1,
        ("business_unit", "BU-BU"): 2, ("business_unit", None): 1, ("cust_cat_phones", "Custom Category-P"): 2,
        ("business_group", "Business Group-G"): 2, ("business_group", None): 1, ("overall", "Overall"): 2}


def test_tag_from_lookup_does_not_exchange_the_fact(spark, no_small_side):
    assert not moved_on(catalog.QUERIES["tag_from_lookup"][0](spark, SF_SMALL), "seller_org_id")


def test_the_fact_moves_as_it_is_read(spark):
    """Labels are made after the writer's exchange; lines meet parts before orders."""
    j = td._joined(spark, SF_SMALL)
    assert {"l_returnflag", "o_orderstatus", "o_orderpriority", "_month"} <= set(j.columns)
    assert not {"order_status", "shipment_status", "fulfillment_center"} & set(j.columns)
    assert same(td.txn_from_tables(spark, SF_SMALL), td.txn(spark, SF_SMALL))
    assert td.txn_from_tables(spark, SF_SMALL).filter(F.col("order_date").isNull()).isEmpty()


def test_pin_lowers_a_tasks_share_and_keeps_a_smaller_one(spark):
    keys = list(session.MOST_BYTES)
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for given, want in (("1g", None), ("134217728b", None), ("64MB", None), ("2m", 2 << 20), ("4096", 4096)):
            for k in keys:
                spark.conf.set(k, given)
            session.pin(spark)
            assert [session._bytes(spark.conf.get(k)) for k in keys] == [want or session.MOST_BYTES[k] for k in keys]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
