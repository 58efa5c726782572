"""Bitmaps over dense ids, carried state, one window for six segments, the bucketed fact."""

import random

import pytest
from pyspark.sql import functions as F

from martmetrics import config as C
from martmetrics.operators import bitmaps, newrep, scorecard, scorecard_counts
from martmetrics.plans import catalog
from martmetrics.sources import bucketed, stage
from conftest import SF_SMALL
from test_operators import D, MAP_DDL, _random_history, txn_rows

CODES = C.FulfilmentCodes(("FC_SELLER",), ("FC_WAREHOUSE",))


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- distinct counts ------------------------------------------------------------------------

def test_bitmaps_count_and_merge_like_sets(spark):
    rng = random.Random(1)
    rows = [(f"c{rng.randrange(4)}", rng.choice([None, *range(9000)]), rng.random() < 0.5) for _ in range(20_000)]
    rows += [("only-null", None, True), ("hot", 7, True)] + [("hot", 7, False)] * 5000
    df = spark.createDataFrame(rows, "cell string, k bigint, yes boolean")
    flags = {"all": "true", "yes": "yes"}
    cells = bitmaps.bitmap_cells(bitmaps.with_dense_ids(bitmaps.fold(df, ["cell"], "k", flags), "k"), ["cell"], "k", list(flags))
    got = {r["cell"]: (r["all"], r["yes"]) for r in bitmaps.counts(cells, ["cell"], list(flags)).collect()}
    want = {c: (len({k for x, k, _ in rows if x == c and k is not None}), len({k for x, k, y in rows if x == c and y and k is not None}))
            for c in {r[0] for r in rows}}
    assert got == want
    merged = bitmaps.counts(cells.withColumn("any", F.lit("any")), ["any"], ["all"]).first()["all"]
    assert merged == len({k for _, k, _ in rows if k is not None})


def test_dense_ids_of_more_than_one_bitmap(spark):
    df = spark.range(100_000).selectExpr("id AS k", "id % 3 AS cell")
    folded = bitmaps.fold(df, ["cell"], "k", {"n": "true"}, buckets=1)
    numbered = bitmaps.with_dense_ids(folded, "k")
    assert numbered.agg(F.min("_id"), F.max("_id"), F.count_distinct("_id")).first()[:] == (1, 100_000, 100_000)
    cells = bitmaps.bitmap_cells(numbered, ["cell"], "k", ["n"])
    assert cells.count() == 3 * 4                                       # 100,000 ids are four bitmaps
    assert sorted(r.n for r in bitmaps.counts(cells, ["cell"], ["n"]).collect()) == [33333, 33333, 33334]


def test_a_dictionary_grows_without_changing_its_ids(spark):
    keys = lambda *xs: spark.createDataFrame([(x,) for x in xs], "k string")
    one = bitmaps.dictionary(keys("a", "b", "c", None, "a"), "k", buckets=2)
    two = bitmaps.dictionary(keys("b", "d", "e", None), "k", one, buckets=2)
    first, then = dict(map(tuple, one.collect())), dict(map(tuple, two.collect()))
    assert set(first) == {"a", "b", "c"} and set(then) == {"a", "b", "c", "d", "e"}
    assert first == {k: then[k] for k in first} and len(set(then.values())) == 5
    for b in range(2):                                                  # dense inside a bucket
        mine = sorted(v - b * bitmaps.STRIDE for v in then.values() if v // bitmaps.STRIDE == b)
        assert mine == list(range(1, len(mine) + 1))
    assert bitmaps.dictionary(keys(), "k", two, buckets=2).count() == 5
    folded = bitmaps.fold(keys("a", "zz"), [], "k", {"n": "true"})
    with pytest.raises(Exception, match="no id for k zz"):
        bitmaps.with_ids(folded, "k", two).collect()


@pytest.mark.parametrize("hnk", ["phones", "own"])
def test_bitmap_counts_equal_the_scorecard(spark, hnk):
    t, m = _random_history(spark, 21)
    t = t.unionByName(txn_rows(spark, [dict(order_id="x1", buyer_org_id=None, category="c2", order_date=D(2020, 3, 3)),
                                       dict(order_id=None, buyer_org_id="b1", category="zz", order_date=D(2020, 3, 4)),
                                       dict(order_id="x2", buyer_org_id="b2", category=None, order_date=D(2020, 3, 5))]))
    cnc = spark.createDataFrame([("s1",)], "org_id string")
    args = (t, m, cnc, "2020-03-01", "2020-03-31", CODES, C.CustomCuts(hnk_flag=hnk))
    assert same(scorecard_counts.scorecard_counts(*args), scorecard.entity_scorecard(*args))
    assert scorecard_counts.scorecard_counts(t.limit(0), *args[1:]).count() == 0


def test_bitmap_scorecard_copies_no_line(spark):
    """The six cuts are made of bitmaps: what is spread over them is an aggregate."""
    lines = plan_of(catalog.QUERIES["scorecard_distinct_bitmaps"][0](spark, SF_SMALL)).splitlines()
    at = [i for i, ln in enumerate(lines) if "Generate inline" in ln]
    assert at and all("bitmap_construct_agg" in "".join(lines[i + 1:i + 6]) for i in at)


# -- carried state --------------------------------------------------------------------------

def test_three_months_in_sequence_equal_three_full_runs(spark, tmp_path):
    t, m = _random_history(spark, 12)
    cnc = spark.createDataFrame([("s2",)], "org_id string")
    base, reached = str(tmp_path / "state"), "2020-01-31"
    for start, end in (("2020-02-01", "2020-02-29"), ("2020-03-01", "2020-03-31"), ("2020-04-01", "2020-04-30")):
        state = scorecard.carry_first_purchases(t, base, reached)
        got = scorecard.entity_scorecard(t, m, cnc, start, end, CODES, state=state, state_upto=reached)
        assert same(got, scorecard.entity_scorecard(t, m, cnc, start, end, CODES))
        assert same(state, scorecard.first_purchases(t, reached))
        reached = end
    assert [v.about["upto"] for v in stage.versions(spark, base)] == ["2020-01-31", "2020-02-29", "2020-03-31"]
    assert same(scorecard.carry_first_purchases(t, base, "2020-03-31"), state)   # nothing to do
    assert len(stage.versions(spark, base)) == 3
    with pytest.raises(ValueError, match="already reaches"):
        scorecard.carry_first_purchases(t, base, "2020-02-29")


def test_a_carried_state_reads_only_the_new_months(spark):
    from martmetrics.plans.params import CFG
    from martmetrics.sources import testdata as td
    t, mp, cn = (f(spark, SF_SMALL) for f in (td.txn, td.custom_mapping, td.cnc_org))
    table = spark.createDataFrame([(1, "ring", 199801, D(1998, 1, 1))], "buyer_org_id bigint, category string, first_month int, first_date date")
    plan = plan_of(scorecard.entity_scorecard(t, mp, cn, "1998-07-01", "1998-07-31", CFG.fulfilment, state=table, state_upto="1998-06-30"))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet [" in ln and "/canonical/" in ln]
    assert scans and all(">= 199806" in ln or ">= 199807" in ln for ln in scans)


# -- New / Repeat ---------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [4, 5])
def test_one_window_equals_the_windowed_form(spark, seed):
    t, m = _random_history(spark, seed)
    got = newrep.newrep_all_segments(t, m)
    assert same(got, newrep.newrep_flags_windowed(t, m, segments=newrep.ALL_SEGMENTS))
    assert same(got.drop("buyer_cust_cat_hnk_month_newrep"), newrep.newrep_flags(t, m))
    assert plan_of(got).count("Window [") == 1


def test_hnk_flag_is_told_apart_from_the_phones_flag(spark):
    """July's c3 has the HNK value of June's c1 (Repeat there) and a phones value never bought (New)."""
    m = spark.createDataFrame([("c1", "BU", "P1", "H", "G"), ("c3", "BU", "P2", "H", "G")], MAP_DDL)
    t = txn_rows(spark, [dict(order_id="o1", buyer_org_id="b1", category="c1", order_date=D(2020, 6, 5)),
                         dict(order_id="o2", buyer_org_id="b1", category="c3", order_date=D(2020, 7, 5))])
    flags = {r.order_month: r for r in newrep.newrep_all_segments(t, m).collect()}
    assert (flags[202007].buyer_cust_cat_hnk_month_newrep, flags[202007].buyer_cust_cat_phones_month_newrep) == ("Repeat", "New")
    cnc = spark.createDataFrame([], "org_id string")
    for which, want in (("phones", (1, 0)), ("own", (0, 1))):
        sc = scorecard.entity_scorecard(t, m, cnc, "2020-07-01", "2020-07-31", CODES, C.CustomCuts(hnk_flag=which)).collect()
        r = next(x for x in sc if x.dim == "cust_cat_hnk" and x.entity == "Custom Category-H")
        assert (r.new_buyers, r.repeat_buyers) == want


# -- bucketed fact --------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["newrep_bucketed", "join_composite_bucketed"])
def test_bucketed_plans_exchange_nothing_on_the_buyer(spark, name):
    df = catalog.QUERIES[name][0](spark, SF_SMALL)
    df.collect()
    plan = plan_of(df)
    assert not [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln and "buyer_org_id" in ln]
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan


def test_bucketed_table_holds_every_row(spark, tmp_path):
    t, m = _random_history(spark, 6)
    name = bucketed.write_bucketed(t, buckets=4, path=str(tmp_path / "b"))
    table = bucketed.co_located(spark).table(name)
    assert same(t, spark.table(name))
    assert sorted(map(tuple, newrep.newrep_all_segments(table, m, placed=True).collect()), key=str) == sorted(
        map(tuple, newrep.newrep_all_segments(t, m).collect()), key=str)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
