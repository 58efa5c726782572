"""Operator behaviour on hand-made fixtures (one per quirk) and properties."""

import datetime as dt
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martmetrics import config as C
from martmetrics.functions.scalars import (epoch_ms_bounds, format_indian, local_date_from_epoch_ms,
                                           local_stamp_from_epoch_ms, weekday_label)
from martmetrics.operators import categorise as cat
from martmetrics.operators import levels, newrep, overrides, reports, scorecard, sheets

TXN_DDL = ("order_id string, buyer_org_id string, seller_org_id string, listing_id string, category string, "
           "order_status string, shipment_status string, payment_mode string, fulfillment_center string, "
           "first_shipped date, total_line_amount decimal(18,2), order_date date, order_month int, "
           "order_date_time bigint, include string")
MAP_DDL = "category string, business_unit string, cust_cat_phones string, cust_cat_hnk string, business_group string"
D = dt.date


def txn_rows(spark, rows):
    full = []
    for r in rows:
        r = dict(r)
        d = r.setdefault("order_date", D(2020, 7, 10))
        if d is not None:
            r.setdefault("order_month", d.year * 100 + d.month)
            r.setdefault("order_date_time", (d - D(1970, 1, 1)).days * 86400000)
        r.setdefault("total_line_amount", Decimal("100.00"))
        full.append(tuple(r.get(c.split()[0]) for c in TXN_DDL.split(", ")))
    return spark.createDataFrame(full, TXN_DDL)


# --- scalar functions ------------------------------------------------------------------


@pytest.mark.parametrize("x,want", [(0, "0"), (999, "999"), (1000, "1,000"), (99999.994, "99,999"),
                                    (99999.996, "1,00,000"), (1234567.999, "12,34,568"),
                                    (1e12, "10,00,00,00,00,000"), (-1234.5, "-1,234")])
def test_format_indian(spark, x, want):
    got = spark.range(1).select(format_indian(F.lit(x).cast("double")).alias("s")).first().s
    assert got == want


def test_local_day_boundary(spark):
    day = D(2020, 9, 1)
    base = (day - D(1970, 1, 1)).days * 86400000
    before = base + (18 * 3600 + 29 * 60 + 59) * 1000   # 23:59:59 local
    at = base + (18 * 3600 + 30 * 60) * 1000             # 00:00:00 local, next day
    df = spark.createDataFrame([(before,), (at,)], "ms long")
    got = df.select(local_date_from_epoch_ms(F.col("ms")).alias("d"),
                    local_stamp_from_epoch_ms(F.col("ms")).alias("s")).collect()
    assert [r.d for r in got] == [D(2020, 9, 1), D(2020, 9, 2)]
    assert got[0].s == "2020-09-01 23:59:59" and got[1].s == "2020-09-02 00:00:00"
    lo, hi = epoch_ms_bounds("2020-09-02", "2020-09-02")
    assert not (lo <= before < hi) and (lo <= at < hi)


def test_weekday_label(spark):
    got = spark.range(1).select(weekday_label(F.lit("2020-09-01").cast("date")).alias("w")).first().w
    assert got == "Tue"


# --- categorisation, caps, overrides ---------------------------------------------------


def test_having_cap_and_null_gmv(spark):
    rows = [dict(order_id="o1", listing_id="l1", total_line_amount=Decimal("199999.99")),
            dict(order_id="o2", listing_id="l1", total_line_amount=Decimal("200000.00")),
            dict(order_id="o3", listing_id="l1", total_line_amount=None)]
    t = txn_rows(spark, rows).withColumn("order_date_time", F.col("order_date"))
    ov = spark.createDataFrame([("l1", "b", "v", "FMCG", "1")],
                               "listing_id string, brand string, vertical string, rt_mis_category string, include string")
    out = cat.categorise_daily(t, ov, D(2020, 7, 10), C.TESTDATA.daily_type, C.TESTDATA.daily_type2, 200000)
    assert sorted(r.order_id for r in out.collect()) == ["o1"]


def test_drop_high_orders_keeps_null_ids_and_exact_cap(spark):
    df = spark.createDataFrame([("a", Decimal("150000")), ("a", Decimal("50000")), ("b", Decimal("150000")),
                                ("b", Decimal("50000.01")), (None, Decimal("900000"))],
                               "order_id string, total_line_amount decimal(18,2)")
    out = cat.drop_high_orders(df, 200000)
    assert sorted((r.order_id or "-") for r in out.collect()) == ["-", "a", "a"]


def test_sku_overrides_fanout(spark):
    listing = spark.createDataFrame(
        [("l1", "Saffola", "Oils", 1), ("l2", "Saffola", "Bulb", 7), ("l3", "Other", "Unmapped", 1)],
        "listing_id string, brand string, vertical string, org_id int")
    cmap = spark.createDataFrame([("Oils", "Sugar & Oil"), ("Bulb", "Electrical")],
                                 "vertical string, rt_mis_category string")
    brand = C.BrandRule("Saffola", "sugar & oil", "FMCG")
    allow = C.AllowListRule((1,), ("Oils", "Unmapped"), "Electrical")
    rows = {(r.listing_id, r.rt_mis_category, r.include, r.vertical)
            for r in overrides.sku_overrides(listing, cmap, brand, allow).collect()}
    assert rows == {("l1", "Sugar & Oil", "1", "Oils"), ("l1", "FMCG", "0", "Oils"),
                    ("l1", "Electrical", "0", "Oils"), ("l2", "Electrical", "1", "Bulb"),
                    ("l3", None, "1", None), ("l3", "Electrical", "0", None)}


def test_relabelled_copies_skip_target_keeps_null(spark):
    raw = spark.createDataFrame([("o1", "s1", "V", "Electrical", "x"), ("o2", "s1", "V", None, "x"),
                                 ("o3", "s2", "V", "Tools", "x")],
                                "order_id string, seller_org_id string, vertical string, rt_mis_category string, "
                                "brand string")
    rule = C.AllowListRule(("s1",), ("V",), "Electrical", skip_target=True)
    out = overrides.relabelled_copies(raw, C.BrandRule("none", "none", "none", False), rule)
    copies = sorted(r.order_id for r in out.filter("include = 0").collect())
    assert copies == ["o2"]
    assert out.filter("include = 1").count() == 3


# --- level roll-ups --------------------------------------------------------------------


def test_two_level_distinct_equals_count_distinct(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["o1", "o2", "o3", None]), rnd.choice(["u1", "u2", None]),
             rnd.choice(["SHIPMENT_DELIVERED", "SHIPMENT_RTS", None]),
             rnd.choice([Decimal("1.10"), Decimal("2.25"), None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, order_id string, buyer_org_id string, shipment_status string, "
                                     "gmv decimal(18,2)")
    m = levels.Measures(order_flags={"orders": "true", "delivered": "shipment_status = 'SHIPMENT_DELIVERED'"},
                        buyer_flags={"buyers": "shipment_status IS NOT NULL"}, sums={"gmv": "gmv"})
    got = {r.k: tuple(r)[1:] for r in levels.distinct_measures(df, ["k"], m).collect()}
    want = {r.k: tuple(r)[1:] for r in df.groupBy("k").agg(
        F.count_distinct("order_id"),
        F.count_distinct(F.when(F.col("shipment_status") == "SHIPMENT_DELIVERED", F.col("order_id"))),
        F.count_distinct(F.when(F.col("shipment_status").isNotNull(), F.col("buyer_org_id"))),
        F.sum("gmv").cast("double")).collect()}
    assert got == want


def test_grand_total_row_on_empty_input(spark):
    empty = spark.createDataFrame([], "order_id string, buyer_org_id string, gmv decimal(18,2), category string, "
                                      "type string, type2 string")
    rows = reports.daily_report(empty).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.level, r.entity, r.orders, r.buyers, r.gmv, r.aov) == ("total", "Grand Total", 0, 0, None, None)


def test_null_category_is_its_own_row(spark):
    df = spark.createDataFrame([("o1", "u1", Decimal("5"), None, "Mario", "R")],
                               "order_id string, buyer_org_id string, gmv decimal(18,2), category string, "
                               "type string, type2 string")
    rows = {(r.level, r.entity) for r in reports.daily_report(df).collect()}
    assert ("category", None) in rows and ("total", "Grand Total") in rows


def test_stacked_outputs_carry_their_order(spark):
    df = spark.createDataFrame([("o1", "u1", Decimal("5"), "c", "Mario", "R")],
                               "order_id string, buyer_org_id string, gmv decimal(18,2), category string, "
                               "type string, type2 string")
    out = reports.text_report(reports.daily_report(df), "2020-09-01 20:00:00").orderBy("level_rank", "entity")
    assert [r.level for r in out.collect()] == ["stamp", "total", "category", "type", "type2"]


def test_production_lists_and_category_alias(spark):
    cfg = C.production(("org1",), C.FulfilmentCodes(("X",), ("Y",)))
    listing = spark.createDataFrame([("l1", "b", "Cables", "org9"), ("l2", "b", "Latch", "org1"),
                                     ("l3", "Saffola", "Oil", "org9")],
                                    "listing_id string, brand string, vertical string, org_id string")
    cmap = spark.createDataFrame([("Cables", "Acc & CE"), ("Latch", "Home & Kitchen"), ("Oil", "Sugar & Oil")],
                                 "vertical string, rt_mis_category string")
    ov = overrides.sku_overrides(listing, cmap, cfg.brand_rule, cfg.allow_rule)
    t = txn_rows(spark, [dict(order_id=f"o{i}", listing_id=f"l{i}", order_date=D(2020, 9, 2),
                              order_date_time=(D(2020, 9, 2) - D(1970, 1, 1)).days * 86400000) for i in (1, 2, 3)])
    got = {(r.order_id, r.category, r.type, r.type2) for r in cat.categorise_period(
        t, ov, "2020-09-01", "2020-09-07", cfg.period_type, cfg.period_type2, cfg.cap).collect()}
    assert got == {("o1", "Acc|CE", "Mario", "Electronics"),
                   ("o2", "Home & Kitchen", "Mario", "GM"), ("o2", "Electrical", "Dont Include:1", "Dont Include:2"),
                   ("o3", "Sugar & Oil", "Food", "Redundant Aggregate"), ("o3", "FMCG", "Dont Include:1", "Dont Include:2")}


def test_text_report_stamp(spark):
    df = spark.createDataFrame([("o1", "u1", Decimal("5.05"), "c", "t", "t2"), ("o2", "u1", Decimal("5.00"), "c", "t", "t2")],
                               "order_id string, buyer_org_id string, gmv decimal(18,2), category string, "
                               "type string, type2 string")
    rows = reports.text_report(reports.daily_report(df), "2020-09-01 20:00:00").collect()
    stamp = [r for r in rows if r.level == "stamp"][0]
    assert stamp.entity == C.STAMP_LABEL and stamp.orders == "2020-09-02 01:30"
    total = [r for r in rows if r.level == "total"][0]
    assert (total.gmv, total.aov) == ("10.05", "5.03")   # 5.025 rounds half-up


# --- new / repeat and the scorecard ----------------------------------------------------


def _random_history(spark, seed, n=400):
    rnd = random.Random(seed)
    cats = ["c1", "c2", "c3", "c4", None]
    rows = []
    for i in range(n):
        d = D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(0, 150))
        rows.append(dict(order_id=f"o{i}", buyer_org_id=rnd.choice(["b1", "b2", "b3", "b4"]),
                         category=rnd.choice(cats), order_date=d, seller_org_id=rnd.choice(["s1", "s2"]),
                         shipment_status=rnd.choice(["SHIPMENT_DELIVERED", "SHIPMENT_RTS", None, "SHIPMENT_RTO"]),
                         payment_mode=rnd.choice(["CREDIT", "CASH"]),
                         fulfillment_center=rnd.choice(["FC_SELLER", "FC_WAREHOUSE", None]),
                         first_shipped=rnd.choice([d, None]),
                         order_status=rnd.choice(["SELLER_ORDER_COMPLETED", "SELLER_ORDER_EXPIRED", None])))
    mapping = spark.createDataFrame([("c1", "BU1", "Phones", "Ignore", "Food"), ("c2", "BU1", "Ignore", "HNK", None),
                                     ("c3", None, "Ignore", "Ignore", "Mario")], MAP_DDL)
    return txn_rows(spark, rows), mapping


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_newrep_closed_form_equals_windowed(spark, seed):
    t, m = _random_history(spark, seed)
    a = newrep.newrep_flags(t, m)
    b = newrep.newrep_flags_windowed(t, m).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scorecard_invariants(spark):
    t, m = _random_history(spark, 5)
    cnc = spark.createDataFrame([("s1",)], "org_id string")
    codes = C.FulfilmentCodes(("FC_SELLER",), ("FC_WAREHOUSE",))
    sc = scorecard.entity_scorecard(t, m, cnc, "2020-03-01", "2020-03-31", codes)
    rows = sc.collect()
    for r in rows:
        assert r.shipped_orders <= r.placed_orders and r.delivered_orders <= r.placed_orders
    overall = [r for r in rows if r.dim == "overall"][0]
    period_buyers = t.filter(F.col("order_date").between("2020-03-01", "2020-03-31")
                             & F.col("category").isin("c1", "c2", "c3")).select("buyer_org_id").distinct().count()
    # one month: New + Repeat = distinct buyers of mapped categories
    assert overall.new_buyers + overall.repeat_buyers == period_buyers
    # the long output has one row per entity and particular
    long = scorecard.scorecard_long(sc, "Mar-20")
    assert long.count() == len(rows) * len(C.PARTICULARS)


@pytest.mark.parametrize("state_upto", ["2020-01-31", "2020-02-29", "2020-03-31"])
def test_scorecard_with_carried_first_purchase_state(spark, state_upto):
    t, m = _random_history(spark, 11)
    cnc = spark.createDataFrame([("s2",)], "org_id string")
    codes = C.FulfilmentCodes(("FC_SELLER",), ("FC_WAREHOUSE",))
    plain = scorecard.entity_scorecard(t, m, cnc, "2020-03-01", "2020-03-31", codes)
    state = scorecard.first_purchases(t, state_upto)
    carried = scorecard.entity_scorecard(t, m, cnc, "2020-03-01", "2020-03-31", codes,
                                         state=state, state_upto=state_upto)
    assert plain.exceptAll(carried).count() == 0 and carried.exceptAll(plain).count() == 0
    with pytest.raises(ValueError):
        scorecard.entity_scorecard(t, m, cnc, "2020-03-01", "2020-03-31", codes, state=state,
                                   state_upto="2020-04-30")


def test_scorecard_hnk_uses_phones_flag_and_dims_do_not_collide(spark):
    # buyer b1 bought c1 (phones 'P') in June, c2 (phones 'Ignore', hnk 'P') in July:
    # in July the HNK cut 'P' is judged by the phones flag of c2 -> 'Ignore' segment is new.
    rows = [dict(order_id="o1", buyer_org_id="b1", category="c1", order_date=D(2020, 6, 5)),
            dict(order_id="o2", buyer_org_id="b1", category="c2", order_date=D(2020, 7, 5)),
            dict(order_id="o3", buyer_org_id="b1", category="c1", order_date=D(2020, 7, 6))]
    t = txn_rows(spark, rows)
    m = spark.createDataFrame([("c1", "BU", "P", "Ignore", "G"), ("c2", "BU", "Ignore", "P", "G")], MAP_DDL)
    cnc = spark.createDataFrame([], "org_id string")
    codes = C.FulfilmentCodes(("X",), ("Y",))
    sc = {(r.dim, r.entity): r for r in scorecard.entity_scorecard(t, m, cnc, "2020-07-01", "2020-07-31", codes).collect()}
    # same label in two cuts stays two rows, no fan-out of past buyers
    assert sc[("cust_cat_phones", "Custom Category-P")].past_buyers == 1
    assert sc[("cust_cat_hnk", "Custom Category-P")].past_buyers is None
    hnk = sc[("cust_cat_hnk", "Custom Category-P")]
    assert (hnk.new_buyers, hnk.repeat_buyers) == (1, 0)      # phones flag of c2 ('Ignore' first seen in July)
    own = scorecard.entity_scorecard(t, m, cnc, "2020-07-01", "2020-07-31", codes, C.CustomCuts(hnk_flag="own"))
    r = [x for x in own.collect() if x.dim == "cust_cat_hnk" and x.entity == "Custom Category-P"][0]
    assert (r.new_buyers, r.repeat_buyers) == (1, 0)
    bu = sc[("business_unit", "BU-BU")]
    assert (bu.new_buyers, bu.repeat_buyers, bu.past_buyers) == (0, 1, 1)


def test_unmapped_category_is_in_neither_new_nor_repeat(spark):
    rows = [dict(order_id="o1", buyer_org_id="b1", category="zz", order_date=D(2020, 7, 5))]
    t = txn_rows(spark, rows)
    m = spark.createDataFrame([("c1", "BU", "P", "Ignore", "G")], MAP_DDL)
    sc = {(r.dim, r.entity): r for r in scorecard.entity_scorecard(
        t, m, spark.createDataFrame([], "org_id string"), "2020-07-01", "2020-07-31",
        C.FulfilmentCodes(("X",), ("Y",))).collect()}
    r = sc[("overall", "Overall")]
    assert (r.placed_orders, r.new_buyers, r.repeat_buyers, r.past_buyers) == (1, 0, 0, None)
    assert ("business_unit", "BU-Null") in sc


# --- sheets -----------------------------------------------------------------------------


SHEET_DDL = "sheet string, row_no int, label string, v1 string, v2 string"


def test_normalise_sheets(spark):
    rows = [("Food", 0, "Parameter", "2020-09-01", "2020-09-02"), ("Food", 1, "Target", "9", "9"),
            ("Food", 2, None, "Mon", None), ("Food", 3, "Orders", "5", None),
            ("Toys", 0, "Parameter", "2020-09-01", None), ("Toys", 1, "Junk", "1", "1"),
            ("Toys", 2, None, "Tue", None), ("Toys", 3, "Orders", "7", None), ("Toys", 4, None, None, None),
            ("Books", 0, "Parameter", "2020-09-01", "2020-10-01"), ("Books", 3, "Orders", None, "2")]
    df = spark.createDataFrame(rows, SHEET_DDL)
    found = sheets.normalise_sheets(df)
    assert found.columns == ["sheet", "order_date", "dow", "Orders"]
    # 'Food' is a skipped sheet; a column without cells is no date; blank cells read 'x'
    assert sorted(map(tuple, found.collect())) == [("Books", "2020-09-01", "Tue", "x"),
                                                   ("Books", "2020-10-01", "Thu", "2"),
                                                   ("Toys", "2020-09-01", "Tue", "7")]
    assert sorted(map(tuple, sheets.normalise_sheets(df, ["Orders", "Other"]).collect())) == [
        ("Books", "2020-09-01", "Tue", "x", None), ("Books", "2020-10-01", "Thu", "2", None),
        ("Toys", "2020-09-01", "Tue", "7", None)]


@pytest.mark.parametrize("cell", [None, "02/09/2020"])
def test_normalise_sheets_refuses_a_column_without_a_date(spark, cell):
    df = spark.createDataFrame([("Toys", 0, "Parameter", "2020-09-01", cell), ("Toys", 3, "Orders", "7", "8")], SHEET_DDL)
    with pytest.raises(Exception, match="not a date in Toys v2"):
        sheets.normalise_sheets(df).collect()


def test_normalise_sheets_refuses_repeated_labels(spark):
    df = spark.createDataFrame([("Toys", 0, "Parameter", "2020-09-01", None), ("Toys", 3, "Orders", "5", None),
                                ("Toys", 4, "Orders", "7", None)], SHEET_DDL)
    with pytest.raises(Exception, match="repeated label in a sheet: Toys, Orders"):
        sheets.normalise_sheets(df).collect()


def test_sheets_of_forty_dates_over_two_months(spark, tmp_path):
    days = [D(2020, 8, 20) + dt.timedelta(days=i) for i in range(40)]
    cells = [("Toys", i, r, lab, v) for i, d in enumerate(days, 1)
             for r, lab, v in ((0, "Parameter", d.isoformat()), (3, "Orders", str(i)))] + [("Books", 1, 0, "Parameter", "2020-08-20")]
    long = spark.createDataFrame(cells, "sheet string, pos int, row_no int, label string, value string")
    path, sink = str(tmp_path / "book"), str(tmp_path / "out")
    sheets.write_csv(sheets.to_sheets(long, 40), path, partition_by=["sheet"])
    book = sheets.read_sheets(spark, path)
    assert book.columns == ["sheet", "row_no", "label", *[f"v{i}" for i in range(1, 41)]]
    out = sheets.normalise_sheets(book, csv_path=sink)
    want = {("Toys", d.isoformat()): str(i) for i, d in enumerate(days, 1)} | {("Books", "2020-08-20"): None}
    assert {(r.sheet, r.order_date): r.Orders for r in out.collect()} == want
    assert spark.read.option("header", True).csv(sink).count() == 41


def test_raw_sheet_drops_columns_by_position(spark):
    raw = spark.createDataFrame([(0, "i", "Parameter", "a", "b", "c", "d", "2020-09-01"),
                                 (3, "i", "Orders", "a", "b", "c", "d", "4")],
                                "row_no int, c0 string, `c.1` string, c2 string, c3 string, c4 string, c5 string, c6 string")
    s = sheets.from_raw(raw, "Toys")
    assert s.columns == ["sheet", "row_no", "label", "v1"]
    assert [tuple(r) for r in sheets.normalise_sheets(s).collect()] == [("Toys", "2020-09-01", "Tue", "4")]


# --- joins ------------------------------------------------------------------------------


def test_repeated_mapping_key_raises_when_run(spark):
    from martmetrics.operators.joins import unique_by
    one = spark.createDataFrame([("a", 1), ("b", None), (None, 2)], "k string, v int")
    assert sorted(map(tuple, unique_by(one, "k").collect()), key=str) == sorted([("a", 1), ("b", None), (None, 2)], key=str)
    with pytest.raises(Exception, match="repeated k"):
        unique_by(one.unionByName(one), "k").collect()




def test_level_sums_equal_grand_total(spark):
    t, _ = _random_history(spark, 21)
    cat_df = t.select("order_id", "buyer_org_id", F.col("total_line_amount").alias("gmv"), "category",
                      F.lit("T").alias("type"), F.coalesce("category", F.lit("n")).alias("type2"))
    rows = reports.daily_report(cat_df).collect()
    total = [r.gmv for r in rows if r.level == "total"][0]
    for lv in ("category", "type", "type2"):
        assert sum(r.gmv or 0 for r in rows if r.level == lv) == pytest.approx(total)


def test_group_by_constant_has_no_row_on_empty_input(spark):
    empty = spark.createDataFrame([], "buyer_org_id string")
    assert empty.groupBy(F.lit("Overall").alias("entity")).agg(F.count_distinct("buyer_org_id")).count() == 0


def test_ratio_with_zero_denominator_is_null(spark):
    from martmetrics.functions.scalars import safe_ratio
    r = spark.range(1).select(safe_ratio(F.lit(5), F.lit(0)).alias("a"), safe_ratio(F.lit(5), F.lit(2)).alias("b")).first()
    assert r.a is None and r.b == 2.5


def test_period_measures_null_status_fails_not_in(spark):
    df = spark.createDataFrame([("o1", "u1", None, "SHIPMENT_DELIVERED", Decimal("10"), Decimal("10"), "c"),
                                ("o2", "u2", "SELLER_ORDER_COMPLETED", None, Decimal("5"), None, "c")],
                               "order_id string, buyer_org_id string, order_status string, shipment_status string, "
                               "gmv decimal(18,2), shipped_gmv decimal(18,2), category string")
    r = reports.period_level(df, "category").first()
    # NULL status: not counted as a non-buyer-cancelled order, but still shipped / delivered
    assert (r.orders, r.buyers, r.placed_gmv_excl_buyer_cncl, r.shipped_orders, r.delivered_orders) == (1, 1, 5.0, 1, 1)
    assert r.placed_gmv_excl_buyer_seller_cncl_exp == 5.0 and r.shipped_gmv == 10.0


def test_snapshot_fixture(spark):
    from martmetrics.operators import snapshot
    ddl = ("order_id string, order_date date, category string, brand string, rt_mis_category string, "
           "seller_org_id string, buyer_org_id string, vertical string, total_line_amount decimal(18,2)")
    d1, d2 = D(2020, 9, 1), D(2020, 9, 2)
    rows = [("a", d2, "Sugar & Oil", "Saffola", "Sugar & Oil", "s9", "u1", "v", Decimal("1000")),   # copied
            ("b", d2, None, "x", None, "s9", "u2", "v", Decimal("2000")),                             # Blank
            ("c", d1, "Sugar & Oil", "Saffola", "Sugar & Oil", "s9", "u3", "v", Decimal("50")),       # other day
            ("d", d2, "Pharma", "x", "Pharma", "s9", "u1", "v", Decimal("150000")),                   # over cap
            ("d", d2, "Pharma", "x", "Pharma", "s9", "u1", "v", Decimal("60000"))]
    cfg = C.production((), C.FulfilmentCodes(("FC_SELLER",), ("FC_WAREHOUSE",)))
    out = {(r.level, r.entity): r for r in snapshot.hourly_snapshot(spark.createDataFrame(rows, ddl), cfg).collect()}
    assert (out[("overall", "overall")].orders, out[("overall", "overall")].gmv) == ("2", "3,000")
    assert out[("category", "Sugar & Oil")].gmv == "2,000"            # the copy counts under its old category
    assert out[("category", "Blank")].gmv == "2,000"
    assert ("category", "Pharma") not in out                          # whole order over the cap
    assert out[("bg", "Food")].gmv == "1,000" and out[("bg", "Mario")].gmv == "2,000"


def test_newrep_drops_null_dates(spark):
    rows = [dict(order_id="o1", buyer_org_id="b1", category="c1", order_date=D(2020, 7, 5)),
            dict(order_id="o2", buyer_org_id="b1", category="c1", order_date=None, order_month=202006,
                 order_date_time=0)]
    t = txn_rows(spark, rows)
    m = spark.createDataFrame([("c1", "BU", "P", "Ignore", "G")], MAP_DDL)
    got = [(r.order_month, r.buyer_cat_month_newrep) for r in newrep.newrep_flags(t, m).collect()]
    assert got == [(202007, "New")]


def test_materialise_path_and_catalog_table(spark):
    from martmetrics.sources import files
    df = spark.range(5).withColumnRenamed("id", "k")
    assert files.materialise(df, "stage_x").count() == 5
    spark.sql("CREATE DATABASE IF NOT EXISTS mm_test_db")
    name = f"stage_{uuid.uuid4().hex[:8]}"   # the in-memory test catalog forgets tables between runs
    t = files.materialise(df, name, database="mm_test_db", as_table=True)
    assert sorted(r.k for r in t.collect()) == [0, 1, 2, 3, 4]
    assert files.materialise(df.limit(2), name, database="mm_test_db", as_table=True).count() == 2


def test_scorecard_rejects_repeated_mapping_categories(spark):
    t = txn_rows(spark, [dict(order_id="o1", buyer_org_id="b1", category="c1")])
    m = spark.createDataFrame([("c1", "BU", "P", "Ignore", "G"), ("c1", "BU2", "P", "Ignore", "G")], MAP_DDL)
    sc = scorecard.entity_scorecard(t, m, spark.createDataFrame([], "org_id string"), "2020-07-01",
                                    "2020-07-31", C.FulfilmentCodes(("X",), ("Y",)))
    with pytest.raises(Exception, match="repeated category"):
        sc.collect()


def test_scorecard_null_buyer_and_null_month(spark):
    t = txn_rows(spark, [dict(order_id="o1", buyer_org_id="b1", category="c1"),
                         dict(order_id="o2", buyer_org_id=None, category="c1"),
                         dict(order_id="o3", buyer_org_id="b3", category="c1")])
    t = t.withColumn("order_month", F.when(F.col("order_id") != "o3", F.col("order_month")))
    m = spark.createDataFrame([("c1", "BU1", "P", "Ignore", "G")], MAP_DDL)
    day = str(t.agg(F.max("order_date")).first()[0])
    rows = {(r.dim, r.entity): r.placed_orders for r in scorecard.entity_scorecard(
        t, m, spark.createDataFrame([], "org_id string"), day, day, C.FulfilmentCodes(("X",), ("Y",))).collect()}
    assert rows["overall", "Overall"] == 3
    assert rows["business_unit", "BU-BU1"] == 2 and rows["business_unit", "BU-Null"] == 1


def test_snapshot_from_csv_export(spark, tmp_path):
    from martmetrics.operators import snapshot
    p = tmp_path / "raw.csv"
    p.write_text("order_id,order_date,category,brand,rt_mis_category,seller_org_id,buyer_org_id,vertical,"
                 "total_line_amount\n"
                 "o1,2020-09-01,Toys,b,Toys,s1,u1,v,100.50\n"
                 "o2,2020-09-01,,b,,s1,u2,v,1000\n")
    out = {(r.level, r.entity): r for r in snapshot.hourly_snapshot(snapshot.read_export(spark, str(p)),
                                                                     C.production((), C.FulfilmentCodes(("FC_SELLER",), ("FC_WAREHOUSE",)))).collect()}
    assert out[("overall", "overall")].gmv == "1,100" and out[("category", "Blank")].orders == "1"
    assert out[("bu", "General Merchandise")].gmv == "100"


def test_categorise_period_local_day_range(spark):
    base = (D(2020, 8, 31) - D(1970, 1, 1)).days * 86400000
    rows = [dict(order_id="early", listing_id="l1", order_date=D(2020, 8, 31),
                 order_date_time=base + (18 * 3600 + 29 * 60 + 59) * 1000),       # 23:59:59 local, Aug 31
            dict(order_id="start", listing_id="l1", order_date=D(2020, 8, 31),
                 order_date_time=base + (18 * 3600 + 30 * 60) * 1000),            # 00:00:00 local, Sep 1
            dict(order_id="end", listing_id="l1", order_date=D(2020, 9, 7),
                 order_date_time=base + 7 * 86400000 + (18 * 3600 + 29 * 60) * 1000),  # 23:59 local, Sep 7
            dict(order_id="late", listing_id="l1", order_date=D(2020, 9, 7),
                 order_date_time=base + 7 * 86400000 + (18 * 3600 + 30 * 60) * 1000)]  # 00:00 local, Sep 8
    t = txn_rows(spark, rows)
    ov = spark.createDataFrame([("l1", "b", "v", "Toys", "1")],
                               "listing_id string, brand string, vertical string, rt_mis_category string, include string")
    out = cat.categorise_period(t, ov, "2020-09-01", "2020-09-07", C.production((), C.FulfilmentCodes(("FC_SELLER",), ("FC_WAREHOUSE",))).period_type,
                                C.production((), C.FulfilmentCodes(("FC_SELLER",), ("FC_WAREHOUSE",))).period_type2, 200000).collect()
    assert sorted(r.order_id for r in out) == ["end", "start"]
    assert {r.order_id: r.order_date for r in out}["start"] == "2020-09-01 00:00:00"


def test_predicates_follow_sql_null_semantics(spark):
    from martmetrics.functions import predicates as P
    df = spark.createDataFrame([(None, None, None), ("SELLER_ORDER_BUYER_CANCEL", "SHIPMENT_RTS", "CREDIT"),
                                ("SELLER_ORDER_COMPLETED", "SHIPMENT_DELIVERED", "CASH"),
                                ("SELLER_ORDER_EXPIRED", "SHIPMENT_RTO", "PAY_LATER")],
                               "order_status string, shipment_status string, payment_mode string")

    def kept(c):
        return sorted(r.order_status or "-" for r in df.filter(c).collect())

    assert kept(P.not_buyer_cancelled()) == ["SELLER_ORDER_COMPLETED", "SELLER_ORDER_EXPIRED"]   # NULL dropped
    assert kept(P.not_cancelled()) == ["SELLER_ORDER_COMPLETED"]
    assert kept(P.shipped()) == ["SELLER_ORDER_COMPLETED", "SELLER_ORDER_EXPIRED"]
    assert kept(P.delivered()) == ["SELLER_ORDER_COMPLETED"]
    assert kept(P.rto()) == ["SELLER_ORDER_EXPIRED"]
    assert kept(P.credit()) == ["SELLER_ORDER_BUYER_CANCEL", "SELLER_ORDER_EXPIRED"]
    assert kept(F.expr(P.NOT_BUYER_CANCELLED_SQL)) == kept(P.not_buyer_cancelled())
    assert kept(F.expr(P.SHIP_SQL)) == kept(P.shipped())


def test_scorecard_overall_matches_pandas_brute_force_on_skewed_history(spark):
    rnd = random.Random(99)
    rows = []
    for i in range(600):
        d = D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(0, 120))
        rows.append(dict(order_id=f"o{rnd.randrange(0, 250)}",                 # multi-line orders
                         buyer_org_id="hot" if rnd.random() < 0.6 else f"b{rnd.randrange(0, 5)}",  # one hot buyer
                         category=rnd.choice(["c1", "c2", "c3"]), order_date=d,
                         seller_org_id=rnd.choice(["s1", "s2"]),
                         shipment_status=rnd.choice(["SHIPMENT_DELIVERED", "SHIPMENT_RTS", None]),
                         payment_mode=rnd.choice(["CREDIT", "CASH"]),
                         fulfillment_center=rnd.choice(["FC_SELLER", "FC_WAREHOUSE"]),
                         first_shipped=rnd.choice([d, None]), order_status="SELLER_ORDER_COMPLETED",
                         total_line_amount=Decimal(rnd.randrange(100, 10000)) / 100))
    t = txn_rows(spark, rows)
    m = spark.createDataFrame([("c1", "A", "P", "Ignore", "G"), ("c2", "A", "Ignore", "H", "G"),
                               ("c3", "B", "Ignore", "Ignore", "M")], MAP_DDL)
    cnc = spark.createDataFrame([("s2",)], "org_id string")
    sc = scorecard.entity_scorecard(t, m, cnc, "2020-03-01", "2020-03-31", C.FulfilmentCodes(("FC_SELLER",), ("FC_WAREHOUSE",)))
    got = [r for r in sc.collect() if r.dim == "overall"][0]

    pdf = t.toPandas()
    per = pdf[(pdf.order_date >= D(2020, 3, 1)) & (pdf.order_date <= D(2020, 3, 31))]
    ship = per.shipment_status.notna() & (per.shipment_status != "SHIPMENT_RTS")
    amt = per.total_line_amount.astype(float)
    shipped_amt = amt.where(per.first_shipped.notna(), 0.0)
    first_month = pdf.groupby("buyer_org_id").order_month.min()
    new = {b for b, mth in zip(per.buyer_org_id, per.order_month) if mth == first_month[b]}
    assert got.placed_orders == per.order_id.nunique()
    assert got.shipped_orders == per[ship].order_id.nunique()
    assert got.placed_gmv == pytest.approx(amt.sum())
    assert got.shipped_gmv == pytest.approx(shipped_amt.sum())
    assert got.cnc_gmv == pytest.approx(shipped_amt[per.seller_org_id == "s2"].sum())
    assert got.new_buyers == len(new) and got.new_buyers + got.repeat_buyers == per.buyer_org_id.nunique()
    assert got.past_buyers == pdf[pdf.order_date < D(2020, 3, 1)].buyer_org_id.nunique()
