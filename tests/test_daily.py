"""The latest day from the listing, order totals of that day's orders, exact text, profiles, raw sheets."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martmetrics import config as C
from martmetrics.operators import explore, reports, sheets, snapshot
from martmetrics.plans import catalog
from conftest import SF_SMALL

D = dt.date
CFG = C.production((), C.FulfilmentCodes(("FC_SELLER",), ("FC_WAREHOUSE",)))
DDL = ("order_id string, order_date date, category string, brand string, rt_mis_category string, seller_org_id string, "
       "buyer_org_id string, vertical string, total_line_amount decimal(18,2), order_month int")


def fact(spark, path, rows):
    """rows: (order, date, amount[, month]), written by month."""
    full = [(o, d, "Toys", "b", "Toys", "s", "u", "v", None if a is None else Decimal(a),
             m[0] if m else None if d is None else d.year * 100 + d.month) for o, d, a, *m in rows]
    spark.createDataFrame(full, DDL).write.partitionBy("order_month").parquet(str(path))
    return spark.read.parquet(str(path))


def partition_filters(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [ln.split("PartitionFilters: ")[1].split("PushedFilters")[0] for ln in plan.splitlines()
            if "FileScan parquet [" in ln]


# -- latest day -----------------------------------------------------------------------------

def test_only_the_newest_month_is_read(spark, tmp_path):
    t = fact(spark, tmp_path / "t", [("a", D(2020, 7, 1), 1), ("b", D(2020, 8, 3), 2), ("c", D(2020, 8, 9), 3), ("d", D(2020, 8, 9), 4)])
    assert snapshot.listed_months(t) == [202007, 202008]
    for f in (tmp_path / "t" / "order_month=202007").glob("*.parquet"):   # reading July would fail
        f.write_bytes(b"x" * f.stat().st_size)
    got = snapshot.latest_day(t, month_col="order_month")
    assert sorted(r.order_id for r in got.collect()) == ["c", "d"]
    assert any("= 202008" in f for f in partition_filters(got))
    with pytest.raises(Exception):
        snapshot.latest_day(t).collect()


@pytest.mark.parametrize("case", ["no date in the newest", "null month", "none at all"])
def test_an_empty_newest_month_is_passed_over(spark, tmp_path, case):
    rows = {"no date in the newest": [("a", D(2020, 7, 1), 1), ("b", D(2020, 7, 2), 1), ("z", None, 9, 202008)],
            "null month": [("a", D(2020, 7, 1), 1), ("b", D(2020, 7, 2), 1, None), ("c", D(2020, 7, 1), 1)],
            "none at all": [("z", None, 9, 202008), ("y", None, 9, 202007)]}[case]
    t = fact(spark, tmp_path / "t", rows)
    want = sorted(r.order_id for r in snapshot.latest_day(t).collect())
    assert sorted(r.order_id for r in snapshot.latest_day(t, month_col="order_month").collect()) == want
    assert want == ([] if case == "none at all" else ["b"])


ROWS = [("old", D(2020, 7, 1), 10), ("big", D(2020, 7, 1), 190_000), ("big", D(2020, 8, 9), 20_000),
        ("ok", D(2020, 8, 9), 500), ("ok", D(2020, 7, 3), 5), (None, D(2020, 8, 9), 900_000), ("b2", D(2020, 8, 2), 7)]


@pytest.mark.parametrize("drop", [(), ("ok",), ("ok", None), ("ok", None, "b2"), ("ok", None, "b2", "old")])
def test_the_day_goes_back_while_all_its_orders_are_over_the_cap(spark, tmp_path, drop):
    rows = [r for r in ROWS if r[0] not in drop]
    t = fact(spark, tmp_path / "t", rows)
    key = lambda df: sorted((str(r.order_id), r.order_date, r.total_line_amount) for r in df.collect())
    got = key(snapshot.latest_day_prepared(t, CFG, "order_month"))
    assert got == key(snapshot.latest_day_prepared(t.select("*"), CFG)) == key(snapshot.latest_day(snapshot.prepare(t, CFG)))
    day = {0: D(2020, 8, 9), 1: D(2020, 8, 9), 2: D(2020, 8, 2), 3: D(2020, 7, 1), 4: None}[len(drop)]
    assert {d for _, d, _ in got} == ({day} if day else set())


def test_order_totals_see_only_the_orders_of_the_day(spark, tmp_path):
    t = fact(spark, tmp_path / "t", [("a", D(2020, 8, 9), 1)] + [(f"o{k}", D(2020, 7, 1), 1) for k in range(500)])
    df = snapshot.latest_day_prepared(t, CFG, "order_month")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    totals = next(ln for ln in plan.split("Aggregate [order_id")[1:] if "sum(total_line_amount" in ln.splitlines()[0])
    assert "Join LeftSemi" in totals
    assert any("CASE WHEN" in f and "<= " in f for f in partition_filters(df))


# -- exact text -----------------------------------------------------------------------------

def test_printed_money_is_exact_above_two_to_the_53_cents(spark, tmp_path):
    rows = [("o1", D(2020, 8, 9), "123456789012345.67"), ("o2", D(2020, 8, 9), "0.01")]
    cfg = C.production((), C.FulfilmentCodes(("FC_SELLER",), ("FC_WAREHOUSE",)))
    from dataclasses import replace
    t = fact(spark, tmp_path / "t", rows)
    out = {r.level: r for r in snapshot.hourly_snapshot(t, replace(cfg, snapshot_cap=1e18)).collect()}
    assert out["overall"].gmv == "12,34,56,78,90,12,345" and out["overall"].AOV == "6,17,28,39,45,06,172"
    c = t.select("order_id", "buyer_org_id", "category", F.lit("t").alias("type"), F.lit("u").alias("type2"),
                 F.col("total_line_amount").alias("gmv"))
    text = {r.level: r for r in reports.text_report(reports.daily_report(c, exact=True), "2020-08-09 10:00:00").collect()}
    assert text["total"].gmv == "123456789012345.68" and text["total"].aov == "61728394506172.84"


@pytest.mark.parametrize("name", ["sheets_union", "transpose_sheet", "agg_overall_const", "agg_by_expr"])
def test_dated_queries_prune_months(spark, name):
    df = catalog.QUERIES[name][0](spark, SF_SMALL)
    if name.startswith("agg"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert all("order_month" in ln.split("PartitionFilters: [")[1].split("]")[0]
                   for ln in plan.splitlines() if "FileScan parquet [" in ln and "/canonical/" in ln)
    from martmetrics.plans import sheets as plan_sheets
    cells = plan_sheets._cells(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "199807" in cells.split("PartitionFilters: [")[1].split("]")[0]


# -- profile and head -----------------------------------------------------------------------

def test_profile_of_every_type(spark):
    rows = [(1, None, 2.5, D(2020, 1, 2), Decimal("1.10"), "b", True, [1], dt.datetime(2020, 1, 1, 3)),
            (12, -3, float("nan"), D(1960, 1, 2), Decimal("-9.00"), "", None, [2, 3], None),
            (1, -3, -1e300, None, None, None, False, None, dt.datetime(1950, 1, 1, 3, 0, 0, 7))]
    df = spark.createDataFrame(rows, "a bigint, `b.c` smallint, d double, e date, f decimal(10,2), g string, h boolean, "
                                     "i array<int>, j timestamp")
    got = {r.column_name: r for r in explore.profile(df).collect()}
    assert [r.column_name for r in explore.profile(df).orderBy("place").collect()] == df.columns
    want = {"a": (3, 0, 2, "1", "12"), "b.c": (3, 1, 1, "-3", "-3"), "d": (3, 0, 3, "-1.0E300", "NaN"),
            "e": (3, 1, 2, "1960-01-02", "2020-01-02"), "f": (3, 1, 2, "-9.00", "1.10"), "g": (3, 1, 2, "", "b"),
            "h": (3, 1, 2, "false", "true"), "j": (3, 1, 2, "1950-01-01 03:00:00.000007", "2020-01-01 03:00:00")}
    for name, w in want.items():
        assert tuple(got[name])[3:] == w, name
    assert tuple(got["i"])[3:6] == (3, 1, 2)
    assert [tuple(r)[3:] for r in explore.profile(df.limit(0)).collect()] == [(0, 0, 0, None, None)] * 9
    assert explore.shape(df).first()[:] == (3, 9)


def test_profile_reads_the_table_once(spark):
    df = catalog.QUERIES["txn_profile"][0](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [") == 1 and "Expand" not in plan


def test_head_is_ordered_and_bounded(spark):
    df = spark.createDataFrame([(k % 4 if k % 5 else None, f"v{k}") for k in range(40)], "a int, b string").repartition(7)
    got = [tuple(r) for r in explore.head(df, ["a"], 9).collect()]
    assert got == sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))[:9]
    assert "TakeOrderedAndProject" in explore.head(df, ["a"])._jdf.queryExecution().executedPlan().toString()


# -- raw sheets -----------------------------------------------------------------------------

def raw_sheet(dates, rows, end="\n"):
    """A sheet as a workbook program exports it: rows of (label, cells)."""
    quote = lambda c: f'"{c}"' if any(x in c for x in ',"\n') else c
    line = lambda i, lab, cells: ",".join([str(i), quote(lab), "", "", '"x, y"', "", *map(quote, cells)])
    head = ",".join(['"Unnamed, 0"', "Parameter", "a", "b", "c", "d", *[f'"Day, {d}"' for d in dates]])
    body = [("Parameter", dates), ("Target", ["9"] * len(dates)), ("", ["Mon"] * len(dates)), *rows]
    return end.join([head, *[line(i, lab, cells) for i, (lab, cells) in enumerate(body)]]) + end


def test_sheets_of_3_40_and_400_dates_in_one_folder(spark, tmp_path):
    want, start = {}, D(2020, 2, 27)
    for name, n in (("Toys", 3), ("Home & Kitchen", 40), ("a+b 100%", 400), ("Food", 5)):
        dates = [(start + dt.timedelta(days=i)).isoformat() for i in range(n)]
        orders = [str(i * n) for i in range(n)]
        (tmp_path / f"{name}.csv").write_text(raw_sheet(dates, [("Orders, placed", orders), ("Note", ['say ""hi"", you'] * (n - 1))],
                                                        "\r\n" if n == 40 else "\n"))
        if name != "Food":
            want |= {(name, d): (o, 'say "hi", you' if i < n - 1 else "x") for i, (d, o) in enumerate(zip(dates, orders, strict=True))}
    cells = sheets.raw_cells(spark, str(tmp_path))
    assert cells.columns == ["sheet", "row_no", "label", "pos", "value"]
    out = sheets.normalise_cells(cells)
    assert out.columns == ["sheet", "order_date", "dow", "Note", "Orders, placed"]
    assert {(r[0], r[1]): (r[4], r[3]) for r in out.collect()} == want
    assert {r.dow for r in out.filter("order_date = '2020-02-27'").collect()} == {"Thu"}


def test_raw_sheet_cases(spark, tmp_path):
    (tmp_path / "T.csv").write_text("")                                # no line at all
    (tmp_path / "H.csv").write_text("i,Parameter,a,b,c,d,x\n")         # a header alone
    (tmp_path / "B.csv").write_text("﻿i,l,a,b,c,d,x,y\n0,Parameter,,,,,2020-09-01\n1,T,,,,,1,1\n\n2,,,,,,\n3,\"two\nlines\",,,,,\"5\",\n4,,,,,,,\n")
    cells = sheets.raw_cells(spark, str(tmp_path))
    got = sheets.normalise_cells(cells, labels=["two\nlines"]).collect()
    assert [tuple(r) for r in got] == [("B", "2020-09-01", "Tue", "5")]
    assert sheets.raw_cells(spark, str(tmp_path), skip=("B",)).count() == 0
    (tmp_path / "X.csv").write_text("i,l,a,b,c,d,x\n0,Parameter,,,,,soon\n3,Orders,,,,,5\n")
    with pytest.raises(Exception, match="not a date in X"):
        sheets.normalise_cells(sheets.raw_cells(spark, str(tmp_path)), labels=["Orders"]).collect()
