"""CSV exports by header name, stage tables that change in one step, scratch folders."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martmetrics.sources import exports, files, stage

WANTED = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("day", T.DateType()),
                       T.StructField("amount", T.DecimalType(18, 2)), T.StructField("name", T.StringType())])
D = dt.date


def write(path, name, text):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text, encoding="utf-8")


# -- exports --------------------------------------------------------------------------------

def test_another_column_order_gives_the_same_rows(spark, tmp_path):
    rows = [("1", "2020-01-01", "5.00", "a"), ("2", "", "1234.50", ""), ("3", "2020-01-03", "", "b, c")]
    cells = lambda r, order: ",".join(f'"{r[i]}"' if "," in r[i] else r[i] for i in order)
    names = ("order_id", "day", "amount", "name")
    want = sorted([(1, D(2020, 1, 1), Decimal("5.00"), "a"), (2, None, Decimal("1234.50"), None),
                   (3, D(2020, 1, 3), None, "b, c")], key=str)
    for k, order in enumerate(((0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1))):
        folder = tmp_path / str(k)
        write(folder, "x.csv", "\n".join([cells(names, order), *[cells(r, order) for r in rows]]) + "\n")
        got = exports.read_export(spark, str(folder), WANTED)
        assert sorted(map(tuple, got.rows.collect()), key=str) == want
        assert got.rows.columns == list(names) and got.bad.count() == 0


def test_bad_lines_are_returned_whatever_is_selected(spark, tmp_path):
    write(tmp_path, "a.csv", 'order_id,amount,day,name\n1,5.00,2020-01-01,"a, b"\n2,bad,2020-01-01,x\n'
                             "3,1,234.50,2020-01-02,y\n4,,2020-13-01,z\n5,2,,\nx,y,2020-01-01,\n")
    write(tmp_path, "b.csv", '﻿Name, DAY ,extra,AMOUNT,order_id\n"q",2020-02-01,e,10,7\nq,2020-02-02\n'
                             '"",2020-02-03,e,"1,234.50",8\n')
    write(tmp_path, "_SUCCESS", "not,a,header\n")
    write(tmp_path, "empty.csv", "")
    got = exports.read_export(spark, str(tmp_path), WANTED)
    assert sorted(r.order_id for r in got.rows.collect()) == [1, 5, 7, 8]
    assert got.rows.count() == 4 and got.rows.select("name").count() == 4
    assert sorted(r.order_id for r in got.rows.select("order_id").collect()) == [1, 5, 7, 8]
    assert got.rows.filter("order_id = 8").first().amount == Decimal("1234.50")
    assert sorted(map(tuple, got.bad.collect())) == [
        ("a.csv", "2,bad,2020-01-01,x", "not of its type: amount"),
        ("a.csv", "3,1,234.50,2020-01-02,y", "number of cells"),
        ("a.csv", "4,,2020-13-01,z", "not of its type: day"),
        ("a.csv", "x,y,2020-01-01,", "not of its type: order_id, amount"),
        ("b.csv", "q,2020-02-02", "number of cells")]
    assert got.bad.count() == 5


@pytest.mark.parametrize("header, what", [("order_id,day,name", "amount is missing"),
                                          ("order_id,day,name,amount,Amount", "amount is repeated")])
def test_a_missing_or_repeated_column_raises(spark, tmp_path, header, what):
    write(tmp_path, "a.csv", header + "\n")
    with pytest.raises(ValueError, match=what):
        exports.read_export(spark, str(tmp_path), WANTED)


def test_empty_exports_and_quoted_line_ends(spark, tmp_path):
    assert exports.read_export(spark, str(tmp_path), WANTED).rows.count() == 0
    write(tmp_path, "a.csv", "order_id;day;amount;name\n")
    got = exports.read_export(spark, str(tmp_path), WANTED, sep=";")
    assert got.rows.count() == 0 and got.bad.count() == 0
    write(tmp_path, "a.csv", 'order_id;day;amount;name\n1;;;"two\nlines; one cell"\n')
    got = exports.read_export(spark, str(tmp_path / "a.csv"), WANTED, sep=";", multi_line=True)
    assert [tuple(r) for r in got.rows.collect()] == [(1, None, None, "two\nlines; one cell")]


# -- stage tables ---------------------------------------------------------------------------

def months(spark, rows):
    return spark.createDataFrame(rows, "k bigint, v string, month int")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def folders(base):
    return sorted(n for n in os.listdir(base) if n.startswith("v-"))


def test_a_writer_that_dies_half_way_changes_nothing(spark, tmp_path):
    base = str(tmp_path / "t")
    first = [(1, "a", 202001), (2, "b", 202002)]
    held = stage.publish(months(spark, first), base, ["month"])
    dying = months(spark, [(k, "x", 202001 + k % 3) for k in range(40)]).repartition(8).withColumn(
        "v", F.when(F.col("k") == 33, F.raise_error(F.lit("disk full")).cast("string")).otherwise(F.col("v")))
    for write_it in (stage.publish, stage.publish_partitions):
        with pytest.raises(Exception, match="disk full"):
            write_it(dying, base, ["month"])
        assert rows_of(stage.read(spark, base)) == rows_of(held) == first
    assert len(folders(base)) == 3
    assert len(stage.vacuum(spark, base)) == 0                         # their writers may still be at work
    assert len(stage.vacuum(spark, base, unfinished_s=0)) == 2
    assert rows_of(stage.read(spark, base)) == first


def test_readers_keep_their_version_until_it_is_removed(spark, tmp_path):
    base = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        stage.read(spark, base)
    one = stage.publish(months(spark, [(1, "a", 1)]), base, about={"upto": "2020-01-31"})
    two = stage.publish(months(spark, [(2, "b", 1)]), base)
    assert rows_of(one) == [(1, "a", 1)] and rows_of(two) == [(2, "b", 1)]
    assert [v.about for v in stage.versions(spark, base)] == [{"upto": "2020-01-31"}, {}]
    stage.publish(months(spark, []), base)
    assert stage.vacuum(spark, base) != []
    assert rows_of(two) == [(2, "b", 1)] and rows_of(stage.read(spark, base)) == []
    assert len(stage.versions(spark, base)) == 2


def test_partition_overwrite_replaces_only_its_partitions(spark, tmp_path):
    base = str(tmp_path / "t")
    stage.publish(months(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "n", None)]), base, ["month"])
    stage.publish_partitions(months(spark, [(9, "z", 2), (8, "y", 5), (7, "m", None)]), base, ["month"])
    t = stage.publish_partitions(months(spark, [(6, "w", 2)]), base, ["month"])
    assert rows_of(t) == rows_of(months(spark, [(1, "a", 1), (3, "c", 3), (6, "w", 2), (8, "y", 5), (7, "m", None)]))
    assert t.columns == ["k", "v", "month"]
    plan = t.filter("month = 3")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(month") >= 1
    stage.publish_partitions(months(spark, []), base, ["month"])
    assert rows_of(stage.read(spark, base)) == rows_of(t)
    assert len(stage.vacuum(spark, base, keep=1)) == 0                 # all three folders are still in use
    with pytest.raises(ValueError, match="other columns"):
        stage.publish_partitions(spark.range(1).selectExpr("id AS k", "1 AS month"), base, ["month"])
    with pytest.raises(ValueError, match="partitioned by"):
        stage.publish_partitions(months(spark, [(1, "a", 1)]), base, ["v"])


def test_a_marker_cut_short_is_passed_over(spark, tmp_path):
    base = str(tmp_path / "t")
    stage.publish(months(spark, [(1, "a", 1)]), base)
    (tmp_path / "t" / "_versions" / "000000000002.json").write_text('{"schema": ')
    assert rows_of(stage.read(spark, base)) == [(1, "a", 1)]
    assert rows_of(stage.publish(months(spark, [(2, "b", 1)]), base)) == [(2, "b", 1)]
    assert [v.number for v in stage.versions(spark, base)] == [1, 3]


def test_the_second_of_two_writers_starts_over_from_the_first(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    stage.publish(months(spark, [(1, "a", 1), (2, "b", 2)]), base, ["month"])
    claim, between = stage._claim, []

    def raced(s, b, number, marker):
        if not between:
            between.append(1)
            stage.publish_partitions(months(spark, [(9, "z", 1)]), base, ["month"])
        return claim(s, b, number, marker)

    monkeypatch.setattr(stage, "_claim", raced)
    t = stage.publish_partitions(months(spark, [(8, "y", 2)]), base, ["month"])
    assert rows_of(t) == [(8, "y", 2), (9, "z", 1)]


def test_scratch_folders_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "checkpoint_dir", lambda _: str(tmp_path))
    monkeypatch.setattr(files, "_SCRATCH", {})
    df = spark.range(3)
    t = files.materialise(df, "x")
    files.write_csv(df, files.scratch_path(spark, "y"))
    old = tmp_path / "martmetrics" / "scratch" / "app-gone"
    (old / "x-1").mkdir(parents=True)
    assert files.remove_old_scratch(spark) == [] and old.exists()
    assert files.remove_old_scratch(spark, 0) == ["app-gone"] and not old.exists()
    assert t.count() == 3
    files.release_scratch()
    assert os.listdir(tmp_path / "martmetrics" / "scratch") == []


def test_materialise_keeps_the_version_before(spark, tmp_path):
    base = str(tmp_path / "t")
    tables = [files.materialise(spark.range(k), "x", base) for k in (3, 4, 5)]
    assert tables[1].count() == 4 and tables[2].count() == 5
    assert len(folders(base)) == 2
    assert json.loads((tmp_path / "t" / "_versions" / "000000000003.json").read_text())["partition_by"] == []
