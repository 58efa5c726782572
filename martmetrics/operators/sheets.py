"""Report workbooks: one sheet per entity, parameters down the rows, one column per date.

Re-aimed for Spark: a workbook is a folder of per-sheet CSV files (``sheet=<name>/``
partitions), each with ``row_no, label, v1..vN``. ``normalise_sheets`` turns them into
one long table — a row per (sheet, date) with one column per parameter — which is an
``unpivot`` of the date columns followed by a pivot on the labels. No cell is lost: the width
comes from the files, all labels are kept by default, and repeated labels or bad dates raise.

``raw_cells`` reads workbooks as they are exported: one CSV file a sheet, each as wide as it
happens to be, with the columns of the report layout around the dates. Its files go straight
to long cells, without a schema as wide as the widest sheet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import SKIP_SHEETS
from ..functions.scalars import iso_date, weekday_label
from ..sources.files import write_csv

DATE_LABEL = "Parameter"   # the row whose cells are the dates
BLANK_FILL = "x"           # blank cells (and the blank-labelled weekday row) read as this


#: Columns of a raw sheet that the report layout does not use: the index column and the four
#: columns between the label (position 1) and the first date (position 6).
DROPPED_POSITIONS = (0, 2, 3, 4, 5)


def sheet_schema(n_dates: int) -> T.StructType:
    return schemas.sheet(n_dates)


def drop_positions(df: DataFrame, positions: Sequence[int] = DROPPED_POSITIONS) -> DataFrame:
    """``df`` without the columns at ``positions``."""
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if i not in set(positions)])


def from_raw(raw: DataFrame, sheet: str, positions: Sequence[int] = DROPPED_POSITIONS) -> DataFrame:
    """A raw sheet (``row_no`` first, then the workbook's own columns in order) as
    (sheet, row_no, label, v1..vN): unused positions go, the first column left is the label."""
    body = drop_positions(raw.drop("row_no"), positions).columns
    if not body:
        raise ValueError("no label column is left")
    return raw.select(F.lit(sheet).alias("sheet"), F.col("row_no").cast("int").alias("row_no"),
                      F.col(f"`{body[0]}`").cast("string").alias("label"),
                      *[F.col(f"`{c}`").cast("string").alias(f"v{i}") for i, c in enumerate(body[1:], 1)])


def header_width(spark: SparkSession, path: str) -> int:
    """The number of date columns of the widest sheet, from the files' header lines."""
    names = F.split("value", ",")
    widest = (spark.read.text(path).filter(F.col("value").rlike('^"?row_no"?,'))
              .agg(F.max(F.size(names) - 2)).first()[0])
    return int(widest or 0)


def read_sheets(spark: SparkSession, path: str, n_dates: int | None = None) -> DataFrame:
    """All sheets of a workbook folder as (sheet, row_no, label, v1..vN); the sheet name is
    the ``sheet=<name>`` partition of each file, typed as text via the schema. N is the width
    of the widest header (narrower sheets read NULL there); ``n_dates`` sets it by hand."""
    schema = sheet_schema(header_width(spark, path) if n_dates is None else n_dates).add("sheet", T.StringType())
    df = spark.read.option("header", True).schema(schema).csv(path)
    return df.select("sheet", *[c for c in df.columns if c != "sheet"])


def kept_sheets(sheets: DataFrame, skip: Sequence[str] = SKIP_SHEETS) -> DataFrame:
    return sheets.filter(~F.col("sheet").isin(list(skip)))


def _one_cell(value: str, *names: str) -> Column:
    """The single cell of a group; a second one raises when the plan runs."""
    where = F.concat_ws(", ", *[F.max(F.col(n).cast("string")) for n in names])
    repeated = F.raise_error(F.concat(F.lit("repeated label in a sheet: "), where)).cast("string")
    return F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.max(value))


_RECORD = r'(?:[^"\r\n]++|"[^"]*+(?:""[^"]*+)*+")++'
_FIELD = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*+)'


def _sheet_name(path: str) -> Column:
    """``sheet=<name>/`` in the file's path, or else the file's name without its ending."""
    p = F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(p, r"/sheet=([^/]+)/[^/]*$", 1)
    unescaped = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))  # the folder's own escapes
    return F.when(folder != "", unescaped).otherwise(F.regexp_extract(p, r"([^/]+?)(?:\.[^./]*)?$", 1))


def raw_cells(spark: SparkSession, path: str, positions: Sequence[int] = DROPPED_POSITIONS,
              skip: Sequence[str] = SKIP_SHEETS) -> DataFrame:
    """(sheet, row_no, label, pos, value): the cells of a folder of raw sheets, one CSV file each.

    A sheet's first line is its header, which the report does not use; data rows count from 0.
    Columns at ``positions`` are left out, the first column left is the label, the others are
    the date columns, numbered from 1. Each file is read whole, as one row (a sheet is bounded
    by what a workbook can hold), and cut into records and cells by quotes, commas and line
    ends, so quoted cells may hold commas, quotes and line ends. Rows shorter than their sheet
    have blank cells at the end; an empty cell is NULL. Files of any widths stand side by side.
    """
    unused = F.array(*[F.lit(p) for p in positions]) if positions else F.array().cast("array<int>")
    whole = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    files = whole.select(_sheet_name("_metadata.file_path").alias("sheet"),
                         F.regexp_extract_all(F.ltrim(F.col("value"), F.lit("\ufeff")), F.lit(_RECORD), F.lit(0)).alias("records"))
    files = files.filter(~F.col("sheet").isin(list(skip)))

    def unquoted(c: Column) -> Column:
        inner = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(c.startswith('"'), inner).otherwise(c), F.lit(""))

    def kept(record: Column) -> Column:
        cells = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_FIELD), F.lit(1))
        return F.filter(F.transform(cells, lambda c, i: F.struct(i.alias("i"), unquoted(c).alias("v"))),
                        lambda c: ~F.array_contains(unused, c["i"]))

    rows = files.select("sheet", F.transform("records", kept).alias("rows"))
    width = F.array_max(F.transform("rows", F.size))
    data = rows.select("sheet", width.alias("width"), F.posexplode(F.slice("rows", 2, F.greatest(F.size("rows"), F.lit(1)))))
    padded = F.concat(F.transform("col", lambda c: c["v"]),
                      F.array_repeat(F.lit(None).cast("string"), F.col("width") - F.size("col")))
    cells = data.select("sheet", F.col("pos").alias("row_no"), padded.alias("cells"))
    return (cells.filter(F.size("cells") > 0)
            .select("sheet", "row_no", F.get("cells", F.lit(0)).alias("label"),
                    F.posexplode(F.slice("cells", F.lit(2), F.size("cells"))))
            .select("sheet", "row_no", "label", (F.col("pos") + 1).alias("pos"), F.col("col").alias("value")))


def normalise_cells(cells: DataFrame, labels: Sequence[str] | None = None, skip: Sequence[str] = SKIP_SHEETS,
                    drop_row: int = 1, csv_path: str | None = None) -> DataFrame:
    """``normalise_sheets`` for long cells (sheet, row_no, label, pos, value), as ``raw_cells`` gives them."""
    s = kept_sheets(cells, skip).filter(F.coalesce(F.col("row_no") != drop_row, F.lit(True)))
    # a row without label and cells is no row
    some = F.max(F.when(F.coalesce("label", "value").isNotNull(), 1)).over(Window.partitionBy("sheet", "row_no"))
    s = s.withColumn("_some", some).filter("_some = 1")
    long = s.select("sheet", F.col("pos").cast("string").alias("pos"), F.coalesce(F.col("label"), F.lit(BLANK_FILL)).alias("label"),
                    F.coalesce(F.col("value"), F.lit(BLANK_FILL)).alias("value"))
    return _normalise(long, labels, csv_path)


def normalise_sheets(sheets: DataFrame, labels: Sequence[str] | None = None, skip: Sequence[str] = SKIP_SHEETS,
                     drop_row: int = 1, csv_path: str | None = None) -> DataFrame:
    """(sheet, order_date, dow, <label>...) — one row per sheet and date column.

    Blank cells read as 'x'; the sheet's second data row (``row_no == drop_row``) and rows
    and columns without any cell are dropped; the ``Parameter`` row becomes ``order_date``
    (ISO text) and the blank-labelled row ``dow``, recomputed from the date. A column with
    cells whose ``Parameter`` is blank or not an ISO date raises, and so does a label that a
    sheet repeats. ``labels``: the parameters to keep; None keeps all (the pivot then looks
    them up in one job). ``csv_path``: also write the result there as CSV.
    """
    vcols = [c for c in sheets.columns if c.startswith("v") and c[1:].isdigit()]
    s = kept_sheets(sheets, skip).filter(F.coalesce(F.col("row_no") != drop_row, F.lit(True)))
    if vcols:
        s = s.filter(F.coalesce("label", *vcols).isNotNull())
    s = s.select("sheet", F.coalesce(F.col("label"), F.lit(BLANK_FILL)).alias("label"),
                 *[F.coalesce(F.col(c), F.lit(BLANK_FILL)).alias(c) for c in vcols])
    return _normalise(s.unpivot(["sheet", "label"], vcols, "pos", "value"), labels, csv_path)


def _normalise(long: DataFrame, labels: Sequence[str] | None, csv_path: str | None) -> DataFrame:
    """The pivot on the labels, from (sheet, pos, label, value) without NULLs."""
    cells = long.groupBy("sheet", "pos", "label").agg(_one_cell("value", "sheet", "label").alias("value"))
    if labels is None:
        names = sorted(r[0] for r in long.select("label").distinct().collect())   # the rows of a report
    else:
        names = list(dict.fromkeys(labels))
    names = [x for x in names if x not in (DATE_LABEL, BLANK_FILL)]
    at = F.max(F.when(F.col("label") == DATE_LABEL, F.col("value"))).alias("_date")
    filled = F.max(F.when((F.col("label") != DATE_LABEL) & (F.col("value") != BLANK_FILL), 1)).alias("_filled")
    wide = cells.groupBy("sheet", "pos").agg(
        at, filled, *[F.max(F.when(F.col("label") == x, F.col("value"))).alias(x) for x in names])
    d = F.coalesce("_date", F.lit(BLANK_FILL))
    iso = d.rlike(r"^\d{4}-\d{2}-\d{2}([ T].*)?$")
    wrong = F.raise_error(F.concat_ws(" ", F.lit("not a date in"), "sheet", "pos", d)).cast("string")
    empty = (d == BLANK_FILL) & F.col("_filled").isNull()
    day = F.to_date(F.when(iso, F.substring(d, 1, 10)).otherwise(wrong))
    out = wide.filter(~empty).select("sheet", iso_date(day).alias("order_date"), weekday_label(day).alias("dow"),
                                     *[F.col(f"`{x}`") for x in names])
    if csv_path is not None:
        write_csv(out, csv_path)
    return out


def to_sheets(long: DataFrame, n_dates: int) -> DataFrame:
    """Lay long (sheet, pos, row_no, label, value) cells out as sheet rows
    (sheet, row_no, label, v1..vN) — the inverse of ``normalise_sheets``' unpivot. Two cells
    at one place raise."""
    cells = long.groupBy("sheet", "row_no", "label", "pos").agg(
        _one_cell("value", "sheet", "label", "pos").alias("value"))
    return cells.groupBy("sheet", "row_no", "label").agg(
        *[F.max(F.when(F.col("pos") == i, F.col("value"))).alias(f"v{i}") for i in range(1, n_dates + 1)])
