"""Looking at a table: a profile of all columns in one pass, its shape, its first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole numbers, decimals, dates and timestamps compare as this.
_NUMBER = "decimal(38, 6)"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _number(c: Column, t: T.DataType) -> Column | None:
    """A value that orders as the column does, for types that are numbers at heart."""
    if isinstance(t, (*_WHOLE, T.DecimalType)):
        return c.cast(_NUMBER)
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast(_NUMBER)
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c).cast(_NUMBER)
    if isinstance(t, T.BooleanType):
        return c.cast("int").cast(_NUMBER)
    return None


def _text(x: Column, t: T.DataType) -> Column:
    """The text of ``_number``'s value, as the column's own cast to text gives it."""
    if isinstance(t, _WHOLE):
        return x.cast("decimal(38, 0)").cast("string")
    if isinstance(t, T.DecimalType):
        return x.cast(f"decimal(38, {t.scale})").cast("string")
    if isinstance(t, T.DateType):
        return F.date_from_unix_date(x.cast("int")).cast("string")
    if isinstance(t, T.TimestampType):
        return F.timestamp_micros(x.cast("bigint")).cast("string")
    return (x == 1).cast("string")


def profile(df: DataFrame) -> DataFrame:
    """One row a column: its place, name, type, rows, nulls, exact distinct values (NULL not
    counted), smallest and largest value as text.

    Every row becomes one (column, value) entry a column; entries are counted by column and
    value first, partially in each task, so a value that fills a third of the table is one
    entry a task, and the counts are then folded by column. Whatever the number of columns,
    the table is read once and shuffled once. Numbers, dates and times are compared as such,
    doubles as doubles (NaN is the largest), everything else as text. An empty table gives
    rows of zeros and NULLs. Decimals are compared to six places.
    """
    fields = df.schema.fields
    null = {"num": F.lit(None).cast(_NUMBER), "dbl": F.lit(None).cast("double")}
    entries = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        number = _number(c, f.dataType)
        is_double = isinstance(f.dataType, (T.FloatType, T.DoubleType))
        text = c if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) else F.to_json(F.struct(c))
        entries.append(F.struct(F.lit(i).alias("i"), F.when(c.isNotNull(), text.cast("string")).alias("value"),
                                (null["num"] if number is None else number).alias("num"),
                                (c.cast("double") if is_double else null["dbl"]).alias("dbl")))
    each = (df.select(F.inline(F.array(*entries))).groupBy("i", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.min("num").alias("num"), F.min("dbl").alias("dbl")))
    none = df.sparkSession.range(len(fields)).select(  # every column has a row, whatever the table holds
        F.col("id").cast("int").alias("i"), F.lit(None).cast("string").alias("value"), F.lit(0).cast("bigint").alias("n"),
        null["num"].alias("num"), null["dbl"].alias("dbl"))
    g = each.unionByName(none).groupBy("i").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count("value").alias("distinct_values"), *[f(c).alias(f"{name}_{c}") for name, f in (("min", F.min), ("max", F.max))
                                                      for c in ("num", "dbl", "value")])

    def shown(end: str) -> Column:
        out = F.lit(None).cast("string")
        for i, f in enumerate(fields):
            if _number(F.lit(None), f.dataType) is not None:
                x = _text(F.col(f"{end}_num"), f.dataType)
            else:
                x = F.col(f"{end}_{'dbl' if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else 'value'}").cast("string")
            out = F.when(F.col("i") == i, x).otherwise(out)
        return out

    names = F.array(*[F.lit(f.name) for f in fields])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])
    return g.select((F.col("i") + 1).alias("place"), names[F.col("i")].alias("column_name"), types[F.col("i")].alias("type"),
                    "rows", "nulls", "distinct_values", shown("min").alias("min_value"), shown("max").alias("max_value"))


def shape(df: DataFrame) -> DataFrame:
    """One row: rows and columns of a table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (ascending, NULLs first): each task keeps its own
    ``n``, so no sort of the table takes place. Ties beyond ``order`` are settled by all other
    columns that can be ordered, so reruns agree."""
    rest = [f.name for f in df.schema.fields if f.name not in order and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return df.orderBy(*[F.asc_nulls_first(f"`{c}`") for c in (*order, *rest)]).limit(n)
