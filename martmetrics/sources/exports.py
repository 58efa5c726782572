"""CSV exports read by column name, with a side table of the lines that do not parse.

An export is one file or a folder of files, each with a header line of its own. Columns are
found by the names in that header, so files whose columns are in another order give the same
rows, extra columns are ignored, and a missing column raises. Spark's CSV reader binds by
place; here the header of every file is read first (one short read a file, in threads, as
file listing does it) and files of equal headers are scanned together under a schema in the
order of their own header.

A line is bad if it has more or fewer cells than its header (an unquoted ``1,234.50``), or a
cell that is not empty and does not convert to its column's type. Bad lines are not among
``rows``; ``bad`` has them whole, with the file they came from and what is wrong. Both are
lazy scans of the same files.

Cases: an empty cell is NULL; an empty file or folder gives no rows; a header that names a
wanted column twice raises; names are compared without regard to case and to blanks around
them; a quoted cell may hold separators, and line ends too with ``multi_line``.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LINE = "_line"
BAD_SCHEMA = "file string, line string, reason string"


@dataclass(frozen=True)
class Export:
    """``rows``: the parsed rows under the wanted schema; ``bad``: (file, line, reason)."""

    rows: DataFrame
    bad: DataFrame


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files under ``path`` (hidden ones and markers left out)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, folders = [], [root]
    if fs.getFileStatus(root).isFile():
        return [root.toString()]
    while folders:
        for st in fs.listStatus(folders.pop()):
            name = st.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if st.isDirectory():
                folders.append(st.getPath())
            elif st.getLen() > 0:
                found.append(st.getPath().toString())
    return sorted(found)


def _first_line(spark: SparkSession, file: str) -> str:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def headers(spark: SparkSession, path: str, sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """The files under ``path`` by their header."""
    files = _files(spark, path)
    with ThreadPoolExecutor(16) as pool:
        first = list(pool.map(lambda f: _first_line(spark, f), files))
    out: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file, line in zip(files, first, strict=True):
        cells = next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep), [])
        out[tuple(c.strip() for c in cells)].append(file)
    return dict(out)


def _places(header: tuple[str, ...], schema: T.StructType, file: str) -> list[int]:
    names = [c.lower() for c in header]
    places = []
    for f in schema.fields:
        n = names.count(f.name.lower())
        if n != 1:
            raise ValueError(f"column {f.name} is {'missing from' if not n else 'repeated in'} the header of {file}")
        places.append(names.index(f.name.lower()))
    return places


def read_export(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", multi_line: bool = False,
                **options: str) -> Export:
    """The export under ``path`` bound to ``schema`` by header names (see the module)."""
    rows: list[DataFrame] = []
    bad: list[DataFrame] = []
    for header, files in sorted(headers(spark, path, sep).items()):
        places = _places(header, schema, files[0])
        typed = {p: f.dataType for p, f in zip(places, schema.fields, strict=True)}
        cells = [f"c{i}" for i in range(len(header))]
        read = T.StructType([T.StructField(c, typed.get(i, T.StringType())) for i, c in enumerate(cells)]
                            + [T.StructField(_LINE, T.StringType())])
        scan = (spark.read.schema(read).option("header", True).option("enforceSchema", True).option("sep", sep)
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
                # with pruning on, the parser would not see that a line has too few or too many cells
                .option("columnPruning", False).option("multiLine", multi_line).options(**options).csv(files))
        # always true; it makes every query convert every wanted cell, whichever columns are asked for, so that
        # a line is bad or not whatever is selected (and Spark refuses a scan of the bad-line column alone)
        whole = scan.filter(F.xxhash64(*[F.col(f"c{p}") for p in places]) >= F.lit(-(1 << 63)))
        wanted = [F.col(f"c{p}").alias(f.name) for p, f in zip(places, schema.fields, strict=True)]
        rows.append(whole.filter(F.col(_LINE).isNull()).select(*wanted))
        texts = T.StructType([T.StructField(c, T.StringType()) for c in cells] + [T.StructField("_over", T.StringType())])
        again = F.from_csv(F.col(_LINE), texts.simpleString()[7:-1].replace(":", " "),
                           {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_over"})
        wrong = F.concat_ws(", ", *[F.when(F.col(f"_t.c{p}").isNotNull() & F.col(f"c{p}").isNull(), F.lit(f.name))
                                    for p, f in zip(places, schema.fields, strict=True)])
        count: Column = F.col("_t._over").isNotNull()
        bad.append(whole.filter(F.col(_LINE).isNotNull()).withColumn("file", F.col("_metadata.file_name"))
                   .withColumn("_t", again)
                   .select("file", F.col(_LINE).alias("line"),
                           F.when(count, F.lit("number of cells")).otherwise(F.concat(F.lit("not of its type: "), wrong))
                           .alias("reason")))
    if not rows:
        return Export(spark.createDataFrame([], schema), spark.createDataFrame([], BAD_SCHEMA))
    for more in range(1, len(rows)):
        rows[0], bad[0] = rows[0].unionByName(rows[more]), bad[0].unionByName(bad[more])
    return Export(rows[0], bad[0])
