"""Exact dedup by content sort.

Rows are range-partitioned (Spark samples the splitters) and sorted externally by the
normalised bytes: their first bytes, then their SHA-256, then the order of preference.
Equal texts end up adjacent, and one scan compares every text with its neighbour in full.
Preference and id are part of the range key, so a group of copies that holds a third of
all rows spreads over as many partitions as it needs. Only the first and the last run of
a partition can continue in another one; those at most two fragments a partition are
merged by their full text.

Only a bounded prefix and the digest are sampled and compared, so the driver never holds
whole texts and a shared boilerplate opening does not make a hot range.

Cases: a null text counts as empty, texts of white space equal the empty text, a null id
sorts after every other id, repeated rows are separate rows of one group of which one is
kept, an empty table gives an empty result; carried columns keep their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stage_table

WHITE = "[\\x20\\x09-\\x0D]+"
_DELETE = b" \t\n\x0b\x0c\r"
#: Characters of the normalised text that lead the sort key.
KEY_CHARS = 32


def _scan(carry: tuple[str, ...], types: list[pa.Field]):
    """Marks the runs of equal texts in one sorted partition, batch by batch.

    Neighbours are compared in full. The open run is held until it ends, with its digest and
    carried columns only; a run inside one partition is bounded by the partition.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("keep_id", pa.int64()),
                        ("group_size", pa.int64()), ("head", pa.bool_()), ("part", pa.int32()),
                        ("edge_text", pa.binary()), ("edge", pa.bool_()), *types])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        text_held: bytes | None = None
        first_run = True

        def emit(rows, keep, size, head, text, edge):
            n = rows.num_rows
            cols = [rows.column("doc_id"), rows.column("text_sha256"), keep, pa.array(size, pa.int64()),
                    pa.array(head, pa.bool_()), pa.array(np.full(n, part, np.int32)),
                    pa.array([text] + [None] * (n - 1) if edge else [None] * n, pa.binary()),
                    pa.array(np.full(n, edge)), *[rows.column(c) for c in carry]]
            return pa.RecordBatch.from_arrays(cols, schema=schema)

        def close(edge: bool) -> Iterator[pa.RecordBatch]:
            n, keep, head = sum(p.num_rows for p in held), held[0].column("doc_id").slice(0, 1), True
            for p in held:
                m = p.num_rows
                flags = np.zeros(m, dtype=bool)
                flags[0] = head
                yield emit(p, keep.take(pa.array(np.zeros(m, np.int64))), np.full(m, n), flags,
                           text_held if edge and head else None, edge)
                head = False

        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [(t or "").encode("utf-8", "surrogatepass").translate(None, _DELETE)
                     for t in batch.column("_text").to_pylist()]
            rows = batch.select(["doc_id", "text_sha256", *carry])
            starts = [i for i, t in enumerate(texts) if t != (texts[i - 1] if i else text_held)]
            if not starts:
                held.append(rows)
                continue
            if starts[0]:
                held.append(rows.slice(0, starts[0]))
            if held:
                yield from close(first_run)
                first_run, held = False, []
            if len(starts) > 1 and first_run:  # the very first run of the partition ends in its first batch
                held, text_held = [rows.slice(0, starts[1])], texts[0]
                yield from close(True)
                first_run, held, starts = False, [], starts[1:]
            if len(starts) > 1:
                s = np.asarray(starts)
                sizes = np.diff(s)
                inner = rows.slice(starts[0], starts[-1] - starts[0])
                head = np.zeros(inner.num_rows, dtype=bool)
                head[s[:-1] - s[0]] = True
                keep = rows.column("doc_id").take(pa.array(np.repeat(s[:-1], sizes)))
                yield emit(inner, keep, np.repeat(sizes, sizes), head, None, False)
            held, text_held = [rows.slice(starts[-1])], texts[-1]
        if held:
            yield from close(True)

    return scan


def _grouped(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...]) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and ``carry`` as _c0, _c1, ... of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = F.regexp_replace(text, WHITE, "")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("_text"),
                       F.char_length(text).alias("_points"), F.substring(norm, 1, KEY_CHARS).alias("_key"),
                       F.sha2(norm.cast("binary"), 256).alias("text_sha256"),
                       *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry) if c != text_col])
    order = [F.col("_key"), F.col("text_sha256"), F.col("_points").desc(), F.col("doc_id").asc_nulls_last()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # the text is moved once, also where it is carried
    held = tuple("_text" if c == text_col else f"_c{i}" for i, c in enumerate(carry))
    out = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text_sha256", T.StringType()),
        T.StructField("keep_id", T.LongType()), T.StructField("group_size", T.LongType()),
        T.StructField("head", T.BooleanType()), T.StructField("part", T.IntegerType()),
        T.StructField("edge_text", T.BinaryType()), T.StructField("edge", T.BooleanType()),
        *[T.StructField(h, docs.schema[c].dataType) for h, c in zip(held, carry, strict=True)]])
    seen = ordered.select("doc_id", "text_sha256", "_text", *[h for h in held if h != "_text"])
    marked = stage_table(seen.mapInArrow(_scan(held, list(to_arrow_schema(out))[8:]), out), "content-runs")
    # at most two fragments a partition; only those whose text continues elsewhere matter
    edges = (marked.filter("edge AND head")
             .groupBy("edge_text", F.col("text_sha256").alias("_sha"))
             .agg(F.min(F.struct("part", "keep_id")).alias("_best"), F.sum("group_size").alias("_total"),
                  F.count(F.lit(1)).alias("_pieces"))
             .filter("_pieces > 1")
             .select("_sha", "_best", "_total"))
    whole = marked.drop("edge_text").join(F.broadcast(edges), F.col("edge") & (F.col("text_sha256") == F.col("_sha")),
                                          "left")
    return whole.select(
        "doc_id", F.when(F.col("_sha").isNotNull(), F.col("_best.keep_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("_total", "group_size").alias("group_size"),
        (F.col("head") & (F.col("part") == F.coalesce(F.col("_best.part"), F.col("part")))).alias("kept"),
        "text_sha256", *[F.col(h).alias(f"_c{i}") for i, h in enumerate(held)])


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Of equal texts, the row with the most code points, then the smallest id, is kept.
    """
    return _grouped(docs, id_col, text_col, ())


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    names = tuple(docs.columns)
    kept = _grouped(docs, id_col, text_col, names).filter("kept")
    return kept.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)])
