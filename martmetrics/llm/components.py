"""Connected components of an edge table, by local contraction and alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces a partition's edges by (node, smallest node of its local component)."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    out = [(x, find(x)) for x in root]
    out = np.array([e for e in out if e[0] != e[1]], dtype=np.int64).reshape(-1, 2)
    for at in range(0, len(out), 65536):
        yield pa.RecordBatch.from_arrays([pa.array(out[at:at + 65536, 0]), pa.array(out[at:at + 65536, 1])],
                                         names=["a", "b"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge table (a, b); component is its smallest node.

    Large-star and small-star steps (Kiveris et al.) halve the paths each round. Rounds end
    when the edges no longer change; each round's edges are a written table.
    """
    def distinct(e: DataFrame) -> DataFrame:
        return e.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def checksum(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = stage_table(distinct(edges).mapInArrow(_contract, "a bigint, b bigint"), "components")
    mark = checksum(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = distinct(both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = distinct(large.join(low, "a").select("b", "m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                         .unionByName(low.select("a", F.col("m").alias("b"))))
        now = stage_table(small.mapInArrow(_contract, "a bigint, b bigint"), "components")
        before, mark = mark, checksum(now)
        if mark == before:
            break
    else:
        raise RuntimeError("connected components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def grow_components(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of the edges behind ``comp`` and of ``links`` (a, b) together.

    Only links between different components count: they are the edges of a graph whose
    nodes are components, which is empty or small once most links are known.
    """
    e = links
    for c in ("a", "b"):
        e = (e.join(comp.select(F.col("node").alias(c), F.col("component").alias("_to")), c, "left")
             .withColumn(c, F.coalesce("_to", c)).drop("_to"))
    e = stage_table(e.filter("a <> b").distinct(), "components")
    if e.isEmpty():
        return comp
    merged = stage_table(components(e), "components")
    moved = comp.join(merged.select(F.col("node").alias("component"), F.col("component").alias("_to")),
                      "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    return stage_table(moved.unionByName(merged.join(comp, "node", "left_anti")), "components")
