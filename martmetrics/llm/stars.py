"""Connected components by alternating large-star and small-star.

Large-star links every larger neighbour of a node to the smallest node of its neighbourhood,
small-star every smaller neighbour and the node itself (Kiveris et al., 2014); both keep the
components, and their alternation ends in stars around each component's smallest node. The
edges of a round are a written table. Rounds work on as many partitions as the edges need,
and each partition first replaces its own edges by those from its nodes to the smallest node
of their local component, which halves the number of rounds at least and ends small tables
at once; a partition holds about ``EDGES`` edges, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table

EDGES = 250_000
MAX_ROUNDS = 60
_EDGE = "a bigint, b bigint"


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
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


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _settle(edges: DataFrame, parts: int) -> tuple[DataFrame, tuple]:
    """The edges after a contraction on ``parts`` partitions, as a written table, with their number and a checksum."""
    now = stage_table(edges.coalesce(parts).mapInArrow(_local_stars, _EDGE), "stars")
    return now, tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _parts(rows: int) -> int:
    return max(1, -(-rows // EDGES))


def star_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge table (a, b); a component is its smallest node."""
    now = stage_table(_directed(edges), "stars")
    parts = _parts(now.count())
    now, mark = _settle(now, parts)
    for _ in range(MAX_ROUNDS):
        if parts == 1:  # all edges have met in one partition
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _directed(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _directed(large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                          .unionByName(least.select("a", F.col("m").alias("b"))))
        before, parts = mark, _parts(mark[0])
        now, mark = _settle(small, parts)
        if mark == before:
            break
    else:
        raise RuntimeError("connected components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
