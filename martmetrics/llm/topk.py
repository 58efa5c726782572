"""Exact top-k by inner product with a pivot-distance index.

Index: every vector is keyed by its nearest pivot and the distance to it, sorted by that
key over the whole table (range partitions), and packed into annulus blocks of at most
``BLOCK`` vectors of one pivot. Pivots are chosen farthest-first from a bounded sample;
every row is indexed.

Search: queries sorted by the same key form chunks that need similar annuli. Each chunk
first visits the annuli its own distances fall into, which gives every query a k-th score.
Then the annuli expand: for a query q and an annulus [lo, hi] around pivot p the triangle
inequality bounds the distance of any member x from below by gap = max(0, |q-p| - hi,
lo - |q-p|), so <q, x> = (|q|^2 + |x|^2 - |q-x|^2) / 2 is at most
(|q|^2 + max|x|^2 - gap^2) / 2. Annuli whose bound is below the k-th score of every query
of a chunk are never read; ties are kept, so the result equals brute force.

Components are floor(scale * x). Scores are exact integers: double arithmetic below 2**53,
Python integers above (clipped to 64 bits).

Cases: vectors that are null or hold null or non-finite components, and rows without an
id, take no part; shorter vectors count as padded with zeros; an id that occurs twice is
one query (its smallest vector) and never its own answer; empty tables give an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table

SCALE = 256
EVERY = 50
K = 5
BLOCK = 1024
CHUNK = 256
PIVOTS = 32
SAMPLE = 4096
_EXACT = float(1 << 53)


def _quantise(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id and the packed components (little-endian doubles) of the rows that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ids, out = [], []
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.values.slice(lists.offsets[0].as_py(), int(sizes.sum()))
            nulls = flat.is_null().to_numpy(zero_copy_only=False)
            x = np.floor(flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            bad = nulls | ~np.isfinite(x)
            at = np.concatenate(([0], np.cumsum(sizes)))
            wrong = np.concatenate(([0], np.cumsum(bad)))
            valid = batch.column(0).is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(
                zero_copy_only=False) & (wrong[at[1:]] == wrong[at[:-1]])
            names = batch.column(0).to_pylist()
            for i in np.flatnonzero(valid):
                ids.append(names[i])
                out.append(x[at[i]:at[i + 1]].astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())],
                                             names=["vec_id", "v"])

    return rows.mapInArrow(run, "vec_id bigint, v binary")


def _matrix(packed: list[bytes], dim: int) -> np.ndarray:
    m = np.zeros((len(packed), dim))
    for i, b in enumerate(packed):
        row = np.frombuffer(b, "<f8")
        m[i, :len(row)] = row
    return m


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2.0 * (x @ p.T)
    return np.sqrt(np.maximum(d, 0.0))


def choose_pivots(vectors: DataFrame, dim: int, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Farthest-first pivots of a sample of at most ``sample`` vectors (smallest id hashes)."""
    got = [r["v"] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).collect()]
    x = _matrix(got, dim)
    if not len(x):
        return np.zeros((0, dim))
    chosen = [0]
    near = _distances(x, x[:1])[:, 0]
    while len(chosen) < min(pivots, len(x)):
        k = int(near.argmax())
        if near[k] <= 0:
            break
        chosen.append(k)
        near = np.minimum(near, _distances(x, x[k:k + 1])[:, 0])
    return x[chosen]


def _keyed(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    dim = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = _distances(_matrix(batch.column(1).to_pylist(), dim), pivots)
            p = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p.astype(np.int32)), pa.array(d[np.arange(len(p)), p])],
                names=["vec_id", "v", "pivot", "dist"])

    return vectors.mapInArrow(run, "vec_id bigint, v binary, pivot int, dist double")


def _packed(keyed: DataFrame, dim: int, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one pivot that are neighbours in distance."""
    order = ["pivot", "dist", "vec_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        ids: list[int] = []
        vs: list[bytes] = []
        ds: list[float] = []
        now = None

        def block() -> pa.RecordBatch:
            nonlocal made
            by = np.argsort(np.asarray(ids), kind="stable")  # ids ascend in a block: ties go to the first
            m = _matrix(vs, dim)[by]
            out = [base + made, now, min(ds), max(ds), float((m * m).sum(1).max()) ** 0.5,
                   np.asarray(ids, dtype="<i8")[by].tobytes(), m.astype("<f8").tobytes()]
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64(),
                                                        pa.binary(), pa.binary()), strict=True)],
                names=["block", "pivot", "lo", "hi", "norm", "ids", "m"])

        for batch in batches:
            for i, v, p, d in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (p != now or len(ids) >= size):
                    yield block()
                    ids, vs, ds = [], [], []
                now = p
                ids.append(i)
                vs.append(v)
                ds.append(d)
        if ids:
            yield block()

    return (keyed.repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(run, "block bigint, pivot int, lo double, hi double, norm double, ids binary, m binary"))


def _scores(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact integer inner products, as int64."""
    if np.abs(q).max(initial=0) * np.abs(m).max(initial=0) * max(q.shape[1], 1) < _EXACT:
        return (q @ m.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in q], dtype=object) @ np.array(
        [[int(x) for x in r] for r in m], dtype=object).T
    lim = (1 << 63) - 1
    return np.array([[max(-lim, min(lim, int(x))) for x in r] for r in exact], dtype=np.int64).reshape(len(q), len(m))


_NONE = -(1 << 63)


def _visit(pairs: DataFrame, dim: int, k: int, pivots: np.ndarray) -> DataFrame:
    """The k best of each (chunk, block) pair, for queries whose bound reaches their k-th score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for qids, qm, kth, pivot, lo, hi, norm, ids, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                qid = np.frombuffer(qids, "<i8")
                q = np.frombuffer(qm, "<f8").reshape(len(qid), dim)
                floor = np.frombuffer(kth, "<i8")
                vid = np.frombuffer(ids, "<i8")
                x = np.frombuffer(m, "<f8").reshape(len(vid), dim)
                use = np.flatnonzero(_bound(q, _distances(q, pivots[pivot:pivot + 1])[:, 0], lo, hi, norm) >= floor)
                if not len(use):
                    continue
                s = _scores(q[use], x)
                s[qid[use][:, None] == vid[None, :]] = _NONE
                best = np.argsort(-s.astype(np.float64) if np.abs(s).max() < _EXACT else _descending(s),
                                  axis=1, kind="stable")[:, :k]
                got = np.take_along_axis(s, best, axis=1)
                r, c = np.nonzero((got != _NONE) & (got >= floor[use][:, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qid[use][r]), pa.array(vid[best[r, c]]), pa.array(got[r, c])],
                    names=["query_id", "vec_id", "score"])

    return pairs.select("qids", "qm", "kth", "pivot", "lo", "hi", "norm", "ids", "m").mapInArrow(
        run, "query_id bigint, vec_id bigint, score bigint")


def _descending(s: np.ndarray) -> np.ndarray:
    return ~s  # ascending order of the complement, without overflow


def _bound(q: np.ndarray, to_pivot: np.ndarray, lo: float, hi: float, norm: float) -> np.ndarray:
    """Upper bound of the score of any vector of an annulus, with room for rounding."""
    gap = np.maximum(0.0, np.maximum(to_pivot - hi, lo - to_pivot))
    qq = (q * q).sum(1)
    size = qq + norm * norm + 1.0
    return np.minimum((qq + norm * norm - gap * gap) / 2.0, np.sqrt(qq) * norm) + 1e-9 * size + 1e-3


def _needs(chunks: DataFrame, dim: int, pivots: np.ndarray, reach: np.ndarray | None) -> DataFrame:
    """(chunk, pivot, near, far): the distances from a pivot at which a chunk needs annuli.

    Without ``reach`` these are the chunk's own distances from its own pivot; with it (the
    largest norm around each pivot) every distance whose bound can still matter.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, home, qids, qm, kth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(qids) // 8
                q = np.frombuffer(qm, "<f8").reshape(n, dim)
                d = _distances(q, pivots)
                if reach is None:
                    rows = [(home, d[:, home].min(), d[:, home].max())]
                else:
                    qq = (q * q).sum(1)
                    floor = np.frombuffer(kth, "<i8").astype(np.float64)
                    size = qq[:, None] + reach[None, :] ** 2
                    r2 = size - 2.0 * (floor[:, None] - 1e-9 * (size + 1.0) - 1e-3)
                    ok = r2 >= 0
                    r = np.sqrt(np.maximum(r2, 0.0)) + 1e-6
                    rows = [(p, (d[:, p] - r[:, p])[ok[:, p]].min(), (d[:, p] + r[:, p])[ok[:, p]].max())
                            for p in range(len(pivots)) if reach[p] >= 0 and ok[:, p].any()]
                if rows:
                    p, a, b = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk] * len(rows), pa.int64()), pa.array(p, pa.int32()), pa.array(a, pa.float64()),
                         pa.array(b, pa.float64())], names=["chunk", "pivot", "near", "far"])

    return chunks.select("chunk", "home", "qids", "qm", "kth").mapInArrow(
        run, "chunk bigint, pivot int, near double, far double")


def _with_floor(chunks: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Chunks with the k-th score found so far of each query in place of the old one."""
    floors = best.filter(F.col("rank") == k).select(F.col("query_id").alias("q"), "score")
    each = (chunks.select("chunk", F.explode("names").alias("q")).join(floors, "q", "left")
            .groupBy("chunk").agg(F.collect_list(F.struct("q", "score")).alias("f")))  # at most CHUNK a group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for qids, f in zip(batch.column("qids").to_pylist(), batch.column("f").to_pylist(), strict=True):
                known = {x["q"]: x["score"] for x in f if x["score"] is not None}
                out.append(np.array([known.get(int(q), _NONE) for q in np.frombuffer(qids, "<i8")], "<i8").tobytes())
            keep = [batch.column(c) for c in ("chunk", "home", "names", "qids", "qm")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(out, pa.binary())],
                                             names=["chunk", "home", "names", "qids", "qm", "kth"])

    return chunks.drop("kth").join(each, "chunk").mapInArrow(
        run, "chunk bigint, home int, names array<bigint>, qids binary, qm binary, kth binary")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, every: int = EVERY, k: int = K, scale: int = SCALE, pivots: int = PIVOTS,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every id divisible by ``every``."""
    rows = stage_table(_quantise(vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")), scale),
        "topk-vectors")
    dim = (rows.agg(F.max(F.octet_length("v"))).first()[0] or 0) // 8
    p = choose_pivots(rows, dim, pivots)
    spark = vectors.sparkSession
    if not len(p):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    blocks = stage_table(_packed(_keyed(rows, p), dim, BLOCK), "topk-blocks")
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    start = np.array([_NONE], "<i8").tobytes()

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = [np.frombuffer(x, "<i8") for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("block"), b.column("pivot"), pa.array([x.tolist() for x in q], pa.list_(pa.int64())),
                 b.column("ids"), b.column("m"), pa.array([start * len(x) for x in q], pa.binary())],
                names=["chunk", "home", "names", "qids", "qm", "kth"])

    chunks = stage_table(_packed(_keyed(asked, p), dim, CHUNK).mapInArrow(
        names, "chunk bigint, home int, names array<bigint>, qids binary, qm binary, kth binary"), "topk-chunks")
    directory = blocks.select("block", "pivot", "lo", "hi")

    def pairs(need: DataFrame) -> DataFrame:
        return (need.join(directory, "pivot").filter((F.col("hi") >= F.col("near")) & (F.col("lo") <= F.col("far")))
                .select("chunk", "block"))

    def visit(at: DataFrame, now: DataFrame) -> DataFrame:
        return _visit(at.join(now, "chunk").join(blocks, "block"), dim, k, p)

    first = stage_table(pairs(_needs(chunks, dim, p, None)), "topk-first")
    near = stage_table(_ranked(visit(first, chunks), k), "topk-near")
    reach = np.full(len(p), -1.0)
    for r in blocks.groupBy("pivot").agg(F.max("norm").alias("n")).collect():  # one row a pivot
        reach[r["pivot"]] = r["n"]
    now = stage_table(_with_floor(chunks, near, k), "topk-floors")
    rest = pairs(_needs(now, dim, p, reach)).join(first, ["chunk", "block"], "left_anti")
    found = near.drop("rank").unionByName(visit(rest, now))
    return _ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
