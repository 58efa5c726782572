"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document's features are its distinct words (hashed into ``WORD_SLOTS`` slots, damped
counts, unit length), one slot for the bin of each structure statistic (sizes, character
classes, repetition of words and lines) and one for each metadata column. Pairwise
interactions have low-rank weights and are scored in linear time with the identity
sum_{i<j} <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2.

The model is fitted on the driver from at most about ``train_docs`` labelled rows of the
training fold, chosen by a hash of the id (a documented bound); Spark computes their
features, and scores every whole text. Labels, language, source and id are never features.

Cases: a null text counts as empty and gets a score like any text; without labelled rows
every score is 0.5, with one class only it is that class's smoothed share; a missing,
null or non-numeric metadata column uses a slot of its own; long texts are read whole, in
segments; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .textkit import code_points, hashed_words, letter_table, segments, small_batches

WORD_SLOTS = 1 << 17
BINS = 12
FACTORS = 8
TRAIN_DOCS = 9000
THRESHOLD = 0.7
SEGMENT = 1_000_000
SLICE = 3_000_000
METADATA = ("n_chars",)

STATISTICS = ("chars", "words", "lines", "mean_word", "letters", "digits", "upper", "spaces", "symbols",
              "stops", "distinct_words", "repeats", "top_word", "distinct_lines", "line_words", "long_words")
_COUNTS = 10  # additive counts kept for each document


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    at, size, first = 0, 0, 0
    for at, t in enumerate(texts):
        n = len(t or "")
        if size and size + n > SLICE:
            yield first, texts[first:at]
            first, size = at, 0
        size += n
    if texts:
        yield first, texts[first:]


_kinds: dict[str, np.ndarray] = {}


def _classes() -> dict[str, np.ndarray]:
    if not _kinds:
        for name, test in (("digit", str.isdigit), ("upper", str.isupper), ("space", str.isspace)):
            _kinds[name] = np.fromiter((test(chr(i)) for i in range(0x110000)), dtype=bool, count=0x110000)
        _kinds["stop"] = np.zeros(0x110000, dtype=bool)
        _kinds["stop"][[ord(c) for c in ".,;:?!'\"。、，；：？！．"]] = True
    return _kinds


@dataclass
class Features:
    """Rows of (slot, value) word features and a row of raw statistics for each document."""
    start: np.ndarray
    slot: np.ndarray
    value: np.ndarray
    stats: np.ndarray


def features(texts: list[str | None]) -> Features:
    """Features of whole texts."""
    n = len(texts)
    counts = np.zeros((n, _COUNTS))
    keys, times = [], []
    line_n, line_u = np.zeros(n), np.zeros(n)
    distinct, top = np.zeros(n), np.zeros(n)
    classes, letters = _classes(), letter_table()
    lines_seen: list[np.ndarray] = []
    for idx, parts in segments(texts, SEGMENT):
        docs = np.asarray(idx)
        codes = code_points(parts)
        sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
        bounds = np.cumsum(sizes)
        begin = bounds - sizes
        is_letter = letters[codes]
        space = classes["space"][codes]
        upper, digit, stop = classes["upper"][codes], classes["digit"][codes], classes["stop"][codes]
        symbol = ~(is_letter | space | digit | stop)

        def per_part(mask, begin=begin):
            return np.add.reduceat(mask, begin, dtype=np.int64)

        lower = codes + np.where(codes < 128, upper, False) * np.uint32(32)
        ws, we, wh = hashed_words(lower, is_letter)
        part = np.searchsorted(bounds, ws, side="right")
        ls, le, lh = hashed_words(lower, lower != 10)
        lpart = np.searchsorted(bounds, ls, side="right")
        add = np.zeros((len(parts), _COUNTS))
        for j, mask in enumerate((is_letter, digit, upper, space, symbol, stop)):
            add[:, j] = per_part(mask)
        add[:, 6] = sizes - 1
        add[:, 7] = np.bincount(part, minlength=len(parts))
        same = (wh[1:] == wh[:-1]) & (part[1:] == part[:-1])
        add[:, 8] = np.bincount(part[1:][same], minlength=len(parts))
        add[:, 9] = np.bincount(part[we - ws > 20], minlength=len(parts))
        np.add.at(counts, docs, add)
        lines_seen.append(np.stack([docs[lpart].astype(np.uint64), lh]))
        # 2**45 distinct words before two documents could mix; the slot is what the model sees
        key = (docs[part].astype(np.uint64) << np.uint64(40)) | (wh >> np.uint64(24))
        k, c = np.unique(key, return_counts=True)
        keys.append(k)
        times.append(c)
    key, inv = np.unique(np.concatenate(keys), return_inverse=True) if keys else (np.zeros(0, np.uint64), np.zeros(0, int))
    time = np.bincount(inv, weights=np.concatenate(times), minlength=len(key)) if len(key) else np.zeros(0)
    doc = (key >> np.uint64(40)).astype(np.int64)
    if len(key):
        distinct = np.bincount(doc, minlength=n).astype(float)
        np.maximum.at(top, doc, time)
    if lines_seen:
        lines = np.concatenate(lines_seen, axis=1)
        line_n = np.bincount(lines[0].astype(np.int64), minlength=n).astype(float)
        pairs = np.unique(lines, axis=1) if lines.shape[1] < 2 else _unique_pairs(lines)
        line_u = np.bincount(pairs[0].astype(np.int64), minlength=n).astype(float)
    value = 1.0 + np.log(time) if len(time) else time
    norm = np.sqrt(np.bincount(doc, weights=value * value, minlength=n)) if len(time) else np.ones(n)
    value = value / norm[doc] if len(time) else value
    chars, words = np.maximum(counts[:, 6], 1), np.maximum(counts[:, 7], 1)
    stats = np.stack([
        np.log2(counts[:, 6] + 1), np.log2(counts[:, 7] + 1), np.log2(line_n + 1), counts[:, 0] / words,
        counts[:, 0] / chars, counts[:, 1] / chars, counts[:, 2] / chars, counts[:, 3] / chars, counts[:, 4] / chars,
        counts[:, 5] / chars, distinct / words, counts[:, 8] / words, top / words, line_u / np.maximum(line_n, 1),
        words / np.maximum(line_n, 1), counts[:, 9] / words], axis=1)
    start = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))) if len(doc) else np.zeros(n + 1, np.int64)
    slot = (key & np.uint64(WORD_SLOTS - 1)).astype(np.int64)
    return Features(start, slot, value.astype(np.float32), stats)


def _unique_pairs(pairs: np.ndarray) -> np.ndarray:
    order = np.lexsort((pairs[1], pairs[0]))
    s = pairs[:, order]
    new = np.concatenate(([True], (s[:, 1:] != s[:, :-1]).any(axis=0)))
    return s[:, new]


class Model:
    def __init__(self, edges: np.ndarray, meta_edges: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray):
        self.edges, self.meta_edges, self.bias, self.w, self.v = edges, meta_edges, bias, w, v

    def rows(self, f: Features, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, slot, value) with the binned statistics and metadata after each row's words."""
        n = len(f.stats)
        extra = f.stats.shape[1] + meta.shape[1]
        sizes = np.diff(f.start) + extra
        start = np.concatenate(([0], np.cumsum(sizes)))
        slot = np.zeros(start[-1], dtype=np.int32)
        value = np.full(start[-1], 0.5, dtype=np.float32)
        ends = start[1:, None] - np.arange(extra, 0, -1)
        mask = np.ones(len(slot), dtype=bool)
        mask[ends.ravel()] = False
        slot[mask], value[mask] = f.slot, f.value
        cols = []
        for j in range(f.stats.shape[1]):
            cols.append(WORD_SLOTS + j * BINS + np.searchsorted(self.edges[j], f.stats[:, j], side="right"))
        base = WORD_SLOTS + f.stats.shape[1] * BINS
        for j in range(meta.shape[1]):
            b = np.searchsorted(self.meta_edges[j], meta[:, j], side="right")
            cols.append(base + j * (BINS + 1) + np.where(np.isnan(meta[:, j]), BINS, b))
        slot[ends.ravel()] = np.stack(cols, axis=1).ravel() if n else 0
        return start, slot, value

    def raw(self, start: np.ndarray, slot: np.ndarray, value: np.ndarray) -> np.ndarray:
        if len(start) < 2:
            return np.zeros(0)
        vx = self.v[slot] * value[:, None]
        s = np.add.reduceat(vx, start[:-1], axis=0)
        pair = 0.5 * ((s * s).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), start[:-1]))
        return self.bias + np.add.reduceat(self.w[slot] * value, start[:-1]) + pair

    def score(self, texts: list[str | None], meta: np.ndarray) -> np.ndarray:
        out = []
        for first, part in _slices(texts):
            r = self.rows(features(part), meta[first: first + len(part)])
            out.append(1.0 / (1.0 + np.exp(-np.clip(self.raw(*r), -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def _slots(meta: int) -> int:
    return WORD_SLOTS + len(STATISTICS) * BINS + meta * (BINS + 1)


def _constant(p: float, meta: int) -> Model:
    n = _slots(meta)
    return Model(np.zeros((len(STATISTICS), 0)), np.zeros((meta, 0)), float(np.log(p / (1 - p))),
                 np.zeros(n, np.float32), np.zeros((n, FACTORS), np.float32))


def _edges(x: np.ndarray) -> np.ndarray:
    """Bin edges of each column from its quantiles."""
    q = np.linspace(0, 1, BINS + 1)[1:-1]
    return np.stack([np.quantile(c[~np.isnan(c)], q) if (~np.isnan(c)).any() else np.zeros(len(q)) for c in x.T]) \
        if x.shape[1] else np.zeros((0, len(q)))


def fit(f: Features, meta: np.ndarray, label: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.1,
        decay: float = 1e-5, seed: int = 7) -> Model:
    """Logistic loss, Adagrad over mini-batches."""
    rng = np.random.default_rng(seed)
    share = (label.sum() + 1) / (len(label) + 2)
    n = _slots(meta.shape[1])
    model = Model(_edges(f.stats), _edges(meta), float(np.log(share / (1 - share))), np.zeros(n, np.float32),
                  rng.normal(0, 0.05, (n, FACTORS)).astype(np.float32))
    start, slot, value = model.rows(f, meta)
    gw, gv, gb = np.full(n, 1e-6, np.float32), np.full((n, FACTORS), 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), batch):
            pick = order[at: at + batch]
            size = start[pick + 1] - start[pick]
            ends = np.cumsum(size)
            pos = np.repeat(start[pick] - (ends - size), size) + np.arange(ends[-1])
            s, x = slot[pos], value[pos]
            b = np.concatenate(([0], ends))
            row = np.repeat(np.arange(len(pick)), size)
            vx = model.v[s] * x[:, None]
            sums = np.add.reduceat(vx, b[:-1], axis=0)
            y = model.raw(b, s, x)
            g = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - label[pick]).astype(np.float32)
            uniq, inv = np.unique(s, return_inverse=True)
            dw = np.bincount(inv, weights=g[row] * x, minlength=len(uniq)).astype(np.float32) / len(pick)
            each = (g[row] * x)[:, None] * (sums[row] - vx)
            by = np.argsort(inv, kind="stable")
            first = np.searchsorted(inv[by], np.arange(len(uniq)))
            dv = np.add.reduceat(each[by], first, axis=0) / len(pick)
            dw += decay * model.w[uniq]
            dv += decay * model.v[uniq]
            gw[uniq] += dw * dw
            gv[uniq] += dv * dv
            model.w[uniq] -= rate * dw / np.sqrt(gw[uniq])
            model.v[uniq] -= 0.5 * rate * dv / np.sqrt(gv[uniq])
            db = float(g.mean())
            gb += db * db
            model.bias -= rate * db / gb ** 0.5
    return model


def _meta_columns(docs: DataFrame, metadata: tuple[str, ...]) -> list:
    numeric = ("bigint", "int", "smallint", "tinyint", "double", "float")
    types = dict(docs.dtypes)
    out = []
    for m in metadata:
        ok = types.get(m) in numeric
        c = F.log2(F.greatest(F.col(m).cast("double"), F.lit(0.0)) + 1) if ok else F.lit(None).cast("double")
        out.append(F.when(~F.isnan(c), c).alias(f"_m_{m}"))
    return out


def _meta(batch: pa.RecordBatch, first: int, count: int) -> np.ndarray:
    cols = [batch.column(first + j).to_numpy(zero_copy_only=False).astype(np.float64) for j in range(count)]
    return np.stack(cols, axis=1) if cols else np.zeros((batch.num_rows, 0))


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, metadata: tuple[str, ...] = METADATA,
          text_col: str = "text", id_col: str = "doc_id") -> Model:
    """Fit on labelled rows that are not held out (see ``common.held_out``)."""
    k = len(metadata)
    known = (labels.filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("_label")))
    total = known.count()
    if not total:
        return _constant(0.5, k)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    ids = known.filter(draw < min(1.0, train_docs / total)).withColumnRenamed("doc_id", "_id")
    meta = _meta_columns(docs, metadata)
    # about train_docs ids: a bound that does not grow with the input
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *meta).join(F.broadcast(ids), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts, m, y = batch.column(0).to_pylist(), _meta(batch, 3, k), batch.column(1)
            for first, part in _slices(texts):
                f = features(part)
                cut = list(zip(f.start[:-1], f.start[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [y.slice(first, len(part)), batch.column(2).slice(first, len(part)),
                     pa.array([f.slot[a:b].astype("<i4").tobytes() for a, b in cut], pa.binary()),
                     pa.array([f.value[a:b].astype("<f4").tobytes() for a, b in cut], pa.binary()),
                     pa.array([r.tobytes() for r in np.ascontiguousarray(f.stats, "<f8")], pa.binary()),
                     pa.array([r.tobytes() for r in np.ascontiguousarray(m[first: first + len(part)], "<f8")], pa.binary())],
                    names=["label", "key", "slot", "value", "stats", "meta"])

    got = (rows.select("_text", "_label", F.xxhash64("_text").alias("_key"), *[c.alias(f"_f{i}") for i, c in enumerate(
        [F.col(f"_m_{m}") for m in metadata])])
        .mapInArrow(run, "label double, key bigint, slot binary, value binary, stats binary, meta binary").toArrow())
    if not got.num_rows:
        return _constant(0.5, k)
    label = got.column("label").to_numpy()
    if label.min() == label.max():
        return _constant(float((label.sum() + 1) / (len(label) + 2)), k)
    # collection order must not matter: sort by content
    order = np.lexsort((label, got.column("key").to_numpy()))

    def flat(name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
        """The packed column in that order: where each row starts, and all values."""
        col = got.column(name).combine_chunks()
        col = col.take(pa.array(order))
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        at = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4).astype(np.int64)
        data = np.frombuffer(col.buffers()[2], np.uint8)[at[0]:at[-1]]
        return (at - at[0]) // np.dtype(kind).itemsize, data.view(kind)

    start, slot = flat("slot", "<i4")
    f = Features(start, slot, flat("value", "<f4")[1], flat("stats", "<f8")[1].reshape(len(order), -1))
    m = flat("meta", "<f8")[1].reshape(len(order), -1) if k else np.zeros((len(order), 0))
    model = fit(f, m, label[order])
    del f, m, slot, got
    pa.default_memory_pool().release_unused()
    return model


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",), metadata: tuple[str, ...] = METADATA,
          text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``carry`` columns and the score (0 to 1, higher is better) for every row."""
    k = len(metadata)
    rows = docs.select(F.col(text_col).alias("_text"), *_meta_columns(docs, metadata),
                       *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            s = model.score(batch.column(0).to_pylist(), _meta(batch, 1, k))
            kept = [batch.column(1 + k + i) for i in range(len(carry))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(s, pa.float64())], names=[f"_c{i}" for i in range(len(carry))] + ["_s"])

    from pyspark.sql import types as T
    out = T.StructType([*[T.StructField(f"_c{i}", docs.schema[c].dataType) for i, c in enumerate(carry)],
                        T.StructField("_s", T.DoubleType())])
    got = rows.mapInArrow(run, out)
    return got.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], F.col("_s").alias(score_col))
