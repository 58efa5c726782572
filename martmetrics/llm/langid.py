"""Language identification by word-first backoff.

Every known word adds its log frequency in each language. A word not in the table backs
off: if any of its character 5-grams is known, the mean log frequency of those counts,
else its 4-grams, and so on down to single characters. The language with the largest sum
wins; the score is its share after a softmax over the languages.

The model is fitted on a bounded sample of the labelled training fold (about
``train_docs`` documents of each language, chosen by a hash of the id) and keeps at most
``max_words`` words and ``max_grams`` n-grams of each length, so its size has a bound that
does not grow with the input. The languages take turns to choose them, each by its own
counts, so one with few documents gets as many as the others, or all that it has. The
sample's counts are aggregated by Spark.

Cases: ``und`` with score 0 for a null text, a text without letters, or when nothing could
be learned; a text with letters of which no n-gram is known gets the most frequent
training language; long texts are scored whole, in segments; repeated rows and null ids
are scored like others; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out
from .textkit import code_points, hashed_words, letter_table, mix, segments, small_batches, values_of

TRAIN_DOCS = 3000
MAX_WORDS = 60_000
MAX_GRAMS = 20_000
MAX_N = 5
SEGMENT = 1_000_000
UNKNOWN = "und"
_U = np.uint64


def _words(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points, starts, ends and hashes of the words of lower-cased parts, and part numbers."""
    lowered = [p.lower() for p in parts]
    codes = code_points(lowered)
    starts, ends, hashes = hashed_words(codes, letter_table()[codes])
    bounds = np.cumsum(np.fromiter((len(p) + 1 for p in lowered), np.int64, len(lowered)))
    return codes, starts, ends, hashes, np.searchsorted(bounds, starts, side="right")


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... (counts[i] of them) for every i, in one array."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def _gram_hashes(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hash of the n-gram at each position) for n from 1 to MAX_N."""
    v = values_of(codes)
    h = v
    for n in range(1, MAX_N + 1):
        if n > 1:
            h = h[:-1] * _U(0x9FB21C651E98DF25) + v[n - 1:]
        yield n, mix(h ^ _U(n))


def _count(parts: list[str]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, hashes, counts); kind 0 is words, n is n-grams inside words."""
    codes, starts, ends, hashes, _ = _words(parts)
    if not len(starts):
        return []
    uniq, first, times = np.unique(hashes, return_index=True, return_counts=True)
    size = ends[first] - starts[first]
    buf = codes[_spread(starts[first], size)]
    begin = np.cumsum(size) - size
    out = [(0, uniq, times)]
    for n, h in _gram_hashes(buf):
        k = np.maximum(size - n + 1, 0)
        if k.sum():
            at = _spread(begin, k)
            g, inv = np.unique(h[at], return_inverse=True)
            out.append((n, g, np.bincount(inv, weights=np.repeat(times, k)).astype(np.int64)))
    return out


class Model:
    """Sorted hash tables with a row of log frequencies per language."""

    def __init__(self, langs: list[str], tables: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        self.tables = tables

    def _look(self, kind: int, h: np.ndarray) -> np.ndarray:
        """Row numbers in a table, -1 where unknown."""
        keys = self.tables[kind][0] if kind in self.tables else np.zeros(0, np.uint64)
        if not len(keys):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, at, -1)

    def _unseen(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A row of log frequencies for each unseen word, by the longest n-grams known."""
        out = np.zeros((len(starts), len(self.langs)))
        size = ends - starts
        buf = codes[_spread(starts, size)]
        begin = np.cumsum(size) - size
        grams = dict(_gram_hashes(buf))
        todo = np.arange(len(starts))
        for n in range(MAX_N, 0, -1):
            k = np.maximum(size[todo] - n + 1, 0)
            if not k.sum():
                continue
            word = np.repeat(np.arange(len(todo)), k)
            row = self._look(n, grams[n][_spread(begin[todo], k)])
            hit = row >= 0
            known = np.bincount(word[hit], minlength=len(todo))
            lp = self.tables[n][1][row[hit]] if hit.any() else None
            done = known > 0
            if done.any():
                for j in range(len(self.langs)):
                    sums = np.bincount(word[hit], weights=lp[:, j], minlength=len(todo))
                    out[todo[done], j] = sums[done] / known[done]
            todo = todo[~done]
            if not len(todo):
                break
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        total = np.zeros((len(texts), len(self.langs)))
        seen = np.zeros(len(texts), dtype=bool)
        for idx, parts in segments(texts, SEGMENT):
            docs = np.asarray(idx)
            codes, starts, ends, hashes, part = _words(parts)
            if not len(starts):
                continue
            which = docs[part]
            seen[which] = True
            if not self.langs:
                continue
            uniq, first, inv = np.unique(hashes, return_index=True, return_inverse=True)
            rows = self._look(0, uniq)
            lp = np.zeros((len(uniq), len(self.langs)))
            known = rows >= 0
            if known.any():
                lp[known] = self.tables[0][1][rows[known]]
            if not known.all():
                lp[~known] = self._unseen(codes, starts[first[~known]], ends[first[~known]])
            low = which.min()
            for j in range(len(self.langs)):
                s = np.bincount(which - low, weights=lp[inv, j])
                total[low: low + len(s), j] += s
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        top = total.max(axis=1, keepdims=True)
        share = 1.0 / np.exp(total - top).sum(axis=1)
        best = total.argmax(axis=1)
        return ([self.langs[b] if s else UNKNOWN for b, s in zip(best, seen, strict=True)], np.where(seen, share, 0.0))


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, max_words: int = MAX_WORDS,
          max_grams: int = MAX_GRAMS, text_col: str = "text", lang_col: str = "lang",
          id_col: str = "doc_id") -> Model:
    """Fit on rows with a language that are not held out (see ``common.held_out``)."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                       F.col(id_col).alias("doc_id")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # one row per language name
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([], {})
    langs = sorted(sizes, key=lambda k: (-sizes[k], k))
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, train_docs / sizes[k]))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(draw < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                for _, parts in segments(texts, SEGMENT):
                    for kind, h, c in _count(parts):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(h), kind, np.int32)), pa.array(h.view(np.int64)),
                             pa.array([lang] * len(h), pa.string()), pa.array(c.astype(np.int64))],
                            names=["kind", "h", "lang", "c"])

    counts = (sample.mapInArrow(count, "kind int, h bigint, lang string, c bigint")
              .groupBy("kind", "h", "lang").agg(F.sum("c").alias("c"))
              .withColumn("turn", F.row_number().over(Window.partitionBy("kind", "lang").orderBy(F.desc("c"), "h")))
              .groupBy("kind", "h").agg(F.min("turn").alias("turn"), F.sum("c").alias("total"),
                                        F.collect_list(F.struct("lang", "c")).alias("by")))
    # the sample is bounded, so are these six partitions
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("turn", F.desc("total"), "h"))
    limit = F.when(F.col("kind") == 0, max_words).otherwise(max_grams)
    kept = (counts.withColumn("r", rank).filter(F.col("r") <= limit)
            .select("kind", "h", F.explode("by").alias("x")).select("kind", "h", "x.lang", "x.c").toArrow())
    kind, h = kept.column("kind").to_numpy(), kept.column("h").to_numpy().view(np.uint64)
    number = {k: i for i, k in enumerate(langs)}
    lang = np.array([number[x] for x in kept.column("lang").to_pylist()], dtype=np.int64)
    c = kept.column("c").to_numpy().astype(np.float64)
    tables = {}
    for k in range(MAX_N + 1):
        m = kind == k
        keys, inv = np.unique(h[m], return_inverse=True)
        if not len(keys):
            continue
        n = np.zeros((len(keys), len(langs)))
        np.add.at(n, (inv, lang[m]), c[m])
        tables[k] = (keys, np.log((n + 0.1) / (n.sum(axis=0) + 0.1 * len(keys))).astype(np.float32))
    return Model(langs, tables)


def identify(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; only the text is scored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            lang, score = model.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")
