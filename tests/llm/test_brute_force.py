"""Scores and fits against plain loops, and the pipeline's stages on odd tables."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from martmetrics.llm import langid, quality

SF = "/root/testdata/sf0.001"


# -- word-first backoff -----------------------------------------------------------------

def words_of(text):
    out, now = [], []
    for c in (text or "").lower() + " ":
        if c.isalpha():
            now.append(c)
        elif now:
            out.append("".join(now))
            now = []
    return out


def test_language_scores_equal_a_plain_backoff(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    counts, size = defaultdict(lambda: defaultdict(Counter)), Counter()
    for i, text, lang in rows:
        if lang is None or text is None or zlib.crc32(str(i).encode()) % 4 == 2:
            continue
        size[lang] += 1
        for w in words_of(text):
            counts[0][w][lang] += 1
            for n in range(1, 6):
                for k in range(len(w) - n + 1):
                    counts[n][w[k:k + n]][lang] += 1
    langs = sorted(size, key=lambda k: (-size[k], k))
    total = {n: Counter({x: sum(c[x] for c in t.values()) for x in langs}) for n, t in counts.items()}

    def log(n, key, lang):
        return math.log((counts[n][key][lang] + 0.1) / (total[n][lang] + 0.1 * len(counts[n])))

    def word(w, lang):
        if w in counts[0]:
            return log(0, w, lang)
        for n in range(5, 0, -1):
            known = [w[k:k + n] for k in range(len(w) - n + 1) if w[k:k + n] in counts[n]]
            if known:
                return sum(log(n, g, lang) for g in known) / len(known)
        return 0.0

    model = langid.train(docs, max_words=10**9, max_grams=10**9)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()}
    held = unseen = 0
    for i, text, _ in rows:
        found = words_of(text)
        if not found:
            assert got[i] == ("und", 0.0)
            continue
        held += zlib.crc32(str(i).encode()) % 4 == 2
        unseen += sum(w not in counts[0] for w in found)
        score = {x: sum(n * word(w, x) for w, n in Counter(found).items()) for x in langs}
        best = max(langs, key=lambda x: (score[x], -langs.index(x)))
        assert got[i][0] == best
        assert got[i][1] == pytest.approx(1 / sum(math.exp(min(score[x] - score[best], 0)) for x in langs), abs=2e-3)
    assert held > 30 and unseen > 300


# -- factorisation machine --------------------------------------------------------------

def plain_score(model, slot, value):
    y = model.bias
    for s, x in zip(slot, value, strict=True):
        y += float(model.w[s]) * x
    for i in range(len(slot)):
        for j in range(i):
            y += float(model.v[slot[i]] @ model.v[slot[j]]) * value[i] * value[j]
    return y


def test_quality_scores_equal_all_pairs(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    rows = [r for r in docs.collect() if len((r["text"] or "").split()) <= 60][:12]
    texts = [r["text"] for r in rows]
    meta = np.array([[math.log2(max(r["n_chars"], 0) + 1) if r["n_chars"] is not None else np.nan] for r in rows])
    start, slot, value = model.rows(quality.features(texts), meta)
    got = model.score(texts, meta)
    spark_scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model, score_col="score").collect()}
    assert len(rows) >= 8
    for k, r in enumerate(rows):
        y = plain_score(model, slot[start[k]:start[k + 1]].tolist(), value[start[k]:start[k + 1]].astype(float).tolist())
        assert got[k] == pytest.approx(1 / (1 + math.exp(-y)), abs=1e-4)
        assert spark_scores[r["doc_id"]] == pytest.approx(float(got[k]), abs=1e-6)


def test_fit_equals_a_plain_loop():
    """Two epochs of Adagrad on the logistic loss, with the gradient of every pair written out."""
    rng = np.random.default_rng(3)
    n, factors = 24, quality.FACTORS
    sizes = rng.integers(2, 6, n)
    start = np.concatenate(([0], np.cumsum(sizes)))
    slot = np.concatenate([rng.choice(40, k, replace=False) for k in sizes]).astype(np.int32)
    value = rng.uniform(0.2, 1.0, len(slot)).astype(np.float32)
    stats = rng.normal(size=(n, len(quality.STATISTICS)))
    label = rng.integers(0, 2, n).astype(float)
    f = quality.Features(start, slot, value, stats)
    meta = np.zeros((n, 0))
    got = quality.fit(f, meta, label, epochs=2, batch=5)

    rng = np.random.default_rng(7)
    want = quality.fit(f, meta, label, epochs=0)
    s0, sl, va = want.rows(f, meta)
    v = rng.normal(0, 0.05, want.v.shape).astype(np.float32).astype(float)
    assert np.array_equal(v.astype(np.float32), want.v)
    w, bias = np.zeros(len(want.w)), want.bias
    gw, gv, gb = np.full(len(w), 1e-6), np.full(v.shape, 1e-6), 1e-6
    for _ in range(2):
        order = rng.permutation(n)
        for at in range(0, n, 5):
            pick = order[at:at + 5]
            dw, dv, db = defaultdict(float), defaultdict(lambda: np.zeros(factors)), 0.0
            for r in pick:
                slots, xs = sl[s0[r]:s0[r + 1]], va[s0[r]:s0[r + 1]].astype(float)
                y = bias + sum(w[a] * x for a, x in zip(slots, xs, strict=True)) + sum(
                    v[slots[i]] @ v[slots[j]] * xs[i] * xs[j] for i in range(len(slots)) for j in range(i))
                g = 1 / (1 + math.exp(-y)) - label[r]
                db += g / len(pick)
                for i, a in enumerate(slots):
                    dw[a] += g * xs[i] / len(pick)
                    dv[a] += g * xs[i] * sum(xs[j] * v[slots[j]] for j in range(len(slots)) if j != i) / len(pick)
            for a in dw:
                d, e = dw[a] + 1e-5 * w[a], dv[a] + 1e-5 * v[a]
                gw[a] += d * d
                gv[a] += e * e
                w[a] -= 0.1 * d / math.sqrt(gw[a])
                v[a] -= 0.05 * e / np.sqrt(gv[a])
            gb += db * db
            bias -= 0.1 * db / math.sqrt(gb)
    used = np.unique(sl)
    assert got.bias == pytest.approx(bias, abs=1e-3)
    assert np.allclose(got.w[used], w[used], atol=5e-3) and np.allclose(got.v[used], v[used], atol=5e-3)


# -- pipeline ---------------------------------------------------------------------------

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, score string, keep_id bigint"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_tables(spark, name):
    """Nulls, repeated rows and clashing column names go through every stage; an empty table stays empty."""
    stage = dict(corpus_pipeline.STAGES)[name]
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (2, None, None, None, None), (3, "", "en", "a", 0),
            (None, "other words " * 30, None, "b", 3), (None, None, None, None, None), (4, " \n", "de", "b", 2),
            (5, "word " * 40_000, "en", "b", 200_000), (6, text.upper(), "en", "b", 7)]
    odd = spark.createDataFrame([(*r, "s", "x", 9) for r in rows], COLUMNS)
    got = stage(spark, odd, SF).collect()
    empty = stage(spark, odd.limit(0), SF)
    assert empty.count() == 0
    if name == "pack":
        assert sum(r["start"] == 0 for r in got) == len(rows)
        return
    assert empty.columns == odd.columns
    ids = Counter(r["doc_id"] for r in got)
    if name == "exact_dedup":  # the two empty kinds of text, and one row of each other text
        assert sum(ids.values()) == len({"".join((t or "").split()) for _, t, *_ in rows})
    if name == "near_dedup":   # 6 equals 1 but for case; rows without an id are linked with nothing
        assert 6 not in ids and ids[None] == 2 and ids[1] == 2 and ids[2] == ids[3] == ids[4] == ids[5] == 1
    if name == "mix":
        assert all(n <= 2 * sum(r[0] == i for r in rows) for i, n in ids.items())
    if name == "quality":
        assert set(ids) <= {r[0] for r in rows}
