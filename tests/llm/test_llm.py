"""Brute-force comparisons and edge cases of the training-data operators."""

import hashlib
import random
import zlib
from collections import Counter
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from martmetrics.llm import (chat, exact_dedup, html_extract, jaccard, langid, mixing, packing, quality, sharding,
                             textkit, topk)
from martmetrics.llm.components import components
from martmetrics.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, keep_id string, size string, shard int, _text string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, white and very long texts, ties, repeated rows, clashing column names."""
    long = "wörd word. " * 60_000
    rows = [(1, "a b c d e f", "en", "s1", 11), (2, "a b  c d e f", "en", None, None), (3, None, None, "s1", None),
            (4, "", "en", "s2", 0), (5, " \n\t", "en", "s2", 3), (6, long, "de", "s1", len(long)), (7, "x", "fr", "s3", 1),
            (7, "x", "fr", "s3", 1), (None, "a b c d e f", "en", "s2", 11), (8, "A B C D E F", "en", "s1", 11),
            (9, "<|endoftext|> Σίσυφος 漢字 it's", "en", "s1", 1), (10, "12 34 !!", "en", "s1", 8)]
    return spark.createDataFrame([(*r, "k", "s", -1, "t") for r in rows], DOCS)


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_registered_queries_match_their_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, (fn, sql) in QUERIES.items():
        if sql:
            got, want = fn(spark, SF).toPandas(), con.sql(sql).df()
            cols = sorted(want.columns)
            assert sorted(got.columns) == cols
            rows = lambda d: sorted(map(repr, d[cols].astype(object).itertuples(index=False)))
            assert [str(x) for x in rows(got)] == [str(x) for x in rows(want.astype(got.dtypes.to_dict()))], name


# -- sharding ---------------------------------------------------------------------------

def jump(key, n):
    key %= 1 << 64
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 24, 100])
def test_jump_hash(spark, shards):
    keys = [0, 1, -1, 2**63 - 1, -2**63, *[random.Random(1).getrandbits(62) - 2**61 + k for k in range(200)]]
    got = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", sharding.jump_hash(F.col("k"), shards).alias("s"))
    assert {r["k"]: r["s"] for r in got.collect()} == {k: jump(k, shards) for k in keys}


def test_shards(spark, odd):
    rows = sharding.shard_documents(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        assert r["grown_shard"] in (r["shard"], 24) and r["law"] == "key"
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    want = sorted((i is not None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts_of(odd))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == want
    assert sharding.shard_documents(odd.limit(0)).count() == 0


# -- exact dedup ------------------------------------------------------------------------

def brute_groups(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault((t or "").encode().translate(None, b" \t\n\x0b\x0c\r"), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for norm, g in groups.items():
        g.sort(key=lambda x: x[:3])
        out += [(x[3], g[0][3], len(g), k == 0, hashlib.sha256(norm).hexdigest()) for k, x in enumerate(g)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("parts", [1, 7])
def test_content_groups(spark, odd, parts):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot  copy"))
                                       .otherwise(F.concat(F.lit("t "), (F.col("id") % 50).cast("string"))).alias("text"))
        for df in (odd, many.repartition(parts)):
            got = exact_dedup.content_groups(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
            assert sorted(map(repr, map(tuple, got))) == brute_groups(texts_of(df))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    assert kept.count() == len({(t or "").translate({9: None, 10: None, 32: None}) for _, t in texts_of(odd)})
    assert exact_dedup.content_groups(odd.limit(0)).count() == 0


# -- mixing -----------------------------------------------------------------------------

def brute_targets(sizes, share=1.5, cap=2.0, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: float(weights[i % 3]) for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while True:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > cap * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.discard(s)
    return {**target, **{s: left * w[s] / total for s in free}}


def test_mix(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (odd, docs):
        rows = mixing.mix_documents(df).collect()
        assert len(rows) == df.count()
        sizes = Counter()
        for r in rows:
            sizes[r["source"]] += r["size"]
        assert sum(sizes.values()) == sum(len((t or "").split()) for _, t in texts_of(df))
        want = brute_targets(dict(sizes))
        taken, largest = Counter(), Counter()
        for r in rows:
            assert r["target"] == pytest.approx(want[r["source"]]) and r["taken"] <= 2 * r["size"]
            taken[r["source"]] += r["taken"]
            largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
        again = sorted(map(repr, map(tuple, mixing.mix_documents(df.repartition(3)).collect())))
        assert again == sorted(map(repr, map(tuple, rows)))
        mixed = mixing.repeat_documents(df)
        assert mixed.columns == df.columns and mixed.count() == sum(r["repetitions"] for r in rows)
    assert mixing.mix_documents(odd.limit(0)).count() == 0


def by_source(rows):
    taken, target, smallest = Counter(), {}, {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["repetitions"] <= 2
    return {s: (taken[s], target[s]) for s in target}


@pytest.mark.parametrize("case", ["null ids", "one id", "equal rows", "one long text", "few documents", "all large"])
def test_mix_comes_near_every_target(spark, case):
    """Groups of equal rows are split row by row, and one long document at the end costs nothing."""
    text = lambda n: " ".join(["w"] * n)
    rng = random.Random(1)
    rows, near = {
        "null ids": lambda: ([(None, text(20), s) for s in "abc" for _ in range(500)], 20),
        "one id": lambda: ([(7, text(20), s) for s in "abc" for _ in range(500)], 20),
        "equal rows": lambda: ([(k % 3, text(10 + k % 3), "abc"[k % 2]) for k in range(1200)], 10),
        "one long text": lambda: ([(k, text(10), "a") for k in range(1000)] + [(2000 + k, text(10), "b") for k in range(1000)]
                                  + [(9999 + k, text(6000), "ab"[k]) for k in range(2)], 10),
        "few documents": lambda: ([(k, text(rng.randrange(1, 60)), "abcd"[k % 4]) for k in range(12)], 60),
        "all large": lambda: ([(k, text(1000 + k), "abc"[k % 3]) for k in range(9)], 1010)}[case]()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    got = mixing.mix_documents(df).collect()
    assert len(got) == len(rows)
    for taken, target in by_source(got).values():
        assert abs(taken - target) <= max(near / 2, 0.0) + 1e-6
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    names = ("doc_id", "size", "source_size", "target", "taken")
    want = con.sql(f"SELECT {', '.join(names)} FROM ({QUERIES['op8_water_filling_mix'][1]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r[n] for n in names)) for r in got)
    mixed = mixing.repeat_documents(df)
    assert Counter(r["source"] for r in mixed.collect()) == Counter(
        s for r in got for s in [r["source"]] * r["repetitions"])


# -- packing ----------------------------------------------------------------------------

def test_packing_round_trip(spark, odd):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for df in (docs, odd.filter("doc_id <> 7 AND doc_id IS NOT NULL")):
        rows = packing.pack_documents(df).collect()
        by, bins = {}, {}
        for r in rows:
            by.setdefault(r["doc_id"], []).append(r)
            bins.setdefault(r["sequence_id"], []).append(r)
        for i, t in texts_of(df):
            ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
            at = 0
            for r in sorted(by.pop(i), key=lambda r: r["start"]):
                assert (r["start"], r["doc_tokens"]) == (at, len(ids))
                assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
                at += r["length"]
            assert at == len(ids)
        assert not by
        for g in bins.values():
            at = 0
            for r in sorted(g, key=lambda r: r["offset"]):
                assert r["offset"] == at
                at += r["length"]
            assert at <= 2048 and len(g) <= packing.MAX_SEGMENTS
    assert packing.pack_documents(odd.limit(0)).count() == 0


@pytest.mark.parametrize("max_loss", [1, 50, 400])
def test_packing_limits_loss_tokens(spark, odd, max_loss):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").withColumn(
        "answer", F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 5 == 1, -3).otherwise(F.col("doc_id") % 5 * 37))
    answer = {r["doc_id"]: r["answer"] for r in docs.collect()}
    by, bins = {}, {}
    for r in packing.pack_documents(docs, loss_col="answer", max_loss=max_loss).collect():
        by.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    for i, t in texts_of(docs):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        bears = np.arange(len(ids)) >= (0 if answer[i] is None else len(ids) - max(answer[i], 0))
        at = 0
        for r in sorted(by.pop(i), key=lambda r: r["start"]):
            end = at + r["length"]
            assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(ids[at:end].tobytes()))
            assert r["loss_tokens"] == bears[at + 1:end].sum()
            at = end
        assert at == len(ids)
    assert not by
    for g in bins.values():
        assert sum(r["length"] for r in g) <= 2048 and len(g) <= packing.MAX_SEGMENTS
        assert sum(r["loss_tokens"] for r in g) <= max_loss
    with pytest.raises(ValueError):
        packing.pack_documents(docs, max_loss=0)


def test_plain_characters_encode_alike():
    tok = packing.PieceTokenizer(packing.default_tokenizer_path())
    chars = [c for c in map(chr, range(0x3000)) if not packing._PLAIN.search(c)]
    rng = random.Random(3)
    texts = [f"a{c}b {c}{c} x{c} 1{c}2" for c in chars]
    texts += ["".join(rng.choice([*chars, *["'s", "'ll", "'re", " ", "\n"] * 40]) for _ in range(50)) for _ in range(500)]
    assert all(got.tolist() == tok.whole(t).tolist() for got, t in zip(tok.plain(texts), texts, strict=True))


def test_another_vocabulary_gives_its_own_ids():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Upper and lower Words, don't 12 34!", "", "  two  spaces\n\nlines", "漢字 é"]
    own = Tokenizer.from_file(path)
    got = dict(packing.PieceTokenizer(path).documents(texts))
    assert [got[i].tolist() for i in range(len(texts))] == [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert packing.PieceTokenizer(packing.default_tokenizer_path()).piecewise


def test_short_documents_leave_little_padding(spark):
    """Texts of five words, of one word and of none: the segments of a sequence set no limit."""
    rng = random.Random(2)
    words = "the of and to a in is it you that".split()
    for low, high in ((5, 5), (1, 1), (0, 1)):
        rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(low, high)))) for k in range(20_000)]
        got = packing.pack_documents(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()
        bins = Counter()
        for r in got:
            bins[r["sequence_id"]] += r["length"]
        assert len(got) == 20_000
        assert 1 - sum(bins.values()) / (2048 * len(bins)) < 0.05
    few = packing.pack_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), max_segments=64).collect()
    assert max(Counter(r["sequence_id"] for r in few).values()) == 64


def test_packing_keeps_null_ids_and_repeated_rows(spark, odd):
    docs = odd.filter("doc_id IS NULL OR doc_id = 7")
    got = Counter((r["doc_id"], r["length"], r["doc_tokens"]) for r in packing.pack_documents(docs).collect())
    assert sorted(got.values()) == [1, 2] and sum(got.values()) == docs.count()


def test_bins_respect_every_limit():
    rng = random.Random(5)
    items = [((rng.randint(1, 100), 1, rng.randint(0, 60)), k) for k in range(2000)]
    bins = list(packing.fill_bins(iter(items), (128, 4, 100), pool=200))
    size = dict((k, v) for v, k in items)
    assert sorted(k for b in bins for k in b) == list(range(2000))
    for b in bins:
        assert all(sum(size[k][d] for k in b) <= lim for d, lim in enumerate((128, 4, 100)))
    assert sum(v[0] for v, _ in items) / (128 * len(bins)) > 0.9
    with pytest.raises(ValueError):
        list(packing.fill_bins(iter([((200, 1, 1), 0)]), (128, 4, 100)))


# -- language and quality ---------------------------------------------------------------

def test_language(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    rows = {(r["doc_id"], r["lang_pred"]): r for r in langid.identify(odd, model).collect()}
    und = {k[0] for k in rows if k[1] == "und"}
    assert und == {3, 4, 5, 10} and all(0 <= r["score"] <= 1 for r in rows.values())
    nothing = langid.train(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(odd, nothing).collect()} == {"und"}
    assert langid.identify(odd.limit(0), model).count() == 0


def test_small_language_keeps_its_words(spark):
    rng = random.Random(4)

    def word(letters):
        return "".join(rng.choice(letters) for _ in range(6))

    words = {"big": [word("abcdefgh") for _ in range(400)], "large": [word("ijklmnop") for _ in range(400)],
             "small": [word("qrstuvwx") for _ in range(30)]}
    rows = [(lang, " ".join(rng.choice(words[lang]) for _ in range(40))) for lang, n in (("big", 600), ("large", 600), ("small", 15))
            for _ in range(n)]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id bigint, lang string, text string")
    model = langid.train(docs, max_words=90, max_grams=90)
    known = {lang: int((model._look(0, langid._words(w)[3]) >= 0).sum()) for lang, w in words.items()}
    assert known == {"big": 30, "large": 30, "small": 30}
    assert all(len(keys) <= 90 for keys, _ in model.tables.values())


def test_unseen_words_back_off():
    model = langid.Model(["a", "b"], {1: (np.sort(textkit.mix(textkit.values_of(np.array([120], np.uint32)) ^ np.uint64(1))),
                                          np.array([[-5.0, -1.0]], np.float32))})
    assert model.predict(["xx", None, "1"])[0] == ["b", "und", "und"]


def test_quality(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).join(labels, "doc_id").filter(quality.held_out(F.col("doc_id"))).collect()
    assert sum((r["score"] >= 0.7) == (r["quality"] == 1) for r in rows) / len(rows) > 0.9
    scored = quality.score(odd, model, carry=("doc_id", "text", "_text")).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert {r["score"] for r in quality.score(odd, quality.train(docs, labels.limit(0))).collect()} == {0.5}
    one = quality.train(docs, labels.withColumn("quality", F.lit(1)))
    assert min(r["score"] for r in quality.score(odd.drop("n_chars"), one).collect()) > 0.9


def test_linear_time_identity():
    rng = np.random.default_rng(0)
    m = quality._constant(0.5, 0)
    m.v = rng.normal(size=m.v.shape).astype(np.float32)
    slot, value = np.array([1, 5, 9, 20]), np.array([.5, 1., 2., .3], np.float32)
    pairs = sum(float(m.v[slot[i]] @ m.v[slot[j]]) * value[i] * value[j] for i in range(4) for j in range(i))
    assert m.raw(np.array([0, 4]), slot, value)[0] == pytest.approx(pairs, rel=1e-4)


# -- top-k ------------------------------------------------------------------------------

def test_topk_cases(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(1, 160)] + [
        (0, [0.5] * 6), (200, None), (250, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (300, [nan] * 6), (350, [inf] * 6), (None, [0.5] * 6),
        (400, [0.5] * 6), (450, [0.0] * 6), (7001, [0.5] * 6), (7002, [3e9] * 6), (7003, [])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, score int, block int")
    got = {}
    for r in topk.search(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, qv in ok:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q)[:5]
            assert got.pop(q) == [(i, -s) for s, i in best]
    assert not got
    assert topk.search(df.limit(0)).count() == 0


# -- Jaccard ----------------------------------------------------------------------------

def brute_components(docs, words, percent):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if y < x and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_near_duplicates(spark, odd, words, percent):
    rng = random.Random(words)
    base = [[f"w{rng.randint(0, 300)}" for _ in range(rng.choice([60, 90]))] for _ in range(3)]
    rows = []
    for i in range(220):
        w = list(base[0 if i % 2 else rng.randint(0, 2)])
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"n{rng.randint(0, 40)}"
        rows.append((i, " ".join(w).upper() if i % 7 == 0 else "  ".join(w)))
    near = spark.createDataFrame(rows, "doc_id bigint, text string")
    for df in (near, odd.filter("doc_id IS NOT NULL"), spark.read.parquet(f"{SF}/documents.parquet")):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df, words, percent).collect()}
        assert got == brute_components(texts_of(df), words, percent)
    assert jaccard.near_duplicates(odd.limit(0)).count() == 0
    nulls = jaccard.near_duplicates(odd).filter("doc_id IS NULL").collect()
    assert [(r["n_shingles"], r["component_id"]) for r in nulls] == [(3, None)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 900), (900, 700), (5, 5)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)).collect()
    want = {**{i: 100 for i in range(100, 161)}, 500: 500, 900: 500, 700: 500}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


# -- pages ------------------------------------------------------------------------------

STORY = "Some longer sentence of the story stands here. " * 8


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("a &amp; b\n c", "a & b c"),
    (f"<body><nav><a href=1>Home</a></nav><article><h1>T&eacute;</h1><p>{STORY}<p>Ok.<script>'</p>'</script></article>"
     f"<div class=comments><p>{STORY}</p></div><footer>f</footer>", f"Té\n{STORY.strip()}\nOk."),
    (f"<div id=wrap><div class=x><a href=1>Home</a> <a href=2>Blog</a></div><div><h2>H</h2><p>{STORY}</p><p>Ok.</p>"
     f"<p>{STORY}</p></div><div><p>Copyright by me</p></div></div>", f"H\n{STORY.strip()}\nOk.\n{STORY.strip()}"),
    (f"<main><p>{STORY}</p><aside>no</aside><form>no</form><ul><li>x<li>y</ul></main>", f"{STORY.strip()}\nx\ny")])
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', 'href="/hidden-gems"', 'title="The Hidden Life"', 'href="/read?id=comments"',
    'data-id="menu"', "data-role='banner'", 'data-class="sidebar"', "href=/x?class=menu", 'alt="a > b" data-hidden',
    'aria-hidden="false"', 'title="it\'s hidden" class="lead"', 'class="lead" class="menu"'])
@pytest.mark.parametrize("tag", ["a", "div"])
def test_attribute_values_and_longer_names_remove_nothing(tag, attributes):
    page = f"<article><p>{STORY}</p><{tag} {attributes}>kept words</{tag}><p>End.</p></article>"
    assert html_extract.main_text(page) == f"{STORY.strip()}\nkept words\nEnd."


@pytest.mark.parametrize("attributes", [
    "hidden", "HIDDEN=''", 'style="x" hidden', 'aria-hidden="true"', "role=navigation", "class = 'x menu'", 'title="a"id="sideBar menu"'])
def test_unwanted_attributes_remove(attributes):
    page = f"<article><p>{STORY}</p><div {attributes}>lost words</div><p>End.</p></article>"
    assert html_extract.main_text(page) == f"{STORY.strip()}\nEnd."


@pytest.mark.parametrize("page", [
    "<body><form action=x><input type=hidden>{0}<select><option>no</select></form></body>",
    "<body><form><nav><a href=1>Home</a></nav><article>{0}</article><button>no</button></form></body>",
    "<form><div class=menu><a href=1>Home</a></div><div><label>no</label>{0}</div><div class=footer>no</div></form>",
    "<div class='content has-sidebar'>{0}</div><div class=sidebar>no</div>",
    "<div class='post no-sidebar'>{0}</div><footer>no</footer>",
    "<div class='content sidebar'><div class=widget>{0}</div><div class=promo>no</div></div>",
    "<div class=ad><p>no</p></div><aside><main>{0}</main></aside>",
    "<div class=sidebar><article>{0}</article></div><div class=comments><p>no</p></div>",
    "<nav><a href=1>Home</a><div>{0}</div>",
    "<form><p>no</p></form><article>{0}</article><div class=cookie><p>" + "no cookies please, but " * 90 + "</p></div>"])
def test_wrappers_that_hold_the_text_stay(page):
    assert html_extract.main_text(page.format(f"<p>{STORY}</p><p>{STORY}</p>")) == f"{STORY.strip()}\n{STORY.strip()}"


@pytest.mark.parametrize("page", [
    "<main>{0}<div>more stories</div></main>",
    "<main>{0}<div><p>More stories</p><p><a href=1>One</a> <a href=2>Two</a></p></div></main>",
    "<main>{0}<div id=comments><article class=comment><p>{1}{1}{1}</p></article><article><p>{1}</p></article></div></main>",
    "<main>{0}<section class=comment-list><article><p>{1}</p></article></section></main>",
    "{0}<article class='related'><p>{1}</p></article>", "{0}<div>more stories</div>",
    "<main><div>teasers</div><div>{0}</div><article><h3>Other</h3><p>short</p></article></main>"])
@pytest.mark.parametrize("article", [
    "<article><p>{0}</p></article>", "<article class='post has-comments category-ads'><p>{0}</p></article>",
    "<article><div><p>{0}</p></div><article class=comment><p>{0}{0}</p></article></article>"])
def test_text_beside_the_article_is_left_out(article, page):
    assert html_extract.main_text(page.format(article.format(STORY), STORY)) == STORY.strip()


@pytest.mark.parametrize("page,text", [
    ("<article><h2>H</h2><div><p>{0}<p>{0}</div><section><p>Short.</p></section><ul><li>x</ul></article>", "H\n{0}\n{0}\nShort.\nx"),
    ("<main><article><p>{0}</p></article><article><p>{0}</p></article></main>", "{0}\n{0}"),
    ("<article><h1>Day</h1><article><p>{0}</p></article><article><p>{0}</p></article></article>", "Day\n{0}\n{0}"),
    ("<main><h1>H</h1><div><p>{0}</p><p>{0}</p></div><div>more stories</div></main>", "H\n{0}\n{0}"),
    ("<main><h1>Topic</h1><article class=comment><p>{0}</p></article><article class=comment><p>{0}</p></article></main>",
     "Topic\n{0}\n{0}")])
def test_text_of_the_extent_is_whole(page, text):
    assert html_extract.main_text(page.format(STORY)) == text.format(STORY.strip())


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = html_extract.extract_pages(pages.withColumn("text", F.lit(1))).collect()
    assert len(rows) == pages.count() and all(r["n_chars"] == len(r["text"]) > 0 for r in rows)
    assert len(html_extract.main_text("<div>" * 20_000 + "deep")) == 4
    html_extract.main_text('<a "' * 50_000)


class ArticleText(HTMLParser):
    """The text of article elements by the standard library's parser, a line per block."""

    def __init__(self, page):
        super().__init__()
        self.depth, self.lines = 0, [""]
        self.feed(page)
        self.close()
        self.text = "\n".join(t for line in self.lines if (t := " ".join(line.split())))

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag == "br":
            self.lines[-1] += " "
        elif tag not in ("a", "b"):
            self.lines.append("")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag not in ("a", "b"):
            self.lines.append("")

    def handle_data(self, data):
        if self.depth:
            self.lines[-1] += data


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_pages_give_their_article(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {r["page_id"]: (r["url"], ArticleText(r["html"]).text) for r in pages.collect()}
    got = {r["page_id"]: (r["url"], r["text"]) for r in html_extract.extract_pages(pages).collect()}
    assert got == want and len(want) == pages.count()


# -- conversations ----------------------------------------------------------------------

def test_snapshots(spark):
    a, b, c = ("user", "hi"), ("assistant", "ho"), ("user", None)
    convs = {1: [a], 2: [a, b], 3: [a, b, c], 4: [a, b, c], 5: [a, ("assistant", "x")], 6: [("user", "")], 7: [("user", None)],
             8: [("user", None), b], 9: [a] * 600, 10: [a] * 599, None: [b]}
    rows = [(k, t, r, x, 0) for k, v in convs.items() for t, (r, x) in enumerate(v)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, position int").repartition(4)
    got = {}
    for r in sorted(chat.format_conversations(df).collect(), key=lambda r: r["position"]):
        got.setdefault(r["conv_id"], []).append(r["rendered"])
    assert set(got) == {3, 5, 6, 8, 9, None}
    assert got[3] == ["<|im_start|>user\nhi<|im_end|>\n", "<|im_start|>assistant\nho<|im_end|>\n", "<|im_start|>user\n<|im_end|>\n"]
    assert chat.format_conversations(df.limit(0)).count() == 0


# -- pipeline ---------------------------------------------------------------------------

def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at, before = docs, None
    for name, stage in pipeline.STAGES:
        before, at = at, pipeline.stage_table(stage(spark, at, SF), f"test-{name}")
        if name != "pack":
            assert at.dtypes == docs.dtypes, name
        ids = lambda d: sorted(r["doc_id"] for r in d.select("doc_id").collect())
        if name == "quality":
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            kept = set(ids(at))
            assert sum((i in kept) == (q == 1) for i, q in labels.items()) / len(labels) > 0.9
        if name == "exact_dedup":
            assert len(ids(at)) == len({"".join((t or "").split()) for _, t in texts_of(before)})
        if name == "near_dedup":
            want = brute_components(texts_of(before), 5, 80)
            assert ids(at) == sorted(i for i, (_, c) in want.items() if c == i)
        if name == "mix":
            want = {r["doc_id"]: r["repetitions"] for r in mixing.mix_documents(before).collect()}
            assert Counter(ids(at)) == Counter({i: n for i, n in want.items() if n})
    tok = Tokenizer.from_file(packing.default_tokenizer_path())
    want = sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts_of(before))
    assert sum(r["length"] for r in at.collect()) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_grown_components_equal_those_of_all_links(spark, seed):
    from martmetrics.llm.components import components, grow_components
    rnd = random.Random(seed)
    ddl = "a bigint, b bigint"
    first, second = ([(rnd.randrange(60), rnd.randrange(60)) for _ in range(n)] for n in (20, 15))
    first, second = ([e for e in x if e[0] != e[1]] for x in (first, second))
    comp = components(spark.createDataFrame(first, ddl))
    both = components(spark.createDataFrame(first + second, ddl))
    grown = grow_components(comp, spark.createDataFrame(second, ddl))
    assert sorted(map(tuple, grown.collect())) == sorted(map(tuple, both.collect()))
    assert grow_components(comp, spark.createDataFrame(first, ddl)) is comp
