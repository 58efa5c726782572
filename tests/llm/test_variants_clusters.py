"""MinHash near duplicates, spelling variants and centroid clusters against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from martmetrics.llm import centroids, minhash, spelling, stars
from martmetrics.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, word string, n bigint, rep bigint, component string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, white and long texts, repeated rows, ids with several texts, clashing names."""
    rng = random.Random(5)
    words = ["colour", "color", "colours", "collour", "kolour", "colou", "Müßig", "müßig", "mußig", "×÷×÷×", "plain", "plaine"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    rows = [(1, "one two three four five six seven"), (2, "One  two\tthree four five six seven"), (3, None), (4, ""),
            (5, " \n\t"), (6, long), (7, long + " end"), (8, "color"), (8, "color"), (9, "colour colour color"),
            (None, "one two three four five six seven"), (None, None), (10, "few words"), (11, "FEW words"),
            (12, "one two three four five six seven"), (12, "few words"), (13, "colour " * 40), (14, "plaine plain " * 9)]
    return spark.createDataFrame([(*r, "w", 1, 2, "c") for r in rows], DOCS)


def documents(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# -- MinHash near duplicates ----------------------------------------------------------------

def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def near_by_brute_force(docs, words=5, percent=85):
    sets = [(i, shingles(t, words)) for i, t in docs]
    holders = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        for x in s if i is not None else ():
            holders[x].append(k)
    root = {i: i for i, _ in docs if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, l in {(a, b) for ks in holders.values() for a in ks for b in ks if a < b}:
        (i, x), (j, y) = sets[k], sets[l]
        if 100 * len(x & y) >= percent * len(x | y) and find(i) != find(j):
            root[max(find(i), find(j))] = min(find(i), find(j))
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=repr)


def test_near_duplicates_equal_brute_force(spark, odd):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    for docs in (odd, table, odd.limit(0)):
        got = sorted((tuple(r) for r in minhash.near_duplicates(docs).collect()), key=repr)
        assert got == near_by_brute_force(documents(docs))


def test_large_bands_meet_block_by_block(spark, monkeypatch):
    """A common passage with own words around it: one band of many classes, few of them linked."""
    monkeypatch.setattr(minhash, "FEW", 3)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(3)
    common = [f"c{i}" for i in range(60)]
    rows = []
    for k in range(150):
        own = [f"w{rng.randrange(40)}" for _ in range(rng.choice((6, 9, 40)))]
        rows.append((k, " ".join(common + own)))
        if k % 7 == 0:
            rows.append((1000 + k, " ".join(common + own[:-1] + ["last"])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in minhash.near_duplicates(docs).collect()), key=repr)
    want = near_by_brute_force(rows)
    assert got == want
    assert 10 < len({r[2] for r in want}) < len(rows) - 10


@pytest.mark.parametrize("held", [4, stars.EDGES])
def test_star_components_equal_a_search(spark, monkeypatch, held):
    monkeypatch.setattr(stars, "EDGES", held)
    rng = random.Random(8)
    edges = ([(k, k + 1) for k in range(100, 130)] + [(7, 7), (9, 3)]
             + [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(40)])
    root = {v: v for e in edges for v in e if e[0] != e[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = stars.star_components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(6))
    assert sorted(map(tuple, got.collect())) == sorted((v, find(v)) for v in root)
    assert stars.star_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_minima_agree_as_often_as_the_sets():
    a, b = minhash.hash_functions(240)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 32, 3000, dtype=np.uint64)
    for share in (0, 500, 1000, 2800):
        y = np.concatenate((x[:share], rng.integers(0, 1 << 32, 3000 - share, dtype=np.uint64)))
        equal = (minhash.minima(x, a, b) == minhash.minima(y, a, b)).mean()
        true = share / (6000 - share)
        assert abs(equal - true) <= 5 * math.sqrt(max(true * (1 - true), 0.002) / 240)
    assert minhash.minima(x[:1], a, b).tolist() == [
        int(minhash.mix(np.array([((int(p) * int(x[0]) + int(q)) % 2**64) >> 32], np.uint64))[0]) & 0xFFFF
        for p, q in zip(a, b, strict=True)]


# -- spelling variants ----------------------------------------------------------------------

def variants_by_brute_force(docs):
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    by = defaultdict(set)  # words by what is left without one letter
    for w in n:
        by[w].add(w)
        for i in range(len(w)):
            by[w[:i] + w[i + 1:]].add(w)
            by[w[:i], w[i + 1:]].add(w)
    out = {}
    for w, k in n.items():
        near = by[w] | {v for i in range(len(w)) for v in by[w[:i], w[i + 1:]]} | {
            w[:i] + w[i + 1:] for i in range(len(w)) if w[:i] + w[i + 1:] in n}
        near -= {w}
        best = min(near, key=lambda v: (-n[v], v), default=None)
        out[w] = (k, len(near), best if best and n[best] >= 2 * k else None)
    rows = []
    for w, (k, near, form) in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows.append((w, k, near, form, n.get(form), root))
    return sorted(rows)


@pytest.mark.parametrize("block", [spelling.BLOCK, 8])
def test_variants_equal_brute_force(spark, odd, block):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    for docs in (odd, table, odd.limit(0)):
        got = spelling.spelling_variants(docs, block=block)
        assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
        assert sorted(tuple(r) for r in got.collect()) == variants_by_brute_force(documents(docs))


def test_position_index_finds_every_single_error():
    def distance_one(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    rng = random.Random(2)
    words = sorted({"".join(rng.choice("aé") for _ in range(rng.randrange(1, 7))) for _ in range(200)})
    index = spelling.PositionIndex(words)
    for w in words:
        same, more, less, begins = index.one_error(w, min(2, len(w)))
        named = lambda bits: {v for j, v in enumerate(words) if bits >> j & 1}
        assert named(same | more | less) == {v for v in words if distance_one(w, v)}
        assert named(begins) == {v for v in words if v.startswith(w[:2])}


def test_chains_of_forms_end_at_the_last(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(40)] + [("x", "w3")]
    got = dict(map(tuple, spelling.follow_forms(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert got == {w: "w40" for w, _ in chain}


# -- centroid clusters ----------------------------------------------------------------------

def clusters_by_brute_force(vectors, clusters=40, rounds=5):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()))
    cs = [v for _, v in order[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for j in range(len(cs)):
            own = [v for (_, v), (_, k) in zip(kept, found, strict=True) if k == j]
            if own:
                cs[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    top = (1 << 63) - 1
    inertia = Counter()
    for d, j in found:
        inertia[j] += d
    return sorted(((i, j, min(d, top), min(inertia[j], top), min(sum(inertia.values()), top),
                    hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(kept, found, strict=True)), key=repr)


def vectors_of(rng, n, size=1.0, groups=6):
    middle = [[rng.gauss(0, size) for _ in range(64)] for _ in range(groups)]
    return [(k, [x + rng.gauss(0, size / 5) for x in rng.choice(middle)]) for k in range(n)]


@pytest.mark.parametrize("case", ["groups", "few", "ties", "huge", "empty"])
def test_clusters_equal_brute_force(spark, case):
    rng = random.Random(4)
    rows = {"groups": lambda: vectors_of(rng, 150), "few": lambda: vectors_of(rng, 7), "empty": list,
            "ties": lambda: [(k, [float(k % 3 - 1)] * 64) for k in range(90)],
            "huge": lambda: vectors_of(rng, 60, 1e12) + [(99, [3e30] * 64), (98, [-3e30] + [0.0] * 63)]}[case]()
    rows += [(1000, None), (1001, [0.0] * 63), (1002, [0.0] * 63 + [None]), (1003, [float("nan")] * 64),
             (1004, [math.inf] + [0.0] * 63), (1005, []), (1006, [0.0] * 65)]
    if rows[0][0] == 0:
        rows += [(None, rows[0][1]), rows[0]]
    df = spark.createDataFrame([(*r, 1, "d") for r in rows], "vec_id bigint, embedding array<double>, cluster int, distance string")
    got = sorted((tuple(r) for r in centroids.cluster_vectors(df).collect()), key=repr)
    assert got == clusters_by_brute_force(rows)


def test_bounds_hold_and_filter():
    rng = random.Random(6)
    x = np.floor(256 * np.array([v for _, v in vectors_of(rng, 400, groups=12)]))
    cs = x[:40]
    simplex = centroids.Simplex(centroids.choose_pivots(x, 16))
    a, c = simplex.apexes(x), simplex.apexes(cs)
    assert a.shape == (400, 16)
    true = np.sqrt(((x[:, None] - cs[None]) ** 2).sum(2))
    inside = ((a[:, None, :-1] - c[None, :, :-1]) ** 2).sum(2)
    lower = np.sqrt(inside + (a[:, None, -1] - c[None, :, -1]) ** 2)
    upper = np.sqrt(inside + (a[:, None, -1] + c[None, :, -1]) ** 2)
    assert (lower <= true + 1e-3).all() and (true <= upper + 1e-3).all()
    ask = centroids.candidates(a, c, 1e-3)
    assert ask[np.arange(400), true.argmin(1)].all()
    assert ask.mean() < 0.5


def test_registered_query_matches_its_sql(spark):
    fn, sql = QUERIES["op13_simplex_centroids"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = con.sql(sql).df()
    got = fn(spark, SF).select(*[F.col(c) for c in want.columns]).toPandas()
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(map(tuple, want.to_numpy().tolist()))
