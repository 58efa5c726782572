"""MinHash near-duplicates: universal hash minima, banding, verification, star components.

Documents become sets of hashed word shingles. ``HASHES`` functions (a x + b mod 2**64,
upper half, of a 32-bit x: pairwise independent) each keep the minimum over the set; the
minima, folded to 16 bits, are the signature. Documents of equal sets are one class, so
copies meet once. A class enters ``HASHES / ROWS`` bands, each keyed by the hash of its
``ROWS`` minima; two sets of similarity s share a band with probability
1 - (1 - s**6)**40, which at 0.85 leaves out 6 pairs in 10**9 (and fewer components, as
these hang on many pairs).

Candidates are verified twice: by the share of equal minima (at least s - 0.15, which
with 240 functions refuses about one true pair in 10**9), then by the full sets, read
again from the texts of the documents concerned. Only confirmed links count.

Pairs of a band are never all listed. First every member meets one pivot of its band, the
member that shares the most bands with others (of an original and its noisy copies, the
original). Links confirmed so far become components by alternating large-star and
small-star. Then the bands whose members are still in several components are compared
whole, across components and each pair in the first band it shares: bands of few members
as one block inside a task, which returns the pairs that pass the signature test; the
others in blocks of about ``BLOCK`` members, block by block. A pair of blocks in which
candidates are left is one row with their places; the sets of the members named there are
joined once a block pair, and only links that join components come out.

Cases: null and empty texts and texts of white space have an empty set and are linked with
nothing; with fewer than ``words`` words the whole sequence is the one shingle; repeated
rows are equal sets; an id with several texts is one node with the links of all of them; a
row without an id is counted but not linked (its component is null, and it is kept); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table
from .jaccard import shingle_hashes
from .stars import star_components
from .textkit import mix, small_batches

WORDS = 5
PERCENT = 85
HASHES = 240
ROWS = 6
#: Bytes of text hashed at a time, and shingles that meet all functions at a time.
CHUNK_BYTES = 1_500_000
_AT_ONCE = 256
#: Members of a band up to which a task returns pairs, and the usual block size beyond.
FEW = 32
BLOCK = 256
#: Ids up to which the documents to read again are picked by a broadcast (8 bytes each).
PICKED = 250_000
#: How far the share of equal minima may lie below the similarity.
SLACK = 15

_U = np.uint64


def hash_functions(count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of x -> (a x + b mod 2**64) >> 32, fixed by the seed; every a is odd."""
    a, b = (mix(np.arange(1, count + 1, dtype=_U) + _U(seed * 1_000_003 + k * 1_009)) for k in (0, 1))
    return a | _U(1), b


def minima(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest value of every function over a set of 32-bit elements, folded to 16 bits."""
    low = np.full(len(a), 0xFFFFFFFFFFFFFFFF, dtype=_U)
    work = np.empty((min(_AT_ONCE, max(len(x), 1)), len(a)), dtype=_U)
    for at in range(0, len(x), _AT_ONCE):
        part = x[at:at + _AT_ONCE]
        w = work[:len(part)]
        np.multiply(part[:, None], a[None, :], out=w)
        w += b[None, :]
        np.minimum(low, w.min(axis=0), out=low)
    return (mix(low >> _U(32)) & _U(0xFFFF)).astype("<u2")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Bounded chunks of (ids, texts lower-cased for A-Z only)."""
    ids: list = []
    texts: list[bytes] = []
    size = 0
    for batch in small_batches(batches):
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            b = (t or "").encode("utf-8", "surrogatepass").lower()
            if ids and size + len(b) > CHUNK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(b)
            size += len(b) + 1
    if ids:
        yield ids, texts


def _sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    doc, h = shingle_hashes(texts, words)
    by = np.argsort(doc, kind="stable")
    h = h[by]
    ends = np.cumsum(np.bincount(doc, minlength=len(texts)))
    out = []
    for at, end in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
        s = np.sort(h[at:end])
        out.append(s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s)
    return out


_SIGNED = "doc_id bigint, n bigint, d1 bigint, d2 bigint, sig binary"


def _signer(words: int, hashes: int):
    a, b = hash_functions(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _texts(batches):
            sets = _sets(texts, words)
            digests = [np.array([mix(s ^ _U(salt)).sum(dtype=_U) for s in sets], dtype=_U).view(np.int64)
                       for salt in (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93)]
            sigs = [minima(s >> _U(32), a, b).tobytes() if len(s) and i is not None else None
                    for i, s in zip(ids, sets, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, digests),
                 pa.array(sigs, pa.binary())], names=["doc_id", "n", "d1", "d2", "sig"])

    return run


def _reader(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _texts(batches):
            sets = _sets(texts, words)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()),
                                              pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                                             names=["rep", "members"])

    return run


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """The band hashes of signatures, one row each; a band's number is part of its hash."""
    bands = sig.shape[1] // rows
    part = sig[:, :bands * rows].reshape(-1, bands, rows).astype(_U)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=_U) * _U(0x9FB21C651E98DF25)), part.shape[:2]).copy()
    for k in range(rows):
        key = mix(key * _U(0x9E3779B97F4A7C15) + part[:, :, k])
    return key


def _bander(hashes: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key = band_keys(np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u2").reshape(-1, hashes), rows)
            bands = key.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(), bands)), pa.array(np.repeat(batch.column(1).to_numpy(), bands)),
                 pa.array(key.ravel().view(np.int64))], names=["rep", "n", "band"])

    return run


def _equal_minima(least: int):
    """Keeps the pairs with at least ``least`` equal minima."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1)
                    for c in ("sa", "sb"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= least))

    return run


class _Block:
    """One side of a comparison: the members of a block of one band."""

    def __init__(self, members: list[tuple[int, int, int, bytes]], hashes: int, rows: int):
        self.rep, self.n, self.comp = (np.array([m[c] for m in members], np.int64) for c in range(3))
        self.sig = np.frombuffer(b"".join(m[3] for m in members), "<u2").reshape(-1, hashes)
        self.keys = band_keys(self.sig, rows).view(np.int64)


def _candidates(x: _Block, y: _Block, band: int, least: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs across components that share no earlier band and pass length and signature."""
    small, large = np.minimum(x.n[:, None], y.n[None, :]), np.maximum(x.n[:, None], y.n[None, :])
    may = (small * 100 >= large * percent) & (x.comp[:, None] != y.comp[None, :])
    if x is y:
        may &= x.rep[:, None] < x.rep[None, :]
    place = int(np.flatnonzero(x.keys[0] == band)[0])
    i, j = np.nonzero(may)
    found = []
    for at in range(0, len(i), 16384):
        p, q = i[at:at + 16384], j[at:at + 16384]
        ok = ((x.keys[p, :place] != y.keys[q, :place]).all(1)) if place else np.ones(len(p), bool)
        p, q = p[ok], q[ok]
        ok = (x.sig[p] == y.sig[q]).sum(1) >= least
        found.append((p[ok], q[ok]))
    if not found:
        return i, j
    return np.concatenate([p for p, _ in found]), np.concatenate([q for _, q in found])


_FOUND = "pair string, a array<bigint>, b array<bigint>, reps array<bigint>, comps array<bigint>, places binary"
_FOUND_TYPES = (pa.string(), *[pa.list_(pa.int64())] * 4, pa.binary())


def _compare(hashes: int, rows: int, least: int, percent: int, few: int):
    """For rows sorted by pair of blocks: its candidates. A whole band of at most ``few``
    members gives them as pairs (a, b); other pairs of blocks give the members concerned,
    their components, and the places of both ends of every candidate among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides, m, out = None, ([], []), 0, []

        def settle() -> None:
            x = _Block(sides[0], hashes, rows)
            y = _Block(sides[1], hashes, rows) if sides[1] else x
            p, q = _candidates(x, y, now[0], least, percent)
            if not len(p):
                return
            pair = ":".join(map(str, now))
            if m <= few:
                out.append((pair, x.rep[p].tolist(), y.rep[q].tolist(), None, None, None))
                return
            reps, at = np.unique(np.concatenate((x.rep[p], y.rep[q])), return_inverse=True)
            comps = dict(zip(np.concatenate((x.rep, y.rep)).tolist(), np.concatenate((x.comp, y.comp)).tolist(), strict=True))
            out.append((pair, None, None, reps.tolist(), [comps[r] for r in reps.tolist()], at.astype("<u2").tobytes()))

        def flush() -> pa.RecordBatch:
            rows_out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _FOUND_TYPES, strict=True)],
                                                  names=["pair", "a", "b", "reps", "comps", "places"])
            out.clear()
            return rows_out

        for batch in batches:
            for band, i, j, side, size, *member in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (band, i, j):
                    if sides[0] and (len(sides[0]) > 1 or sides[1]):
                        settle()
                        if len(out) >= 64:
                            yield flush()
                    now, sides, m = (band, i, j), ([], []), size
                sides[side].append(tuple(member))
        if sides[0] and (len(sides[0]) > 1 or sides[1]):
            settle()
        if out:
            yield flush()

    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """The exact test on two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return both * (100 + percent) >= (len(x) + len(y)) * percent


def _joining_links(percent: int):
    """Of the candidates of one pair of blocks, confirmed links that join components."""
    def run(found: pa.Table, group: pa.Table) -> pa.Table:
        where = {}
        for k, r in enumerate(group.column("rep").to_pylist()):
            where.setdefault(r, []).append(k)  # an id with several texts has several sets
        sets = [np.asarray(x.values) if x.is_valid else np.zeros(0, np.int64) for x in group.column("members")]
        reps, comps = found.column("reps")[0].as_py(), found.column("comps")[0].as_py()
        places = np.frombuffer(found.column("places")[0].as_py(), "<u2").reshape(2, -1)
        root: dict[int, int] = {}

        def find(v: int) -> int:
            while root.setdefault(v, v) != v:
                root[v] = v = root[root[v]]
            return v

        out = []
        for i, j in places.T.tolist():
            a, b = find(comps[i]), find(comps[j])
            if a != b and any(_linked(sets[s], sets[t], percent) for s in where.get(reps[i], ()) for t in where.get(reps[j], ())):
                root[a] = b
                out.append((reps[i], reps[j]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def link_components(docs: DataFrame, signed: DataFrame, words: int = WORDS, percent: int = PERCENT, hashes: int = HASHES,
                    rows: int = ROWS) -> DataFrame:
    """(doc_id, component_id) of the documents that have a link.

    ``docs`` are rows (doc_id, text), ``signed`` their signatures as a written table.
    """
    least = hashes * max(percent - SLACK, 0) // 100
    same = ["n", "d1", "d2"]
    may = signed.filter("sig IS NOT NULL")
    classes = stage_table(may.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                 F.first("sig").alias("sig")), "minhash-classes")
    sigs = classes.select("rep", "n", "sig")
    match = [F.col(c) == F.col(f"_{c}") for c in same]
    member = stage_table(
        may.select("doc_id", *same).join(classes.select("rep", "copies", *[F.col(c).alias(f"_{c}") for c in same]),
                                         match[0] & match[1] & match[2]).select("doc_id", "rep", "copies"),
        "minhash-members")
    # an id with several texts joins their classes
    several = member.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo <> hi")
    joined = member.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    bands = sigs.mapInArrow(_bander(hashes, rows), "rep bigint, n bigint, band bigint")
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    bands = stage_table(bands.join(shared, "band"), "minhash-bands")

    def read_sets(need: DataFrame) -> DataFrame:
        """(rep, members): the full sets of the needed ids, from their texts."""
        need = stage_table(need.distinct(), "minhash-needed")
        few = need.count() <= PICKED
        picked = docs.join(F.broadcast(need) if few else need, docs["doc_id"] == need["rep"], "left_semi")
        return stage_table(picked.mapInArrow(_reader(words), "rep bigint, members array<bigint>"), "minhash-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The links among pairs that passed the signature test, by their full sets."""
        passed = stage_table(pairs, "minhash-passed")
        sets = read_sets(passed.select(F.explode(F.array("a", "b")).alias("rep")))
        x = sets.select(F.col("rep").alias("a"), F.col("members").alias("x"))
        y = sets.select(F.col("rep").alias("b"), F.col("members").alias("y"))
        both = F.size(F.array_intersect("x", "y")).cast("bigint")
        return (passed.join(x, "a").join(y, "b").withColumn("both", both)
                .filter(F.col("both") * (100 + percent) >= (F.size("x") + F.size("y")) * percent).select("a", "b"))

    # every member with its band's pivot
    crowd = bands.groupBy("rep").agg(F.sum("m").alias("crowd"))
    ranked = bands.join(crowd, "rep")
    h = F.xxhash64("rep")
    pivots = ranked.groupBy("band").agg(F.min(F.struct((-F.col("crowd")).alias("c"), h.alias("h"), "rep", "n")).alias("p"))
    met = (bands.join(pivots.select("band", F.col("p.rep").alias("p_rep"), F.col("p.n").alias("p_n")), "band")
           .filter((F.col("rep") != F.col("p_rep")) & (F.least("n", "p_n") * 100 >= F.greatest("n", "p_n") * percent))
           .select(F.least("rep", "p_rep").alias("a"), F.greatest("rep", "p_rep").alias("b")).distinct())
    tested = (met.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a")
              .join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb")
              .mapInArrow(_equal_minima(least), "a bigint, b bigint"))
    links = stage_table(confirmed(tested).unionByName(joined), "minhash-links")
    comp = stage_table(star_components(links), "minhash-components")

    # the bands whose members lie in several components
    t = bands.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "rep", "n", "m", F.coalesce("component", "rep").alias("comp"))
    split = t.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    blocks = F.when(F.col("m") <= FEW, 1).otherwise(F.ceil(F.col("m") / F.lit(float(BLOCK)))).cast("int")
    still = (t.join(split.select("band"), "band", "left_semi").join(sigs.select("rep", "sig"), "rep")
             .withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("blocks")).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", F.least("own", "with").alias("x"), F.greatest("own", "with").alias("y"),
                     (F.col("own") > F.col("with")).cast("int").alias("side"), "m", "rep", "n", "comp", "sig"))
    by = ["band", "x", "y"]
    near = stage_table(still.repartition(*by).sortWithinPartitions(*by)
                       .mapInArrow(_compare(hashes, rows, least, percent, FEW), _FOUND), "minhash-near")
    few = near.filter("a IS NOT NULL").select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b")
    dense = near.filter("reps IS NOT NULL").select("pair", "reps", "comps", "places")
    named = dense.select(F.col("pair").alias("of"), F.explode("reps").alias("rep"))
    sets = read_sets(named.select("rep"))
    from_blocks = (dense.groupBy("pair").cogroup(named.join(sets, "rep").groupBy("of"))
                   .applyInArrow(_joining_links(percent), "a bigint, b bigint"))
    more = stage_table(confirmed(few).unionByName(from_blocks), "minhash-links")
    if not more.isEmpty():
        comp = stage_table(star_components(links.unionByName(more)), "minhash-components")
    return (member.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
            .filter((F.col("copies") > 1) | F.col("component").isNotNull())
            .select("doc_id", F.coalesce("component", "rep").alias("component_id")))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, hashes: int = HASHES, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stage_table(texts.mapInArrow(_signer(words, hashes), _SIGNED), "minhash-signatures")
    linked = (link_components(texts, signed, words, percent, hashes, rows)
              .groupBy("doc_id").agg(F.min("component_id").alias("component_id")))
    out = signed.select("doc_id", F.col("n").alias("n_shingles")).join(linked, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))
