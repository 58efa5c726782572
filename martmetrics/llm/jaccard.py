"""N-gram Jaccard join: rare-first prefix filtering, with connected components of the links.

Documents become sets of hashed word shingles. All shingles of all documents are ordered
by document frequency (on a fine logarithmic scale), then hash. If two sets reach the
similarity, they share a shingle among the first |x| - ceil(t |x|) + 1 of each (prefix
filter). A shingle that occurs in one document cannot be shared and comes first, so a
document whose unshared shingles fill its prefix has no link at all; the others keep only
their shared shingles, which is all that an intersection needs.

Counting frequencies moves packed arrays: a task turns about ``CHUNK_BYTES`` of text into
one chunk of (hash, document number) entries, cut by hash range into buckets; a bucket
counts and answers each chunk with its shared entries. A shingle frequent inside a chunk
travels as one count, and its entries follow in rows of their own that a bucket streams
past, so a shingle of a third of all documents does not fill a task.

Links are found without listing all pairs of a group. Documents with equal sets are one
class. Star rounds compare each class with pivots of its prefix shingles (length filter,
positional filter, suffix filter, then the exact intersection) and components of the
links found so far are formed; classes that are already connected need no comparison. The
last round compares every remaining pair of classes that share a prefix shingle and lie
in different components, so no link between components is lost: pair by pair for shingles
of few classes, and for the others block against block inside tasks, which return only
the links that join components.

Cases: null and empty texts and texts of white space have an empty set and are linked
with nothing; with fewer than ``words`` words the whole sequence is the one shingle;
repeated rows are equal sets (one document id is one node); a row without an id is counted
but not linked; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table
from .components import components, grow_components
from .textkit import SPACES, hashed_words, mix, small_batches

WORDS = 4
PERCENT = 85
CHUNK_BYTES = 1_500_000
CHUNK_DOCS = 60_000
BUCKET_BYTES = 8_000_000
#: Classes of a shingle up to which the last round joins pairs, and the block size beyond.
FEW = 48
GROUP_BLOCK = 512
#: Occurrences in a chunk from which a shingle travels as a count.
HEAVY = 8
_U = np.uint64
_STEP = _U(0x9FB21C651E98DF25)


def shingle_hashes(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document number, 64-bit hash) of every shingle occurrence of lower-cased texts."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    starts, _, h = hashed_words(buf, ~SPACES[buf])
    bounds = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    doc = np.searchsorted(bounds, starts, side="right")
    n = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n) - n
    docs, hashes = [], []
    for size in range(1, words + 1):  # documents with fewer words have one shingle of all of them
        if size == words:
            at = np.flatnonzero(doc[: len(doc) - words + 1] == doc[words - 1:]) if len(doc) >= words else []
        else:
            at = first[n == size]
        if not len(at):
            continue
        s = h[at]
        for k in range(1, size):
            s = mix(s * _STEP + h[at + k])
        docs.append(doc[at])
        hashes.append(mix(s ^ _U(size)))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(docs), np.concatenate(hashes)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> _U(16)) * _U(buckets)) >> _U(32)


_MAPPED = "bucket int, kind int, chunk bigint, a binary, b binary, c binary, d binary"
_MAPPED_NAMES = ["bucket", "kind", "chunk", "a", "b", "c", "d"]
_MAPPED_TYPES = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
HEADER, LIGHT, REFS = 0, 1, 2


def _mapper(words: int, buckets: int):
    def chunk_rows(chunk: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        doc, h = shingle_hashes(texts, words)
        key = h >> _U(16)
        e = np.unique((key << _U(16)) | doc.astype(_U))
        e_doc, e_key = (e & _U(0xFFFF)).astype(np.int64), e >> _U(16)
        n = np.bincount(e_doc, minlength=len(texts))
        for i in np.flatnonzero(n > 20_000):  # 48 bits could meet in one very long document: count all 64
            n[i] = len(np.unique(h[doc == i]))
        by = np.argsort(e_doc, kind="stable")
        sums = []
        for salt in (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93):
            c = np.concatenate((np.zeros(1, _U), np.cumsum(mix(e_key[by] ^ _U(salt)))))
            ends = np.cumsum(np.bincount(e_doc, minlength=len(texts)))
            sums.append(c[ends] - c[ends - np.bincount(e_doc, minlength=len(texts))])
        rows = [(chunk % buckets, HEADER, chunk,
                 np.array([i is not None for i in ids], np.uint8).tobytes(),
                 np.array([i or 0 for i in ids], "<i8").tobytes(), n.astype("<i4").tobytes(),
                 np.stack(sums).astype("<u8").tobytes())]
        new = np.flatnonzero(np.concatenate(([True], e_key[1:] != e_key[:-1]))) if len(e) else np.zeros(0, np.int64)
        times = np.diff(np.concatenate((new, [len(e)])))
        heavy = times >= HEAVY
        is_heavy = np.repeat(heavy, times)
        heavy_key, heavy_times = e_key[new[heavy]], times[heavy]
        cuts = {k: np.searchsorted(_bucket(v, buckets), np.arange(buckets + 1)) for k, v in (
            ("light", e_key[~is_heavy]), ("heavy", heavy_key), ("refs", e_key[is_heavy]))}
        light, refs = e[~is_heavy], e[is_heavy]
        for b in range(buckets):
            i, j = cuts["light"][b], cuts["light"][b + 1]
            p, q = cuts["heavy"][b], cuts["heavy"][b + 1]
            if j > i or q > p:
                rows.append((b, LIGHT, chunk, light[i:j].astype("<u8").tobytes(), heavy_key[p:q].astype("<u8").tobytes(),
                             heavy_times[p:q].astype("<i8").tobytes(), None))
            i, j = cuts["refs"][b], cuts["refs"][b + 1]
            if j > i:
                rows.append((b, REFS, chunk, refs[i:j].astype("<u8").tobytes(), None, None, None))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _MAPPED_TYPES, strict=True)],
                                          names=_MAPPED_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[bytes] = []
        size = 0
        for batch in small_batches(batches):
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                b = (t or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower: A-Z only
                if ids and (size + len(b) > CHUNK_BYTES or len(ids) >= CHUNK_DOCS):
                    yield chunk_rows(chunk, ids, texts)
                    chunk, ids, texts, size = chunk + 1, [], [], 0
                ids.append(i)
                texts.append(b)
                size += len(b) + 1
        if ids:
            yield chunk_rows(chunk, ids, texts)

    return run


def _classes(df: np.ndarray) -> np.ndarray:
    """Document frequency on a logarithmic scale in one byte; 1 is 0."""
    return np.minimum(255, np.floor(8 * np.log2(df))).astype(np.uint8)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows sorted by (bucket, kind): answers each chunk with its shared entries."""
    held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
    bucket, uniq, df = None, None, None
    empty = np.zeros(0, "<u8")

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _MAPPED_TYPES[1:], strict=True)],
                                          names=_MAPPED_NAMES[1:])

    def settle() -> Iterator[pa.RecordBatch]:
        nonlocal held, uniq, df
        if not held:
            return
        keys = np.concatenate([x[1] >> _U(16) for x in held] + [x[2] for x in held])
        weight = np.concatenate([np.ones(sum(len(x[1]) for x in held), np.int64)] + [x[3] for x in held])
        uniq, inv = np.unique(keys, return_inverse=True)
        df = np.bincount(inv, weights=weight, minlength=len(uniq)).astype(np.int64)
        at = 0
        for chunk, e, _, _ in held:
            f = df[inv[at: at + len(e)]]
            at += len(e)
            m = f > 1
            if m.any():
                yield out([(LIGHT, chunk, e[m].tobytes(), _classes(f[m]).tobytes(), None, None)])
        held = []

    for batch in batches:
        for b, kind, chunk, a, bb, c, d in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if b != bucket:
                yield from settle()
                bucket, uniq, df = b, empty, np.zeros(0, np.int64)
            if kind == HEADER:
                yield out([(HEADER, chunk, a, bb, c, d)])
            elif kind == LIGHT:
                held.append((chunk, np.frombuffer(a, "<u8"), np.frombuffer(bb, "<u8"), np.frombuffer(c, "<i8")))
            else:
                yield from settle()
                e = np.frombuffer(a, "<u8")
                f = df[np.searchsorted(uniq, e >> _U(16))]
                yield out([(LIGHT, chunk, a, _classes(f).tobytes(), None, None)])
    yield from settle()


_DOCS = "doc_id bigint, n bigint, d1 bigint, d2 bigint, unshared bigint, prefix array<bigint>, shared binary"


def _prefixes(percent: int):
    def finish(header, parts) -> pa.RecordBatch:
        has, ids, n, sums = header
        ids, n = np.frombuffer(ids, "<i8"), np.frombuffer(n, "<i4").astype(np.int64)
        d1, d2 = np.frombuffer(sums, "<u8").reshape(2, -1).astype("<u8").view("<i8")
        e = np.concatenate([np.frombuffer(p[0], "<u8") for p in parts]) if parts else np.zeros(0, "<u8")
        f = np.concatenate([np.frombuffer(p[1], np.uint8) for p in parts]) if parts else np.zeros(0, np.uint8)
        doc, key = (e & _U(0xFFFF)).astype(np.int64), e >> _U(16)
        order = np.lexsort((key, f, doc))
        doc, key = doc[order], key[order].astype(np.int64)
        shared = np.bincount(doc, minlength=len(ids))
        ends = np.cumsum(shared)
        unshared = np.maximum(n - shared, 0)
        prefix = n - -(-percent * n // 100) + 1
        take = np.where((n > 0) & (np.frombuffer(has, np.uint8) > 0), np.minimum(prefix - unshared, shared), 0)
        pre = [key[a:a + k].tolist() if k > 0 else None for a, k in zip(ends - shared, take, strict=True)]
        body = [np.sort(key[a:b]).astype("<i8").tobytes() if k > 0 else None
                for a, b, k in zip(ends - shared, ends, take, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=np.frombuffer(has, np.uint8) == 0), pa.array(n), pa.array(d1), pa.array(d2),
             pa.array(unshared), pa.array(pre, pa.list_(pa.int64())), pa.array(body, pa.binary())],
            names=["doc_id", "n", "d1", "d2", "unshared", "prefix", "shared"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, header, parts = None, None, []
        for batch in batches:
            for kind, chunk, a, b, c, d in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if chunk != now:
                    if header:
                        yield finish(header, parts)
                    now, header, parts = chunk, None, []
                if kind == HEADER:
                    header = (a, b, c, d)
                else:
                    parts.append((a, b))
        if header:
            yield finish(header, parts)

    return run


def prefix_table(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: set size, set digest, and for documents that may have a link
    their shared shingles and the shared part of their prefix, rarest first."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))
    counted = (rows.mapInArrow(_mapper(words, buckets), _MAPPED)
               .repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")
               .mapInArrow(_count, ", ".join(_MAPPED.split(", ")[1:])))
    return stage_table(counted.repartition(buckets, "chunk").sortWithinPartitions("chunk", "kind")
                       .mapInArrow(_prefixes(percent), _DOCS), "jaccard-docs")


_CUTS = (np.arange(1, 16, dtype=np.int64) << 44)


def _similar(a: bytes, b: bytes, na: int, nb: int, percent: int) -> bool:
    """Suffix filter (the shares of both sets in 16 ranges), then the exact intersection."""
    x, y = np.frombuffer(a, "<i8"), np.frombuffer(b, "<i8")
    need = -(-percent * (na + nb) // (100 + percent))
    if min(len(x), len(y)) < need:
        return False
    px = np.diff(np.concatenate(([0], np.searchsorted(x, _CUTS), [len(x)])))
    py = np.diff(np.concatenate(([0], np.searchsorted(y, _CUTS), [len(y)])))
    if np.minimum(px, py).sum() < need:
        return False
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum()) >= need


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_pylist() for c in batch.columns]
            ok = [_similar(sa, sb, na, nb, percent) for _, _, na, nb, sa, sb in zip(*cols, strict=True)]
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keep], names=["a", "b", "linked"])

    return run


def _block_links(percent: int):
    """Links between components among the classes of one pair of blocks of one shingle."""
    def run(group: pa.Table) -> pa.Table:
        rep, comp, n, side = (group.column(c).to_numpy() for c in ("rep", "comp", "n", "side"))
        sets = [np.frombuffer(b, "<i8") for b in group.column("shared").to_pylist()]
        uniq, inv, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        common = times > 1
        column = np.cumsum(common) - 1
        use = common[inv]
        row, col = row[use], column[inv[use]]
        by = np.argsort(col, kind="stable")
        row, col = row[by], col[by]
        overlap = np.zeros((len(sets), len(sets)), dtype=np.float32)
        for at in range(0, int(common.sum()), 4096):
            i, j = np.searchsorted(col, (at, at + 4096))
            m = np.zeros((len(sets), 4096), dtype=np.float32)
            m[row[i:j], col[i:j] - at] = 1.0
            overlap += m @ m.T
        need = np.ceil(percent * (n[:, None] + n[None, :]) / (100.0 + percent) - 1e-9)
        ok = (overlap >= need) & (comp[:, None] != comp[None, :])
        both = (side[:, None] != side[None, :]) | (side[:, None] == 2)
        a, b = np.nonzero(np.triu(ok & both, 1))
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        out = []
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            cx, cy = find(int(comp[x])), find(int(comp[y]))
            if cx != cy:
                root[cx] = cy
                out.append((int(rep[x]), int(rep[y])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _candidates(left: str, right: str, percent: int):
    """Length filter and positional filter, for columns <side>_n and <side>_pos."""
    ln, rn = F.col(f"{left}_n"), F.col(f"{right}_n")
    need = F.ceil(F.lit(percent) * (ln + rn) / F.lit(float(100 + percent)))
    return ((F.least(ln, rn) * 100 >= F.greatest(ln, rn) * percent)
            & (F.least(ln - F.col(f"{left}_pos"), rn - F.col(f"{right}_pos")) >= need))


def link_components(table: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, component_id) of the documents that have a link, from a ``prefix_table``."""
    may = table.filter("prefix IS NOT NULL")
    same = ["n", "d1", "d2"]
    classes = stage_table(may.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
                          "jaccard-classes")
    reps = stage_table(
        may.join(classes.select(F.col("rep").alias("doc_id"), *same), ["doc_id", *same], "left_semi")
        .dropDuplicates(["doc_id", *same])
        .select(F.col("doc_id").alias("rep"), "n", "unshared", "prefix", "shared"), "jaccard-reps")
    tokens = reps.select("rep", "n", "unshared", F.posexplode("prefix").alias("k", "token"))
    tokens = tokens.select("rep", "n", "token", "k", (F.col("unshared") + F.col("k")).alias("pos"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    tokens = stage_table(tokens.join(shared, "token"), "jaccard-tokens")
    spark = table.sparkSession
    checked = spark.createDataFrame([], "a bigint, b bigint")
    comp = None

    def pivot_pairs(t: DataFrame, salt: int, by_token: bool) -> DataFrame:
        h = F.xxhash64("rep", "token", F.lit(salt)) if by_token else F.xxhash64("rep", F.lit(salt))
        own = [c for c in ("comp",) if c in t.columns]
        pivots = t.groupBy("token").agg(F.min_by(F.struct("rep", "n", "pos", *own), h).alias("p"))
        pivots = pivots.select("token", F.col("p.rep").alias("p_rep"), F.col("p.n").alias("p_n"),
                               F.col("p.pos").alias("p_pos"), *[F.col("p.comp").alias("p_comp") for _ in own])
        return t.join(pivots, "token")

    def pairs_of(j: DataFrame) -> DataFrame:
        j = j.withColumnsRenamed({"n": "t_n", "pos": "t_pos"}).filter("rep <> p_rep")
        if "p_comp" in j.columns:
            j = j.filter("comp <> p_comp")
        return (j.filter(_candidates("t", "p", percent))
                .select(F.least("rep", "p_rep").alias("a"), F.greatest("rep", "p_rep").alias("b")).distinct())

    def check(pairs: DataFrame, first: bool, more: DataFrame | None = None) -> None:
        nonlocal checked, comp
        new = pairs if first else pairs.join(checked, ["a", "b"], "left_anti")
        a = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
        b = reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
        done = stage_table(new.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "sa", "sb")
                           .mapInArrow(_verify(percent), "a bigint, b bigint, linked boolean"), "jaccard-pairs")
        checked = checked.unionByName(done.select("a", "b"))
        links = done.filter("linked").select("a", "b")
        if first:
            comp = stage_table(components(links), "jaccard-components")
        else:
            comp = grow_components(comp, links if more is None else links.unionByName(more))

    def apart() -> DataFrame:
        """The rows of the tokens whose members are not all in one component."""
        t = tokens.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
            "comp", F.coalesce("component", "rep")).drop("component")
        split = t.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
        return stage_table(t.join(split.select("token"), "token", "left_semi"), "jaccard-open")

    # a class meets the pivots of its four rarest shared shingles, and one pivot of every shingle
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("k"))
    few = tokens.withColumn("r", rank).filter("r <= 4").select("token", "rep").withColumnRenamed("rep", "r_rep")
    by_token = pivot_pairs(tokens, 1, True)
    by_token = by_token.join(few, (by_token["token"] == few["token"]) & (by_token["rep"] == few["r_rep"]),
                             "left_semi")
    check(pairs_of(by_token).unionByName(pairs_of(pivot_pairs(tokens, 2, False))).distinct(), True)
    still = apart()
    check(pairs_of(pivot_pairs(still, 3, True)).unionByName(pairs_of(pivot_pairs(still, 4, True))).distinct(), False)
    still = apart()
    # shingles of few classes: pairs by a join; side 2 marks both halves of a block with itself
    few = still.filter(F.col("members") <= FEW)
    other = few.select("token", F.col("rep").alias("p_rep"), F.col("n").alias("p_n"), F.col("pos").alias("p_pos"),
                       F.col("comp").alias("p_comp"))
    every = few.withColumnsRenamed({"n": "t_n", "pos": "t_pos"}).join(other, "token").filter(
        (F.col("rep") < F.col("p_rep")) & (F.col("comp") != F.col("p_comp")) & _candidates("t", "p", percent))
    blocks = F.ceil(F.col("members") / F.lit(float(GROUP_BLOCK))).cast("int")
    many = (still.filter(F.col("members") > FEW).withColumn("blocks", blocks)
            .withColumn("own", F.pmod(F.xxhash64("rep", F.lit(9)), F.col("blocks")).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("token", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "rep", "comp", "n",
                    F.when(F.col("own") == F.col("with"), 2).when(F.col("own") < F.col("with"), 0).otherwise(1)
                    .alias("side")))
    dense = (many.join(reps.select("rep", "shared"), "rep").groupBy("token", "i", "j")
             .applyInArrow(_block_links(percent), "a bigint, b bigint"))
    found = stage_table(dense.distinct(), "jaccard-blocks")
    check(every.select(F.col("rep").alias("a"), F.col("p_rep").alias("b")).distinct(), False, found)
    named = classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left").filter(
        (F.col("copies") > 1) | F.col("component").isNotNull()).select(
        *[F.col(c).alias(f"_{c}") for c in same], F.coalesce("component", "rep").alias("component_id"))
    match = [F.col(c) == F.col(f"_{c}") for c in same]
    return may.select("doc_id", *same).join(named, match[0] & match[1] & match[2]).select("doc_id", "component_id")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    table = prefix_table(docs, words, percent, id_col, text_col)
    linked = link_components(table, percent).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return (table.select("doc_id", F.col("n").alias("n_shingles"))
            .join(linked, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
