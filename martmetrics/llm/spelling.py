"""Spelling variant grouping with a bit-sliced position index.

Words: maximal letter runs of whole texts, lower-cased for A-Z only. Where 97 divides the
crc32 of ``<doc_id>:<run>`` one code point of the run is deleted (a planted misspelling).
Results of at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences are the
vocabulary; two words are near if one insertion, deletion or replacement turns one into
the other.

Index: for every (position, letter) a bitset over a group of vocabulary words has a bit
for each word with that letter there. A query word runs through its letters once and
carries four bitsets over the group: the words equal so far (zero errors), and those with
one error so far, as a replacement (same position), an extra letter of theirs (position
one ahead) or a missing one (one behind). Every step is a few word-parallel ANDs and ORs
with the bitsets of the letter at the shifted positions, for all words of the group at
once. Members are numbered from the most to the least frequent, so the lowest bit of a
result is the form and its bit count the number of near words: nothing is enumerated.

Groups: of two words with one error, the shorter with c letters, either the first c // 2
letters agree or the last c - c // 2 do. Each word takes part with its first and its last
half, in the class of its own length and of one less. A pair that agrees in the first half
is left out of the second's groups (by the zero-error set after c // 2 letters), so each
pair counts once. Groups over ``BLOCK`` words are cut into blocks, and every block of
queries meets every block of the index in a task of its own.

Counting: each task counts its own words first (bounded by entries and letters), so a
word of a third of all occurrences is one row a task.

Cases: null and empty texts have no words; a null id counts as the empty text in the hash;
repeated rows count each time; ties for the form go to the smaller word in code-point
order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table
from .textkit import small_batches

MIN_LENGTH = 5
MIN_COUNT = 3
ONE_IN = 97
BLOCK = 16384
#: A task hands on its counts when it holds so many words, or letters.
HELD_WORDS = 200_000
HELD_LETTERS = 8_000_000


def _counter(min_length: int, one_in: int):
    run = re.compile("[A-Za-zÀ-ÿ]{%d,}" % min_length).findall  # shorter runs cannot become long enough
    crc = zlib.crc32

    def batch_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                          names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        letters = 0
        for batch in small_batches(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                # lower-cases A-Z alone, whatever else the text holds
                text = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode(
                    "utf-8", "surrogatepass")
                start = crc(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(run(text)).items():
                    h = crc(word.encode(), start)
                    if not h % one_in:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    if word not in held:
                        letters += len(word)
                    held[word] += n
                if len(held) >= HELD_WORDS or letters >= HELD_LETTERS:
                    yield batch_of(held)
                    held, letters = Counter(), 0
        if held:
            yield batch_of(held)

    return count


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, one_in: int = ONE_IN,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that occur often enough."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(_counter(min_length, one_in), "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))


class PositionIndex:
    """Bitsets over words, by (position, letter) and by length; bit j is word j."""

    def __init__(self, words: list[str]):
        self.at: list[dict[str, int]] = []
        self.of_length: dict[int, int] = {}
        for j, word in enumerate(words):
            bit = 1 << j
            while len(self.at) < len(word):
                self.at.append({})
            for letters, letter in zip(self.at, word):  # noqa: B905 - at may be longer
                letters[letter] = letters.get(letter, 0) | bit
            self.of_length[len(word)] = self.of_length.get(len(word), 0) | bit
        self.all = (1 << len(words)) - 1

    def one_error(self, word: str, half: int) -> tuple[int, int, int, int]:
        """Words with exactly one replaced letter, one letter more and one letter less than
        ``word``, and the words that begin with its first ``half`` letters."""
        at, end = self.at, len(self.at)
        none: dict[str, int] = {}
        same, replaced, more, less = self.all, 0, 0, 0
        begins = same if not half else 0
        behind, here, ahead = none, at[0] if end else none, at[1] if end > 1 else none
        for i, letter in enumerate(word, 1):
            now = here.get(letter, 0)
            replaced = replaced & now | same & ~now
            more = (more | same) & ahead.get(letter, 0)
            less = less & behind.get(letter, 0) | same
            same &= now
            if i == half:
                begins = same
            behind, here, ahead = here, ahead, at[i + 1] if i + 1 < end else none
        m, lengths = len(word), self.of_length
        return (replaced & lengths.get(m, 0), (more | same) & lengths.get(m + 1, 0), less & lengths.get(m - 1, 0),
                begins)


_NEAR = "word string, n_near bigint, form_n bigint, form string"
_NEAR_NAMES = ["word", "n_near", "form_n", "form"]


def _near_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows sorted by group: the near words of its queries among its index words."""
    now, members, out = None, [], []

    def flush() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=_NEAR_NAMES)
        out.clear()
        return rows

    def settle(c: int, last: bool) -> None:
        listed = sorted(((-n, w) for w, n, role in members if role & 1))
        index = PositionIndex([w for _, w in listed])
        half = c // 2
        for word, _, role in members:
            if not role & 2:
                continue
            replaced, more, less, begins = index.one_error(word, half)
            near = replaced | more if len(word) == c else less
            if last:
                near &= ~begins
            if near:
                n, form = listed[(near & -near).bit_length() - 1]
                out.append((word, near.bit_count(), -n, form))

    for batch in batches:
        for c, last, key, i, j, word, n, role in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if now != (c, last, key, i, j):
                if len(members) > 1:
                    settle(now[0], now[1])
                now, members = (c, last, key, i, j), []
                if len(out) >= 50_000:
                    yield flush()
            members.append((word, n, role))
    if len(members) > 1:
        settle(now[0], now[1])
    if out:
        yield flush()


def near_words(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, form_n, form (the most frequent near word) of the words that have near words."""
    group = ["c", "last", "key"]
    size = F.length("word")
    ways = []
    for less in (0, 1):  # the class of its own length, and of one less, in which it is the longer word
        c = size - less
        first = F.floor(c / 2).cast("int")
        ways.append(F.struct(c.alias("c"), F.lit(False).alias("last"), F.left("word", first).alias("key")))
        ways.append(F.struct(c.alias("c"), F.lit(True).alias("last"), F.right("word", c - first).alias("key")))
    keyed = vocab.select("word", "n", F.explode(F.array(*ways)).alias("g")).select("word", "n", "g.*")
    sizes = keyed.groupBy(*group).agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    blocks = F.ceil(F.col("m") / F.lit(float(block))).cast("int")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    # a word is in the index of its own block row and asks every block column; one block does both at once
    both = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(3).alias("role")))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    spread = F.concat(
        F.transform(other, lambda x: F.struct(F.col("own").alias("i"), x.alias("j"),
                                              F.when(x == F.col("own"), 3).otherwise(1).alias("role"))),
        F.transform(F.filter(other, lambda x: x != F.col("own")),
                    lambda x: F.struct(x.alias("i"), F.col("own").alias("j"), F.lit(2).alias("role"))))
    placed = (keyed.join(sizes, group).withColumn("blocks", blocks).withColumn("own", own)
              .withColumn("p", F.explode(F.when(F.col("blocks") == 1, both).otherwise(spread)))
              .select(*group, "p.i", "p.j", "word", "n", "p.role"))
    by = [*group, "i", "j"]
    # by number: few bytes are much work here, so partitions must not be merged by their bytes
    parts = int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = placed.repartition(parts, *by).sortWithinPartitions(*by).mapInArrow(_near_rows, _NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("form_n"), F.col("b.form").alias("form")))


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, by pointer doubling over written tables.

    A form is at least twice as frequent as its word, so a chain has at most 63 steps and
    seven doublings settle it.
    """
    now = stage_table(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(7):
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = stage_table(now.join(step, "root", "left").select("word", "root", "further"), "spelling-roots")
        now = joined.select("word", F.coalesce("further", "root").alias("root"))
        if joined.filter("further IS NOT NULL").isEmpty():
            break
    return now


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, one_in: int = ONE_IN,
                      block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of the vocabulary."""
    vocab = stage_table(vocabulary(docs, min_length, min_count, one_in, id_col, text_col), "spelling-words")
    known = stage_table(vocab.join(near_words(vocab, block), "word", "left"), "spelling-near")
    has = F.col("form_n") >= 2 * F.col("n")
    roots = follow_forms(known.filter(has))
    return (known.join(roots, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                    F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n"),
                    F.coalesce("root", "word").alias("root")))
