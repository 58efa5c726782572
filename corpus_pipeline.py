"""Corpus preparation in five stages, from ``documents`` to packed training sequences.

Each stage takes what its predecessor kept, as a written table, and all but the last
return the columns of ``documents``:

1. quality classifier: a factorisation machine fitted on labelled documents; those scored
   below the threshold go;
2. exact dedup: of equal texts (white space aside) one stays;
3. n-gram Jaccard join: of each group linked by five-word shingles at similarity 0.8 or
   more, the document with the smallest id stays;
4. mixing: sources are repeated or thinned towards capped target weights;
5. packing: token pieces placed in sequences of 2048 ids.

``ORACLE_SQL`` is None: a fitted classifier and the tokenizer have no SQL form; the tests
hold the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martmetrics.llm import exact_dedup, jaccard, mixing, packing, quality
from martmetrics.llm.common import stage_table, table

NEAR_WORDS = 5
NEAR_PERCENT = 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores at least ``quality.THRESHOLD``, with all their columns.

    Null and empty texts are scored like any text, repeated rows alike; without labelled rows
    every score is 0.5 and nothing stays; an empty table stays empty.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    names = docs.columns
    renamed = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)],
                          *[F.col(m) for m in quality.METADATA if m in names], F.col("text"))
    scored = quality.score(renamed, model, carry=tuple(f"c{i}" for i in range(len(names))), score_col="score")
    return (scored.filter(F.col("score") >= quality.THRESHOLD)
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)]))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text (white space aside): the longest original, then the smallest id.

    All null and empty texts are one text; of repeated rows one stays.
    """
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose id is the smallest of its linked group.

    Empty texts and rows without an id are linked with nothing and stay; rows that share an id
    stay or go together (an id with several texts goes if one of them is linked to a smaller id).
    """
    linked = jaccard.link_components(jaccard.prefix_table(docs, NEAR_WORDS, NEAR_PERCENT), NEAR_PERCENT)
    gone = stage_table(linked.filter("doc_id <> component_id").select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows as often as the mixture takes them: not at all, once or twice.

    A null source is a source; rows without words take no part in the targets.
    """
    return mixing.repeat_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row in sequences of 2048 ids; a null or empty text is its end id."""
    return packing.pack_documents(docs)


STAGES = [("quality", keep_quality), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mix", mix_sources), ("pack", pack_sequences)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole corpus."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
