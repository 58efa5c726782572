"""The registered queries of this package: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (centroids, chat, exact_dedup, html_extract, jaccard, langid, minhash, mixing, packing, quality, sharding,
               spelling, topk)
from .common import held_out, table

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def _register(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return put


@_register("op3_jump_sharding")
def op3_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


DEDUP_SQL = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), k AS (
  SELECT norm, first(doc_id ORDER BY length(t) DESC, doc_id NULLS LAST) AS keep_id, count(*) AS group_size
  FROM n GROUP BY norm
)
SELECT n.doc_id, k.keep_id, k.group_size, n.doc_id IS NOT DISTINCT FROM k.keep_id AS kept,
       sha256(n.norm) AS text_sha256
FROM n JOIN k ON n.norm = k.norm
"""


@_register("op4_content_sort_dedup", DEDUP_SQL)
def op4_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (exact_dedup.content_groups(table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


_MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null')) AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM d GROUP BY source
), ordered AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap FROM s
), sums AS (
  SELECT *, coalesce(sum(cap) OVER o, 0.0) AS cap_before, coalesce(sum(w) OVER o, 0.0) AS w_before,
         sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS total, sum(w) OVER () AS w_all
  FROM ordered
  WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), clamped AS (
  SELECT *, cap * (w_all - w_before) <= w * (total - cap_before) AS is_full FROM sums
), goal AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN cap
              ELSE w * (total - sum(CASE WHEN is_full THEN cap ELSE 0.0 END) OVER ())
                   / (w_all - sum(CASE WHEN is_full THEN w ELSE 0.0 END) OVER ()) END AS target
  FROM clamped
), p0 AS (
  SELECT d.doc_id, d.size, g.source, g.source_size, g.target, whole, target - whole * source_size AS gap, false AS more,
         row_number() OVER (PARTITION BY g.source ORDER BY d.h, d.size) AS place
  FROM d JOIN (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM goal) g
       ON d.source IS NOT DISTINCT FROM g.source
)"""


def _pass_sql(p: int) -> str:
    """Documents not taken yet and no larger than the gap, in hash order while they fit."""
    may = "gap > 0 AND NOT more" + (" AND size <= gap" if p else "")
    return f""", f{p} AS (
  SELECT *, {may} AS may,
         sum(CASE WHEN {may} THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY place) AS upto FROM p{p}
), t{p} AS (
  SELECT * EXCLUDE (more, may, upto), more OR (may AND upto <= gap) AS more,
         CASE WHEN may AND upto <= gap THEN size ELSE 0 END AS now FROM f{p}
), p{p + 1} AS (
  SELECT * EXCLUDE (gap, now), gap - sum(now) OVER (PARTITION BY source) AS gap FROM t{p}
)"""


MIX_SQL = _MIX_SQL + "".join(_pass_sql(p) for p in range(mixing.PASSES)) + f""", spare AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY more OR size = 0, size, place) = 1
            AND NOT more AND size > 0 AND gap > 0 AND size < 2 * gap AS close FROM p{mixing.PASSES}
)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN more OR close THEN 1 ELSE 0 END))::BIGINT AS taken FROM spare
"""


@_register("op8_water_filling_mix", MIX_SQL)
def op8_water_filling_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix_documents(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS position
  FROM conversations
), d AS (
  SELECT *, md5(concat(position, CASE WHEN role IS NULL THEN 'n' ELSE concat('v', length(role), ':', role) END,
                       CASE WHEN text IS NULL THEN 'n' ELSE concat('v', length(text), ':', text) END)) AS h
  FROM t
), p AS (
  SELECT conv_id, position, role, text,
         md5(string_agg(h, ',') OVER (PARTITION BY conv_id ORDER BY position ROWS UNBOUNDED PRECEDING)) AS prefix,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM d
), kept AS (
  SELECT min(conv_id) AS conv_id FROM p WHERE position = n_turns
  AND prefix NOT IN (SELECT prefix FROM p WHERE position < n_turns) GROUP BY prefix
)
SELECT p.conv_id, p.position, p.n_turns, p.role, coalesce(p.role = 'assistant', false) AS bears_loss,
       '<|im_start|>' || coalesce(p.role, '') || chr(10) || coalesce(p.text, '') || '<|im_end|>' || chr(10) AS rendered
FROM p JOIN kept k ON p.conv_id IS NOT DISTINCT FROM k.conv_id
"""


@_register("op10_snapshot_collapse_chat", CHAT_SQL)
def op10_snapshot_collapse_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


@_register("op1_vector_packing")
def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@_register("op2_backoff_langid")
def op2_backoff_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


@_register("op5_fm_quality")
def op5_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@_register("op9_text_density_html")
def op9_text_density_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@_register("op6_pivot_distance_topk", TOPK_SQL)
def op6_pivot_distance_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


@_register("op7_rare_first_jaccard")
def op7_rare_first_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@_register("op11_minhash_near_dedup")
def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@_register("op12_bit_sliced_spelling")
def op12_bit_sliced_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def _centroid_sql(rounds: int = 5, clusters: int = 40) -> str:
    """The rounds written out: assign to c0, move to c1, and so on."""
    steps = [f"""
v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS cluster, q FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id), q) <= {clusters}
)"""]
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (
  SELECT v.vec_id, v.q, c.cluster, list_dot_product(v.q, v.q) - 2 * list_dot_product(v.q, c.q) + list_dot_product(c.q, c.q) AS distance
  FROM v, c{r} c
), a{r} AS (
  SELECT vec_id, q, cluster, distance FROM d{r}
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1
)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
  SELECT cluster, i, floor(sum(x) / count(*)) AS x
  FROM (SELECT cluster, generate_subscripts(q, 1) AS i, unnest(q) AS x FROM a{r}) GROUP BY cluster, i
), c{r + 1} AS (
  SELECT c.cluster, coalesce(m.q, c.q) AS q
  FROM c{r} c LEFT JOIN (SELECT cluster, list(x ORDER BY i) AS q FROM m{r} GROUP BY cluster) m ON c.cluster = m.cluster
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT a.vec_id, a.cluster::INTEGER AS cluster, a.distance::BIGINT AS distance,
       sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia, sum(a.distance) OVER ()::BIGINT AS inertia,
       sha256(list_aggregate(list_transform(c.q, lambda x: x::BIGINT::VARCHAR), 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.cluster
"""


@_register("op13_simplex_centroids", _centroid_sql())
def op13_simplex_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
