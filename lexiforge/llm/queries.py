"""The queries of this subpackage, their SQL and the pipeline's registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, clustering, ctw, langid, mixing, packing, quality, simhash, suffix_dedup, topk, toxicity, vector_dedup
from .common import table


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix_dedup.suffix_dedup(docs, replace=False)
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("__lf_bytes").alias("n_bytes"),
        F.col("__lf_removed").alias("n_removed"),
        F.col("__lf_spans").alias("n_spans"),
        F.lower(F.hex("__lf_kept")).alias("kept_sha256"),
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.format_conversations(turns.unionByName(probe))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(rows, rows.where(F.col("vec_id") % 50 == 0))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_chat_format,
        op3_mix_sources,
        op4_best_fit_packing,
        op5_language_id,
        op6_toxicity,
        op7_simhash,
        op8_top_k,
        op9_quality_rules,
        op10_lm_score,
        op11_cross_tokenizer,
        op12_vector_dedup,
        op13_clusters,
        pipeline,
    )
}

_CHAT_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), levels AS (
  SELECT *, regexp_matches(role, '\\(\\|###|</turn>|: |$)') OR regexp_matches(text, '\\(\\|###|</turn>|: |$)') AS strict FROM said
), formatted AS (
  SELECT *, CASE WHEN strict
    THEN length(regexp_replace(role, '(\\|###|</turn>|: )', '__\1', 'g')) + length(regexp_replace(text, '(\\|###|</turn>|: )', '__\1', 'g'))
    ELSE length(regexp_replace(role, '(###|</turn>|: )', '__\1', 'g')) + length(regexp_replace(text, '(###|</turn>|: )', '__\1', 'g')) END AS twice
  FROM levels
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(14 + (twice + length(role) + length(text)) / 2)::BIGINT AS formatted_chars
FROM formatted GROUP BY conv_id
"""

_TOP_K_SQL = """
WITH fine AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM fine WHERE vec_id % 50 = 0) q JOIN fine c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""


def _quality_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))
    tests = [f"{n} >= {a}" for n, a, _ in quality.THRESHOLDS if a is not None] + [f"{n} <= {b}" for n, _, b in quality.THRESHOLDS if b is not None]
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT *, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d
), windows AS (
  SELECT r, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM d)
), twice AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT p + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), f AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines) AS nl,
    len([x FOR x IN w IF lower(rtrim(x, '.,;:!?')) IN ({stops})]) AS stops,
    len([x FOR x IN lines IF regexp_matches(x, '^\s*[-*•‣▪]\s')]) AS bullets,
    len([x FOR x IN lines IF regexp_matches(x, '(\.\.\.|…)\s*$')]) AS dots
  FROM l LEFT JOIN covered c USING (r)
), g AS (
  SELECT *, coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0) AS mean_word_chars, coalesce(n_symbols::DOUBLE / nullif(n_words, 0), 0) AS symbol_ratio,
    coalesce(stops::DOUBLE / nullif(n_words, 0), 0) AS stop_word_ratio, coalesce(n_dup_lines::DOUBLE / nullif(nl, 0), 0) AS dup_line_ratio,
    coalesce(bullets::DOUBLE / nullif(nl, 0), 0) AS bullet_line_ratio, coalesce(dots::DOUBLE / nullif(nl, 0), 0) AS ellipsis_line_ratio,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {" AND ".join(tests)} AS kept FROM g
"""


_VECTOR_SQL = """
WITH RECURSIVE fine AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), half AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), links AS MATERIALIZED (
  SELECT a, b FROM half UNION ALL SELECT b, a FROM half
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), degree AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id, e.vec_id = least(e.vec_id, coalesce(l.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN least l ON l.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""


def _cluster_sql() -> str:
    near = """SELECT vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS m FROM (
      SELECT vec_id, v.v, c.c, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v.v, c.v)])::BIGINT AS d FROM v, c{0} c) GROUP BY vec_id"""
    parts = [
        f"""v AS MATERIALIZED (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = {clustering.LENGTH} AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT sha256('2:' || vec_id) AS h, v FROM v ORDER BY h LIMIT {clustering.CLUSTERS}))",
    ]
    for i in range(clustering.ROUNDS):
        parts += [
            f"a{i} AS MATERIALIZED ({near.format(i)})",
            f"""s{i} AS (SELECT m.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, {clustering.LENGTH + 1})) AS i) GROUP BY ALL)""",
            f"""c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(w.v, c.v) AS v FROM c{i} c LEFT JOIN (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s{i} GROUP BY c) w ON w.c = c.c)""",
        ]
    last = clustering.ROUNDS
    return f"""WITH {", ".join(parts)}, a{last} AS MATERIALIZED ({near.format(last)})
SELECT vec_id, m.c::INTEGER AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia, (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c ON c.c = a.m.c"""


ORACLE_SQL = {"op2_chat_format": _CHAT_SQL, "op8_top_k": _TOP_K_SQL, "op9_quality_rules": _quality_sql(), "op12_vector_dedup": _VECTOR_SQL, "op13_clusters": _cluster_sql()}
