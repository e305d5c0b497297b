"""The operators' queries over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, clusters, decontaminate, hard_negatives, language_model, lines, pages, pieces, quality, run_index, simhash, substrings, token_counts
from millrace.llm.text import table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


@query()
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    items = table(spark, folder, "benchmark").select("item_id", "text")
    return decontaminate.contaminated(docs, items, "doc_id", "item_id")


@query()
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), "doc_id", seed=7)
    digest = F.sha2(F.array_join("pieces", " "), 256).alias("pieces_sha256")
    return found.select("doc_id", "n_pieces", digest, "lossless")


@query()
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query()
def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    fitted = language_model.fit(docs.filter(~language_model.held_out(F.col("doc_id"))))
    scored = language_model.score(docs, fitted, "doc_id")
    return scored.withColumn("held_out", language_model.held_out(F.col("doc_id")))


@query("""
    WITH texts AS MATERIALIZED (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    windows AS (SELECT r, doc_id, i, list_slice(w, i + 1, i + 13) AS run FROM (
        SELECT r, doc_id, w, unnest(range(len(w) - 12)) AS i FROM texts)),
    later AS (SELECT r, i FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY run)),
    gone AS (SELECT DISTINCT r, i + k AS j FROM later, range(13) t(k)),
    marked AS (SELECT r, list(j) AS js FROM gone GROUP BY r),
    kept AS (
        SELECT t.r, list(x ORDER BY j) AS ws FROM (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS j FROM texts) t
        ANTI JOIN gone USING (r, j) GROUP BY t.r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
        sha256(coalesce(array_to_string(ws, ' '), '')) AS kept_sha256
    FROM texts LEFT JOIN marked USING (r) LEFT JOIN kept USING (r)""")
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = substrings.remove_repeats(docs, "doc_id", window=13)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = lines.remove_repeats(docs, "doc_id", min_chars=1)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repaired(table(spark, folder, "conversations"), "conv_id")


@query()
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, "doc_id", shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query()
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    forest = quality.fit(docs, table(spark, folder, "labels"))
    judged = quality.judge(docs, forest)
    counts = [F.col(f"quality.{c}").alias(c) for c in quality.COUNTS]
    return judged.select("doc_id", *counts, "quality.base_failed", "quality.kept", "quality.score")


def _cluster_sql(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024) -> str:
    """One pair of named tables per round: assignments, then floored means."""
    nearest = """SELECT * FROM (
        SELECT kept.vec_id, kept.v, c, list_sum(list_transform(list_zip(kept.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM kept CROSS JOIN m{0} m) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1"""
    parts = [
        f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE len(embedding) = {dim}
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v FROM kept
        ORDER BY sha256('3:' || vec_id) LIMIT {k})""",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({nearest.format(r)})")
        parts.append(f"""s{r} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (
            SELECT c, unnest(v) AS x, unnest(range(1, {dim} + 1)) AS i FROM a{r}) GROUP BY c, i)""")
        parts.append(f"""m{r + 1} AS MATERIALIZED (SELECT c, coalesce(w, v) AS v FROM m{r} LEFT JOIN (
            SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS w FROM s{r} GROUP BY c) USING (c))""")
    parts.append(f"a{rounds} AS MATERIALIZED ({nearest.format(rounds)})")
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
            (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m{rounds}.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN m{rounds} USING (c)"""


@query(_cluster_sql())
def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.cluster(table(spark, folder, "embeddings"), "vec_id", "embedding", k=8, rounds=10, dim=64)


@query("""
    WITH rows AS MATERIALIZED (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
            list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS score
        FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, other_id AS negative_id,
        positive_score::BIGINT AS positive_score, score::BIGINT AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
    QUALIFY row_number() OVER best <= 5""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    anchor = F.col("vec_id") % 100 == 0
    return hard_negatives.mine(table(spark, folder, "embeddings"), "vec_id", "embedding", moved, anchor)


@query("""
    WITH texts AS MATERIALIZED (
        SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t FROM documents),
    windows AS (
        SELECT r, i, md5(t[i + 1:i + 200]) AS w FROM (SELECT r, t, unnest(range(octet_length(t) - 199)) AS i FROM texts)),
    repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
    fresh AS (
        SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 1 ELSE 0 END AS gap FROM repeated),
    spans AS (
        SELECT r, min(i) AS a, max(i) + 200 AS b FROM (
            SELECT r, i, sum(gap) OVER (PARTITION BY r ORDER BY i) AS span FROM fresh) GROUP BY r, span),
    edges AS (
        SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans
        UNION ALL SELECT r, octet_length(t), octet_length(t), coalesce(max(b), 0) FROM texts LEFT JOIN spans USING (r) GROUP BY r, t),
    kept AS (
        SELECT r, sum(b - a) AS n_removed, count_if(b > a) AS n_spans,
            string_agg(CASE WHEN a > before THEN hex(t[before + 1:a]) ELSE '' END, '' ORDER BY a, b DESC) AS bytes
        FROM edges JOIN texts USING (r) GROUP BY r)
    SELECT doc_id, octet_length(t)::BIGINT AS n_bytes, n_removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans,
        sha256(unhex(bytes)) AS kept_sha256
    FROM texts JOIN kept USING (r)""")
def op13_run_index_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = run_index.remove_repeats(table(spark, folder, "documents"), "doc_id", length=200)
    return found.drop("spans")
