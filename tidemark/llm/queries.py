"""The registered queries of this package and the SQL that must give the same rows (None: SQL cannot say it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe,
    codes,
    divergence,
    gridjoin,
    hosts,
    lm,
    mixing,
    repetition,
    simhash,
    statements,
    suffixes,
    template,
    tokencount,
    toxicity,
)
from tidemark.llm.common import table


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public tokenizer files are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), vocabulary())


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def repetition_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality(table(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=3)


def mix_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, sf_dir, "documents"), length=50)


SUFFIX_DEDUP_SQL = """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), windows AS (
    SELECT doc_id, unnest(range(0, CAST(length(digits) / 2 AS BIGINT) - 49)) AS pos, digits FROM texts
), cut AS (
    SELECT doc_id, pos, substr(digits, CAST(2 * pos + 1 AS BIGINT), 100) AS piece FROM windows
), least AS (
    SELECT piece, min(doc_id) AS first FROM cut GROUP BY piece HAVING min(doc_id) < max(doc_id)
), hits AS (
    SELECT DISTINCT c.doc_id, c.pos FROM cut c JOIN least l USING (piece) WHERE c.doc_id > l.first
), marked AS (
    SELECT doc_id, pos, CASE WHEN pos - lag(pos) OVER w <= 50 THEN 0 ELSE 1 END AS fresh
    FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), runs AS (
    SELECT doc_id, run, min(pos) AS s, max(pos) + 50 AS e FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM marked
    ) GROUP BY doc_id, run
), around AS (
    SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before,
           row_number() OVER (PARTITION BY doc_id ORDER BY s DESC) AS back FROM runs
), kept AS (
    SELECT doc_id, string_agg(
        substr(digits, CAST(2 * before + 1 AS BIGINT), CAST(2 * (s - before) AS BIGINT)) ||
        CASE WHEN back = 1 THEN substr(digits, CAST(2 * e + 1 AS BIGINT)) ELSE '' END, '' ORDER BY s) AS rest,
        CAST(sum(e - s) AS BIGINT) AS n_removed, count(*) AS n_spans
    FROM around JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT t.doc_id, CAST(length(digits) / 2 AS BIGINT) AS n_bytes,
       coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(rest, digits))) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)
"""


def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), folds=7, held=2)


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gridjoin.near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


NEAR_VECTORS_SQL = """
WITH RECURSIVE sound AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
    SELECT vec_id AS node, vec_id AS least FROM embeddings
    UNION
    SELECT l.b, r.least FROM reach r JOIN links l ON l.a = r.node WHERE r.least < l.b
), component AS (SELECT node, min(least) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON c.node = e.vec_id
"""


def toxicity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5, held=0)


def template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.extract(table(spark, sf_dir, "pages"))


#: Rules of the url filter: (verdict, host, path), fixed values of its contract.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hosts.judged(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least=3, top=200)


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compressed(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6).drop("label")


#: name -> (query, SQL)
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_template_text": (template_text, None),
    "op2_token_count": (token_count, None),
    "op3_lm_score": (lm_score, None),
    "op4_repetition_quality": (repetition_quality, None),
    "op5_toxicity_score": (toxicity_score, None),
    "op6_suffix_dedup": (suffix_dedup, SUFFIX_DEDUP_SQL),
    "op7_near_vectors": (near_vectors, NEAR_VECTORS_SQL),
    "op8_simhash_near_dedup": (simhash_near_dedup, None),
    "op9_mix_cube": (mix_cube, None),
    "op10_bpe_round_trip": (bpe_round_trip, None),
    "op11_host_reputation": (host_reputation, statements.host_filter(URL_RULES)),
    "op12_source_divergence": (source_divergence, statements.source_divergence()),
    "op13_vector_codes": (vector_codes, statements.vector_codes()),
}
