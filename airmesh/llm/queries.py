"""The training-data queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import mine_phrases
from .common import n_bytes, table
from .decontam import find_leaks
from .langid import predict_languages
from .mixing import mix_documents
from .mtree import top_k
from .ngramjoin import link_components
from .quality import judge_quality
from .sharding import shard_rows
from .tokencount import count_tokens
from .tokenfile import token_file_digests
from .toxicity import score_toxicity
from .urlfilter import judge_urls
from .whitening import whiten

CONTEXT_TOKENS = 4096
END_ID = 1
SHARDS = 40
NEIGHBOURS = 20


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shard_rows(table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select(
        "doc_id", (n_bytes(F.col("text")) + 16).alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), NEIGHBOURS, F.col("vec_id") % 20 == 0)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_mixing, op3_decontamination, op4_toxicity, op5_sharding, op6_url_filter, op7_language_id, op8_ngram_join, op9_exact_top_k, op10_token_files, op11_collocations, op12_quality_rules, op13_whitening)
}

ORACLE_SQL: dict[str, str] = {
    "op8_ngram_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                             '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
            FROM words),
        shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
            FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM shared JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
            WHERE 100 * n_both >= 80 * (len(p.s) + len(q.s) - n_both)),
        edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
        SELECT s.doc_id, any_value(len(s.s))::BIGINT AS n_shingles, min(r.b) AS component_id
        FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id""",
    "op9_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
        ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
        SELECT * FROM ranked WHERE rank <= 20""",
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
        grams AS (
            SELECT lang, k, unnest(CASE WHEN len(w) < k THEN [] ELSE list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')) END) AS phrase
            FROM split, range(1, 5) AS t(k)),
        counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
        candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 30),
        parts AS (
            SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS p, array_to_string(w[j + 1:k], ' ') AS q
            FROM candidates, range(1, 4) AS t(j) WHERE j < k),
        scored AS (
            SELECT s.lang, s.phrase, s.a, s.j, x.f AS l, y.f AS r, ((2000000::HUGEINT * s.a) // (x.f + y.f))::BIGINT AS score
            FROM parts s JOIN counts x ON x.lang = s.lang AND x.phrase = s.p JOIN counts y ON y.lang = s.lang AND y.phrase = s.q),
        weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        inner_phrases AS (
            SELECT DISTINCT c.lang, c.a, array_to_string(c.w[i:i + m - 1], ' ') AS phrase
            FROM candidates c, range(2, 4) AS t(m), range(1, 4) AS u(i) WHERE m < c.k AND i + m - 1 <= c.k),
        covers AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY lang, phrase),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
        ranked AS (
            SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS rank, w.phrase, w.a, w.l, w.r, t.n, w.score
            FROM weakest w JOIN totals t ON t.lang = w.lang LEFT JOIN covers c ON c.lang = w.lang AND c.phrase = w.phrase
            WHERE c.longer IS NULL OR 100::HUGEINT * c.longer < 80::HUGEINT * w.a)
        SELECT * FROM ranked WHERE rank <= 2000""",
}
