"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table

TOKEN_LIMIT = 1024


def byte_bpe() -> str:
    """Where the tokenizer of the queries lies; looked up when it is needed, so that the others do without."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.lm_score import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.toxicity import toxicity

    held_out = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out")
    found = toxicity(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out, "score", "predicted", "rejected")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), length=200).drop("kept")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), byte_bpe(), TOKEN_LIMIT)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.topk_search import top_k

    return top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.decontam import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.token_ids import encode_and_read

    return encode_and_read(table(spark, sf_dir, "documents"), byte_bpe())


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.secret_scan import scan_secrets

    return scan_secrets(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_lm_score, op2_toxicity, op3_suffix_dedup, op4_token_counts, op5_source_mixing, op6_minhash_neardup, op7_topk_search, op8_decontamination, op9_token_ids, op10_secret_scan)
}

TOPK_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 100 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 3 THEN list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))
                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS g FROM w
), e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s
), p AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS n, count(*) AS i FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (SELECT x, y FROM p WHERE 100 * i >= 85 * (n - i)
), both_ AS (SELECT x, y FROM l UNION SELECT y, x FROM l
), reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, b.y FROM reach r JOIN both_ b ON b.x = r.y
), c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept FROM s JOIN c USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op6_minhash_neardup": NEAR_SQL, "op7_topk_search": TOPK_SQL}
