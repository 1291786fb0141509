"""Shared pieces of the registered queries: tables, sample inputs made of them, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.lexicon import Lexicon
from quarry.plans.stages import documents_from_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table documents as documents of stage S00."""
    return documents_from_table(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_from_table(table(spark, sf_dir, "pages").select("page_id", "html", "url"), "page_id", "html", "url")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as blocks: system turns are headings of level 1, user turns of level 2, others paragraphs or, of even length, list items."""
    t = table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role").isin("system", "user"), "heading").when(F.length("text") % 2 == 0, "list_item").otherwise("paragraph")
    level = F.when(F.col("role") == "system", 1).when(F.col("role") == "user", 2)
    name = F.concat_ws(":", "role", F.col("turn").cast("string"))
    return t.select(
        F.col("conv_id").cast("string").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("order"), kind.alias("type"), level.cast("int").alias("level"), name.alias("text"),
        F.concat(F.lit("b"), F.col("turn").cast("string")).alias("block_id"), F.length("text").alias("size"), F.lit(None).cast("int").alias("char_start"), F.lit(None).cast("int").alias("char_end"),
    )


TURNS_SQL = """
turns AS (
  SELECT CAST(conv_id AS VARCHAR) AS doc_id, CAST(turn + 1 AS INTEGER) AS ord, role,
         CASE WHEN role IN ('system', 'user') THEN 'heading' WHEN length(text) % 2 = 0 THEN 'list_item' ELSE 'paragraph' END AS type,
         CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 END AS level,
         role || ':' || CAST(turn AS VARCHAR) AS name, 'b' || CAST(turn AS VARCHAR) AS block_id, length(text) AS size
  FROM conversations
), open1 AS (
  SELECT *, max(CASE WHEN level = 1 THEN ord END) OVER w AS at1, max(CASE WHEN level = 2 THEN ord END) OVER w AS at2
  FROM turns WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING)
), named AS (
  SELECT o.*, a.name AS n1, CASE WHEN o.at2 > coalesce(o.at1, 0) THEN b.name END AS n2
  FROM open1 o LEFT JOIN turns a ON a.doc_id = o.doc_id AND a.ord = o.at1 LEFT JOIN turns b ON b.doc_id = o.doc_id AND b.ord = o.at2
), pathed AS (SELECT *, concat_ws(' > ', n1, n2) AS path FROM named)
"""

NORMAL_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"""


def normal_sql(x: str) -> str:
    """normalize_lines of ASCII white space in SQL."""
    return NORMAL_SQL.format(x=x)


DOCS_SQL = r"""
hashed AS (
  SELECT *, substr(sha256(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), '[ \t]+\n', chr(10), 'g'), '^\s+|\s+$', '', 'g')), 1, 24) AS content_hash
  FROM documents
), docs AS (
  SELECT 'doc_' || substr(sha256(CAST(doc_id AS VARCHAR) || content_hash), 1, 20) AS doc_id, CAST(doc_id AS VARCHAR) AS source_id, CAST(doc_id AS BIGINT) AS source_row,
         coalesce(text, '') AS raw, content_hash, CAST(length(coalesce(text, '')) AS INTEGER) AS raw_length,
         regexp_matches(coalesce(text, ''), '<\s*/?\s*[a-zA-Z][^>]*>') AS has_html,
         CASE WHEN regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') = '' THEN 'empty_content' ELSE 'ok' END AS ingest_status
  FROM hashed
)
"""

LINES_SQL = (
    DOCS_SQL
    + f""", lines AS (
  SELECT doc_id, source_row, raw_length, unnest(string_split({normal_sql("raw")}, chr(10))) AS line, generate_subscripts(string_split({normal_sql("raw")}, chr(10)), 1) - 1 AS pos FROM docs
), blocks AS (
  SELECT doc_id, source_row, pos, line AS text, CAST(row_number() OVER (PARTITION BY doc_id, source_row ORDER BY pos) AS INTEGER) AS ord,
         CASE WHEN regexp_matches(line, '^\\s*(?:[-*•]|\\d+[.)])\\s+') THEN 'list_item' ELSE 'paragraph' END AS type
  FROM lines WHERE line <> ''
)
"""
)


def tagged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as candidates: a document for each brand, a unit for each fifth of the sizes, scores and roles from keys."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    score = ((k * 37) % 101).cast("double") / 100
    kind = F.when(k % 7 == 0, "unknown").otherwise(F.lower("p_type"))
    generic = k % 11 == 0
    base = p.select(
        F.col("p_brand").alias("doc_id"), F.concat_ws("-", "p_brand", (F.col("p_size") % 5).cast("string")).alias("topic_unit_id"), F.concat(F.lit("c"), k.cast("string")).alias("candidate_id"), k.alias("seq"),
        F.col("p_name").alias("surface"), F.col("p_name").alias("normalized_surface"), F.split("p_name", " ")[1].alias("core_surface"), kind.alias("entity_type"), F.split("p_name", " ").alias("facets"),
        F.split("p_name", " ")[0].alias("facet_type"), score.alias("score"), generic.alias("is_generic"), F.lit(False).alias("is_facet_only"), (F.col("p_size") % 5).cast("int").alias("unit_index"),
        F.array(F.when(k % 3 == 0, "title").when(k % 3 == 1, "heading").otherwise("pattern_match")).alias("sources"), F.array("p_name", "p_type").alias("evidence_texts"),
    )
    return base.withColumn("facet_type", F.when(k_of("seq") % 2 == 0, F.col("facet_type")))


def k_of(name: str):
    return F.col(name)


PARTS_SQL = """
parts AS (
  SELECT p_brand AS doc_id, p_brand || '-' || CAST(p_size % 5 AS VARCHAR) AS topic_unit_id, 'c' || CAST(p_partkey AS VARCHAR) AS candidate_id, p_partkey AS seq, p_name AS surface,
         split_part(p_name, ' ', 2) AS core_surface, CASE WHEN p_partkey % 7 = 0 THEN 'unknown' ELSE lower(p_type) END AS entity_type, string_split(p_name, ' ') AS facets,
         CASE WHEN p_partkey % 2 = 0 THEN split_part(p_name, ' ', 1) END AS facet_type, CAST((p_partkey * 37) % 101 AS DOUBLE) / 100 AS score, p_partkey % 11 = 0 AS is_generic,
         CAST(p_size % 5 AS INTEGER) AS unit_index, CASE p_partkey % 3 WHEN 0 THEN 'title' WHEN 1 THEN 'heading' ELSE 'pattern_match' END AS source, p_name || ' ' || p_type AS said
  FROM part
), flagged AS (
  SELECT *, entity_type <> 'unknown' AND NOT is_generic AS entity, CASE source WHEN 'title' THEN 3 WHEN 'heading' THEN 1 ELSE 0 END AS bonus FROM parts
), first AS (
  SELECT *, entity AND score >= 0.75 AND row_number() OVER (PARTITION BY doc_id, entity AND score >= 0.75 ORDER BY score DESC, bonus DESC, unit_index, seq) = 1 AS is_primary FROM flagged
), apt AS (SELECT *, entity AND NOT is_primary AND score >= 0.45 AS is_apt FROM first
), best AS (
  SELECT *, is_apt AND row_number() OVER (PARTITION BY doc_id, topic_unit_id, is_apt ORDER BY score DESC, bonus DESC, unit_index, seq) = 1 AS is_section FROM apt
), cast_ AS (
  SELECT *, CASE WHEN is_generic AND facet_type IS NOT NULL THEN 'facet_only' WHEN is_generic THEN 'rejected_generic' WHEN is_primary THEN 'document_primary_candidate'
                 WHEN is_section THEN 'section_topic_candidate' WHEN source = 'pattern_match' AND entity_type IN ('disease') THEN 'cross_topic_reference'
                 WHEN entity AND score >= 0.32 THEN 'secondary_topic_candidate' ELSE 'needs_review' END AS role
  FROM best
), cand AS (
  SELECT *, coalesce(CASE WHEN role = 'rejected_generic' THEN 'generic_phrase_without_entity' END, CASE WHEN role = 'needs_review' THEN 'low_score_or_unknown_entity' END,
                     CASE WHEN entity_type = 'unknown' AND role NOT IN ('facet_only', 'rejected_generic') THEN 'unknown_entity_type' END,
                     CASE WHEN score < 0.55 AND role NOT IN ('facet_only', 'rejected_generic') THEN 'score_below_review_threshold' END) AS review_reason,
            CASE WHEN role IN ('facet_only', 'rejected_generic') THEN 'generic_facet_not_primary' ELSE '' END AS warnings,
            CASE WHEN score >= 0.8 THEN 'high' WHEN score >= 0.55 THEN 'medium' ELSE 'low' END AS confidence_bucket
  FROM cast_
)
"""

#: An English lexicon for the synthetic tables.
ENGLISH = Lexicon.parse("""
entity_types:
  drug_product: {keywords: [], regex: []}
  disease: {keywords: [the, of]}
  symptom: {keywords: [and, that, this]}
  medical_device: {keywords: [der, die, das]}
  procedure: {keywords: [les, des]}
facets: {dosage: [with], treatment: [for], diagnosis: [by]}
generic_phrases: [is, in]
""").with_defaults()

#: Adjectives of part names as facets, nouns as entities.
WORKSHOP = Lexicon.parse("""
entity_types:
  drug_product: {keywords: [], regex: []}
  tool: {keywords: [anvil, gear, rod]}
  fastener: {keywords: [bolt, ring]}
  sheet: {keywords: [plate]}
  gadget: {keywords: [], regex: ['\\b[a-z]*(?:gizmo|dget)\\b']}
facets: {temperature: [hot, cold], size: [large, small], colour: [red, blue], age: [new, old]}
generic_phrases: [gizmo]
""").with_defaults()
