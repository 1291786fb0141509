"""Explicit schemas of all tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

BLOCK_META = (
    "source_format string, editorjs_type string, editorjs_block_id string, `rows` array<array<string>>, row_count int, column_count int, "
    "has_header boolean, has_header_tag boolean, markdown string, list_type string, list_level int, quote_caption string, "
    "source string, container string, inline_marks array<string>, links array<struct<text: string, href: string>>"
)
DDL = {
    "documents": "doc_id string, source_id string, source_row long, name string, description string, raw_content string, content_hash string, raw_length int, has_html boolean, ingest_status string, metadata map<string,string>",
    "manifest": "doc_id string, source_row long, content_hash string, ingest_status string",
    "documents_normalized": "doc_id string, title string, content_hash string, plain_text string, markdown string, block_count int, normalization_status string, error string, raw_length int, plain_text_length int, markdown_length int, text_preservation_ratio double, source_format string, raw_format_detected string, useful_text_length int, useful_text_ratio double, heading_count int, paragraph_count int, list_item_count int, table_count int, unknown_count int, has_tables boolean, has_headings boolean, has_warnings boolean, metadata struct<source_format: string, raw_format_detected: string, useful_text_length: int, useful_text_ratio: double, source_useful_text_length: int, text_preservation_basis: string, warnings: array<string>>",
    "blocks": f"block_id string, doc_id string, `order` int, type string, text string, html string, level int, parent_path array<string>, heading_path array<string>, dom_path string, char_start int, char_end int, text_hash string, metadata struct<{BLOCK_META}>",
    "block_metrics": "doc_id string, block_id string, `order` int, type string, text_length int, level int, row_count int, column_count int, heading_path array<string>",
    "topic_units": "topic_unit_id string, doc_id string, unit_index int, unit_type string, title string, heading_path array<string>, block_ids array<string>, text string, text_length int, char_start int, char_end int, source_block_types array<string>, metadata map<string,string>, warnings array<string>",
    "tag_candidates": "candidate_id string, doc_id string, topic_unit_id string, role string, surface string, normalized_surface string, core_surface string, normalized_core_surface string, entity_type string, entity_subtype string, facet_type string, facets array<string>, qualifiers map<string,string>, sources array<string>, evidence_block_ids array<string>, evidence_texts array<string>, heading_paths array<array<string>>, score double, score_components map<string,double>, confidence_bucket string, needs_review boolean, review_reason string, warnings array<string>, metadata struct<parser_pattern: string, classifier_pattern: string, classifier_confidence: double, is_generic: boolean, no_evidence_reason: string>",
    "candidate_evidence": "evidence_id string, candidate_id string, doc_id string, topic_unit_id string, block_id string, evidence_type string, text string, heading_path array<string>, char_start int, char_end int, weight double",
    "doc_topics": "doc_id string, title string, normalization_status string, topic_unit_count int, candidate_count_total int, primary_candidate_ids array<string>, top_candidate_ids_for_review array<string>, facet_only_count int, cross_topic_reference_count int, needs_review boolean, review_reason string, warnings array<string>",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[name])


def columns(name: str) -> list[str]:
    return schema(name).fieldNames()


def json_schemas() -> dict[str, dict]:
    """The schemas as JSON, for export."""
    return {name: schema(name).jsonValue() for name in DDL}
