"""Checks of stage outputs: rows of (stage, artifact, error, message, sample)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import schemas
from quarry.functions import text as X
from quarry.operators import relations

SAMPLE = 20
STAGES = ("s00", "s01", "s02a")


def _issue(stage: str, artifact: str, error: str, message: str, sample: list | None = None) -> dict:
    return {"stage": stage, "artifact": artifact, "error": error, "message": message, "sample": [str(x) for x in sample or []]}


def _found(stage: str, artifact: str, error: str, message: str, rows: DataFrame, column: str = "doc_id") -> Iterator[dict]:
    held = [r[0] for r in rows.select(column).distinct().orderBy(column).limit(SAMPLE + 1).collect()]
    if held:
        yield _issue(stage, artifact, error, message, held[:SAMPLE])


def missing_columns(stage: str, name: str, table: DataFrame) -> Iterator[dict]:
    gone = [c for c in schemas.columns(name) if c not in table.columns]
    if gone:
        yield _issue(stage, name, "MissingColumns", f"missing columns: {', '.join(gone)}", gone)


def check_s00(tables: dict[str, DataFrame]) -> Iterator[dict]:
    for name in ("documents", "manifest"):
        yield from missing_columns("s00", name, tables[name])


def check_s01(tables: dict[str, DataFrame], partial: bool = False) -> Iterator[dict]:
    """Coverage, block counts, JSON left in texts, filled documents without blocks."""
    before = [x for name in ("documents_normalized", "blocks") for x in missing_columns("s01", name, tables[name])]
    yield from before
    if before:
        return
    docs, normalized, blocks = tables["documents"], tables["documents_normalized"], tables["blocks"]
    if not partial:
        yield from _found("s01", "documents_normalized", "MissingNormalizedDocuments", "ingested documents are not normalised", relations.missing(docs, normalized, "doc_id"))
    yield from _found("s01", "blocks", "BlockCountMismatch", "block_count differs from the blocks there", relations.mismatched_counts(normalized, blocks, "doc_id", "block_count"))
    yield from _found("s01", "documents_normalized", "JsonMarkersInPlainText", "plain_text holds service keys", normalized.where(F.size(X.json_markers(F.col("plain_text"))) > 0))
    filled = docs.where(X.strip(X.or_empty("raw_content")) != "")
    ok = relations.both(filled, normalized.where("normalization_status = 'ok'"), "doc_id")
    if blocks.limit(1).count() == 0 and ok.limit(1).count():
        yield _issue("s01", "blocks", "EmptyBlocksForNonemptyDocuments", "filled documents, but no blocks at all")
    else:
        yield from _found("s01", "blocks", "NoBlocksForNonemptyDocuments", "ok documents without blocks", relations.missing(ok, blocks, "doc_id"))


def warnings_s01(tables: dict[str, DataFrame]) -> Iterator[dict]:
    yield from _found("s01", "documents_normalized", "NoBlocksDocuments", "documents without blocks", tables["documents_normalized"].where("normalization_status = 'no_blocks'"))


def check_s02a(tables: dict[str, DataFrame], partial: bool = False, report: dict | None = None) -> Iterator[dict]:
    """Evidence links, generic primaries, units, coverage of documents, the report's figures."""
    before = [x for name in ("topic_units", "tag_candidates", "doc_topics") for x in missing_columns("s02a", name, tables[name])]
    yield from before
    if before:
        return
    found = tables["tag_candidates"]
    excused = F.coalesce(F.col("metadata.no_evidence_reason") != "", F.lit(False))
    bare = found.where((F.coalesce(F.size("evidence_block_ids"), F.lit(0)) < 1) & ~excused)
    yield from _found("s02a", "tag_candidates", "CandidatesMissingEvidence", "candidates without evidence", bare, "candidate_id")
    generic = found.where((F.col("role") == "document_primary_candidate") & F.coalesce(F.col("metadata.is_generic"), F.lit(False)))
    yield from _found("s02a", "tag_candidates", "GenericFacetPromotedToPrimary", "generic phrases as primary candidates", generic, "candidate_id")
    processed = (report or {}).get("processed")
    rows = tables["doc_topics"].count()
    if processed is not None and processed != rows:
        yield _issue("s02a", "doc_topics", "DocTopicCoverageMismatch", f"{rows} summaries, but the report has {processed} documents")
    if tables["topic_units"].limit(1).count() == 0 and (rows or processed):
        yield _issue("s02a", "topic_units", "EmptyTopicUnits", "no topic units for processed documents")
    if "documents_normalized" in tables and not partial:
        ok = tables["documents_normalized"].where("normalization_status = 'ok'")
        yield from _found("s02a", "doc_topics", "DocTopicCoverageMismatch", "ok documents without a summary", relations.missing(ok, tables["doc_topics"], "doc_id"))


CHECKS = {"s00": check_s00, "s01": check_s01, "s02a": check_s02a}


def validate(stage: str, tables: dict[str, DataFrame], partial: bool = False, report: dict | None = None) -> dict:
    """{stage, valid, missing, errors, warnings, outputs} of a stage's tables; an unknown stage is invalid."""
    name = stage.lower()
    if name not in CHECKS:
        return {"stage": stage, "valid": False, "missing": [], "errors": [_issue(stage, "", "UnknownStage", f"no such stage: {stage}")], "warnings": [], "outputs": []}
    args = {"s00": (), "s01": (partial,), "s02a": (partial, report)}[name]
    found = list(CHECKS[name](tables, *args))
    warned = list(warnings_s01(tables)) if name == "s01" and not found else []
    if partial:
        warned.append(_issue(name, "", "PartialS02AOutput" if name == "s02a" else "PartialOutput", "the stage ran on a part of the documents"))
    return {"stage": name, "valid": not found, "missing": [], "errors": found, "warnings": warned, "outputs": []}
