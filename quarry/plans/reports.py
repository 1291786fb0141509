"""Reports for people: Markdown, HTML and the exports beside the tables."""

from __future__ import annotations

import html
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import audit, lexicon, review
from quarry.sources import files


def _list(title: str, rows: list) -> str:
    return f"## {title}\n\n" + ("\n".join(f"- {r}" for r in rows) if rows else "None.") + "\n"


def quality_markdown(report: dict) -> str:
    """The quality report of stage S01, from Project.audit_normalized."""
    figures = "\n".join(f"| {k} | {v} |" for k, v in report.items() if isinstance(v, int))
    parts = [_list(k.replace("_", " ").capitalize(), report[k]) for k in ("low_preservation", "largest", "many_blocks") if k in report]
    return "\n".join(["# Quality of normalised documents\n", "| Figure | Value |\n| --- | --- |\n" + figures + "\n", *parts])


def sample_index_markdown(samples: dict[str, list[str]], titles: dict[str, str]) -> str:
    rows = [f"| {k} | {d} | {titles.get(d, '')} | {', '.join(reasons)} |" for k, (d, reasons) in enumerate(samples.items(), 1)]
    return "# Samples\n\n| No. | Document | Title | Reasons |\n| --- | --- | --- | --- |\n" + "\n".join(rows) + "\n"


def tagging_markdown(report: dict) -> str:
    """The report of stage S02A, from Project.tag_candidates."""
    figures = "\n".join(f"| {k} | {report[k]} |" for k in ("status", "processed", "skipped_no_blocks", "topic_units", "candidates") if k in report)
    counters = _list("Counters", [f"{k}: {n}" for k, n in sorted(report.get("counters", {}).items())])
    facets = _list("Facets", [f"{r['facet']}: {r['n']}" for r in report.get("top_facets", [])])
    rejected = _list("Rejected phrases", [f"{r['normalized_surface']}: {r['n']}" for r in report.get("top_rejected", [])])
    return "\n".join(["# Tag candidates\n", "| Figure | Value |\n| --- | --- |\n" + figures + "\n", counters, facets, rejected])


def page(title: str, body: str) -> str:
    return f'<!doctype html><html><head><meta charset="utf-8"><title>{html.escape(title)}</title></head><body>{body}</body></html>'


def sample_html(doc: dict, raw: str | None) -> str:
    """One sampled document: its raw body, unless it is Editor.js JSON, beside the normalised text."""
    shown = "" if doc.get("source_format") == "editorjs" else f"<h2>Raw</h2><pre>{html.escape(raw or '')}</pre>"
    return page(doc.get("title") or doc["doc_id"], f"<h1>{html.escape(doc.get('title') or '')}</h1><p>{doc['doc_id']}</p>{shown}<h2>Normalised</h2><pre>{html.escape(doc.get('plain_text') or '')}</pre>")


def audit_samples(normalized: DataFrame, docs: DataFrame, blocks: DataFrame, size: int) -> list[dict]:
    """The sampled documents with bodies, blocks in order and a page each; `size` documents at most come to the driver."""
    chosen = audit.samples(normalized, size)
    nested = blocks.join(F.broadcast(chosen.select("doc_id")), "doc_id").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("order", "type", "text", "level", "heading_path"))).alias("blocks"))
    rows = F.broadcast(chosen).join(normalized, "doc_id").join(docs.select("doc_id", "raw_content"), "doc_id", "left").join(nested, "doc_id", "left")
    found = [r.asDict(recursive=True) for r in rows.dropDuplicates(["doc_id"]).toLocalIterator()]
    return [r | {"page": sample_html(r, r["raw_content"])} for r in found]


def markdown_to_editorjs(markdown: Column) -> Column:
    """A Markdown text as an Editor.js document of one paragraph."""
    paragraph = F.struct(F.lit("paragraph").alias("type"), F.struct(X.or_empty(markdown).alias("text")).alias("data"))
    return F.to_json(F.struct(F.array(paragraph).alias("blocks")))


def structure(normalized: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per document its outline: counts and, in order, each block's type, level, path and length."""
    outline = blocks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("order", "type", "level", "heading_path", F.length("text").alias("text_length")))).alias("outline"))
    return normalized.select("doc_id", "title", "source_format", "block_count", "heading_count", "table_count", "list_item_count").join(outline, "doc_id", "left")


def export(project, out: str, by_document: bool = False) -> None:
    """Exports of all stages that are there: JSON lines, CSV for review, optionally a file for each document."""
    there = {r["artifact"] for r in project.status().where("exists").collect()}
    read = {n: project._read(n) for n in there}
    for name in ("documents", "manifest", "topic_units", "tag_candidates", "candidate_evidence", "doc_topics"):
        if name in read:
            files.write_jsonl(read[name], f"{out}/{name}.jsonl")
    if {"documents_normalized", "blocks"} <= there:
        skipped = read["documents_normalized"].where("normalization_status = 'no_blocks'")
        files.write_csv(skipped.select("doc_id", "title", "normalization_status", "raw_length"), f"{out}/skipped_no_blocks.csv")
        if by_document:
            files.write_by_document(structure(read["documents_normalized"], read["blocks"]), f"{out}/structure")
    if {"doc_topics", "tag_candidates", "topic_units", "candidate_evidence"} <= there:
        words = (project.words or lexicon.default()).with_defaults()
        ordered = read["tag_candidates"].withColumn("seq", F.col("candidate_id"))
        files.write_csv(review.review_rows(read["documents_normalized"], read["topic_units"], ordered, int(words.review["top_k"]), int(words.review["sample_size"])), f"{out}/review.csv")
        files.write_csv(review.distribution(read["doc_topics"], read["tag_candidates"]), f"{out}/distribution.csv")
        queue = read["doc_topics"].withColumn("needs_review_candidate_ids", F.array().cast("array<string>"))
        files.write_jsonl(review.ambiguity_queue(queue), f"{out}/ambiguity.jsonl")
        if by_document:
            files.write_by_document(review.by_document(read["doc_topics"], read["topic_units"], ordered, read["candidate_evidence"]), f"{out}/tags")


def write_json(payload: dict, path: str) -> None:
    """A report on the driver's disk."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump(payload, f, ensure_ascii=False, indent=2, sort_keys=True, default=str)
        f.write("\n")
