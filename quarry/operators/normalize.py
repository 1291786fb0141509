"""Stage S01: raw bodies to normalised documents and typed blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.functions.markup import META_DDL, parse_editorjs, parse_html
from quarry.operators.blocks import block_markdown, starts_in, with_heading_path

LEAST_USEFUL, LEAST_PRESERVED = 0.10, 0.80
_BLOCKS = f"array<struct<type: string, text: string, html: string, level: int, dom_path: string, metadata: {META_DDL}>>"
_LINES = f"array<struct<type: string, text: string, html: string, level: int, dom_path: string, metadata: {META_DDL}, line: int>>"


def _plain(text: Column) -> Column:
    """Blocks of plain text: one for each line that is not empty, with the number of lines before it."""
    numbered = F.transform(F.split(text, r"\R"), lambda x, k: F.struct(X.strip(x).alias("text"), k.cast("int").alias("line")))
    lines = F.filter(numbered, lambda x: x["text"] != "")

    kind = lambda line: F.when(line.rlike(X.LIST_MARK), F.lit("list_item")).otherwise(F.lit("paragraph"))
    nothing = F.from_json(F.lit("{}"), META_DDL.removeprefix("struct<").removesuffix(">").replace(": ", " "))
    return F.transform(lines, lambda x: F.struct(kind(x["text"]).alias("type"), x["text"].alias("text"), F.lit(None).cast("string").alias("html"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("string").alias("dom_path"), nothing.alias("metadata"), x["line"].alias("line"))).cast(_LINES)


def parsed(docs: DataFrame) -> DataFrame:
    """One row for each document with its format, texts, error and ordered array of blocks. A single scan; no shuffle."""
    base = docs.select("doc_id", "source_row", F.col("name").alias("title"), "content_hash", X.or_empty("raw_content").alias("raw"), F.coalesce("raw_length", F.length("raw_content"), F.lit(0)).alias("raw_length"))
    base = base.withColumn("format", F.when(X.strip(F.col("raw")) == "", "empty").otherwise(X.source_format(F.col("raw"))))
    base = base.withColumn("_h", parse_html(F.when(F.col("format") == "html", F.col("raw")))).withColumn("_e", parse_editorjs(F.when(F.col("format") == "editorjs_json", F.col("raw"))))
    is_html, is_editor = F.col("format") == "html", F.col("format") == "editorjs_json"
    base = base.withColumn("_direct", F.when(is_html, F.col("_h.plain_text")).when(is_editor, F.lit("")).otherwise(X.normalize_lines(F.col("raw"))))
    own = F.when(is_editor, F.col("_e.blocks")).when(is_html & (F.size("_h.blocks") > 0), F.col("_h.blocks"))
    of_markup = F.transform(own.cast(_BLOCKS), lambda b: F.struct(*(b[c].alias(c) for c in ("type", "text", "html", "level", "dom_path", "metadata")), F.lit(None).cast("int").alias("line")))
    base = base.withColumn("_blocks", F.coalesce(of_markup, F.when(is_editor, F.array().cast(_LINES)).otherwise(_plain(F.col("_direct")))))
    base = base.withColumn("normalized_text", X.normalize_lines(F.array_join(F.transform("_blocks", lambda b: b["text"]), "\n")))
    base = base.withColumn("plain_text", F.when(is_editor, F.col("normalized_text")).otherwise(F.col("_direct")))
    base = base.withColumn("useful_source", F.when(is_editor, F.col("_e.plain_text")).otherwise(F.col("_direct")))
    searched = starts_in(F.col("plain_text"), F.transform("_blocks", lambda b: b["text"]))
    base = base.withColumn("_starts", F.when(own.isNotNull() | is_editor, searched))  # lines are placed by running sums, see blocks
    base = base.withColumn("error", F.when(is_editor, F.col("_e.error")).when(is_html, F.col("_h.error")))
    return base.drop("raw", "_h", "_e", "_direct")


def blocks(done: DataFrame) -> DataFrame:
    """Block rows with ids, heading paths and offsets; `source_row` keeps copies of a document apart."""
    searched = F.coalesce("_starts", F.array().cast("array<int>"))
    rows = done.withColumn("_starts", searched).select("doc_id", "source_row", F.posexplode(F.arrays_zip("_blocks", "_starts")).alias("_pos", "_b"))
    order = (F.col("_pos") + 1).cast("int")
    text, line = F.col("_b._blocks.text"), F.col("_b._blocks.line")
    # a line begins behind the texts before it and one line end for each line before it, empty ones as well
    before = F.sum(F.length(text)).over(Window.partitionBy("doc_id", "source_row").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_start", F.when(line.isNotNull(), F.coalesce(before, F.lit(0)) + line).otherwise(F.col("_b._starts")).cast("int"))
    start = F.col("_start")
    rows = rows.select(
        X.make_block_id(F.col("doc_id"), order, text).alias("block_id"), "doc_id", "source_row", order.alias("order"), F.col("_b._blocks.type").alias("type"), text.alias("text"),
        F.col("_b._blocks.html").alias("html"), F.col("_b._blocks.level").alias("level"), F.col("_b._blocks.dom_path").alias("dom_path"), start.alias("char_start"),
        (start + F.length(text)).cast("int").alias("char_end"), X.digest(X.normalize_lines(text), 24).alias("text_hash"), F.col("_b._blocks.metadata").alias("metadata"),
    )
    return with_heading_path(rows, ["doc_id", "source_row"])


def documents_normalized(done: DataFrame) -> DataFrame:
    """One row for each document: texts, counts, ratios, status, warnings. No shuffle."""
    count = lambda kind: F.size(F.filter("_blocks", lambda b: b["type"] == kind)).alias(f"{kind}_count")
    md = F.transform("_blocks", lambda b: block_markdown(b["type"], b["text"], b["level"], b["metadata"]["list_type"], b["metadata"]["markdown"]))
    blank, editor = F.col("format") == "empty", F.col("format") == "editorjs_json"
    base = done.withColumn("block_count", F.size("_blocks")).withColumn("_md", X.strip(F.array_join(md, "\n\n")))
    base = base.withColumn("markdown", F.when((F.col("_md") == "") & ~editor, F.col("plain_text")).otherwise(F.col("_md")))
    base = base.withColumn("useful_text_length", F.length("normalized_text"))
    base = base.withColumn("useful_text_ratio", F.when(~blank, X.ratio(F.col("useful_text_length"), F.col("raw_length"))))
    base = base.withColumn("_kept", X.ratio(F.col("useful_text_length"), F.length("useful_source")))
    base = base.withColumn("text_preservation_ratio", F.when(~blank, F.col("_kept")))
    status = F.when(blank, "empty_content").when(F.col("error").isNotNull(), "failed").when(F.col("block_count") > 0, "ok").otherwise("no_blocks")
    markers = F.array_union(X.json_markers(F.col("plain_text")), X.json_markers(F.col("markdown")))
    warnings = F.array_compact(
        F.array(
            F.when(F.col("error").isNotNull(), "editorjs_parse_failed"),
            F.when((F.col("block_count") == 0) & F.col("error").isNull(), "no_useful_blocks"),
            F.when(F.col("useful_text_ratio") < LEAST_USEFUL, "low_useful_text_ratio"),
            F.when(F.size(markers) > 0, "json_markers_in_normalized_text"),
            F.when(F.col("text_preservation_ratio") < LEAST_PRESERVED, "low_text_preservation"),
        )
    )
    base = base.withColumn("_warnings", F.when(blank, F.array().cast("array<string>")).otherwise(warnings))
    shown = F.when(blank, "empty").when(editor, "editorjs").otherwise(F.col("format"))
    raw_format = F.when(blank, "plain_text").otherwise(F.col("format"))
    meta = F.struct(
        shown.alias("source_format"), raw_format.alias("raw_format_detected"), "useful_text_length", "useful_text_ratio", F.length("useful_source").alias("source_useful_text_length"),
        F.when(editor, "editorjs_useful_text").otherwise("direct_plain_text").alias("text_preservation_basis"), F.col("_warnings").alias("warnings"),
    )
    return base.select(
        "doc_id", "source_row", "title", "content_hash", "plain_text", "markdown", "block_count", status.alias("normalization_status"), "error", "raw_length",
        F.length("plain_text").alias("plain_text_length"), F.length("markdown").alias("markdown_length"), "text_preservation_ratio", shown.alias("source_format"), raw_format.alias("raw_format_detected"),
        "useful_text_length", "useful_text_ratio", *(count(k) for k in ("heading", "paragraph", "list_item", "table", "unknown")),
        F.exists("_blocks", lambda b: b["type"] == "table").alias("has_tables"), F.exists("_blocks", lambda b: b["type"] == "heading").alias("has_headings"),
        (F.size("_warnings") > 0).alias("has_warnings"), meta.alias("metadata"),
    )


def report(normalized: DataFrame, block_rows: DataFrame) -> DataFrame:
    """Counts of the stage in one row; documents without blocks count as failed."""
    by_type = block_rows.groupBy("type").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("block_types"))
    totals = normalized.agg(
        F.count("*").alias("documents"), F.count_if(F.col("normalization_status") == "ok").alias("ok"), F.count_if(F.col("normalization_status") == "empty_content").alias("empty"),
        F.count_if(F.col("normalization_status").isin("failed", "no_blocks")).alias("failed"), F.coalesce(F.sum("block_count"), F.lit(0)).alias("blocks"),
    )
    return totals.join(by_type)  # one row each
