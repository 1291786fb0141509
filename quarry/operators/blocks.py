"""Blocks of a document: plain lines, heading paths, offsets, metrics, Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as X

LEVELS = range(1, 7)


def with_heading_path(blocks: DataFrame, keys: list[str], order: str = "order") -> DataFrame:
    """Adds heading_path and parent_path: for each level the last heading so far that no later, shallower one has closed.

    One running maximum for each level; no state beyond the window frame, so any document length streams through.
    """
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    is_level = lambda k: (F.col("type") == "heading") & (F.col("level") == k)
    found = blocks
    for k in LEVELS:
        held = F.struct(F.col(order).alias("at"), F.col("text").alias("text"))
        found = found.withColumn(f"_h{k}", F.last(F.when(is_level(k), held), ignorenulls=True).over(so_far))
    entries = []
    for k in LEVELS:
        last_shallower = [F.col(f"_h{j}.at") for j in range(1, k)]
        open_still = F.col(f"_h{k}").isNotNull()
        if last_shallower:
            newest = F.greatest(F.lit(-1), *last_shallower) if len(last_shallower) > 1 else F.coalesce(last_shallower[0], F.lit(-1))
            open_still &= F.col(f"_h{k}.at") > newest
        entries.append(F.when(open_still, F.struct(F.lit(k).alias("level"), F.col(f"_h{k}.text").alias("text"))))
    found = found.withColumn("_stack", F.array_compact(F.array(*entries)))
    path = F.transform("_stack", lambda x: x["text"])
    parents = F.concat(F.array(F.lit("root")), F.transform("_stack", lambda x: F.concat(F.lit("h"), x["level"].cast("string"), F.lit(":"), X.slugify(x["text"]))))
    return found.withColumns({"heading_path": path, "parent_path": parents}).drop("_stack", *(f"_h{k}" for k in LEVELS))


def starts_in(full_text: Column, texts: Column) -> Column:
    """Where each of `texts` stands in the full text, from 0, searched from the end of the last one found; null if nowhere."""
    start = F.struct(F.lit(0).alias("cursor"), F.array().cast("array<int>").alias("found"))

    def step(state: Column, piece: Column) -> Column:
        def placed(at: Column) -> Column:
            hit = at > 0
            cursor = F.when(hit, at - 1 + F.length(piece)).otherwise(state["cursor"])
            return F.struct(cursor.alias("cursor"), F.array_append(state["found"], F.when(hit, at - 1)).alias("found"))

        return X.let(F.call_function("locate", piece, full_text, state["cursor"] + 1), placed)

    return F.aggregate(texts, start, step, lambda s: s["found"])


def metrics(blocks: DataFrame) -> DataFrame:
    return blocks.select("doc_id", "block_id", "order", "type", F.length("text").alias("text_length"), "level", F.col("metadata.row_count").alias("row_count"), F.col("metadata.column_count").alias("column_count"), "heading_path")


def counts_by_document(blocks: DataFrame, keys: list[str]) -> DataFrame:
    kinds = ("heading", "paragraph", "list_item", "table", "unknown")
    return blocks.groupBy(*keys).agg(F.count("*").cast("int").alias("block_count"), *(F.count_if(F.col("type") == k).cast("int").alias(f"{k}_count") for k in kinds))


def counts_by_type(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("type").agg(F.count("*").alias("blocks")).orderBy("type")


def block_markdown(kind: Column, text: Column, level: Column, list_type: Column, table: Column) -> Column:
    """Markdown of one block."""
    return (
        F.when(kind == "heading", F.concat(F.repeat(F.lit("#"), F.least(F.greatest(F.coalesce(level, F.lit(2)), F.lit(1)), F.lit(6))), F.lit(" "), text))
        .when(kind == "list_item", F.concat(F.when(list_type == "ordered", "1. ").otherwise("- "), text))
        .when(kind == "table", F.coalesce(F.nullif(table, F.lit("")), text))
        .when(kind == "blockquote", F.concat(F.lit("> "), text))
        .otherwise(text)
    )


def markdown_of(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """The Markdown of each document, blocks in order with an empty line between."""
    one = block_markdown(F.col("type"), F.col("text"), F.col("level"), F.col("metadata.list_type"), F.col("metadata.markdown"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("order"), one.alias("md"))))
    return blocks.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["md"]), "\n\n").alias("markdown"))
