"""Topic units: a title, heading sections or windows, tables and lists of each document."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as X

WINDOW_BLOCKS, WINDOW_CHARS = 5, 1800
SMALL_BLOCKS, SMALL_CHARS = 8, 2500
LEAST_TABLE_TEXT, LEAST_LIST = 8, 2


def islands(rows: DataFrame, keys: list[str], order: str, value: Column) -> DataFrame:
    """Numbers runs of rows with equal `value`; a value that comes back begins a new run."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = rows.withColumn("_value", value)
    changed = (~F.col("_value").eqNullSafe(F.lag("_value").over(w)) | (F.row_number().over(w) == 1)).cast("int")
    return rows.withColumn("_changed", changed).withColumn("island", F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_value", "_changed")


def greedy_windows(sizes: Column, most_rows: int = WINDOW_BLOCKS, most_chars: int = WINDOW_CHARS) -> Column:
    """The window number of each size: a window closes when it is full or would grow over its characters; one oversize row stands alone.

    Each number depends on all before it, and an array that grows by one is copied whole by built-ins; so this runs
    over Arrow batches, in time linear in the sizes.
    """

    def numbers(sizes: pd.Series) -> pd.Series:
        def one(held: np.ndarray | None) -> list[int] | None:
            if held is None:
                return None
            out, window, n, chars = [], 0, 0, 0
            for size in held.tolist():
                if n and (n >= most_rows or chars + size > most_chars):
                    window, n, chars = window + 1, 0, 0
                n, chars = n + 1, chars + size
                out.append(window)
            return out

        return sizes.map(one)

    return F.pandas_udf(numbers, "array<int>")(sizes)


def gathered(rows: DataFrame, group: list[str], **fixed: Column) -> DataFrame:
    """One unit of each group of blocks, in block order."""
    piece = F.struct("order", "type", "heading_path", "block_id", F.trim(X.or_empty("text")).alias("text"))
    out = rows.groupBy(*group).agg(F.array_sort(F.collect_list(piece)).alias("_b"), F.min("order").alias("pos"), F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"))
    texts = F.filter(F.transform("_b", lambda b: b["text"]), lambda t: t != "")
    paths = F.filter(F.transform("_b", lambda b: b["heading_path"]), lambda p: F.size(p) > 0)
    return out.select(
        "doc_id", "pos", "char_start", "char_end", F.transform("_b", lambda b: b["block_id"]).alias("block_ids"), F.array_join(texts, "\n").alias("text"),
        F.coalesce(F.try_element_at(paths, F.lit(1)), F.array().cast("array<string>")).alias("heading_path"), F.array_distinct(F.transform("_b", lambda b: b["type"])).alias("source_block_types"),
        *(c.alias(k) for k, c in fixed.items()),
    )


def topic_units(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """All units of ok documents, numbered in the order title, sections or windows, tables, lists.

    `docs`: doc_id, title, plain_text; `blocks`: as of stage S01. Documents with headings make a unit of each run
    of blocks under one path; without, a small document is one unit and a larger one is cut into windows.
    """
    blocks = blocks.withColumn("heading_path", F.coalesce("heading_path", F.array().cast("array<string>")))
    titles = docs.select("doc_id", X.squeeze(X.or_empty("title")).alias("doc_title"), X.or_empty("plain_text").alias("plain_text"))
    shape = blocks.groupBy("doc_id").agg(
        F.bool_or(F.col("type") == "heading").alias("headed"), F.count("*").alias("n"),
        (F.sum(F.when(F.trim("text") != "", F.length(F.trim("text")) + 1).otherwise(0)) - 1).alias("chars"),
    )
    shaped = blocks.join(shape, "doc_id")
    no_path, none = F.array().cast("array<string>"), F.lit(None)
    null_text, null_int = none.cast("string"), none.cast("int")

    first = titles.where("doc_title <> ''").select(
        "doc_id", F.lit(0).alias("kind"), F.lit(0).alias("pos"), null_int.alias("char_start"), null_int.alias("char_end"), no_path.alias("block_ids"), F.col("doc_title").alias("text"),
        no_path.alias("heading_path"), F.array(F.lit("title")).alias("source_block_types"), F.lit("document_title").alias("unit_type"), F.lit("document_title").alias("source"), no_path.alias("warnings"),
    )
    sections = gathered(islands(shaped.where("headed"), ["doc_id"], "order", F.col("heading_path")), ["doc_id", "island"], kind=F.lit(1), unit_type=F.lit("heading_section"), source=F.lit("heading_path_group"))
    flat = shaped.where("not headed")
    small = (F.col("n") <= SMALL_BLOCKS) & (F.col("chars") <= SMALL_CHARS)
    whole = gathered(flat.where(small), ["doc_id"], kind=F.lit(1), unit_type=F.lit("fallback_document"), source=F.lit("small_document_without_headings"))
    cut = flat.where(~small).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("order", "block_id", "type", "text", "heading_path", "char_start", "char_end"))).alias("_all"))
    cut = cut.withColumn("_window", greedy_windows(F.transform("_all", lambda b: F.length(b["text"]))))
    cut = cut.select("doc_id", F.explode(F.arrays_zip("_all", "_window")).alias("x")).select("doc_id", F.col("x._window").alias("window"), "x._all.*")
    windows = gathered(cut, ["doc_id", "window"], kind=F.lit(1), unit_type=F.lit("paragraph_window"), source=F.lit("paragraph_window")).withColumn("heading_path", no_path)
    whole = whole.withColumn("heading_path", no_path)
    tables = blocks.where((F.col("type") == "table") & (F.length(X.squeeze(F.col("text"))) >= LEAST_TABLE_TEXT))
    tables = gathered(tables, ["doc_id", "order"], kind=F.lit(2), unit_type=F.lit("table_unit"), source=F.lit("table_block"))
    listed = islands(blocks, ["doc_id"], "order", F.when(F.col("type") == "list_item", F.col("heading_path"))).where("type = 'list_item'")
    lists = gathered(listed, ["doc_id", "island"], kind=F.lit(3), unit_type=F.lit("list_unit"), source=F.lit("consecutive_list_items")).where(F.size("block_ids") >= LEAST_LIST)
    from_blocks = sections.where("text <> ''").unionByName(whole).unionByName(windows.where("text <> ''")).unionByName(tables).unionByName(lists).withColumn("warnings", no_path)
    empty = titles.where("doc_title = ''").join(shape.select("doc_id"), "doc_id", "left_anti").select(
        "doc_id", F.lit(1).alias("kind"), F.lit(0).alias("pos"), null_int.alias("char_start"), null_int.alias("char_end"), no_path.alias("block_ids"), F.col("plain_text").alias("text"), no_path.alias("heading_path"),
        no_path.alias("source_block_types"), F.lit("fallback_document").alias("unit_type"), F.lit("empty_fallback").alias("source"), F.array(F.lit("no_blocks_for_ok_document")).alias("warnings"),
    )
    every = first.unionByName(from_blocks.select(first.columns)).unionByName(empty).join(titles.select("doc_id", "doc_title"), "doc_id")
    last = F.try_element_at("heading_path", F.lit(-1))
    own = F.nullif("doc_title", F.lit(""))
    title = F.when(F.col("source") == "empty_fallback", null_text).when(F.col("unit_type") == "document_title", F.col("doc_title")).when(F.col("unit_type") == "heading_section", last).otherwise(F.coalesce(last, own))
    every = every.withColumn("title", title).withColumn("text", X.strip(F.col("text"))).withColumn("unit_index", (F.row_number().over(Window.partitionBy("doc_id").orderBy("kind", "pos")) - 1).cast("int"))
    key = X.json_object(
        doc_id=X.json_string(F.col("doc_id")), unit_index=F.col("unit_index").cast("string"), unit_type=X.json_string(F.col("unit_type")), title=X.json_string(F.col("title")),
        block_ids=X.json_strings(F.col("block_ids")), text=X.json_string(F.substring("text", 1, 500)),
    )
    return every.select(
        F.concat(F.lit("tu_"), X.digest(key, 20)).alias("topic_unit_id"), "doc_id", "unit_index", "unit_type", "title", "heading_path", "block_ids", "text", F.length("text").alias("text_length"),
        "char_start", "char_end", "source_block_types", F.create_map(F.lit("source"), F.col("source")).alias("metadata"), "warnings",
    )
