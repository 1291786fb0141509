"""Audits of normalised documents: quality figures, extremes, samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as X

TOP = 20


def low_preservation(normalized: DataFrame, k: int = TOP) -> DataFrame:
    found = normalized.where((F.coalesce("text_preservation_ratio", F.lit(1.0)) < 0.8) & (F.col("normalization_status") != "empty_content"))
    return found.orderBy(F.asc_nulls_last("text_preservation_ratio"), "doc_id").limit(k)


def without_blocks(normalized: DataFrame) -> DataFrame:
    return normalized.where("block_count = 0 and normalization_status <> 'empty_content'")


def errors(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col("normalization_status").isin("failed", "no_blocks") | F.col("error").isNotNull())


def largest(normalized: DataFrame, column: str, k: int = TOP) -> DataFrame:
    return normalized.orderBy(F.desc_nulls_last(column), "doc_id").limit(k)


def is_suspicious() -> Column:
    blank = (X.strip(X.or_empty("markdown")) == "") & (F.coalesce("raw_length", F.lit(0)) > 0)
    return (
        (F.coalesce("block_count", F.lit(0)) == 0) | (F.coalesce("text_preservation_ratio", F.lit(1.0)) < 0.8) | (F.coalesce("unknown_count", F.lit(0)) > 0)
        | (F.size(X.json_markers(F.col("plain_text"))) > 0) | F.coalesce(F.col("normalization_status").isin("failed", "no_blocks"), F.lit(False)) | blank
    )


def summary(normalized: DataFrame) -> DataFrame:
    """Quality figures of the stage in one row."""
    status = lambda s: F.count_if(F.col("normalization_status") == s)
    return normalized.agg(
        F.count("*").alias("documents"), status("empty_content").alias("empty"), status("ok").alias("ok"), F.count_if(F.col("normalization_status").isin("failed", "no_blocks")).alias("failed"),
        F.count_if("has_tables").alias("with_tables"), F.count_if("has_headings").alias("with_headings"), F.count_if(F.size(X.json_markers(F.col("plain_text"))) > 0).alias("with_json_markers"),
    )


def samples(normalized: DataFrame, size: int, seeds: tuple[int, int] = (42, 7)) -> DataFrame:
    """(doc_id, reasons): a bounded sample for people to look at.

    Buckets are taken in turn: random, largest, with tables, many blocks, suspicious, and random again to fill up.
    Each adds up to a fifth of the size in new documents, and its reason to those taken before that it meets on
    the way. Only `size` times six ids come to the driver, from bounded top-k plans.
    """
    if size <= 0:
        return normalized.sparkSession.createDataFrame([], "doc_id string, reasons array<string>")
    quota = max(1, math.ceil(size / 5))
    random = lambda seed: [F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id"))), F.col("doc_id")]
    buckets = [
        ("random", normalized, random(seeds[0]), quota), ("largest", normalized, [F.desc_nulls_last("raw_length"), F.col("doc_id")], quota),
        ("table", normalized.where("coalesce(has_tables, false)"), [F.col("doc_id")], quota), ("many_blocks", normalized, [F.desc_nulls_last("block_count"), F.col("doc_id")], quota),
        ("suspicious", normalized.where(is_suspicious()), [F.col("doc_id")], quota), ("fill", normalized, random(seeds[1]), size),
    ]
    chosen: dict[str, list[str]] = {}
    for reason, rows, order, most in buckets:
        added = 0
        if reason == "fill" and len(chosen) >= size:
            break
        for doc_id in [r["doc_id"] for r in rows.where("doc_id <> ''").orderBy(*order).limit(2 * size + quota).select("doc_id").collect()]:
            if len(chosen) >= size or added >= most:
                break
            added += doc_id not in chosen
            reasons = chosen.setdefault(doc_id, [])
            if reason not in reasons:
                reasons.append(reason)
    return normalized.sparkSession.createDataFrame(list(chosen.items()), "doc_id string, reasons array<string>")


def ranked_samples(normalized: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """The first documents of each bucket in one plan: (doc_id, bucket, place); each document under its first bucket."""
    quota = max(1, math.ceil(size / 5))
    out = None
    for k, (name, rows, order) in enumerate(
        [("random", normalized, [F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id")))]), ("largest", normalized, [F.desc_nulls_last("raw_length")]), ("many_blocks", normalized, [F.desc_nulls_last("block_count")])]
    ):
        top = rows.orderBy(*order, "doc_id").limit(quota)
        place = F.row_number().over(Window.orderBy(*order, "doc_id"))
        one = top.select("doc_id", F.lit(k).alias("turn"), F.lit(name).alias("bucket"), place.alias("place"))
        out = one if out is None else out.unionByName(one)
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("turn"))
    return out.withColumn("_first", first).where("_first = 1").select("doc_id", "bucket", "place")
