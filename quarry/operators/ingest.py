"""Stage S00: source rows to hashed documents, a manifest and a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as X

ID_COLUMNS = ("source_id", "id", "document_id", "uuid")
REQUIRED = ("name", "content")
KNOWN = ("name", "description", "content", "source_row", "extra_values")


def missing_columns(rows: DataFrame) -> list[str]:
    return sorted(set(REQUIRED) - set(rows.columns))


def documents(rows: DataFrame) -> DataFrame:
    """One document for each source row.

    The source id is the first filled one of ID_COLUMNS; all other unknown columns that hold something become
    metadata. Rows without a source_row get numbers in no order. Rows with equal name or id and content share a doc_id and all stay.
    """
    if gone := missing_columns(rows):
        raise ValueError(f"missing required columns: {', '.join(gone)}")
    ids = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ID_COLUMNS if c in rows.columns]
    extra = [c for c in rows.columns if c not in KNOWN and c not in ID_COLUMNS]
    names, values = [F.lit(c) for c in extra], [F.col(f"`{c}`").cast("string") for c in extra]
    if "extra_values" in rows.columns:
        names, values = [*names, F.lit("extra_values")], [*values, F.col("extra_values").cast("string")]
    metadata = F.map_filter(F.map_from_arrays(F.array(*names), F.array(*values)), lambda _, v: v.isNotNull() & (v != "")) if names else F.create_map().cast("map<string,string>")
    order = F.col("source_row").cast("long") if "source_row" in rows.columns else F.monotonically_increasing_id()
    raw, hashed = X.or_empty("content"), X.content_hash(F.col("content"))
    source_id = F.coalesce(*ids) if ids else F.lit(None).cast("string")
    description = X.or_empty("description") if "description" in rows.columns else F.lit("")
    base = rows.select(source_id.alias("source_id"), order.alias("source_row"), X.or_empty("name").alias("name"), description.alias("description"), raw.alias("raw_content"), hashed.alias("content_hash"), metadata.alias("metadata"))
    return base.select(
        X.make_doc_id(F.col("source_id"), F.col("name"), F.col("content_hash")).alias("doc_id"),
        "source_id", "source_row", "name", "description", "raw_content", "content_hash",
        F.length("raw_content").alias("raw_length"),
        X.is_html(F.col("raw_content")).alias("has_html"),
        F.when(X.strip(F.col("raw_content")) == "", "empty_content").otherwise("ok").alias("ingest_status"),
        "metadata",
    )


def manifest(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source_row", "content_hash", "ingest_status")


def report(docs: DataFrame) -> DataFrame:
    return docs.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("ingest_status") == "ok").alias("ok_rows"),
        F.count_if(F.col("ingest_status") == "empty_content").alias("empty_content_rows"),
        F.count_if(~F.col("ingest_status").isin("ok", "empty_content")).alias("failed_rows"),
    )


def duplicates(docs: DataFrame) -> DataFrame:
    """Documents whose id stands more than once; none of them is dropped."""
    return docs.groupBy("doc_id").agg(F.count("*").alias("copies")).where("copies > 1")
