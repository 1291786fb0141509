"""Summaries, review queues, distributions and counters over candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators.lexicon import Lexicon


def doc_topics(docs: DataFrame, units: DataFrame, candidates: DataFrame, lexicon: Lexicon) -> DataFrame:
    """One row for each document: counts, primary and top candidates, review state."""
    limits = lexicon.review
    n_units = units.groupBy("doc_id").agg(F.count("*").cast("int").alias("topic_unit_count"))
    ids = lambda c, by: F.transform(F.array_sort(F.collect_list(F.when(c, F.struct(*by, "candidate_id")))), lambda x: x["candidate_id"])
    per_doc = candidates.groupBy("doc_id").agg(
        F.count("*").cast("int").alias("candidate_count_total"), ids(F.col("role") == "document_primary_candidate", ["seq"]).alias("primary_candidate_ids"),
        F.slice(ids(F.lit(True), [(-F.col("score")).alias("low"), "seq"]), 1, int(limits["top_k"])).alias("top_candidate_ids_for_review"),
        F.slice(ids(F.col("needs_review"), ["seq"]), 1, 20).alias("needs_review_candidate_ids"), F.count_if(F.col("role") == "facet_only").cast("int").alias("facet_only_count"),
        F.count_if(F.col("role") == "cross_topic_reference").cast("int").alias("cross_topic_reference_count"), F.bool_or("needs_review").alias("_any"), F.bool_or(F.col("role") == "document_primary_candidate").alias("_primary"),
    )
    rows = docs.select("doc_id", "title", "normalization_status").join(n_units, "doc_id", "left").join(per_doc, "doc_id", "left")
    rows = rows.na.fill(0, ["topic_unit_count", "candidate_count_total", "facet_only_count", "cross_topic_reference_count"])
    n = F.col("candidate_count_total")
    warnings = F.array_compact(F.array(F.when(F.col("topic_unit_count") > limits["many_units"], "long_document_many_topic_units"), F.when(n > limits["many_candidates"], "many_candidates_in_document"), F.when(n > limits["explosion"], "candidate_explosion_risk")))
    rows = rows.withColumn("warnings", warnings)
    reason = (
        F.when(n == 0, "document_without_candidates").when(F.size("warnings") > 0, F.array_join("warnings", ",")).when(F.col("_any"), "candidate_needs_review").when(~F.col("_primary"), "no_document_primary_candidate")
    )
    empty = F.array().cast("array<string>")
    for c in ("primary_candidate_ids", "top_candidate_ids_for_review", "needs_review_candidate_ids"):
        rows = rows.withColumn(c, F.coalesce(c, empty))
    return rows.withColumn("review_reason", reason).withColumn("needs_review", F.col("review_reason").isNotNull()).drop("_any", "_primary")


def ambiguity_queue(topics: DataFrame) -> DataFrame:
    return topics.where("needs_review").select("doc_id", "title", F.col("review_reason").alias("reason"), "topic_unit_count", "candidate_count_total", "needs_review_candidate_ids")


def review_rows(docs: DataFrame, units: DataFrame, candidates: DataFrame, top_k: int, sample_size: int) -> DataFrame:
    """The top candidates of each document in one queue: those that need review first, then by score. A negative sample size keeps all."""
    first = [F.desc(F.col("needs_review").cast("int")), F.desc("score"), F.asc("seq")]
    rows = candidates.withColumn("_k", F.row_number().over(Window.partitionBy("doc_id").orderBy(*first))).where(F.col("_k") <= top_k)
    rows = rows.join(docs.select("doc_id", X.or_empty("title").alias("title")), "doc_id", "left").join(units.select("doc_id", "topic_unit_id", F.array_join("heading_path", " > ").alias("unit_path")), ["doc_id", "topic_unit_id"], "left")
    rows = rows.orderBy(*first[:2], "doc_id", "seq")
    if sample_size >= 0:
        rows = rows.limit(sample_size)
    return rows.select(
        "doc_id", "title", "topic_unit_id", X.or_empty("unit_path").alias("heading_path"), "candidate_id", "surface", "core_surface", "entity_type", "role", "facet_type", F.array_join("facets", ";").alias("facets"), "score",
        "confidence_bucket", X.or_empty(F.try_element_at("evidence_texts", F.lit(1))).alias("evidence_text"), F.array_join("warnings", ";").alias("warnings"), "needs_review", "review_reason",
    )


def distribution(topics: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates of each document by role."""
    of = lambda role: F.count_if(F.col("role") == role).cast("int")
    counts = candidates.groupBy("doc_id").agg(
        of("document_primary_candidate").alias("primary_candidate_count"), of("section_topic_candidate").alias("section_candidate_count"), of("cross_topic_reference").alias("cross_reference_count"),
        F.count_if("needs_review").cast("int").alias("needs_review_count"),
    )
    rows = topics.join(counts, "doc_id", "left").na.fill(0, ["primary_candidate_count", "section_candidate_count", "cross_reference_count", "needs_review_count"])
    return rows.select("doc_id", "title", "topic_unit_count", "candidate_count_total", "primary_candidate_count", "section_candidate_count", "cross_reference_count", "facet_only_count", "needs_review_count", F.array_join("warnings", ";").alias("warnings"))


def counters(candidates: DataFrame) -> DataFrame:
    """Candidates by role, by type and by bucket, in one pass: (counter, value, n)."""
    found = candidates.groupingSets([["role"], ["entity_type"], ["confidence_bucket"]], "role", "entity_type", "confidence_bucket").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    name = F.when(F.col("g") == 3, "role").when(F.col("g") == 5, "entity_type").otherwise("confidence_bucket")
    return found.select(name.alias("counter"), F.coalesce("role", "entity_type", "confidence_bucket").alias("value"), "n")


def top_facets(candidates: DataFrame, k: int = 20) -> DataFrame:
    return candidates.select(F.explode("facets").alias("facet")).groupBy("facet").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "facet").limit(k)


def top_rejected(candidates: DataFrame, k: int = 20) -> DataFrame:
    return candidates.where("role = 'rejected_generic'").groupBy("normalized_surface").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "normalized_surface").limit(k)


def by_document(topics: DataFrame, units: DataFrame, candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """Everything known of a document in one nested row."""
    nested = lambda df, name, order: df.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*order, F.struct(*[c for c in df.columns if c != "score_components" and c != "metadata" and c != "qualifiers"]).alias("row")))).alias(name)).withColumn(name, F.transform(name, lambda x: x["row"]))
    return (
        topics.select("doc_id", F.struct(*topics.columns).alias("summary"))
        .join(nested(units, "topic_units", ["unit_index"]), "doc_id", "left").join(nested(candidates, "candidates", ["seq"]), "doc_id", "left").join(nested(evidence, "evidence", ["evidence_id"]), "doc_id", "left")
    )
