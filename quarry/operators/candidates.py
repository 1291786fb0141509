"""Tag candidates: five ordered passes over titles, headings, units, blocks and texts, merged, scored and given roles."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.functions.spans import KEYWORD, span_finder
from quarry.operators.lexicon import LEAST_MINED_KEYWORD, MINED_PATTERN_TYPES, Lexicon
from quarry.operators.surface import classify, parse_surfaces
from quarry.sources.shared import cut

#: Fixed value: the block id of evidence from a title.
TITLE_BLOCK = "__document_title__"
MOST_PREFIX = 90
NO_UNIT = 999
CONDITIONAL_TYPES = ("symptom", "contraindication", "adverse_effect")
CROSS_TYPES = ("disease", "medical_device", "diagnostic_test", "procedure", "drug_product", "drug_brand", "drug_substance")
GENERIC_ROLES = ("facet_only", "rejected_generic")


def drop_overlaps(spans: Column) -> Column:
    """The spans that a greedy pass from left to right keeps: at one start the longest, then the first listed."""
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (s["start"] - s["end"]).alias("shorter"), s["rank"].alias("rank"), s.alias("span"))))
    none = F.array().cast("array<struct<start: int, end: int, surface: string, pattern: string, kind: string, rank: int>>")

    def take(state: Column, s: Column) -> Column:  # spans come by their start, so one number says where the kept ones end
        free = s["start"] >= state["reach"]
        kept = F.when(free, F.array_append(state["kept"], s["span"])).otherwise(state["kept"])
        return F.struct(F.when(free, s["span"]["end"]).otherwise(state["reach"]).alias("reach"), kept.alias("kept"))

    return F.aggregate(keyed, F.struct(F.lit(-1).alias("reach"), none.alias("kept")), take, lambda state: state["kept"])


def mention_rules(lexicon: Lexicon) -> list[tuple[str, str, str]]:
    rules = []
    for kind in lexicon.entity_types:
        rules += [(rf"(?<!\w){re.escape(k)}(?!\w)", kind, f"{KEYWORD}{k}") for k in lexicon.entity_types[kind].get("keywords") or [] if len(k or "") >= LEAST_MINED_KEYWORD]
        if kind in MINED_PATTERN_TYPES:
            rules += [(p, kind, f"regex:{p}") for p in lexicon.patterns(kind)]
    return rules


def mentions(units: DataFrame, lexicon: Lexicon) -> DataFrame:
    """One row for each mention that a unit's text keeps: topic_unit_id, doc_id, sub, surface, kind, pattern."""
    find = span_finder(mention_rules(lexicon))
    found = units.select("doc_id", "topic_unit_id", find(F.col("text")).alias("spans"))
    return found.where(F.size("spans") > 0).select("doc_id", "topic_unit_id", F.posexplode(drop_overlaps(F.col("spans"))).alias("sub", "s")).select("doc_id", "topic_unit_id", "sub", "s.surface", "s.kind", "s.pattern")


def header_values(blocks: DataFrame) -> DataFrame:
    """The cells of each table's first row, or of its first text line."""
    first_row = F.filter(F.try_element_at("metadata.rows", F.lit(1)), lambda c: X.or_empty(c) != "")
    line = F.try_element_at(F.split("text", r"\R"), F.lit(1))
    split = F.filter(F.transform(F.split(line, r"\s*\|\s*|\t"), X.squeeze), lambda c: c != "")
    has_rows = F.coalesce(F.size("metadata.rows") > 0, F.lit(False))
    return blocks.where("type = 'table'").select("*", F.posexplode(F.when(has_rows, first_row).otherwise(split)).alias("sub", "value"))


def _evidence(block_id: Column, kind: str, text: Column, path: Column, start: Column, end: Column, weight: Column | float) -> Column:
    return F.struct(
        block_id.alias("block_id"), F.lit(kind).alias("evidence_type"), X.trim_evidence(text).alias("text"), F.coalesce(path, F.array().cast("array<string>")).alias("heading_path"),
        start.cast("int").alias("char_start"), end.cast("int").alias("char_end"), (weight if isinstance(weight, Column) else F.lit(weight)).cast("double").alias("weight"),
    ).alias("evidence")


def _of_block(kind: str, weight: float) -> Column:
    return _evidence(F.col("block_id"), kind, F.col("text"), F.col("heading_path"), F.col("char_start"), F.col("char_end"), weight)


def hits(docs: DataFrame, blocks: DataFrame, units: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Every sighting of a surface: doc_id, unit, order (pass, pos, sub), value, sources, evidence and a given class where the pass has one."""
    unit_cols = units.select("doc_id", "topic_unit_id", "unit_index", F.col("text").alias("unit_text"), "unit_type", F.col("title").alias("unit_title"), F.col("heading_path").alias("unit_path"), "block_ids")
    pairs = unit_cols.select("doc_id", "topic_unit_id", "unit_index", F.posexplode("block_ids").alias("place", "block_id"))
    of_block = pairs.groupBy("doc_id", "block_id").agg(F.max_by("topic_unit_id", "unit_index").alias("topic_unit_id"))
    placed = blocks.join(of_block, ["doc_id", "block_id"], "left")
    none = F.lit(None).cast("string")
    given = lambda kind=none, pattern=none, conf=F.lit(None): [kind.alias("g_type"), pattern.alias("g_pattern"), conf.cast("double").alias("g_confidence")]
    order = lambda p, pos, sub=F.lit(0): F.struct(F.lit(p).alias("pass"), pos.cast("long").alias("pos"), sub.cast("long").alias("sub")).alias("seq")
    sources = lambda *names: F.array(*(F.lit(n) for n in names)).alias("sources")
    no = F.lit(None)

    titled = docs.select("doc_id", X.squeeze(X.or_empty("title")).alias("value")).where("value <> ''").join(unit_cols.where("unit_type = 'document_title'").select("doc_id", "topic_unit_id"), "doc_id", "left")
    titled = titled.select("doc_id", "topic_unit_id", order(0, F.lit(0)), "value", sources("title", "document_title"), _evidence(F.lit(TITLE_BLOCK), "title", F.col("value"), no.cast("array<string>"), no, no, 1.0), *given())

    first = F.min(F.when(F.col("type") == "heading", F.col("order"))).over(Window.partitionBy("doc_id"))
    headings = placed.withColumn("_first", first).where("type = 'heading'")
    headings = headings.select("doc_id", "topic_unit_id", order(1, F.col("order")), F.col("text").alias("value"), F.when(F.col("order") == F.col("_first"), sources("heading", "first_heading")).otherwise(sources("heading")).alias("sources"), _of_block("heading", 0.9), *given())

    # texts are brought to their compared form once, before they meet their mentions
    plain = blocks.select("doc_id", "block_id", "text", X.normalize_surface(X.or_empty("text")).alias("compared"), "heading_path", "char_start", "char_end")
    lead = pairs.join(plain, ["doc_id", "block_id"])
    texts = F.struct("place", "block_id", "text", "compared", "heading_path", "char_start", "char_end")
    lead = lead.groupBy("doc_id", "topic_unit_id").agg(F.array_sort(F.collect_list(texts)).alias("b"))
    named = unit_cols.where("unit_type <> 'document_title' and unit_title <> ''").join(lead, ["doc_id", "topic_unit_id"], "left")
    b = F.try_element_at("b", F.lit(1))
    with_block = _evidence(b["block_id"], "heading_path", b["text"], b["heading_path"], b["char_start"], b["char_end"], 0.75)
    without = _evidence(F.lit(TITLE_BLOCK), "heading_path", F.col("unit_title"), F.col("unit_path"), no, no, 0.6)
    named = named.select("doc_id", "topic_unit_id", order(2, F.col("unit_index")), F.col("unit_title").alias("value"), sources("heading_path"), F.when(b.isNotNull(), with_block).otherwise(without).alias("evidence"), *given())

    cells = header_values(placed).select("doc_id", "topic_unit_id", order(3, F.col("order"), F.col("sub")), "value", sources("table"), _of_block("table", 0.55), *given())
    prefix = X.strip(F.substring_index("text", ":", 1))
    items = placed.where(F.col("type") == "list_item").where(F.contains("text", F.lit(":"))).withColumn("value", prefix).where(F.length("value").between(1, MOST_PREFIX))
    items = items.select("doc_id", "topic_unit_id", order(3, F.col("order")), "value", sources("list_item"), _of_block("list_item", 0.55), *given())

    real = unit_cols.where("unit_type <> 'document_title'")
    mined = mentions(units.where("unit_type <> 'document_title'"), lexicon).withColumn("value", F.col("surface")).withColumn("weight", F.lit(0.45)).withColumn("conf", F.lit(0.76)).withColumn("step", F.lit(0))
    if verb := lexicon.treatment_verb:
        words = real.select("doc_id", "topic_unit_id", F.posexplode(F.regexp_extract_all("unit_text", F.lit("(?iU)" + verb["pattern"]), F.lit(0))).alias("sub", "surface"))
        words = words.select("doc_id", "topic_unit_id", "sub", "surface", F.lit("treatment").alias("kind"), F.lit("facet_verb:леч").alias("pattern"), F.lit(verb["surface"]).alias("value"), F.lit(0.35).alias("weight"), F.lit(0.65).alias("conf"), F.lit(1).alias("step"))
        mined = mined.unionByName(words)
    mined = mined.join(real.select("doc_id", "topic_unit_id", "unit_index"), ["doc_id", "topic_unit_id"]).join(lead, ["doc_id", "topic_unit_id"])
    mined = mined.withColumn("_s", X.normalize_surface(F.col("surface")))
    holding = F.filter("b", lambda x: (F.col("_s") != "") & F.contains(x["compared"], F.col("_s")))
    h = F.coalesce(F.try_element_at(holding, F.lit(1)), b)
    mined = mined.withColumn("_h", h)
    h = F.col("_h")
    mined = mined.select(
        "doc_id", "topic_unit_id", order(4, F.col("unit_index"), F.col("step") * F.lit(1 << 32) + F.col("sub")), "value", sources("pattern_match"),
        _evidence(h["block_id"], "pattern_match", h["text"], h["heading_path"], h["char_start"], h["char_end"], F.col("weight")), *given(F.col("kind"), F.col("pattern"), F.col("conf")),
    )
    out = titled
    for more in (headings, named, cells, items, mined):
        out = out.unionByName(more)
    return out


def drafts(sightings: DataFrame, units: DataFrame, blocks: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Sightings of one core, type and facets in one unit merged: the first gives all single values, the rest add sources and evidence."""
    # each distinct phrase is parsed and classified once; the tables between keep the two cascades from being planned into each other
    phrases = cut(parse_surfaces(sightings.select("value").distinct(), "value", lexicon))
    phrases = cut(classify(phrases, "p_surface", lexicon).where("p_surface <> ''"))
    rows = sightings.join(phrases, "value")
    known = F.col("g_type").isNotNull()
    rows = rows.withColumn("entity_type", F.when(known, F.col("g_type")).otherwise(F.col("c_type")))
    rows = rows.withColumn("c_pattern", F.when(known, F.col("g_pattern")).otherwise(F.col("c_pattern"))).withColumn("c_confidence", F.when(known, F.col("g_confidence")).otherwise(F.col("c_confidence")))
    idle_cell = (F.col("evidence.evidence_type") == "table") & (F.col("entity_type") == "unknown") & (F.size("p_facets") == 0)
    rows = rows.where(~idle_cell).withColumn("unit_key", X.or_empty("topic_unit_id")).withColumn("core_key", F.coalesce(F.nullif("p_normalized_core", F.lit("")), F.col("p_normalized")))
    single = F.struct("topic_unit_id", "p_surface", "p_normalized", "p_core", "p_normalized_core", "p_facet_type", "p_generic", "p_facet_only", "p_confidence", "p_pattern", "c_pattern", "c_confidence")
    merged = rows.groupBy("doc_id", "unit_key", "core_key", "entity_type", F.col("p_facets").alias("facets")).agg(
        F.min("seq").alias("seq"), F.min_by(single, "seq").alias("one"), F.array_sort(F.collect_list(F.struct("seq", "sources", "evidence"))).alias("all")
    )
    evidence = F.transform("all", lambda x: x["evidence"])

    def distinct(kept: Column, e: Column) -> Column:
        same = lambda k: (k["block_id"] == e["block_id"]) & (k["evidence_type"] == e["evidence_type"]) & (k["text"] == e["text"])
        return F.when(F.exists(kept, same), kept).otherwise(F.array_append(kept, e))

    merged = merged.withColumn("evidence", F.aggregate(evidence, F.slice(evidence, 1, 0), distinct)).withColumn("sources", F.array_distinct(F.flatten(F.transform("all", lambda x: x["sources"])))).drop("all")
    merged = merged.select("doc_id", "seq", "one.*", "entity_type", "facets", "sources", "evidence")
    names = {"p_surface": "surface", "p_normalized": "normalized_surface", "p_core": "core_surface", "p_normalized_core": "normalized_core_surface", "p_facet_type": "facet_type", "p_generic": "is_generic", "p_facet_only": "is_facet_only", "p_confidence": "split_confidence"}
    merged = merged.withColumnsRenamed(names)
    filled = lambda field: F.array_distinct(F.filter(F.transform("evidence", lambda e: e[field]), lambda v: v != ""))
    paths = F.array_distinct(F.filter(F.transform("evidence", lambda e: e["heading_path"]), lambda p: F.size(p) > 0))
    merged = merged.withColumns({"evidence_block_ids": filled("block_id"), "evidence_texts": filled("text"), "heading_paths": paths})
    compared = units.select("doc_id", "topic_unit_id", "unit_index", X.normalize_surface(X.or_empty("text")).alias("unit_text"))
    merged = merged.join(compared, ["doc_id", "topic_unit_id"], "left")
    headed = blocks.where("type = 'heading'").groupBy("doc_id").agg(F.collect_list(X.normalize_surface(X.or_empty("text"))).alias("headings"))
    merged = merged.join(headed, "doc_id", "left").withColumn("unit_index", F.coalesce("unit_index", F.lit(NO_UNIT)))
    merged = merged.withColumn("_needle", X.normalize_surface(X.or_empty(F.coalesce(F.nullif("core_surface", F.lit("")), F.col("surface")))))
    count = F.coalesce(F.size(F.filter("headings", lambda h: F.contains(h, F.col("_needle")))), F.lit(0))
    merged = merged.withColumn("heading_hits", F.when(F.col("_needle") != "", F.when(F.col("headings").isNull(), 0).otherwise(count)).otherwise(0))
    own = F.coalesce("unit_text", X.normalize_surface(X.or_empty("surface")))
    return merged.withColumn("unit_frequency", X.occurrences(own, F.col("_needle"))).drop("_needle", "headings", "unit_text")


def score_terms(lexicon: Lexicon) -> dict[str, Column]:
    """Each term of the score: null where it does not apply."""
    w = {k: F.lit(float(v)) for k, v in lexicon.scoring["components"].items()}
    has = lambda s: F.array_contains("sources", s)
    generic, known = F.col("is_generic"), F.col("entity_type") != "unknown"
    length = F.length(F.coalesce(F.nullif("normalized_core_surface", F.lit("")), F.col("normalized_surface")))
    return {
        "base_entity": F.when(known & ~generic, w["base_entity"]),
        "base_generic_facet": F.when(~(known & ~generic) & (F.size("facets") > 0), w["base_generic_facet"]),
        "title_entity_match": F.when(has("title"), w["title_entity_match"]),
        "heading_entity_match": F.when(has("heading") | has("first_heading"), w["heading_entity_match"]),
        "heading_path_match": F.when(has("heading_path"), w["heading_path_match"]),
        "cross_reference_signal": F.when(has("pattern_match"), w["cross_reference_signal"]),
        "topic_unit_position": F.when(F.col("unit_index") <= 1, w["topic_unit_position"]).when(F.col("unit_index") <= 5, F.round(w["topic_unit_position"] * 0.5, 4)),
        "entity_pattern_match": F.when(X.or_empty("c_pattern") != "", w["entity_pattern_match"]),
        "facet_split_confidence": F.when(F.col("split_confidence") != 0, F.round(w["facet_split_confidence"] * F.col("split_confidence"), 4)),
        "frequency_in_headings": F.when(F.col("heading_hits") > 0, F.round(F.least(w["frequency_in_headings"], F.col("heading_hits") * 0.025), 4)),
        "frequency_in_unit_text": F.when(F.col("unit_frequency") > 1, F.round(F.least(w["frequency_in_unit_text"], (F.col("unit_frequency") - 1) * 0.02), 4)),
        "generic_penalty": F.when(generic, w["generic_penalty"]),
        "dosage_only_penalty": F.when((F.col("facet_type") == "dosage") & ~known, w["dosage_only_penalty"]),
        "too_short_penalty": F.when(length <= 2, w["too_short_penalty"]),
    }


def bucket(score: Column) -> Column:
    return F.when(score >= 0.80, "high").when(score >= 0.55, "medium").otherwise("low")


def scored(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Adds candidate_id, score, score_components and confidence_bucket; drops what scores below the minimum."""
    terms = score_terms(lexicon)
    entries = F.array_compact(F.array(*(F.when(c.isNotNull(), F.struct(F.lit(k).alias("key"), c.cast("double").alias("value"))) for k, c in terms.items())))
    rows = rows.withColumn("score_components", F.map_from_entries(entries))
    total = F.aggregate(F.map_values("score_components"), F.lit(0.0), lambda a, x: a + x)
    rows = rows.withColumn("score", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), 4)).withColumn("confidence_bucket", bucket(F.col("score")))
    key = X.json_object(
        doc_id=X.json_string(F.col("doc_id")), topic_unit_id=X.json_string(F.col("topic_unit_id")), surface=X.json_string(F.col("normalized_surface")), core=X.json_string(F.col("normalized_core_surface")),
        entity_type=X.json_string(F.col("entity_type")), facets=X.json_strings(F.col("facets")),
    )
    return rows.withColumn("candidate_id", F.concat(F.lit("cand_"), X.digest(key, 20))).where(F.col("score") >= float(lexicon.scoring.get("minimum_score", 0.12)))


def with_roles(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Adds role, needs_review, review_reason and warnings: the best entity of a document, of each unit, and what the rest signals."""
    limits = {"primary_min_score": 0.8, "section_min_score": 0.45, "secondary_min_score": 0.32, "needs_review_score": 0.55} | {k: v for k, v in lexicon.scoring.items() if k != "components"}
    has = lambda s: F.array_contains("sources", s)
    entity = (F.col("entity_type") != "unknown") & ~F.col("is_generic") & ~F.col("is_facet_only")
    bonus = has("title").cast("int") * 3 + has("first_heading").cast("int") * 2 + has("heading").cast("int")
    best = [F.desc("score"), F.desc("_bonus"), F.asc("unit_index"), F.asc("seq")]
    rows = rows.withColumn("_bonus", bonus).withColumn("_entity", entity)
    first = F.row_number().over(Window.partitionBy("doc_id", "_main").orderBy(*best))
    rows = rows.withColumn("_main", F.col("_entity") & (F.col("score") >= limits["primary_min_score"])).withColumn("_primary", F.col("_main") & (first == 1))
    apt = F.col("_entity") & ~F.col("_primary") & (F.col("score") >= limits["section_min_score"]) & ~has("document_title") & F.col("topic_unit_id").isNotNull()
    in_unit = F.row_number().over(Window.partitionBy("doc_id", "topic_unit_id", "_apt").orderBy(*best))
    rows = rows.withColumn("_apt", apt).withColumn("_section", F.col("_apt") & (in_unit == 1))
    said = F.array_join("evidence_texts", " ")
    conditional = F.col("entity_type").isin(*CONDITIONAL_TYPES) & (said.rlike(rf"(?iU)\b({'|'.join(lexicon.conditional_words)})\b") if lexicon.conditional_words else F.lit(False))
    cross = has("pattern_match") & F.col("entity_type").isin(*CROSS_TYPES)
    role = (
        F.when(F.col("is_generic") & F.col("facet_type").isNotNull(), "facet_only")
        .when(F.col("is_generic"), "rejected_generic")
        .when(F.col("_primary"), "document_primary_candidate")
        .when(conditional, "conditional_context")
        .when(F.col("_section"), "section_topic_candidate")
        .when(cross, "cross_topic_reference")
        .when(F.col("_entity") & (F.col("score") >= limits["secondary_min_score"]), "secondary_topic_candidate")
        .otherwise("needs_review")
    )
    rows = rows.withColumn("role", role)
    plain = ~F.col("role").isin(*GENERIC_ROLES)
    reason = F.coalesce(
        F.when(F.col("role") == "rejected_generic", "generic_phrase_without_entity"),
        F.when(F.col("role") == "needs_review", "low_score_or_unknown_entity"),
        F.when((F.col("entity_type") == "unknown") & plain, "unknown_entity_type"),
        F.when((F.col("score") < limits["needs_review_score"]) & plain, "score_below_review_threshold"),
    )
    generic = F.when(~plain, F.array(F.lit("generic_facet_not_primary"))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("review_reason", reason).withColumn("needs_review", F.col("review_reason").isNotNull()).withColumn("warnings", generic)
    return rows.drop("_bonus", "_entity", "_main", "_primary", "_apt", "_section")


def candidates(docs: DataFrame, blocks: DataFrame, units: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All candidates with their evidence arrays, scores and roles."""
    sightings = cut(hits(docs, blocks, units, lexicon))
    return with_roles(scored(cut(drafts(sightings, units, blocks, lexicon)), lexicon), lexicon)


def candidate_table(rows: DataFrame) -> DataFrame:
    """The columns of tag_candidates."""
    return rows.select(
        "candidate_id", "doc_id", "topic_unit_id", "role", "surface", "normalized_surface", "core_surface", "normalized_core_surface", "entity_type", F.lit(None).cast("string").alias("entity_subtype"), "facet_type", "facets",
        F.create_map().cast("map<string,string>").alias("qualifiers"), "sources", "evidence_block_ids", "evidence_texts", "heading_paths", "score", "score_components", "confidence_bucket", "needs_review", "review_reason", "warnings",
        F.struct(F.col("p_pattern").alias("parser_pattern"), F.col("c_pattern").alias("classifier_pattern"), F.col("c_confidence").alias("classifier_confidence"), F.col("is_generic").alias("is_generic"), F.lit(None).cast("string").alias("no_evidence_reason")).alias("metadata"), "seq", "unit_index",
    )


def evidence_table(rows: DataFrame) -> DataFrame:
    """One row for each piece of evidence of each candidate."""
    each = rows.select("candidate_id", "doc_id", "topic_unit_id", F.explode("evidence").alias("e"))
    key = X.json_object(candidate_id=X.json_string(F.col("candidate_id")), block_id=X.json_string(F.col("e.block_id")), evidence_type=X.json_string(F.col("e.evidence_type")), text=X.json_string(F.col("e.text")))
    return each.select(F.concat(F.lit("ev_"), X.digest(key, 20)).alias("evidence_id"), "candidate_id", "doc_id", "topic_unit_id", "e.block_id", "e.evidence_type", "e.text", "e.heading_path", "e.char_start", "e.char_end", "e.weight")
