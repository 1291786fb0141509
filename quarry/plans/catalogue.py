"""The registered queries of the document operators, each with its SQL where SQL can express it.

Every query runs over its whole tables. Names follow the operators: sources and ingest, formats, blocks, units,
surfaces, candidates, review, relations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import tables as TB
from quarry.functions import text as X
from quarry.functions.markup import parse_editorjs
from quarry.operators import audit, ingest, normalize, relations, review, units
from quarry.operators import blocks as B
from quarry.operators import candidates as C
from quarry.operators.surface import classify, parse_surfaces
from quarry.plans.base import DOCS_SQL, ENGLISH, LINES_SQL, PARTS_SQL, TURNS_SQL, WORKSHOP, documents, normal_sql, pages, table, tagged_parts, turns
from quarry.plans.stages import normalise, tag
from quarry.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


@query(f"WITH {DOCS_SQL} SELECT doc_id, source_id, content_hash, raw_length, has_html, ingest_status FROM docs")
def q01_ingest_documents(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", "source_id", "content_hash", "raw_length", "has_html", "ingest_status")


@query(f"WITH {DOCS_SQL} SELECT doc_id, source_row, content_hash, ingest_status FROM docs")
def q02_manifest(spark, sf_dir):
    return ingest.manifest(documents(spark, sf_dir))


@query(f"""WITH {DOCS_SQL} SELECT count(*) AS total_rows, count(*) FILTER (ingest_status = 'ok') AS ok_rows, count(*) FILTER (ingest_status = 'empty_content') AS empty_content_rows,
  CAST(0 AS BIGINT) AS failed_rows FROM docs""")
def q03_ingest_report(spark, sf_dir):
    return ingest.report(documents(spark, sf_dir))


@query(f"WITH {DOCS_SQL} SELECT content_hash, count(*) AS copies FROM docs GROUP BY content_hash HAVING count(*) > 1")
def q04_content_hash_duplicates(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.groupBy("content_hash").agg(F.count("*").alias("copies")).where("copies > 1")


@query(r"""
WITH bodies AS (SELECT 'documents' AS origin, text AS body FROM documents UNION ALL SELECT 'pages', html FROM pages UNION ALL SELECT 'events', props FROM events
  UNION ALL SELECT 'made', '{"blocks": [{"type": "paragraph"}], "i": ' || CAST(p_partkey AS VARCHAR) || '}' FROM part)
SELECT origin, CASE WHEN json_valid(trim(body)) AND json_type(CASE WHEN json_valid(trim(body)) THEN body ELSE '{}' END, '$.blocks') = 'ARRAY' THEN 'editorjs_json'
                    WHEN regexp_matches(body, '<\s*/?\s*[a-zA-Z][^>]*>') THEN 'html' ELSE 'plain_text' END AS format, count(*) AS n
FROM bodies GROUP BY ALL""")
def q05_format_detect(spark, sf_dir):
    made = F.concat(F.lit('{"blocks": [{"type": "paragraph"}], "i": '), F.col("p_partkey").cast("string"), F.lit("}"))
    parts = (("documents", "text", "documents"), ("pages", "html", "pages"), ("events", "props", "events"))
    rows = table(spark, sf_dir, "part").select(F.lit("made").alias("origin"), made.alias("body"))
    for origin, column, name in parts:
        rows = rows.unionByName(table(spark, sf_dir, name).select(F.lit(origin).alias("origin"), F.col(column).alias("body")))
    return rows.groupBy("origin", X.source_format(F.col("body")).alias("format")).agg(F.count("*").alias("n"))


_CASES = ["  a \t b  ", "x\r\n\r\n\r\n y", "\n\nlead", "one\n \n\n\ntwo \n"]


@query(f"""
WITH cases AS (SELECT doc_id, coalesce(text, '') AS text FROM documents UNION ALL
  SELECT unnest([-1, -2, -3, -4]) AS doc_id, unnest(['  a ' || chr(9) || ' b  ', 'x' || chr(13) || chr(10) || chr(13) || chr(10) || chr(13) || chr(10) || ' y', chr(10) || chr(10) || 'lead', 'one' || chr(10) || ' ' || chr(10) || chr(10) || chr(10) || 'two ' || chr(10)]) AS text)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(length({normal_sql("text")}) AS INTEGER) AS n, sha256({normal_sql("text")}) AS digest FROM cases""")
def q06_normalize_whitespace(spark, sf_dir):
    made = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(_CASES)], "doc_id long, text string")
    rows = table(spark, sf_dir, "documents").select("doc_id", X.or_empty("text").alias("text")).unionByName(made)
    tidy = X.normalize_lines(F.col("text"))
    return rows.select("doc_id", F.length(tidy).alias("n"), F.sha2(tidy, 256).alias("digest"))


def _blocks(spark, sf_dir):
    return normalise(documents(spark, sf_dir))[1]


@query(f"WITH {LINES_SQL} SELECT doc_id, ord AS \"order\", type, 'blk_' || substr(sha256(doc_id || ':' || CAST(ord AS VARCHAR) || ':' || text), 1, 20) AS block_id FROM blocks")
def q07_plain_blocks(spark, sf_dir):
    return _blocks(spark, sf_dir).select("doc_id", "order", "type", "block_id")


@query(f"WITH {LINES_SQL} SELECT type, count(*) AS blocks FROM blocks GROUP BY type")
def q08_blocks_by_type(spark, sf_dir):
    return B.counts_by_type(_blocks(spark, sf_dir))


@query(f"""WITH {LINES_SQL} SELECT doc_id, source_row, CAST(count(*) AS INTEGER) AS block_count, CAST(count(*) FILTER (type = 'paragraph') AS INTEGER) AS paragraph_count,
  CAST(count(*) FILTER (type = 'list_item') AS INTEGER) AS list_item_count FROM blocks GROUP BY ALL""")
def q09_block_metrics(spark, sf_dir):
    return B.counts_by_document(_blocks(spark, sf_dir), ["doc_id", "source_row"]).select("doc_id", "source_row", "block_count", "paragraph_count", "list_item_count")


@query(f"""WITH {LINES_SQL} SELECT doc_id, source_row, ord AS "order", CAST(coalesce(sum(length(text)) OVER w, 0) + pos AS INTEGER) AS char_start,
  CAST(coalesce(sum(length(text)) OVER w, 0) + pos + length(text) AS INTEGER) AS char_end
  FROM blocks WINDOW w AS (PARTITION BY doc_id, source_row ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def q10_char_offsets(spark, sf_dir):
    return _blocks(spark, sf_dir).select("doc_id", "source_row", "order", "char_start", "char_end")


@query(f"WITH {TURNS_SQL} SELECT doc_id, ord AS \"order\", path AS heading_path, CAST(length(path) - length(replace(path, ' > ', '')) AS INTEGER) AS marks FROM pathed")
def q11_heading_path(spark, sf_dir):
    found = B.with_heading_path(turns(spark, sf_dir), ["doc_id"])
    path = F.array_join("heading_path", " > ")
    return found.select("doc_id", "order", path.alias("heading_path"), (F.length(path) - F.length(F.replace(path, F.lit(" > ")))).cast("int").alias("marks"))


_RATIO_SQL = f"""
WITH {DOCS_SQL}, done AS (SELECT doc_id, source_row, raw_length, ingest_status, length({normal_sql("raw")}) AS kept FROM docs),
ratios AS (SELECT *, round(least(kept / CAST(nullif(raw_length, 0) AS DOUBLE), 1.0), 4) AS ratio FROM done)
"""


@query(_RATIO_SQL + "SELECT doc_id, source_row, CAST(kept AS INTEGER) AS useful_text_length, CASE WHEN ingest_status = 'ok' THEN ratio END AS useful_text_ratio, CASE WHEN ingest_status = 'ok' THEN 'ok' ELSE 'empty_content' END AS normalization_status FROM ratios")
def q12_text_ratios(spark, sf_dir):
    return normalise(documents(spark, sf_dir))[0].select("doc_id", "source_row", "useful_text_length", "useful_text_ratio", "normalization_status")


@query(r"""
WITH r AS (SELECT page_id, round(least(length(regexp_replace(html, '<[^>]*>', '', 'g')) / CAST(nullif(length(html), 0) AS DOUBLE), 1.0), 4) AS ratio FROM pages)
SELECT CAST(page_id AS VARCHAR) AS doc_id, ratio AS text_preservation_ratio FROM r WHERE ratio < 0.8 ORDER BY ratio, doc_id LIMIT 20""")
def q13_low_ratio_top20(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    bare = F.length(F.regexp_replace("html", "<[^>]*>", ""))
    rows = p.select(F.col("page_id").cast("string").alias("doc_id"), X.ratio(bare, F.length("html")).alias("text_preservation_ratio"), F.lit("ok").alias("normalization_status"))
    return audit.low_preservation(rows).select("doc_id", "text_preservation_ratio")


@query(f"WITH {DOCS_SQL} SELECT doc_id, raw_length FROM docs ORDER BY raw_length DESC NULLS LAST, doc_id LIMIT 20")
def q14_top20_largest(spark, sf_dir):
    return audit.largest(documents(spark, sf_dir), "raw_length").select("doc_id", "raw_length")


@query(r"""SELECT event_id, concat_ws(',', CASE WHEN regexp_matches(x, '(?i)"k"\s*:') THEN 'k' END, CASE WHEN regexp_matches(x, '(?i)"tools"\s*:') THEN 'tools' END) AS markers
FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN props || ' "Tools" : 1' ELSE props END AS x FROM events)""")
def q15_json_markers(spark, sf_dir):
    x = F.when(F.col("event_id") % 3 == 0, F.concat("props", F.lit(' "Tools" : 1'))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(X.json_markers(x, ("k", "tools")), ",").alias("markers"))


@query(r"""SELECT page_id AS source_row, CAST(len(regexp_extract_all(html, '<h[1-6][ >]')) AS BIGINT) AS heading, CAST(len(regexp_extract_all(html, '<li[ >]')) AS BIGINT) AS list_item FROM pages""")
def q16_html_block_counts(spark, sf_dir):
    found = normalize.parsed(pages(spark, sf_dir))
    count = lambda kind: F.size(F.filter("_blocks", lambda b: b["type"] == kind)).cast("long").alias(kind)
    return found.select(F.col("source_row").cast("long").alias("source_row"), count("heading"), count("list_item"))


_RUNS = """, marked AS (SELECT *, CASE WHEN lag({v}) OVER w IS NOT DISTINCT FROM {v} AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS edge FROM pathed WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
runs AS (SELECT *, sum(edge) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS island FROM marked)"""


@query(f"WITH {TURNS_SQL} {_RUNS.format(v='path')} SELECT doc_id, CAST(island AS BIGINT) AS island, min(ord) AS first, max(ord) AS last, count(*) AS n FROM runs GROUP BY doc_id, island")
def q17_heading_groups(spark, sf_dir):
    rows = units.islands(B.with_heading_path(turns(spark, sf_dir), ["doc_id"]), ["doc_id"], "order", F.col("heading_path"))
    return rows.groupBy("doc_id", "island").agg(F.min("order").alias("first"), F.max("order").alias("last"), F.count("*").alias("n"))


_LISTED = "CASE WHEN type <> 'heading' THEN CAST(size % 3 > 0 AS INTEGER) END"


@query(f"WITH {TURNS_SQL} {_RUNS.format(v=_LISTED)} SELECT doc_id, min(ord) AS first, count(*) AS n FROM runs WHERE type <> 'heading' GROUP BY doc_id, island HAVING count(*) >= 1")
def q18_list_groups(spark, sf_dir):
    value = F.when(F.col("type") != "heading", (F.col("size") % 3 > 0).cast("int"))
    rows = units.islands(turns(spark, sf_dir), ["doc_id"], "order", value).where("type <> 'heading'")
    return rows.groupBy("doc_id", "island").agg(F.min("order").alias("first"), F.count("*").alias("n")).select("doc_id", "first", "n")


@query(f"""
WITH RECURSIVE {LINES_SQL}, sized AS (SELECT source_row, ord, length(text) AS n FROM blocks),
walk AS (
  SELECT source_row, ord, 0 AS win, 1 AS held, CAST(n AS BIGINT) AS chars FROM sized WHERE ord = 1
  UNION ALL
  SELECT s.source_row, s.ord, CASE WHEN w.held >= 5 OR w.chars + s.n > 1800 THEN w.win + 1 ELSE w.win END, CASE WHEN w.held >= 5 OR w.chars + s.n > 1800 THEN 1 ELSE w.held + 1 END,
         CASE WHEN w.held >= 5 OR w.chars + s.n > 1800 THEN s.n ELSE w.chars + s.n END
  FROM walk w JOIN sized s ON s.source_row = w.source_row AND s.ord = w.ord + 1
)
SELECT source_row, CAST(win AS INTEGER) AS win, count(*) AS blocks FROM walk GROUP BY ALL""")
def q19_paragraph_windows(spark, sf_dir):
    done = normalize.parsed(documents(spark, sf_dir))
    sizes = F.transform("_blocks", lambda b: F.length(b["text"]))
    return done.select("source_row", F.explode(units.greedy_windows(sizes)).alias("win")).groupBy("source_row", "win").agg(F.count("*").alias("blocks"))


@query(f"""
WITH {TURNS_SQL} {_RUNS.format(v='path')}, shape AS (SELECT doc_id, bool_or(type = 'heading') AS headed FROM turns GROUP BY doc_id),
sections AS (SELECT r.doc_id, 1 AS kind, min(ord) AS pos, 'heading_section' AS unit_type, count(*) AS n, string_agg(name, chr(10) ORDER BY ord) AS text, any_value(path) AS path, string_agg('"' || block_id || '"', ', ' ORDER BY ord) AS ids FROM runs r JOIN shape USING (doc_id) WHERE headed GROUP BY r.doc_id, island),
lmark AS (SELECT *, CASE WHEN lag(CASE WHEN type = 'list_item' THEN path END) OVER w IS NOT DISTINCT FROM CASE WHEN type = 'list_item' THEN path END AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS edge FROM pathed WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
lrun AS (SELECT *, sum(edge) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS island FROM lmark),
lists AS (SELECT doc_id, 3 AS kind, min(ord) AS pos, 'list_unit' AS unit_type, count(*) AS n, string_agg(name, chr(10) ORDER BY ord) AS text, any_value(path) AS path, string_agg('"' || block_id || '"', ', ' ORDER BY ord) AS ids FROM lrun WHERE type = 'list_item' GROUP BY doc_id, island HAVING count(*) >= 2),
every AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY kind, pos) - 1 AS k FROM (SELECT * FROM sections UNION ALL SELECT * FROM lists))
SELECT doc_id, CAST(k AS INTEGER) AS unit_index, unit_type, CAST(n AS INTEGER) AS blocks, CAST(length(text) AS INTEGER) AS text_length,
  'tu_' || substr(sha256('{{"block_ids": [' || ids || '], "doc_id": "' || doc_id || '", "text": "' || replace(substr(text, 1, 500), chr(10), '\\n') || '", "title": ' || CASE WHEN path = '' THEN 'null' ELSE '"' || split_part(path, ' > ', -1) || '"' END
    || ', "unit_index": ' || CAST(k AS VARCHAR) || ', "unit_type": "' || unit_type || '"}}'), 1, 20) AS topic_unit_id FROM every
""")
def q20_topic_units(spark, sf_dir):
    rows = B.with_heading_path(turns(spark, sf_dir), ["doc_id"])
    docs = rows.groupBy("doc_id").agg(F.bool_or(F.col("type") == "heading").alias("headed")).where("headed").select("doc_id", F.lit("").alias("title"), F.lit("").alias("plain_text"))
    made = units.topic_units(docs, rows.join(docs.select("doc_id"), "doc_id", "left_semi"))
    return made.select("doc_id", "unit_index", "unit_type", F.size("block_ids").alias("blocks"), "text_length", "topic_unit_id")


@query()
def q21_html_blocks_full(spark, sf_dir):
    rows = normalise(pages(spark, sf_dir))[1]
    return rows.select("doc_id", "order", "type", "text", "level", F.array_join("heading_path", " > ").alias("heading_path"), "dom_path", "char_start", "metadata.container", "metadata.list_level", F.size("metadata.links").alias("links"))


@query()
def q22_html_markdown(spark, sf_dir):
    return normalise(pages(spark, sf_dir))[0].select("doc_id", "markdown", "markdown_length", "block_count", "text_preservation_ratio", "normalization_status")


@query(f"""
WITH t AS (SELECT conv_id, turn, role, {normal_sql("text")} AS text FROM conversations WHERE text IS NOT NULL)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS "order", CASE role WHEN 'system' THEN 'heading' WHEN 'user' THEN 'blockquote' ELSE 'paragraph' END AS type,
       CAST(length(text) AS INTEGER) AS n, sha256(text) AS digest FROM t WHERE text <> ''
""")
def q23_editorjs_blocks(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").where("text is not null")
    kind = F.when(F.col("role") == "system", "header").when(F.col("role") == "user", "quote").otherwise("paragraph")
    block = F.struct(F.col("turn"), F.struct(kind.alias("type"), F.struct(F.col("text").alias("text")).alias("data")).alias("block"))
    docs = t.groupBy("conv_id").agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(block)), lambda x: x["block"]).alias("blocks"))).alias("body"))
    found = docs.select("conv_id", parse_editorjs(F.col("body")).alias("e")).select("conv_id", F.posexplode("e.blocks").alias("pos", "b"))
    return found.select("conv_id", (F.col("pos") + 1).alias("order"), "b.type", F.length("b.text").alias("n"), F.sha2("b.text", 256).alias("digest"))


_FACET = "CASE WHEN a IN ('hot', 'cold') THEN 'temperature' WHEN a IN ('large', 'small') THEN 'size' WHEN a IN ('red', 'blue') THEN 'colour' WHEN a IN ('new', 'old') THEN 'age' END"


@query(f"""
WITH s AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN b ELSE b END AS surface, {_FACET} AS facets, CAST(CASE WHEN p_partkey % 2 = 0 THEN 0.92 ELSE 0.72 END AS DOUBLE) AS confidence, b = 'gizmo' AS generic FROM s""")
def q24_facet_parse(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    value = F.when(F.col("p_partkey") % 2 == 0, F.concat(words[1], F.lit(": "), words[0])).otherwise(F.col("p_name"))
    found = parse_surfaces(p.select("p_partkey", value.alias("value")), "value", WORKSHOP)
    return found.select("p_partkey", F.col("p_surface").alias("surface"), F.array_join("p_facets", ",").alias("facets"), F.col("p_confidence").alias("confidence"), F.col("p_generic").alias("generic"))


@query("""
WITH s AS (SELECT p_partkey, split_part(p_name, ' ', 2) AS b FROM part)
SELECT p_partkey, CASE WHEN b IN ('anvil', 'gear', 'rod') THEN 'tool' WHEN b IN ('bolt', 'ring') THEN 'fastener' WHEN b = 'plate' THEN 'sheet' WHEN b IN ('gizmo', 'widget', 'gadget') THEN 'gadget' ELSE 'unknown' END AS entity_type,
       CAST(CASE WHEN b IN ('anvil', 'gear', 'rod', 'bolt', 'ring', 'plate') THEN 0.78 WHEN b IN ('gizmo', 'widget', 'gadget') THEN 0.66 ELSE 0.25 END AS DOUBLE) AS confidence FROM s""")
def q25_classify(spark, sf_dir):
    found = classify(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", WORKSHOP)
    return found.select("p_partkey", F.col("c_type").alias("entity_type"), F.col("c_confidence").cast("double").alias("confidence"))


_WORDS = ("with", "that", "this", "from", "para", "nicht", "elle")


@query(rf"""
WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}_]+')) AS word FROM documents)
SELECT doc_id, word AS surface, count(*) AS n FROM w WHERE word IN {_WORDS} GROUP BY ALL""")
def q26_mentions(spark, sf_dir):
    from quarry.operators.lexicon import Lexicon

    words = Lexicon(entity_types={"disease": {"keywords": list(_WORDS)}}, facets={}, generic_phrases=[])
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lit("u").alias("topic_unit_id"), "text")
    return C.mentions(rows, words).groupBy("doc_id", F.lower("surface").alias("surface")).agg(F.count("*").alias("n"))


@query("""
WITH RECURSIVE s AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 40 AS INTEGER) AS a, CAST(l_partkey % 40 + 2 + l_suppkey % 9 AS INTEGER) AS b FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY a, b DESC, l_linenumber, b) AS k FROM s),
walk AS (
  SELECT l_orderkey, k, a, b, true AS kept, b AS reach FROM o WHERE k = 1
  UNION ALL
  SELECT o.l_orderkey, o.k, o.a, o.b, o.a >= w.reach, CASE WHEN o.a >= w.reach THEN o.b ELSE w.reach END FROM walk w JOIN o ON o.l_orderkey = w.l_orderkey AND o.k = w.k + 1
)
SELECT l_orderkey, count(*) AS n, CAST(sum(b - a) AS BIGINT) AS covered FROM walk WHERE kept GROUP BY l_orderkey""")
def q27_overlap_dedupe(spark, sf_dir):
    a = (F.col("l_partkey") % 40).cast("int")
    span = F.struct(a.alias("start"), (a + 2 + F.col("l_suppkey") % 9).cast("int").alias("end"), F.lit("").alias("surface"), F.lit("").alias("pattern"), F.lit("").alias("kind"), F.col("l_linenumber").cast("int").alias("rank"))
    kept = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(span).alias("spans")).select("l_orderkey", C.drop_overlaps(F.col("spans")).alias("kept"))
    return kept.select("l_orderkey", F.size("kept").cast("long").alias("n"), F.aggregate("kept", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]).alias("covered"))


@query("""
WITH s AS (SELECT p_brand AS doc_id, split_part(p_name, ' ', 2) AS core, p_type, p_partkey, p_size % 5 AS place FROM part)
SELECT doc_id, core, min(p_partkey) AS first, CAST(count(DISTINCT CAST(place AS VARCHAR) || p_type) AS INTEGER) AS evidence, CAST(count(DISTINCT p_type) AS INTEGER) AS sources,
  CAST(count(DISTINCT place) AS INTEGER) AS blocks, arg_min(p_type, p_partkey) AS first_source,
  CASE WHEN core IN ('anvil', 'gear', 'rod') THEN 'tool' WHEN core IN ('bolt', 'ring') THEN 'fastener' WHEN core = 'plate' THEN 'sheet' ELSE 'gadget' END AS entity_type FROM s GROUP BY doc_id, core""")
def q28_candidate_merge(spark, sf_dir):
    """Parts as sightings of their nouns, one unit for each brand."""
    p, none = table(spark, sf_dir, "part"), F.lit(None)
    seq = F.struct(F.lit(1).alias("pass"), F.col("p_partkey").alias("pos"), F.lit(0).cast("long").alias("sub"))
    piece = F.struct(
        F.concat(F.lit("b"), (F.col("p_size") % 5).cast("string")).alias("block_id"), F.lit("heading").alias("evidence_type"), F.col("p_type").alias("text"), F.array().cast("array<string>").alias("heading_path"),
        none.cast("int").alias("char_start"), none.cast("int").alias("char_end"), F.lit(0.9).alias("weight"),
    )
    seen = p.select(
        F.col("p_brand").alias("doc_id"), F.concat(F.lit("u-"), "p_brand").alias("topic_unit_id"), seq.alias("seq"), F.split("p_name", " ")[1].alias("value"), F.array("p_type").alias("sources"), piece.alias("evidence"),
        none.cast("string").alias("g_type"), none.cast("string").alias("g_pattern"), none.cast("double").alias("g_confidence"),
    )
    made = seen.select("doc_id", "topic_unit_id").distinct().select("*", F.lit(0).alias("unit_index"), F.lit("").alias("text"))
    blocks = made.select("doc_id", F.lit("paragraph").alias("type"), "text")
    merged = C.drafts(seen, made, blocks, WORKSHOP)
    return merged.select("doc_id", F.col("normalized_surface").alias("core"), F.col("seq.pos").alias("first"), F.size("evidence").alias("evidence"), F.size("sources").alias("sources"), F.size("evidence_block_ids").alias("blocks"), F.col("sources")[0].alias("first_source"), "entity_type")


@query(f"""
WITH {PARTS_SQL}, s AS (
  SELECT candidate_id, entity_type, is_generic, unit_index, source, seq, length(core_surface) AS n, (entity_type <> 'unknown' AND NOT is_generic) AS known FROM parts
), t AS (
  SELECT candidate_id, (CASE WHEN known THEN 0.18 ELSE 0.16 END) + (CASE WHEN source = 'title' THEN 0.26 ELSE 0.0 END) + (CASE WHEN source = 'heading' THEN 0.22 ELSE 0.0 END)
       + (CASE WHEN source = 'pattern_match' THEN 0.07 ELSE 0.0 END) + (CASE WHEN unit_index <= 1 THEN 0.08 WHEN unit_index <= 5 THEN 0.04 ELSE 0.0 END) + 0.2 + round(0.08 * 0.72, 4)
       + (CASE WHEN seq % 4 > 0 THEN round(least(0.08, (seq % 4) * 0.025), 4) ELSE 0.0 END) + (CASE WHEN seq % 5 > 1 THEN round(least(0.06, (seq % 5 - 1) * 0.02), 4) ELSE 0.0 END) - (CASE WHEN is_generic THEN 0.30 ELSE 0.0 END) AS total FROM s
)
SELECT candidate_id, CAST(round(total, 3) AS DOUBLE) AS score, CASE WHEN round(total, 4) >= 0.8 THEN 'high' WHEN round(total, 4) >= 0.55 THEN 'medium' ELSE 'low' END AS confidence_bucket FROM t WHERE round(total, 4) >= 0.05""")
def q29_score_bucket(spark, sf_dir):
    rows = tagged_parts(spark, sf_dir).drop("score", "candidate_id", "topic_unit_id").withColumn("topic_unit_id", F.col("seq").cast("string")).withColumn("normalized_core_surface", F.col("core_surface"))
    rows = rows.withColumns({"c_pattern": F.lit("keyword"), "split_confidence": F.lit(0.72), "heading_hits": (F.col("seq") % 4).cast("int"), "unit_frequency": (F.col("seq") % 5).cast("int")})
    found = C.scored(rows, WORKSHOP)
    return found.select(F.concat(F.lit("c"), F.col("seq").cast("string")).alias("candidate_id"), F.round("score", 3).alias("score"), "confidence_bucket")


def _roled(spark, sf_dir):
    rows = C.with_roles(tagged_parts(spark, sf_dir), WORKSHOP)
    return rows.withColumn("confidence_bucket", C.bucket(F.col("score")))


@query(f"WITH {PARTS_SQL} SELECT candidate_id, role, review_reason IS NOT NULL AS needs_review, coalesce(review_reason, '') AS review_reason FROM cand")
def q30_primary_and_section(spark, sf_dir):
    return _roled(spark, sf_dir).select("candidate_id", "role", "needs_review", X.or_empty("review_reason").alias("review_reason"))


@query(f"""WITH {PARTS_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(review_reason IS NOT NULL AS INTEGER) DESC, score DESC, seq) AS k FROM cand)
SELECT doc_id, candidate_id, role, facets[1] || ';' || facets[2] AS facets, score, said AS evidence_text, warnings FROM k WHERE k <= 10
ORDER BY CAST(review_reason IS NOT NULL AS INTEGER) DESC, score DESC, doc_id, seq LIMIT 300""")
def q31_review_topk(spark, sf_dir):
    rows = _roled(spark, sf_dir).withColumn("evidence_texts", F.array(F.array_join("evidence_texts", " ")))
    docs = rows.select("doc_id").distinct().withColumn("title", F.col("doc_id"))
    made = rows.select("doc_id", "topic_unit_id").distinct().withColumn("heading_path", F.array("topic_unit_id"))
    return review.review_rows(docs, made, rows, 10, 300).select("doc_id", "candidate_id", "role", "facets", "score", "evidence_text", "warnings")


_TOPICS_SQL = """, topics AS (
  SELECT doc_id, CAST(count(DISTINCT topic_unit_id) AS INTEGER) AS topic_unit_count, CAST(count(*) AS INTEGER) AS candidate_count_total, CAST(count(*) FILTER (role = 'document_primary_candidate') AS INTEGER) AS primary_candidate_count,
         CAST(count(*) FILTER (role = 'section_topic_candidate') AS INTEGER) AS section_candidate_count, CAST(count(*) FILTER (role = 'facet_only') AS INTEGER) AS facet_only_count, CAST(count(*) FILTER (review_reason IS NOT NULL) AS INTEGER) AS needs_review_count
  FROM cand GROUP BY doc_id), warned AS (
  SELECT *, concat_ws(',', CASE WHEN topic_unit_count > 50 THEN 'long_document_many_topic_units' END, CASE WHEN candidate_count_total > 50 THEN 'many_candidates_in_document' END, CASE WHEN candidate_count_total > 200 THEN 'candidate_explosion_risk' END) AS warnings FROM topics)"""


def _topics(spark, sf_dir):
    rows = _roled(spark, sf_dir)
    docs = rows.select("doc_id").distinct().withColumn("title", F.col("doc_id")).withColumn("normalization_status", F.lit("ok"))
    return review.doc_topics(docs, rows.select("doc_id", "topic_unit_id").distinct(), rows, WORKSHOP), rows


@query(f"WITH {PARTS_SQL} {_TOPICS_SQL} SELECT doc_id, topic_unit_count, candidate_count_total, primary_candidate_count, section_candidate_count, facet_only_count, needs_review_count, replace(warnings, ',', ';') AS warnings FROM warned")
def q32_distribution(spark, sf_dir):
    topics, rows = _topics(spark, sf_dir)
    return review.distribution(topics, rows).drop("title", "cross_reference_count")


@query(f"""WITH {PARTS_SQL} SELECT 'role' AS counter, role AS value, count(*) AS n FROM cand GROUP BY role UNION ALL SELECT 'entity_type', entity_type, count(*) FROM cand GROUP BY entity_type
UNION ALL SELECT 'confidence_bucket', confidence_bucket, count(*) FROM cand GROUP BY confidence_bucket""")
def q33_counters(spark, sf_dir):
    return review.counters(_roled(spark, sf_dir))


@query(f"WITH {PARTS_SQL} SELECT facet, count(*) AS n FROM (SELECT unnest(facets) AS facet FROM cand) GROUP BY facet ORDER BY n DESC, facet LIMIT 20")
def q34_top_facets(spark, sf_dir):
    return review.top_facets(_roled(spark, sf_dir))


@query(f"WITH {PARTS_SQL} {_TOPICS_SQL} SELECT doc_id, CASE WHEN warnings <> '' THEN warnings WHEN needs_review_count > 0 THEN 'candidate_needs_review' ELSE 'no_document_primary_candidate' END AS reason, candidate_count_total, CAST(least(needs_review_count, 20) AS INTEGER) AS listed FROM warned WHERE warnings <> '' OR needs_review_count > 0 OR primary_candidate_count = 0")
def q35_ambiguity_queue(spark, sf_dir):
    found = review.ambiguity_queue(_topics(spark, sf_dir)[0])
    return found.select("doc_id", "reason", "candidate_count_total", F.size("needs_review_candidate_ids").alias("listed"))


@query("""
WITH e AS (SELECT 'c' || CAST(o_orderkey AS VARCHAR) AS candidate_id, 'b' || CAST(l_linenumber AS VARCHAR) AS block_id, l_returnflag AS text FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT 'ev_' || substr(sha256('{"block_id": "' || block_id || '", "candidate_id": "' || candidate_id || '", "evidence_type": "table", "text": "' || text || '"}'), 1, 20) AS evidence_id, candidate_id, block_id FROM e""")
def q36_evidence(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    none = F.lit(None)
    piece = F.struct(
        F.concat(F.lit("b"), F.col("l_linenumber").cast("string")).alias("block_id"), F.lit("table").alias("evidence_type"), F.col("l_returnflag").alias("text"), F.array().cast("array<string>").alias("heading_path"),
        none.cast("int").alias("char_start"), none.cast("int").alias("char_end"), F.lit(0.55).alias("weight"),
    )
    rows = joined.groupBy(F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("candidate_id")).agg(F.collect_list(piece).alias("evidence"))
    return C.evidence_table(rows.withColumn("doc_id", F.lit("d")).withColumn("topic_unit_id", F.lit("u"))).select("evidence_id", "candidate_id", "block_id")


@query("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) AND doc_id IS NOT NULL")
def q37_coverage_anti(spark, sf_dir):
    return relations.missing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("""WITH d AS (SELECT o_orderkey AS doc_id, o_custkey % 8 AS declared FROM orders), f AS (SELECT l_orderkey AS doc_id, count(*) AS found FROM lineitem GROUP BY 1)
SELECT doc_id, CAST(declared AS BIGINT) AS declared, coalesce(found, 0) AS found FROM d LEFT JOIN f USING (doc_id) WHERE declared <> coalesce(found, 0)""")
def q38_count_reconcile(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), (F.col("o_custkey") % 8).alias("block_count"))
    return relations.mismatched_counts(parents, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id")), "doc_id", "block_count")


@query("SELECT doc_id FROM documents WHERE length(text) > 0 INTERSECT SELECT doc_id FROM labels WHERE quality = 1 EXCEPT SELECT doc_id FROM labels WHERE toxic = 1")
def q39_nonempty_without_blocks(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    ok = relations.both(table(spark, sf_dir, "documents").where(F.length("text") > 0), labels.where("quality = 1"), "doc_id")
    return relations.missing(ok, labels.where("toxic = 1"), "doc_id")


@query(f"""
WITH {DOCS_SQL}, one AS (SELECT doc_id, max(raw_length) AS raw_length, CAST(count(*) AS INTEGER) AS block_count FROM docs GROUP BY doc_id),
r AS (SELECT doc_id, 0 AS turn, 'random' AS bucket, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS place FROM one UNION ALL
      SELECT doc_id, 1, 'largest', row_number() OVER (ORDER BY raw_length DESC, doc_id) FROM one UNION ALL SELECT doc_id, 2, 'many_blocks', row_number() OVER (ORDER BY block_count DESC, doc_id) FROM one),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY turn) AS k FROM r WHERE place <= 10)
SELECT doc_id, bucket, CAST(place AS INTEGER) AS place FROM f WHERE k = 1""")
def q40_audit_samples(spark, sf_dir):
    one = documents(spark, sf_dir).groupBy("doc_id").agg(F.max("raw_length").alias("raw_length"), F.count("*").cast("int").alias("block_count"))
    return audit.ranked_samples(one, 50)


@query("SELECT p_partkey, CASE split_part(p_name, ' ', 2) WHEN 'gizmo' THEN 'gadget' WHEN 'rod' THEN 'bar' ELSE split_part(p_name, ' ', 2) END AS canonical FROM part")
def q41_alias_resolve(spark, sf_dir):
    names = spark.createDataFrame([("gizmo", "gadget"), ("rod", "bar")], "alias string, canonical string")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ")[1].alias("surface"))
    return relations.resolve_aliases(rows, "surface", names).select("p_partkey", "canonical")


@query("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE length(b.text) > 0")
def q42_quote_exists(spark, sf_dir):
    quotes = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("quote"))
    return relations.quotes_in(table(spark, sf_dir, "documents").select("doc_id", "text"), quotes).select("doc_id", "item_id")


@query("SELECT c_custkey AS source_row, 'segment=' || c_mktsegment || ';nation=' || CAST(c_nationkey AS VARCHAR) AS metadata FROM customer")
def q43_metadata_map(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    rows = c.select(F.col("c_custkey").cast("int").alias("source_row"), F.col("c_name").alias("name"), F.lit("").alias("content"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation"), F.lit("").alias("gone"))
    pairs = F.transform(F.map_entries("metadata"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return ingest.documents(rows).select(F.col("source_row").cast("long").alias("source_row"), F.array_join(pairs, ";").alias("metadata"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def q44_dynamic_decode(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", files.json_cell(F.col("props"), "$.k", "int").alias("k"))


@query("SELECT p_partkey, lower(regexp_replace(p_name || '--' || p_brand, '[^0-9a-zA-Z]+', '-', 'g')) AS slug FROM part")
def q45_slugify(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.slugify(F.concat("p_name", F.lit("--"), "p_brand")).alias("slug"))


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '| ' || l_returnflag || ' | ' || l_linestatus || ' |' AS line, row_number() OVER w AS k
           FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus))
SELECT l_orderkey, string_agg(CASE WHEN k = 1 THEN line || chr(10) || '| --- | --- |' ELSE line END, chr(10) ORDER BY k) AS markdown FROM r GROUP BY l_orderkey""")
def q46_table_markdown(spark, sf_dir):
    cell = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(cell)).alias("r"))
    return rows.withColumn("cells", F.transform("r", lambda x: F.array(x["l_returnflag"], x["l_linestatus"]))).select("l_orderkey", TB.to_markdown(F.col("cells")).alias("markdown"))


@query(f"""WITH {TURNS_SQL} SELECT doc_id, string_agg(CASE level WHEN 1 THEN '# ' || name WHEN 2 THEN '## ' || name ELSE CASE WHEN type = 'list_item' THEN '- ' || name ELSE name END END, chr(10) || chr(10) ORDER BY ord) AS markdown FROM turns GROUP BY doc_id""")
def q47_block_markdown(spark, sf_dir):
    none = F.lit(None).cast("string")
    rows = turns(spark, sf_dir).withColumn("metadata", F.struct(none.alias("list_type"), none.alias("markdown")))
    return B.markdown_of(rows, ["doc_id"])


@query(f"""WITH {PARTS_SQL}, t AS (SELECT DISTINCT doc_id, core_surface AS c FROM cand)
SELECT x.c AS a, y.c AS b, count(*) AS weight FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.c < y.c GROUP BY ALL""")
def q48_tag_graph(spark, sf_dir):
    links = _roled(spark, sf_dir).select("doc_id", F.col("core_surface").alias("canonical"))
    return relations.co_occurrence(links)


@query(f"WITH {PARTS_SQL} SELECT CASE core_surface WHEN 'gizmo' THEN 'gadget' ELSE core_surface END AS canonical, doc_id, max(score) AS score FROM cand GROUP BY ALL")
def q49_tag_documents(spark, sf_dir):
    names = spark.createDataFrame([("gizmo", "gadget")], "alias string, canonical string")
    return relations.tag_documents(_roled(spark, sf_dir).withColumn("normalized_surface", F.col("core_surface")), names)


@query("""SELECT l_orderkey, CAST(len(list_distinct(list(l_returnflag))) AS INTEGER) AS kinds, CAST(min(l_partkey) AS INTEGER) AS first, CAST(max(l_partkey + l_suppkey) AS INTEGER) AS last, CAST(count(*) AS INTEGER) AS blocks,
  CAST(length(string_agg(l_linestatus || CAST(l_linenumber AS VARCHAR), chr(10))) AS INTEGER) AS text_length FROM lineitem GROUP BY l_orderkey""")
def q50_unit_spans(spark, sf_dir):
    """Lines as blocks, an order as a unit."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("order"), F.col("l_returnflag").alias("type"), F.array().cast("array<string>").alias("heading_path"), F.col("l_linenumber").cast("string").alias("block_id"),
        F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("text"), F.col("l_partkey").cast("int").alias("char_start"), (F.col("l_partkey") + F.col("l_suppkey")).cast("int").alias("char_end"),
    )
    made = units.gathered(rows, ["doc_id"])
    return made.select(F.col("doc_id").alias("l_orderkey"), F.size("source_block_types").alias("kinds"), F.col("char_start").alias("first"), F.col("char_end").alias("last"), F.size("block_ids").alias("blocks"), F.length("text").alias("text_length"))


@query(r"""SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower(x), '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g'), '\s*([:;,.])\s*', '\1 ', 'g'), '\s+', ' ', 'g')) AS surface
FROM (SELECT p_partkey, '  -- ' || p_name || ' ,' || p_brand || ':' || p_type || ' ..' AS x FROM part)""")
def q51_normalize_surface(spark, sf_dir):
    value = F.concat(F.lit("  -- "), "p_name", F.lit(" ,"), "p_brand", F.lit(":"), "p_type", F.lit(" .."))
    return table(spark, sf_dir, "part").select("p_partkey", X.normalize_surface(value).alias("surface"))


@query("""SELECT conv_id, turn, CASE WHEN length(s) <= 500 THEN s ELSE rtrim(substr(s, 1, 500)) || '...' END AS evidence FROM (SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS s FROM conversations)""".replace("\\\\", "\\"))
def q52_trim_evidence(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.trim_evidence(F.col("text")).alias("evidence"))


@query()
def q53_tag_candidates(spark, sf_dir):
    """S00 to S02A over table documents."""
    return _tagged(spark, sf_dir).candidates.select("doc_id", "candidate_id", "role", "surface", "entity_type", F.array_join("facets", ",").alias("facets"), "score", "confidence_bucket", "needs_review")


@query()
def q54_html_candidates(spark, sf_dir):
    """S00 to S02A over table pages."""
    normalized, blocks = normalise(pages(spark, sf_dir), keep=True)
    return tag(normalized, blocks, ENGLISH).topics.select("doc_id", "topic_unit_count", "candidate_count_total", "facet_only_count", "needs_review", "review_reason")


def _tagged(spark, sf_dir):
    normalized, blocks = normalise(documents(spark, sf_dir), keep=True)
    return tag(normalized, blocks, ENGLISH)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to blocks, units, candidates and their roles, end to end: candidates by role and type."""
    found = _tagged(spark, sf_dir).candidates
    return found.groupBy("role", "entity_type").agg(F.count("*").alias("candidates"), F.round(F.avg("score"), 4).alias("mean_score"), F.countDistinct("doc_id").alias("documents")).orderBy("role", "entity_type")


