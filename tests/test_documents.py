"""Ingest, formats, markup, blocks, units, candidates on small made-up documents."""

import hashlib
import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import markup
from quarry.functions import text as X
from quarry.operators import audit, blocks, ingest, lexicon, normalize, surface, units
from quarry.operators import candidates as cand
from quarry.plans.stages import Project, documents_from_table, normalise, tag
from quarry.sources import files


def made(spark, *bodies, names=None):
    names = names or [f"n{k}" for k in range(len(bodies))]
    rows = spark.createDataFrame([(k + 1, str(k + 1), n, b) for k, (n, b) in enumerate(zip(names, bodies, strict=True))], "source_row int, source_id string, name string, content string")
    return ingest.documents(rows)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_hashes_follow_the_rule(spark):
    doc = made(spark, "a \r\nb  \n").first()
    want = hashlib.sha256(b"a\nb").hexdigest()[:24]
    assert doc["content_hash"] == want
    assert doc["doc_id"] == "doc_" + hashlib.sha256(("1" + want).encode()).hexdigest()[:20]


def test_empty_and_null_content(spark):
    rows = made(spark, "", None, " \n ").collect()
    assert [r["ingest_status"] for r in rows] == ["empty_content"] * 3


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="content"):
        ingest.documents(spark.createDataFrame([("x",)], "name string"))


def test_metadata_takes_filled_unknown_columns(spark):
    rows = spark.createDataFrame([("7", "n", "c", "k", "")], "uuid string, name string, content string, kind string, gone string")
    doc = ingest.documents(rows).first()
    assert doc["source_id"] == "7" and doc["metadata"] == {"kind": "k"}


def test_slug_and_surface(spark):
    assert value(spark, X.slugify(F.lit("Глава 1: Ввод"))) == "глава-1-ввод"
    assert value(spark, X.slugify(F.lit("!!"))) == "item"
    assert value(spark, X.normalize_surface(F.lit(" «Ёлка ;0,5» "))) == "елка; 0, 5"


@pytest.mark.parametrize(
    ("body", "kind"),
    [('{"blocks": []}', "editorjs_json"), ('{"blocks": [1', "editorjs_json"), ('{"a": 1}', "plain_text"), ("<p>x", "html"), ("a < b", "plain_text"), ("", "plain_text"), ('[{"blocks": []}]', "plain_text")],
)
def test_formats(spark, body, kind):
    assert value(spark, X.source_format(F.lit(body))) == kind


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \t\n", max_size=40))
def test_tidy_is_idempotent_and_keeps_words(text):
    once = markup.tidy(text)
    assert markup.tidy(once) == once
    assert once.split() == text.split()
    assert "\n\n\n" not in once


def test_html_blocks_nested_and_broken():
    found = markup.html_document("<div>lead<h1>A<h2>B</h2><ul><li>x<ol><li>y</ol><li>z</ul><table><tr><th>p<th>q<tr><td>1<td>2</table></div><!-- c -->")["blocks"]
    assert [(b["type"], b["text"]) for b in found] == [
        ("paragraph", "lead"), ("heading", "A"), ("heading", "B"), ("list_item", "x"), ("list_item", "y"), ("list_item", "z"), ("table", "p | q\n1 | 2"), ("paragraph", "c"),
    ]
    assert found[3]["metadata"]["list_type"] == "unordered" and found[4]["metadata"]["list_type"] == "ordered" and found[4]["metadata"]["list_level"] == 2
    table = found[6]["metadata"]
    assert table["row_count"] == 2 and table["has_header"] and table["markdown"].splitlines()[1] == "| --- | --- |"


def test_scripts_are_not_text():
    found = markup.html_document("<html><head><title>T</title><script>var a='</p><p>no';</script></head><body><p>yes</p><style>p{}</style></body></html>")
    assert found["plain_text"] == "T\nyes" and [b["text"] for b in found["blocks"]] == ["yes"]
    assert found["blocks"][0]["dom_path"] == "html[1]/body[1]/p[1]"


def test_inline_marks_and_links():
    b = markup.html_document('<p>a <b>b</b> <a href="/x">l</a></p>')["blocks"][0]
    assert b["metadata"]["inline_marks"] == ["b"] and b["metadata"]["links"] == [{"text": "l", "href": "/x"}]


def test_editorjs_kinds():
    body = {
        "blocks": [
            {"id": "h", "type": "header", "data": {"text": "T <b>x</b>", "level": 9}}, {"type": "paragraph", "data": {"text": "a<br>b", "api": {"text": "no"}}},
            {"type": "list", "data": {"style": "ordered", "items": ["i", {"content": "j", "items": [{"text": "k"}]}]}}, {"type": "table", "data": {"withHeadings": True, "content": [["p", "q"], ["1", ""]]}},
            {"type": "quote", "data": {"text": "s", "caption": "c"}}, {"type": "delimiter", "data": {}}, {"type": "image", "data": {"url": "u", "caption": "cap"}},
        ]
    }
    found = markup.editor_document(json.dumps(body))
    assert [(b["type"], b["text"]) for b in found["blocks"]] == [
        ("heading", "T x"), ("paragraph", "a\nb"), ("list_item", "i"), ("list_item", "j"), ("list_item", "k"), ("table", "p | q\n1 | "), ("blockquote", "s\nc"), ("unknown", "cap"),
    ]
    assert found["blocks"][0]["level"] == 6 and found["blocks"][4]["metadata"]["list_level"] == 2
    assert markup.editor_document('{"blocks": [1')["error"].startswith("Invalid Editor.js JSON")


def test_normalised_documents(spark):
    docs = made(spark, "one\n- two\n\nthree", "<h1>A</h1><p>B</p>", "", '{"blocks": [', "<p></p>", '{"blocks": [{"type": "header", "data": {"text": "H", "level": 2}}]}')
    normalized, rows = normalise(docs)
    by_row = {r["source_row"]: r for r in normalized.collect()}
    assert [by_row[k]["normalization_status"] for k in range(1, 7)] == ["ok", "ok", "empty_content", "failed", "no_blocks", "ok"]
    assert [by_row[k]["source_format"] for k in range(1, 7)] == ["plain_text", "html", "empty", "editorjs", "html", "editorjs"]
    assert by_row[1]["list_item_count"] == 1 and by_row[1]["block_count"] == 3 and by_row[2]["markdown"] == "# A\n\nB"
    assert by_row[4]["metadata"]["warnings"][0] == "editorjs_parse_failed" and by_row[5]["metadata"]["warnings"][:1] == ["no_useful_blocks"]
    found = {(r["source_row"], r["order"]): r for r in rows.collect()}
    assert found[1, 2]["type"] == "list_item" and found[1, 3]["char_start"] == 11 and found[2, 2]["heading_path"] == ["A"] and found[2, 2]["parent_path"] == ["root", "h1:a"]


def test_offsets_search_on_from_the_last_hit(spark):
    full, texts = "a b a", ["a", "a", "x", "b"]
    got = value(spark, blocks.starts_in(F.lit(full), F.array(*map(F.lit, texts))))
    assert got == [0, 4, None, None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=14))
def test_heading_paths_equal_a_stack(spark, levels):
    rows = [("d", k, "heading" if v else "paragraph", v or None, f"t{k}") for k, v in enumerate(levels)]
    found = blocks.with_heading_path(spark.createDataFrame(rows, "doc_id string, `order` int, type string, level int, text string"), ["doc_id"])
    stack, want = [], []
    for _, k, _, level, text in rows:
        if level:
            stack = [x for x in stack if x[0] < level] + [(level, text)]
        want.append([t for _, t in stack])
    assert [r["heading_path"] for r in found.orderBy("order").collect()] == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 900), max_size=20))
def test_greedy_windows(spark, sizes):
    want, window, n, chars = [], 0, 0, 0
    for s in sizes:
        if n and (n >= 5 or chars + s > 1800):
            window, n, chars = window + 1, 0, 0
        n, chars = n + 1, chars + s
        want.append(window)
    assert value(spark, units.greedy_windows(F.array(*map(F.lit, sizes)).cast("array<int>"))) == want


LEX = lexicon.default()


@pytest.mark.parametrize(
    ("phrase", "core", "facets", "pattern"),
    [
        ("Зиннат таблетки 125 мг: Способы и дозировка", "Зиннат", ["dosage"], "entity_colon_facet"), ("Гастрит: симптомы и лечение", "Гастрит", ["symptoms", "treatment"], "entity_colon_facet"),
        ("Как правильно надевать медицинские перчатки", "медицинские перчатки", ["instruction"], "how_to_entity"), ("симптомы гриппа", "гриппа", ["symptoms"], "facet_entity_prefix"),
        ("лечение", "лечение", ["treatment"], "generic_phrase"), ("Инструкция по применению Нурофен", "Нурофен", ["instruction"], "instruction_entity"), ("", None, [], "empty"),
    ],
)
def test_parsed_surfaces(spark, phrase, core, facets, pattern):
    r = surface.parse_surfaces(spark.createDataFrame([(phrase,)], "v string"), "v", LEX).first()
    assert (r["p_core"], r["p_facets"], r["p_pattern"]) == (core, facets, pattern)


@pytest.mark.parametrize(("phrase", "kind", "confidence"), [("Зиннат таблетки 125 мг", "drug_product", 0.92), ("Гастрит", "disease", 0.78), ("медицинские перчатки", "medical_device", 0.78), ("сепсоз", "disease", 0.66), ("прочее", "unknown", 0.25), ("", "unknown", 0.0)])
def test_classes(spark, phrase, kind, confidence):
    r = surface.classify(spark.createDataFrame([(phrase,)], "v string"), "v", LEX).first()
    assert (r["c_type"], float(r["c_confidence"])) == (kind, confidence)


@pytest.fixture(scope="module")
def tagged(spark):
    docs = made(
        spark, "Текст про препарат.", "<h1>Гастрит</h1><p>Боль. Чем лечить.</p>", "Надо.\n- раз: два\n- три",
        names=["Зиннат таблетки 125 мг: Способы и дозировка", "Гастрит: симптомы и лечение", "Как правильно надевать медицинские перчатки"],
    )
    normalized, rows = normalise(docs)
    return tag(normalized, rows), {r["title"]: r["doc_id"] for r in normalized.collect()}


def test_worked_scores(tagged):
    out, ids = tagged
    by_title = {(r["doc_id"]): r for r in out.candidates.where("array_contains(sources, 'title')").collect()}
    got = {t: (by_title[d]["score"], by_title[d]["role"]) for t, d in ids.items()}
    assert got["Зиннат таблетки 125 мг: Способы и дозировка"] == (0.7936, "document_primary_candidate")
    assert got["Гастрит: симптомы и лечение"][0] == 0.8186
    assert got["Как правильно надевать медицинские перчатки"] == (0.7888, "document_primary_candidate")
    verb = out.candidates.where("entity_type = 'treatment' and array_contains(sources, 'pattern_match')").first()
    assert (verb["score"], verb["role"], verb["confidence_bucket"]) == (0.238, "facet_only", "low")


def test_candidate_ids_follow_the_rule(tagged):
    r = tagged[0].candidates.where("array_contains(sources, 'title')").first()
    key = {"doc_id": r["doc_id"], "topic_unit_id": r["topic_unit_id"], "surface": r["normalized_surface"], "core": r["normalized_core_surface"], "entity_type": r["entity_type"], "facets": r["facets"]}
    want = hashlib.sha256(json.dumps(key, ensure_ascii=False, sort_keys=True).encode()).hexdigest()[:20]
    assert r["candidate_id"] == "cand_" + want


def test_every_candidate_has_evidence_and_one_primary_at_most(tagged):
    out, _ = tagged
    assert out.candidates.where("size(evidence_block_ids) = 0").count() == 0
    assert out.candidates.where("role = 'document_primary_candidate'").groupBy("doc_id").count().where("count > 1").count() == 0
    assert out.evidence.join(out.candidates, "candidate_id", "left_anti").count() == 0
    assert out.topics.count() == 3


def test_no_cap_on_units(spark):
    body = "".join(f"<h2>Раздел {k}</h2><p>Текст {k}</p>" for k in range(20))
    normalized, rows = normalise(made(spark, body))
    assert units.topic_units(normalized, rows).where("unit_type = 'heading_section'").count() == 20


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 5)), max_size=8))
def test_overlaps_are_dropped_greedily(spark, spans):
    rows = [(a, a + n, k) for k, (a, n) in enumerate(spans)]
    want, taken = [], []
    for a, b, k in sorted(rows, key=lambda r: (r[0], r[0] - r[1], r[2])):
        if all(b <= x or a >= y for x, y in taken):
            taken.append((a, b))
            want.append((a, b, k))
    column = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit("").alias("surface"), F.lit("").alias("pattern"), F.lit("").alias("kind"), F.lit(k).alias("rank")) for a, b, k in rows)) if rows else None
    if column is not None:
        assert [(s["start"], s["end"], s["rank"]) for s in value(spark, cand.drop_overlaps(column))] == want


def test_samples_fill_up_and_state_reasons(spark):
    rows = documents_from_table(spark.createDataFrame([(k, "x" * k) for k in range(1, 30)], "k long, t string"), "k", "t")
    got = audit.samples(normalise(rows)[0], 10).collect()
    assert len(got) == 10 and all(r["reasons"] for r in got)
    assert audit.samples(normalise(rows)[0], 0).count() == 0


def write_csv(path):
    path.write_text('﻿source_id,name,description,content,kind\n1,A,d,"<h1>T</h1><p>x, ""y""</p>",h\n2,B,,"l1\nl2",p\n3,C,,,e\n4,D\n', encoding="utf-8")
    return str(path)


def test_csv_keeps_lines_quotes_and_empty_cells(spark, tmp_path):
    rows = files.read_csv(spark, write_csv(tmp_path / "in.csv")).collect()
    assert [r["source_row"] for r in rows] == [1, 2, 3, 4]
    assert rows[0]["content"] == '<h1>T</h1><p>x, "y"</p>' and rows[1]["content"] == "l1\nl2" and rows[2]["content"] == "" and rows[3]["content"] == ""


def test_csv_keeps_all_further_cells(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text("name,content\nA,x\n" + "B,y," + ",".join(f"e{k}" for k in range(20)) + '\nC,"z, z","q ""1""\nq2",last\n', encoding="utf-8")
    rows = files.read_csv(spark, str(path)).collect()
    assert [json.loads(r["extra_values"]) if r["extra_values"] else None for r in rows] == [None, [f"e{k}" for k in range(20)], ['q "1"\nq2', "last"]]


def test_csv_folder_numbers_rows_within_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"part{k}.csv").write_text("name,content\n" + "".join(f'f{k},"{j}\n."\n' for j in range(1, 4 + k)), encoding="utf-8")
    rows = files.read_csv(spark, str(tmp_path)).collect()
    assert len(rows) == 12 and all(r["content"] == f"{r['source_row']}\n." for r in rows)


def test_repeated_documents_are_tagged_once(spark):
    rows = spark.createDataFrame([(k, "7", "Гастрит: лечение", "Боль.\nКашель.\n- раз\n- два") for k in (1, 2)], "source_row int, source_id string, name string, content string")
    once, twice = (tag(*normalise(ingest.documents(r))) for r in (rows.where("source_row = 1"), rows))
    for name in ("units", "candidates", "evidence", "topics"):
        a, b = (sorted(map(str, getattr(t, name).drop("score_components").collect())) for t in (once, twice))
        assert a == b and a, name


def test_long_documents_take_time_in_proportion(spark):
    """A document of 100,000 lines: places by running sums, windows one after the other."""
    n = 100_000
    docs = made(spark, "\n".join(f"line {k}" + ("\n" if k % 10 == 0 else "") for k in range(n)))
    normalized, rows = normalise(docs, keep=True)
    text = normalized.first()["plain_text"]
    found = rows.select("text", "char_start", "char_end").where("`order` % 1000 = 1").collect()
    assert len(found) == n // 1000 and all(text[r["char_start"] : r["char_end"]] == r["text"] for r in found)
    assert units.topic_units(normalized, rows).where("unit_type = 'paragraph_window'").count() == n // 5


def test_unit_types_and_title_block_have_their_fixed_names(spark):
    normalized, rows = normalise(made(spark, "<h1>A</h1><ul><li>one</li><li>two</li></ul><table><tr><th>name</th><th>dose</th></tr></table>", names=["Гастрит"]))
    out = tag(normalized, rows)
    assert {r["unit_type"] for r in out.units.collect()} == {"document_title", "heading_section", "table_unit", "list_unit"}
    assert out.evidence.where("evidence_type = 'title' and block_id <> '__document_title__'").count() == 0 < out.evidence.where("evidence_type = 'title'").count()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["анализ", "крови", "анализ крови", "общий анализ крови", " ", "-", ".", "Анализ", "ab", "ab ab"]), max_size=12))
def test_keywords_are_found_as_by_one_expression_each(parts):
    from quarry.functions import spans

    text = "".join(parts)
    words = ["анализ", "крови", "анализ крови", "общий анализ крови", "ab", "ab ab"]
    want = sorted((w, *m.span()) for w in words for m in re.finditer(rf"(?<!\w){re.escape(w)}(?!\w)", text, re.I))
    assert sorted(spans._Keywords(words).places(text)) == want


def test_quotes_in_texts(spark):
    from quarry.operators import relations

    texts = spark.createDataFrame([(1, "say hello big world now"), (2, "hello bigworld"), (3, None), (4, "xx")], "doc_id int, text string")
    quotes = spark.createDataFrame([(1, "lo big wor"), (2, "x"), (3, ""), (4, "hello big")], "item_id int, quote string")
    found = sorted((r["doc_id"], r["item_id"]) for r in relations.quotes_in(texts, quotes).collect())
    assert found == [(1, 1), (1, 4), (2, 4), (4, 2)]


def test_cells_of_old_tables(spark):
    cells = spark.createDataFrame([("3.0",), ("7",), ("nan",), ("x",), (None,), ('["a", " ", "b"]',)], "c string")
    got = cells.select(X.to_int(F.col("c"), 0).alias("n"), X.to_int(F.col("c")).alias("m"), X.string_list(F.col("c")).alias("l"), X.optional_string(F.col("c")).alias("s")).collect()
    assert [r["n"] for r in got] == [3, 7, 0, 0, 0, 0] and [r["m"] for r in got] == [3, 7, None, None, None, None]
    assert got[5]["l"] == ["a", "b"] and got[3]["l"] == ["x"] and got[4]["s"] is None


def test_configuration_folder(tmp_path):
    folder = tmp_path / "configs" / "tagging"
    folder.mkdir(parents=True)
    (folder / "review.yaml").write_text("review_top_k_per_doc: 3\n", encoding="utf-8")
    (folder / "facet_patterns.yaml").write_text("facets: {colour: [red]}\n", encoding="utf-8")
    (folder / "scoring.yaml").write_text("primary_min_score: 0.9\n", encoding="utf-8")
    words = lexicon.Lexicon.read_folder(lexicon.find_folder(str(tmp_path)))
    assert words.review["top_k"] == 3 and words.review["explosion"] == 200 and words.facets == {"colour": ["red"]}
    assert words.scoring["primary_min_score"] == 0.9 and words.scoring["components"] == LEX.scoring["components"] and words.entity_types == LEX.entity_types


def test_validation_reads_reports_and_outputs(spark, tmp_path):
    project = Project(spark, str(tmp_path / "root"))
    project.ingest(write_csv(tmp_path / "in.csv"))
    assert project.validate("s01")["missing"] and not project.validate("s01")["valid"]
    project.normalize(limit=1)
    found = project.validate("s01")
    assert found["valid"] and {w.get("error", w.get("warning")) for w in found["warnings"]} >= {"PartialOutput", "MissingOptionalQualityReport"}
    project.normalize(force=True)
    project.audit_normalized(5)
    assert project._there(project.report_path("S01_quality_report", "md")) and project._there(project.report_path("S01_sample_index", "md"))
    project.tag_candidates()
    report = files.read_json(spark, project.report_path("S02A_tagging_report"))
    assert report["processed"] == 2 and project.validate("s02a")["valid"]
    files.write_text(spark, project.report_path("S02A_tagging_report"), json.dumps(report | {"processed": 3}))
    assert [e["error"] for e in project.validate("s02a")["errors"]] == ["DocTopicCoverageMismatch"]
    files.write_text(spark, project.report_path("S02A_tagging_report"), "{")
    assert [e["error"] for e in project.validate("s02a")["errors"]] == ["UnreadableArtifact"]
    from quarry.operators import validate

    held = {n: project._read(n) for n in ("topic_units", "tag_candidates", "doc_topics")}
    bare = held["tag_candidates"].withColumn("evidence_block_ids", F.array().cast("array<string>"))
    assert [e["error"] for e in validate.validate("s02a", held | {"tag_candidates": bare})["errors"]] == ["CandidatesMissingEvidence"]
    excused = bare.withColumn("metadata", F.col("metadata").withField("no_evidence_reason", F.lit("made by hand")))
    assert validate.validate("s02a", held | {"tag_candidates": excused})["valid"]
    generic = held["tag_candidates"].withColumn("metadata", F.col("metadata").withField("is_generic", F.lit(True))).withColumn("role", F.lit("document_primary_candidate"))
    assert [e["error"] for e in validate.validate("s02a", held | {"tag_candidates": generic})["errors"]] == ["GenericFacetPromotedToPrimary"]


def test_project_end_to_end_and_faults(spark, tmp_path):
    project = Project(spark, str(tmp_path / "root"))
    assert project.ingest(write_csv(tmp_path / "in.csv"))["ok_rows"] == 2
    assert project.normalize()["status"] == "ok"
    assert project.normalize()["errors"][0]["error"] == "ExistingS01Artifacts"
    assert project.normalize(doc_id="none", force=True)["errors"][0]["error"] == "DocIdNotFound"
    assert project.tag_candidates()["processed"] == 2
    for stage in ("s00", "S01", "s02a"):
        assert project.validate(stage)["valid"], project.validate(stage)
    assert project.validate("s99")["errors"][0]["error"] == "UnknownStage"
    assert project.status().where("not exists").count() == 0
    assert project.audit_normalized(5)["documents"] == 4
    kept = project._read("documents_normalized")
    broken = kept.withColumn("block_count", F.col("block_count") + 1).where("source_format <> 'plain_text'")
    tables = {"documents": project._read("documents"), "documents_normalized": broken, "blocks": project._read("blocks")}
    from quarry.operators import validate

    assert {e["error"] for e in validate.validate("s01", tables)["errors"]} == {"MissingNormalizedDocuments", "BlockCountMismatch"}
    tables["documents_normalized"] = kept.withColumn("plain_text", F.lit('"tools": 1'))
    assert [e["error"] for e in validate.validate("s01", tables)["errors"]] == ["JsonMarkersInPlainText"]
    tables["documents_normalized"] = kept.drop("error")
    assert [e["error"] for e in validate.validate("s01", tables)["errors"]] == ["MissingColumns"]


def test_stream_ingests_new_files_once(spark, tmp_path):
    from quarry.streaming.incremental import run_incremental

    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    schema = "source_id string, name string, content string"
    for k in range(2):
        spark.createDataFrame([(str(k), "n", f"text {k}")], schema).write.mode("append").parquet(landing)
        run_incremental(spark, landing, schema, out, str(tmp_path / "checkpoint")).awaitTermination()
    # a document delivered again in a later file
    spark.createDataFrame([("0", "n", "text 0")], schema).write.mode("append").parquet(landing)
    run_incremental(spark, landing, schema, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(f"{out}/documents").count() == 2
    assert {r["text"] for r in spark.read.parquet(f"{out}/blocks").collect()} == {"text 0", "text 1"}


def test_report_of_normalisation(spark):
    normalized, rows = normalise(made(spark, "a\nb", ""))
    r = normalize.report(normalized, rows).first()
    assert (r["documents"], r["ok"], r["empty"], r["blocks"], r["block_types"]) == (2, 1, 1, 2, {"paragraph": 2})


def test_package_stands_without_its_optional_part():
    import pathlib

    core = pathlib.Path(markup.__file__).parents[1]
    for path in core.rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"quarry\.llm|corpus_pipeline", path.read_text(encoding="utf-8")), path
