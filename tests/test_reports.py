"""Reports and exports."""

import json

from pyspark.sql import functions as F

from quarry.functions.markup import editor_document
from quarry.plans import reports
from quarry.plans.cli import main
from quarry.plans.stages import Project


def project(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('source_id,name,content\n1,Гастрит: симптомы,"<h1>Гастрит</h1><p>Боль.</p>"\n2,B,"l1\nl2"\n3,C,<p></p>\n', encoding="utf-8")
    p = Project(spark, str(tmp_path / "root"))
    p.ingest(str(path))
    p.normalize()
    return p, p.tag_candidates()


def test_reports_and_exports(spark, tmp_path):
    p, report = project(spark, tmp_path)
    text = reports.tagging_markdown(report)
    assert "| processed | 2 |" in text and "role:" in text
    quality = p.audit_normalized(3)
    assert "| documents | 3 |" in reports.quality_markdown(quality)
    assert "| 1 |" in reports.sample_index_markdown(quality["samples"], {})
    pages = reports.audit_samples(p._read("documents_normalized"), p._read("documents"), p._read("blocks"), 3)
    assert len(pages) == 3 and all("<pre>" in r["page"] for r in pages)
    reports.export(p, str(tmp_path / "out"), by_document=True)
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "out/review.csv"))
    assert rows.count() > 0 and rows.columns[0] == "doc_id"
    assert spark.read.json(str(tmp_path / "out/tags")).count() == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "out/skipped_no_blocks.csv")).count() == 1
    reports.write_json(quality, str(tmp_path / "q.json"))
    assert json.loads((tmp_path / "q.json").read_text(encoding="utf-8"))["documents"] == 3


def test_markdown_round_trip(spark):
    body = spark.range(1).select(reports.markdown_to_editorjs(F.lit("a\nb")).alias("v")).first()["v"]
    assert [b["text"] for b in editor_document(body)["blocks"]] == ["a\nb"]


def test_command_line(spark, tmp_path, capsys):
    assert main(["--root", str(tmp_path / "none"), "validate-stage", "s01"]) == 1
    said = json.loads(capsys.readouterr().out)
    assert len(said["missing"]) == 4 and {e["error"] for e in said["errors"]} == {"MissingDependency"}
    assert main(["--root", str(tmp_path / "none"), "status"]) == 0
