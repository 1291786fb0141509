"""Stages put together: ingest, normalise, tag candidates, audits, validation, status."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import schemas
from quarry.functions import text as X
from quarry.operators import audit, ingest, lexicon, normalize, review, units, validate
from quarry.operators import blocks as block_ops
from quarry.operators import candidates as cand
from quarry.plans import reports
from quarry.sources import files
from quarry.sources.shared import cut

#: The report that each stage leaves under reports/.
REPORTS = {"s00": "S00_ingest_report", "s01": "S01_normalization_report", "s02a": "S02A_tagging_report"}
QUALITY_REPORT, SAMPLE_INDEX = "S01_quality_report", "S01_sample_index"
S00, S01, S02A = ("documents", "manifest"), ("documents_normalized", "blocks", "block_metrics"), ("topic_units", "tag_candidates", "candidate_evidence", "doc_topics")


def documents_from_table(table: DataFrame, key: str, text: str, name: str | None = None) -> DataFrame:
    """Any table with a key and a text as source rows of stage S00."""
    extra = [c for c in table.columns if c not in (key, text, name)]
    rows = table.select(F.col(key).cast("string").alias("source_id"), (F.col(name) if name else F.lit("")).cast("string").alias("name"), F.lit("").alias("description"), F.col(text).alias("content"), F.col(key).try_cast("long").alias("source_row"), *extra)
    return ingest.documents(rows)


@dataclass
class Tagged:
    """The outputs of stage S02A."""

    units: DataFrame
    candidates: DataFrame
    evidence: DataFrame
    topics: DataFrame


def normalise(docs: DataFrame, keep: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents_normalized, blocks) of stage S01; `keep` parses once for both, into the shared folder."""
    done = normalize.parsed(docs)
    if keep:
        done = cut(done)
    return normalize.documents_normalized(done), normalize.blocks(done)


def tag(normalized: DataFrame, blocks: DataFrame, words: lexicon.Lexicon | None = None) -> Tagged:
    """Stage S02A over the ok documents, each doc_id once."""
    words = (words or lexicon.default()).with_defaults()
    # copies of a document have one doc_id, one content and so the same blocks: one of them stands for all
    ok = normalized.where("normalization_status = 'ok'").groupBy("doc_id").agg(F.min(F.struct("title", "plain_text", "normalization_status")).alias("one"))
    ok = cut(ok.select("doc_id", "one.*"))
    own = cut(blocks.join(ok.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id", "order"]))
    made = cut(units.topic_units(ok, own))
    found = cut(cand.candidates(ok, own, made, words))
    table = cand.candidate_table(found)
    return Tagged(made, table, cand.evidence_table(found), review.doc_topics(ok, made, table, words))


class Project:
    """Stage outputs under one root, in a folder for each stage."""

    def __init__(self, spark: SparkSession, root: str, words: lexicon.Lexicon | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        folder = None if words else lexicon.find_folder(self.root)
        self.words = lexicon.Lexicon.read_folder(folder) if folder else words

    def path(self, name: str) -> str:
        stage = "s00" if name in S00 else "s01" if name in S01 else "s02a"
        return f"{self.root}/{stage}/{name}"

    def report_path(self, name: str, kind: str = "json") -> str:
        return f"{self.root}/reports/{name}.{kind}"

    def _reported(self, name: str, report: dict, markdown: str | None = None) -> dict:
        """The report, kept under reports/ as JSON and, if there is one, as Markdown."""
        files.write_text(self.spark, self.report_path(name), json.dumps(report, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n")
        if markdown is not None:
            files.write_text(self.spark, self.report_path(name, "md"), markdown)
        return report

    def exists(self, name: str) -> bool:
        return self._there(self.path(name))

    def _there(self, where: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def status(self) -> DataFrame:
        """(artifact, path, exists) of every output."""
        return self.spark.createDataFrame([(n, self.path(n), self.exists(n)) for n in (*S00, *S01, *S02A)], "artifact string, path string, exists boolean")

    def _read(self, name: str) -> DataFrame:
        table, error = files.read_artifact(self.spark, self.path(name), name)
        if error:
            raise FileNotFoundError(json.dumps(error))
        return table

    def _refused(self, names: tuple[str, ...], error: str, force: bool) -> dict | None:
        there = [n for n in names if self.exists(n)]
        return None if force or not there else {"status": "failed", "errors": [{"error": error, "message": f"outputs exist: {', '.join(there)}; use force"}]}

    def ingest(self, csv_path: str) -> dict:
        rows = files.read_csv(self.spark, csv_path)
        if gone := ingest.missing_columns(rows):
            return {"status": "failed", "errors": [{"error": "MissingColumns", "message": ", ".join(gone)}]}
        docs = ingest.documents(rows)
        files.write_table(docs, self.path("documents"), "documents", overwrite=True)
        docs = self._read("documents")
        files.write_table(ingest.manifest(docs), self.path("manifest"), "manifest", overwrite=True)
        report = files.single_row(ingest.report(docs)) | {"repeated_doc_ids": ingest.duplicates(docs).count()}
        return self._reported(REPORTS["s00"], {"stage": "S00", "status": "ok" if not report["failed_rows"] else "partial"} | report)

    def _chosen(self, rows: DataFrame, doc_id: str | None, limit: int | None, order: str) -> DataFrame:
        if doc_id is not None:
            rows = rows.where(F.col("doc_id") == doc_id)
            if rows.limit(1).count() == 0:
                raise LookupError("DocIdNotFound")
        return rows if limit is None else rows.orderBy(order, "doc_id").limit(max(0, limit))

    def normalize(self, limit: int | None = None, doc_id: str | None = None, force: bool = False) -> dict:
        if refused := self._refused(S01, "ExistingS01Artifacts", force):
            return refused
        try:
            docs = self._chosen(self._read("documents"), doc_id, limit, "source_row")
        except (FileNotFoundError, LookupError) as e:
            return {"status": "failed", "errors": [{"error": "DocIdNotFound" if isinstance(e, LookupError) else "MissingInput", "message": str(e)}]}
        normalized, blocks = normalise(docs, keep=True)
        for name, table in (("documents_normalized", normalized), ("blocks", blocks)):
            files.write_table(table, self.path(name), name, overwrite=True)
        files.write_table(block_ops.metrics(self._read("blocks")), self.path("block_metrics"), "block_metrics", overwrite=True)
        report = files.single_row(normalize.report(self._read("documents_normalized"), self._read("blocks")))
        partial = limit is not None or doc_id is not None or report["failed"] > 0
        chosen = limit is not None or doc_id is not None
        return self._reported(REPORTS["s01"], {"stage": "S01", "status": "partial" if partial else "ok", "partial": chosen} | report)

    def tag_candidates(self, limit: int | None = None, doc_id: str | None = None, force: bool = False, stage: str = "s02a") -> dict:
        if stage.lower() != "s02a":
            return {"status": "failed", "errors": [{"error": "UnsupportedStage", "message": stage}]}
        if refused := self._refused(S02A, "ExistingS02AArtifacts", force):
            return refused
        try:
            chosen = self._chosen(self._read("documents_normalized"), doc_id, limit, "doc_id")
            out = tag(chosen, self._read("blocks"), self.words)
        except (FileNotFoundError, LookupError) as e:
            return {"status": "failed", "errors": [{"error": "DocIdNotFound" if isinstance(e, LookupError) else "MissingInput", "message": str(e)}]}
        for name, table in zip(S02A, (out.units, out.candidates, out.evidence, out.topics), strict=True):
            files.write_table(table, self.path(name), name, overwrite=True)
        done = {n: self._read(n) for n in S02A}
        counts = {f"{c['counter']}:{c['value']}": c["n"] for c in review.counters(done["tag_candidates"]).collect()}
        report = {
            "stage": "S02A", "status": "ok" if limit is None and doc_id is None else "partial", "partial": limit is not None or doc_id is not None, "processed": done["doc_topics"].count(), "skipped_no_blocks": chosen.where("normalization_status = 'no_blocks'").count(),
            "topic_units": done["topic_units"].count(), "candidates": done["tag_candidates"].count(), "counters": counts, "top_facets": [r.asDict() for r in review.top_facets(done["tag_candidates"]).collect()],
            "top_rejected": [r.asDict() for r in review.top_rejected(done["tag_candidates"]).collect()],
        }
        return self._reported(REPORTS["s02a"], report, reports.tagging_markdown(report))

    def audit_normalized(self, sample_size: int = 50) -> dict:
        normalized = self._read("documents_normalized")
        chosen = audit.samples(normalized, sample_size)
        marked = normalized.where(F.size(X.json_markers(F.col("plain_text"))) > 0)
        report = files.single_row(audit.summary(normalized)) | {
            "low_preservation": [r["doc_id"] for r in audit.low_preservation(normalized).collect()], "largest": [r["doc_id"] for r in audit.largest(normalized, "raw_length").collect()],
            "many_blocks": [r["doc_id"] for r in audit.largest(normalized, "block_count").collect()], "samples": {r["doc_id"]: r["reasons"] for r in chosen.collect()},
            "by_source_format": {r["source_format"]: r["count"] for r in normalized.groupBy("source_format").count().orderBy("source_format").collect()},
            "many_unknown": [r["doc_id"] for r in audit.largest(normalized, "unknown_count").collect()], "with_json_marker_ids": [r["doc_id"] for r in marked.orderBy("doc_id").limit(audit.TOP).collect()],
            "without_blocks": [r["doc_id"] for r in audit.without_blocks(normalized).orderBy("doc_id").limit(audit.TOP).collect()], "errors": [r["doc_id"] for r in audit.errors(normalized).orderBy("doc_id").limit(audit.TOP).collect()],
        }
        titles = {r["doc_id"]: r["title"] for r in normalized.join(F.broadcast(chosen.select("doc_id")), "doc_id").select("doc_id", "title").collect()}  # of the sample alone
        files.write_text(self.spark, self.report_path(SAMPLE_INDEX, "md"), reports.sample_index_markdown(report["samples"], titles))
        return self._reported(QUALITY_REPORT, report, reports.quality_markdown(report))

    def audit_tags(self, sample_size: int = 300) -> DataFrame:
        words = (self.words or lexicon.default()).with_defaults()
        table = self._read("tag_candidates").withColumn("seq", F.col("candidate_id"))
        return review.review_rows(self._read("documents_normalized"), self._read("topic_units"), table, int(words.review["top_k"]), sample_size)

    def validate(self, stage: str, partial: bool = False) -> dict:
        """Checks a stage's outputs: which are missing, which cannot be read, and what the others hold against each other and the report."""
        name = stage.lower()
        if name not in REPORTS:
            return validate.validate(stage, {})
        outputs = [*(self.path(n) for n in {"s00": S00, "s01": S01, "s02a": S02A}[name]), self.report_path(REPORTS[name])]
        missing = [p for p in outputs if not self._there(p)]
        needed = {"s00": S00, "s01": ("documents", "documents_normalized", "blocks"), "s02a": (*S02A, "documents_normalized")}[name]
        tables, errors, warned, report = {}, [], [], None
        for n in needed:
            table, error = files.read_artifact(self.spark, self.path(n), n)
            if table is not None:
                tables[n] = table
            elif error["error"] != "MissingInput":
                errors.append(error)
            elif self.path(n) not in missing:
                errors.append({"artifact": n, "error": "MissingDependency", "message": f"{stage} is checked against {n}"})
        if self._there(self.report_path(REPORTS[name])):
            try:
                report = files.read_json(self.spark, self.report_path(REPORTS[name]))
            except ValueError as e:
                errors.append({"artifact": REPORTS[name], "error": "UnreadableArtifact", "message": str(e)})
        if name == "s01" and not self._there(self.report_path(QUALITY_REPORT)):
            warned.append({"artifact": QUALITY_REPORT, "warning": "MissingOptionalQualityReport", "message": "audit_normalized has not run"})
        if len(tables) == len(needed):
            found = validate.validate(stage, tables, partial or bool((report or {}).get("partial")), report)
            errors, warned = errors + found["errors"], found["warnings"] + warned
        return {"stage": name, "valid": not missing and not errors, "missing": missing, "errors": errors, "warnings": warned, "outputs": outputs}

    def export_schemas(self) -> str:
        return json.dumps(schemas.json_schemas(), ensure_ascii=False, indent=2, sort_keys=True)
