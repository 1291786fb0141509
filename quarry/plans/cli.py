"""Command line: python -m quarry.plans.cli COMMAND --root FOLDER."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from quarry.plans.stages import Project


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quarry")
    parser.add_argument("--root", required=True)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("ingest").add_argument("--input", required=True)
    for name in ("normalize", "tag-candidates"):
        sub = commands.add_parser(name)
        sub.add_argument("--limit", type=int)
        sub.add_argument("--doc-id")
        sub.add_argument("--force", action="store_true")
        if name == "tag-candidates":
            sub.add_argument("--stage", default="s02a")
    commands.add_parser("audit-normalized").add_argument("--sample-size", type=int, default=50)
    commands.add_parser("audit-tag-candidates").add_argument("--sample-size", type=int, default=300)
    commands.add_parser("status")
    commands.add_parser("validate-stage").add_argument("stage")
    commands.add_parser("export-schemas")
    args = parser.parse_args(argv)
    project = Project(SparkSession.builder.appName("quarry").config("spark.sql.session.timeZone", "UTC").getOrCreate(), args.root)
    if args.command == "ingest":
        out = project.ingest(args.input)
    elif args.command == "normalize":
        out = project.normalize(args.limit, args.doc_id, args.force)
    elif args.command == "tag-candidates":
        out = project.tag_candidates(args.limit, args.doc_id, args.force, args.stage)
    elif args.command == "audit-normalized":
        out = project.audit_normalized(args.sample_size)
    elif args.command == "audit-tag-candidates":
        out = {"rows": [r.asDict() for r in project.audit_tags(args.sample_size).collect()]}
    elif args.command == "status":
        out = {r["artifact"]: r["exists"] for r in project.status().collect()}
    elif args.command == "validate-stage":
        out = project.validate(args.stage)
    else:
        out = json.loads(project.export_schemas())
    print(json.dumps(out, ensure_ascii=False, indent=2, default=str))
    return int(out.get("status") == "failed" or out.get("valid") is False)


if __name__ == "__main__":
    sys.exit(main())
