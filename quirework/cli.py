"""Command line: ``run``, ``evaluate`` and ``gates``."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import fields

from pyspark.sql import SparkSession

from quirework.config import EvalConfig, GateConfig, PipelineConfig
from quirework.operators import evaluate
from quirework.plans.pipeline import run_evaluation, run_gates, run_pipeline, source_texts
from quirework.sources.shared import Files
from quirework.sources.writers import write_json, write_reports


def _options(parser: argparse.ArgumentParser, config: type) -> None:
    for f in fields(config):
        name = "--" + f.name.replace("_", "-")
        if isinstance(f.default, bool):
            parser.add_argument(name, action=argparse.BooleanOptionalAction, default=f.default)
        else:
            parser.add_argument(name, type=type(f.default), default=f.default)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quirework")
    sub = parser.add_subparsers(dest="command", required=True)
    _options(sub.add_parser("run", help="folders to chunks"), PipelineConfig)
    for name, config in (("evaluate", EvalConfig), ("gates", GateConfig)):
        p = sub.add_parser(name)
        p.add_argument("--artifacts-dir", required=True)
        p.add_argument("--output-json", default="")
        p.add_argument("--output-md", default="")
        p.add_argument("--fail-on-threshold", action="store_true")
        _options(p, config)
    sub.choices["gates"].add_argument("--eval-report", default="", help="report of evaluate, whose coverage counts; measured anew without one")
    return parser


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = SparkSession.builder.appName("quirework").getOrCreate()
    pick = lambda config: config(**{f.name: getattr(args, f.name) for f in fields(config)})
    if args.command == "run":
        manifest = run_pipeline(spark, pick(PipelineConfig))
        print(f"{manifest['documents']} documents, {manifest['chunks']} chunks, {len(manifest['errors'])} errors")
        return 0
    chunks, documents = (spark.read.parquet(f"{args.artifacts_dir}/{t}") for t in ("chunks", "documents"))
    if args.command == "evaluate":
        report = run_evaluation(chunks, documents, source_texts(spark, documents), pick(EvalConfig))
        if args.output_json and args.output_md:
            write_reports(spark, report, args.output_json, args.output_md)
    else:
        if args.eval_report:
            covered = json.loads(Files(spark).read(args.eval_report))["coverage_pct"]
        else:
            covered = evaluate.coverage_pct(source_texts(spark, documents), chunks).first()[0]
        report = run_gates(chunks, documents, covered, pick(GateConfig), check=False)
        if args.output_json:
            write_json(spark, args.output_json, report)
    return 2 if args.fail_on_threshold and not report["passed"] else 0


if __name__ == "__main__":
    sys.exit(main())
