"""Writers: Parquet by default, JSON lines in order, and the small JSON and Markdown reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.sources.shared import Files


def write_json(spark: SparkSession, path: str, payload: dict | list) -> None:
    """A small object as indented JSON, non-ASCII kept."""
    Files(spark).write(path, json.dumps(payload, ensure_ascii=False, indent=2, default=str))


def write_json_lines(df: DataFrame, path: str, order: list[str], keep_nulls: tuple[str, ...] = ()) -> None:
    """One JSON object a line, sorted by ``order``; null fields are left out, but for top-level ``keep_nulls``.

    Written by many tasks, as a folder of parts whose names sort in the order of the rows.
    """
    body = F.to_json(F.struct(*df.columns))
    for c in keep_nulls:
        body = F.when(F.col(c).isNull(), F.regexp_replace(body, r"^\{", f'{{"{c}":null,')).otherwise(body)
    df.orderBy(*order).select(F.regexp_replace(body, r",\}$", "}").alias("value")).write.mode("overwrite").text(path)


#: Errors shown in a manifest; all of them are in the table beside it.
SHOWN = 100


def run_manifest(documents: DataFrame, chunks: DataFrame, errors: list[dict], error_count: int, **more: object) -> dict:
    """Counts of a run and its first errors. Results by document stay a table; only aggregates come to the driver."""
    modes = {r.source_mode_used or "unknown": r["count"] for r in documents.groupBy("source_mode_used").count().collect()}
    return {
        **more,
        "documents": sum(modes.values()),
        "chunks": chunks.count(),
        "source_modes": modes,
        "errors": errors,
        "error_count": error_count,
    }


def scorecard(report: dict) -> str:
    """Markdown report of scores, counters and gates; ``report`` needs scores, counters and quality_gates."""
    lines = ["# Chunk quality scorecard", "", f"Overall: **{report['scores']['overall_score']:.2f}** ({report['scores']['status']})", ""]
    lines += ["| dimension | score |", "|---|---|"]
    lines += [f"| {k.removesuffix('_score')} | {v:.2f} |" for k, v in report["scores"].items() if k.endswith("_score") and k != "overall_score"]
    lines += ["", "| counter | chunks |", "|---|---|", *(f"| {k} | {v} |" for k, v in report["counters"].items())]
    lines += ["", "| gate | actual | expected | passed |", "|---|---|---|---|"]
    lines += [f"| {g['name']} | {g['actual']:g} | {g['expected']:g} | {'yes' if g['passed'] else 'no'} |" for g in report["quality_gates"]]
    return "\n".join(lines) + "\n"


def write_reports(spark: SparkSession, report: dict, json_path: str, md_path: str) -> None:
    write_json(spark, json_path, report)
    Files(spark).write(md_path, scorecard(report))
