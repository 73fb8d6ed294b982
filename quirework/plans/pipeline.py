"""The whole run: sources to blocks to chunks, reuse of unchanged documents, global dedupe, evaluation and gates."""

from __future__ import annotations

from dataclasses import asdict
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quirework import schemas
from quirework.config import EvalConfig, GateConfig, PipelineConfig
from quirework.functions.clean import folder_title
from quirework.operators import assemble, dedupe, evaluate, segments
from quirework.operators.incremental import Commits, changed
from quirework.operators.ordered import is_long
from quirework.runtime import materialize
from quirework.sources import readers, writers
from quirework.sources.shared import Files


def chunk_blocks(blocks: DataFrame, sources: DataFrame, config: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """(documents, chunks) of ``blocks``; ``sources`` has (doc_id, title, source_folder, source_file, ...).

    Documents without any block left after cleaning come out without chunks; the caller reports them.
    """
    long = is_long(blocks, "pos")
    clean = materialize(segments.clean_blocks(segments.distinct_blocks(blocks)), "blocks")
    segs = segments.build_segments(clean, long=long)
    segs = segments.drop_toc(segs) if config.drop_toc else segments.merge_toc(segs, config.max_tokens, long)
    segs = segments.merge_small(materialize(segs, "segments"), config.min_viable_chunk_tokens, config.max_tokens, long)
    rows = materialize(assemble.chunk_rows(segs, config, long), "rows")
    about = assemble.document_meta(clean, sources.select("doc_id", "title"), long)
    docs = about.join(sources.drop("title"), "doc_id")
    return docs, assemble.finish(rows, docs, long)


def with_stats(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    stats = dedupe.document_stats(documents, chunks)
    d = documents.join(stats, "doc_id")
    stat = F.struct(F.col("blocks").cast("int").alias("blocks"), "chunks", "pages", "tokens")
    return d.select("doc_id", "source_folder", "source_md_path", "source_mode_used", "name", "year", "brief_description", "language_hint", stat.alias("stats"))


def _previous(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path) if path else spark.createDataFrame([], schema)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def _path(uri: str) -> str:
    return uri.removeprefix("file://")


#: Tables of a run that readers find under the output folder itself.
PUBLISHED = ("documents", "chunks", "errors", "document_results", "documents.jsonl", "chunks.jsonl", "run_manifest.json")
_ENTRY = schemas.CACHE_ENTRY + ", batch string"
_SUMS = "folder string, path string, rel string, size long, modified timestamp, sum string"


def publish(spark: SparkSession, out: str, run: str) -> None:
    """Put the results of a committed run in place; a repeated call goes on where a broken one stopped."""
    files = Files(spark)
    for name in PUBLISHED:
        files.replace(f"{out}/runs/{run}/{name}", f"{out}/{name}")


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> dict:
    """Process the folders of ``input_dir`` into ``output_dir`` and return the run manifest.

    Unchanged documents (equal folder hash and settings) are reused; only files of a new size or time are read to see
    whether they changed. What a run makes of its documents is one batch, written once; the entries say which batch holds
    a document now, so nothing that is reused is written again. Batches hold the chunks as they were before the global
    dedupe, so a text comes back when the document that owned it goes.

    A run writes its batch, entries and results under its own name, then commits by one rename, and then puts the
    results in place. A run that breaks off before the commit leaves the last state and its results as they were; one
    that breaks off after it is completed by the next. Documents without usable text, or whose source can't be read as
    what it should be, are listed as errors (raised with ``fail_fast``).
    """
    out = config.output_dir.rstrip("/")
    files, commits = Files(spark), Commits(spark, f"{out}/state/commits")
    done, last = commits.last()
    if last:
        publish(spark, out, last["run"])
    found = readers.files(spark, config.input_dir)
    choices = materialize(readers.choose_sources(found, config.source_priority), "choices")
    sums = materialize(readers.checksums(found, _previous(spark, last and last["sums"], _SUMS)), "sums")
    hashes = readers.folder_hashes(sums).select("doc_id", F.col("folder").alias("source_folder"), "content_hash", F.lit(config.signature()).alias("processing_signature"))
    hashes = materialize(hashes, "hashes")
    entries = _previous(spark, last and last["entries"], _ENTRY)
    as_state = lambda d: d.select("doc_id", F.col("content_hash").alias("content"), F.col("processing_signature").alias("signature"))
    due = (changed(as_state(hashes), as_state(entries)) if config.incremental else as_state(hashes)).select("doc_id")
    due = materialize(due, "due")
    todo = choices.join(due, "doc_id", "left_semi")
    blocks, modes, bad = readers.load_blocks(found, todo)
    md_name = F.regexp_extract("md_path", "([^/]+)$", 1)
    sources = todo.join(modes, "doc_id").select(
        "doc_id", folder_title(F.col("folder")).alias("title"), F.concat(F.lit(_path(config.input_dir).rstrip("/") + "/"), F.col("folder")).alias("source_folder"),
        F.when(F.col("md_path").isNotNull(), md_name).otherwise(F.col("folder")).alias("source_file"), F.col("md_path").alias("source_md_path"),
        "source_mode_used", "fallback_reason",
    )
    docs, chunks = chunk_blocks(blocks, sources, config)
    run = datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")
    here, state = f"{out}/runs/{run}", f"{out}/state/{run}"
    batch = f"{out}/state/batches/batch={run}"
    with_stats(docs, chunks).write.parquet(f"{batch}/documents")
    chunks.write.parquet(f"{batch}/chunks")
    made = spark.read.parquet(f"{batch}/documents").select("doc_id")
    kept = entries.join(choices.select("doc_id").join(due, "doc_id", "left_anti"), "doc_id", "left_semi")
    fresh = hashes.join(made, "doc_id", "left_semi").withColumn("batch", F.lit(run)).select(*entries.columns)
    kept.unionByName(fresh).write.parquet(f"{state}/entries")
    sums.select(*[c.split()[0] for c in _SUMS.split(", ")]).write.parquet(f"{state}/sums")
    current = spark.read.parquet(f"{state}/entries")
    live = [r.batch for r in current.select("batch").distinct().collect()]  # as many as there were runs

    def table(name: str, schema: str) -> DataFrame:
        """What the current entries' batches hold of the entries' documents."""
        if not live:
            return spark.createDataFrame([], schema)
        parts = [spark.read.schema(schema).parquet(f"{out}/state/batches/batch={b}/{name}").withColumn("batch", F.lit(b)) for b in live]
        return reduce(DataFrame.unionByName, parts).join(current.select("doc_id", "batch"), ["doc_id", "batch"], "left_semi").drop("batch")

    all_docs, all_chunks = table("documents", schemas.DOCUMENT), table("chunks", schemas.CHUNK)
    final = all_chunks
    if config.dedupe_chunks:
        order = choices.select("doc_id", F.lower("folder").alias("doc_ord"))
        final = dedupe.keep_first(all_chunks.join(order, "doc_id"), ["doc_ord", "doc_id", "chunk_index"]).drop("doc_ord")
    final.write.parquet(f"{here}/chunks")
    final = spark.read.parquet(f"{here}/chunks")
    stats = dedupe.document_stats(all_docs, final)
    counted = F.struct(F.col("stats.blocks").alias("blocks"), F.col("chunks"), F.col("pages"), F.col("tokens"))
    all_docs.join(stats, "doc_id").withColumn("stats", counted).select(*all_docs.columns).write.parquet(f"{here}/documents")
    if config.json_lines:
        by_folder = ["source_path", "chunk_index"]
        writers.write_json_lines(final, f"{here}/chunks.jsonl", by_folder)
        writers.write_json_lines(spark.read.parquet(f"{here}/documents"), f"{here}/documents.jsonl", ["source_folder"])
    failed = choices.join(all_docs.select("doc_id"), "doc_id", "left_anti").join(bad, "doc_id", "left").select(
        F.col("folder").alias("source_folder"), F.coalesce("error", F.lit("No usable text blocks extracted")).alias("error")
    )
    failed = materialize(failed, "failed")
    first = failed.orderBy("source_folder").limit(writers.SHOWN).collect()
    if first and config.fail_fast:
        raise ValueError(f"{first[0].source_folder}: {first[0].error}")
    failed.write.parquet(f"{here}/errors")
    document_results(all_docs, choices, due).write.parquet(f"{here}/document_results")
    manifest = writers.run_manifest(
        all_docs, final, [r.asDict() for r in first], failed.count(), document_results=f"{out}/document_results",
        input_dir=config.input_dir, output_dir=config.output_dir, processed_at_utc=datetime.now(UTC).isoformat(),
        incremental={"enabled": config.incremental, "processed_documents": made.count(), "reused_documents": kept.count()},
    )
    writers.write_json(spark, f"{here}/run_manifest.json", manifest)
    commits.add(done, {"run": run, "entries": f"{state}/entries", "sums": f"{state}/sums"})
    publish(spark, out, run)
    return manifest


def document_results(documents: DataFrame, choices: DataFrame, due: DataFrame) -> DataFrame:
    """(doc_id, source_folder, source_mode_used, fallback_reason, warnings, reused) of every document of a run."""
    d = documents.join(choices.select("doc_id", "fallback_reason"), "doc_id", "left").join(due.withColumn("_due", F.lit(True)), "doc_id", "left")
    reused = F.col("_due").isNull()
    said = F.array_compact(F.array(F.when(F.col("source_mode_used") != "block_list", "block_list not used"), F.when(F.col("year").isNull(), "year not detected")))
    return d.select(
        "doc_id", "source_folder", "source_mode_used", F.when(reused, "incremental reuse").otherwise(F.col("fallback_reason")).alias("fallback_reason"),
        F.when(reused, F.array().cast("array<string>")).otherwise(said).alias("warnings"), reused.alias("reused"),
    )


def run_evaluation(chunks: DataFrame, documents: DataFrame, sources: DataFrame | None = None, config: EvalConfig = EvalConfig()) -> dict:
    """Report of counters, sizes, duplicates, scores, samples and gates.

    ``coverage_pct`` is measured on ``sources`` (doc_id, text), such as :func:`source_texts`; without them it is null.
    """
    counted = materialize(evaluate.counters(chunks, documents, config), "counters")
    row = lambda df: (df.first() or {}).asDict() if df.columns else {}
    missing = documents.agg(*[F.count_if(evaluate.empty(F.col(f))).alias(f) for f in evaluate.DOCUMENT_FIELDS])
    cover = evaluate.coverage_pct(sources, chunks).first()[0] if sources is not None else None
    gates = [r.asDict() for r in evaluate.quality_gates(counted, config).collect()]
    return {
        "scores": row(evaluate.scores(counted)),
        "counters": row(counted),
        "token_stats": row(evaluate.size_report(chunks)),
        "char_stats": row(evaluate.size_report(chunks, value="char_count")),
        "duplicates": row(dedupe.duplicate_stats(chunks)),
        "documents_missing": row(missing),
        "source_modes": {r.source_mode_used: r["count"] for r in documents.groupBy("source_mode_used").count().collect()},
        "coverage_pct": cover,
        "samples": [r.asDict() for r in evaluate.issue_samples(chunks, config=config).collect()],
        "quality_gates": gates,
        "passed": all(g["passed"] for g in gates),
        "config": asdict(config),
    }


def source_texts(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, text) of the Markdown files that the documents name as their sources and that are there."""
    named = documents.where("source_md_path is not null").select("doc_id", F.col("source_md_path").alias("path"))
    root = named.select(F.regexp_extract("path", "^(.*)/[^/]+/[^/]+$", 1).alias("root")).distinct().collect()  # input roots of the runs
    texts = None
    for r in root:
        raw = readers.contents(readers.files(spark, r.root), named.where(F.startswith("path", F.lit(r.root + "/"))))
        part = named.join(raw, "path").select("doc_id", F.decode("content", "UTF-8").alias("text"))
        texts = part if texts is None else texts.unionByName(part)
    return texts.distinct() if texts is not None else spark.createDataFrame([], "doc_id string, text string")


def run_gates(chunks: DataFrame, documents: DataFrame, coverage_pct: float | None, config: GateConfig = GateConfig(), check: bool = True) -> dict:
    """The deterministic gates; raises AssertionError after the report is made if one fails and ``check`` is set.

    A coverage that was not measured (None) counts as 0: its gate fails.
    """
    counted = evaluate.counters(chunks, documents)
    gates = materialize(evaluate.deterministic_gates(chunks, counted, coverage_pct or 0.0, config), "gates")
    report = {"checks": [r.asDict() for r in gates.collect()]}
    report["passed"] = all(g["passed"] for g in report["checks"])
    if check:
        evaluate.assert_gates(gates)
    return report
