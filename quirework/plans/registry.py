"""Queries of the core operators over the given tables, and their SQL.

Each query runs over its whole tables. Where SQL can't express an operator (folds with lookahead, entity tables), no
SQL is given and the operator is tested in ``tests/`` instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.config import EvalConfig, PipelineConfig
from quirework.functions import clean, meta, splitting
from quirework.functions.tokens import TOKEN_JAVA, token_count, token_sql
from quirework.operators import assemble, dedupe, evaluate, incremental, segments
from quirework.operators.ordered import is_long, numbered
from quirework.plans.pipeline import chunk_blocks
from quirework.plans.sql import ORACLES
from quirework.runtime import read_table, shared_dir, spread
from quirework.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


def _long(spark: SparkSession, d: str, name: str = "blocks", pos: str = "pos") -> bool:
    return is_long(_t(spark, d, name), pos)


# --- incremental -----------------------------------------------------------------------------


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return incremental.to_process(_t(spark, d, "doc_hashes"), _t(spark, d, "run_manifest"), _t(spark, d, "folder_scan"))


def incremental_split(spark: SparkSession, d: str) -> DataFrame:
    """What a run reuses and what it processes."""
    now = incremental.present_state(_t(spark, d, "folder_scan"))
    last = incremental.last_processed(_t(spark, d, "doc_hashes"), _t(spark, d, "run_manifest"))
    mark = lambda df, name: df.select("doc_id", F.lit(name).alias("action"))
    return mark(incremental.changed(now, last), "process").unionByName(mark(incremental.unchanged(now, last), "reuse"))


def run_summary(spark: SparkSession, d: str) -> DataFrame:
    """Documents, reuses and errors of each run by source mode."""
    m = _t(spark, d, "run_manifest").select("run_id", "doc_id", "source_mode_used", "reused", "error").distinct()
    return m.groupBy("run_id", "source_mode_used").agg(
        F.count(F.lit(1)).alias("results"), F.count_if("reused").alias("reused"), F.count_if(F.col("error").isNotNull()).alias("errors")
    )


# --- tokens, windows, sizes ------------------------------------------------------------------


def token_counts(spark: SparkSession, d: str) -> DataFrame:
    """T2."""
    return _t(spark, d, "chunks").select("row_id", token_count("text").alias("tokens"))


def chunk_size_report(spark: SparkSession, d: str) -> DataFrame:
    """Fixed windows of the documents' tokens and their sizes by declared language.

    A closed-form approximation of the splitter: windows of 350 matches that share 25.
    """
    size, step = 350, 325
    toks = _t(spark, d, "documents").select("lang", F.regexp_extract_all("text", F.lit(TOKEN_JAVA), F.lit(0)).alias("t"))
    n = F.size("t")
    starts = F.explode(F.sequence(F.lit(0), n - 1, F.lit(step)))
    w = toks.where(n > 0).select("lang", n.alias("n"), starts.alias("s"))
    w = w.select("lang", F.floor((F.least(F.lit(size), F.col("n") - F.col("s")) * 12 + 5) / 10).cast("int").alias("token_count"))
    r = evaluate.size_report(w, ["lang"])
    small = w.groupBy("lang").agg(F.count_if(F.col("token_count") < 50).alias("small"))
    both = r.alias("r").join(small.alias("s"), F.col("r.lang").eqNullSafe(F.col("s.lang")))
    return both.select("r.lang", "count", "min", "median", "p95", "max", "avg", evaluate.pct(F.col("small"), F.col("count")).alias("small_pct"))


def split_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The documents' texts by the splitter."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, k, p) for i, t in zip(b["doc_id"], b["text"]) for k, p in enumerate(splitting.split_tokens(t or "", 420, 480, 30))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece_no", "text"])

    return spread(_t(spark, d, "documents").select("doc_id", "text")).mapInPandas(run, "doc_id long, piece_no int, text string")


def chunk_sizes(spark: SparkSession, d: str) -> DataFrame:
    """R1, R3 by document."""
    c = _t(spark, d, "chunks").select("doc_id", token_count("text").alias("token_count"))
    return evaluate.size_report(c, ["doc_id"])


# --- cleaning --------------------------------------------------------------------------------


def paragraph_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The documents read as Markdown."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return readers.markdown(docs).select("doc_id", "pos", "text", "block_type", "heading_level")


def source_choice(spark: SparkSession, d: str) -> DataFrame:
    """The source read of each folder, from the files it would hold by its mode in the scans."""
    f = _t(spark, d, "folder_scan").groupBy("source_folder").agg(F.max("source_mode").alias("mode"))
    names = F.when(F.col("mode") == "block_list", F.array(F.lit("block_list.json"), F.lit("z_content_list.json"), F.lit("b.md"))).when(
        F.col("mode") == "content_list", F.array(F.lit("z_content_list.json"), F.lit("a_content_list.json"), F.lit("c.md"))
    ).when(F.col("mode") == "md", F.array(F.lit("b.md"), F.lit("a.md"), F.lit("notes.txt"))).otherwise(F.array(F.lit("notes.txt")))
    found = f.select(F.col("source_folder").alias("folder"), F.explode(names).alias("name")).withColumn("path", F.concat_ws("/", "folder", "name"))
    return readers.choose_sources(found).select("folder", "mode", "block_path", "content_path", "md_path", "fallback_reason")


def _numbered_blocks(spark: SparkSession, d: str) -> DataFrame:
    return numbered(segments.distinct_blocks(_t(spark, d, "blocks")), "doc_id", "pos", "i", _long(spark, d))


def block_list_read(spark: SparkSession, d: str) -> DataFrame:
    """The blocks of each document as a block list in JSON, ten a page, and read back.

    Every seventh block is discarded, and a connection joins the second and third of each document.
    """
    table = F.col("block_type") == "table_body"
    at = lambda i: F.concat(F.floor(i / 10).cast("string"), F.lit("-"), i.cast("string"))
    item = F.struct(
        F.col("block_type").alias("type"), F.when(~table, F.col("text")).alias("text"), F.when(table, F.col("text")).alias("table_body"),
        F.floor(F.col("i") / 10).cast("int").alias("page_idx"), F.col("heading_level").alias("level"), at(F.col("i")).alias("block_position"),
        F.concat(F.lit("b"), F.col("i").cast("string")).alias("id"), (F.col("i") % 7 == 6).alias("is_discarded"),
    )
    b = _numbered_blocks(spark, d).select("doc_id", F.floor(F.col("i") / 10).alias("page"), "i", item.alias("item"))
    ordered = lambda key, c: F.transform(F.array_sort(F.collect_list(F.struct(key, c))), lambda x: x[c])
    pages = b.groupBy("doc_id", "page").agg(ordered("i", "item").alias("items"))
    merge = F.array(F.struct(F.lit("m").alias("id"), F.lit("merge").alias("type"), F.array(at(F.lit(1)), at(F.lit(2))).alias("blocks")))
    docs = pages.groupBy("doc_id").agg(ordered("page", "items").alias("pdfData")).withColumn("mergeConnections", merge)
    raw = docs.select("doc_id", F.to_json(F.struct("pdfData", "mergeConnections")).cast("binary").alias("content"))
    return readers.block_list(raw).select("doc_id", "pos", "text", "block_type", "heading_level", F.size("page_refs").alias("refs"))


def content_list_read(spark: SparkSession, d: str) -> DataFrame:
    """The blocks of each document as a content list in JSON, tables with captions and footnotes, and read back."""
    table = F.col("block_type") == "table_body"
    item = F.struct(
        "i", F.when(table, "table").when(F.col("block_type") == "title", "text").otherwise(F.col("block_type")).alias("type"),
        F.when(~table, F.col("text")).alias("text"), F.col("heading_level").alias("text_level"), (F.col("i") % 5).alias("page_idx"),
        F.when(table, F.col("text")).alias("table_body"), F.when(table, F.array(F.lit("cap"), F.lit("tion"))).alias("table_caption"),
        F.when(table & (F.col("i") % 2 == 0), F.array(F.lit("foot"))).alias("table_footnote"),
    )
    raw = _numbered_blocks(spark, d).groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(item))).cast("binary").alias("content"))
    return readers.content_list(raw).select("doc_id", "pos", "text", "block_type", "heading_level", F.col("page_refs")[0]["page_idx"].alias("page"))


def json_lines_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The chunks written as JSON lines, in order and without null fields, and read back."""
    c = _t(spark, d, "chunks").select("row_id", "doc_id", "chunk_index", "text", "token_count", "page_refs")
    path = f"{shared_dir(spark)}/chunks-{uuid.uuid4().hex[:8]}.jsonl"
    writers.write_json_lines(c, path, ["doc_id", "chunk_index", "row_id"])
    back = readers.json_lines(spark, path, c.schema)
    return back.select("row_id", "doc_id", "chunk_index", "text", "token_count", F.size("page_refs").alias("refs"))


def bookmark_noise(spark: SparkSession, d: str) -> DataFrame:
    """Bookmark errors and tags out of block texts."""
    return _t(spark, d, "blocks").select("row_id", clean.strip_tags(F.regexp_replace("text", clean.BOOKMARK, " ")).alias("text"))


def line_clean(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the blocks, noise and repeats dropped."""
    return _t(spark, d, "blocks").select("row_id", clean.clean_lines(F.col("text")).alias("text"))


def sentence_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """C12."""
    return _t(spark, d, "blocks").select("row_id", clean.dedupe_sentences(F.col("text")).alias("text"))


def clean_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Whole cleaning of the blocks."""
    return segments.clean_blocks(_t(spark, d, "blocks").select("row_id", "text"))


def folder_titles(spark: SparkSession, d: str) -> DataFrame:
    """C14."""
    name = F.regexp_extract("source_folder", "([^/]+)$", 1)
    return _t(spark, d, "folder_scan").select("source_folder").distinct().select("source_folder", clean.folder_title(name).alias("title"))


# --- metadata --------------------------------------------------------------------------------


def year_extract(spark: SparkSession, d: str) -> DataFrame:
    """M1."""
    return _t(spark, d, "documents").select("doc_id", meta.extract_year(F.col("text")).alias("found_year"))


def language_hint(spark: SparkSession, d: str) -> DataFrame:
    """M4."""
    return _t(spark, d, "documents").select("doc_id", meta.language_hint(F.col("text")).alias("hint"))


def document_meta(spark: SparkSession, d: str) -> DataFrame:
    """M1-M4, M6: name, year, description and language of each document from its blocks."""
    b = segments.distinct_blocks(_t(spark, d, "blocks"))
    titles = _t(spark, d, "documents").select(F.col("doc_key").alias("doc_id"), F.lit("").alias("title"))
    return assemble.document_meta(b, titles, _long(spark, d))


def augmented_text(spark: SparkSession, d: str) -> DataFrame:
    """M11."""
    c = [F.col("text"), *(F.col(f"metadata.{f}") for f in ("name", "year", "section", "article", "subarticle"))]
    return _t(spark, d, "chunks").select("row_id", meta.augmented_text(*c).alias("augmented"))


def page_ranges(spark: SparkSession, d: str) -> DataFrame:
    """M12, M13."""
    r = _t(spark, d, "segments").select("row_id", meta.page_meta(F.col("page_refs")).alias("r"))
    label = lambda x: F.concat_ws(":", x["page_idx"].cast("string"), F.coalesce(x["block_position"], F.lit("")), F.coalesce(x["block_id"], F.lit("")))
    return r.select(
        "row_id", meta.page_start(F.col("r")).alias("page_start"), meta.page_end(F.col("r")).alias("page_end"),
        F.array_join(F.transform("r", label), ",").alias("refs"),
    )


def structure_state(spark: SparkSession, d: str) -> DataFrame:
    """Section, article and subarticle at each block."""
    b = segments.distinct_blocks(_t(spark, d, "blocks"))
    return segments.structure_state(b, long=_long(spark, d)).select("doc_id", "pos", "section", "article", "subarticle", "changed")


def heading_paths(spark: SparkSession, d: str) -> DataFrame:
    """G1."""
    b = segments.distinct_blocks(_t(spark, d, "blocks"))
    return segments.heading_paths(b, _long(spark, d)).select("doc_id", "pos", F.array_join("heading_path", " > ").alias("path"))


def built_segments(spark: SparkSession, d: str) -> DataFrame:
    """G2, W3, W5."""
    b = segments.distinct_blocks(_t(spark, d, "blocks")).where("trim(text) <> ''")
    s = segments.build_segments(b, long=_long(spark, d))
    return s.select("doc_id", "seg_no", "text", "section", "article", "subarticle", F.size("page_refs").alias("refs"))


def toc_flags(spark: SparkSession, d: str) -> DataFrame:
    """G3, G4."""
    t, p = F.col("text"), F.col("heading_path")
    return _t(spark, d, "segments").select("row_id", meta.is_toc(t, p).alias("toc"), meta.is_toc_continuation(t, p).alias("continuation"))


def _own_segments(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "segments")
    cols = ["text", "page_refs", "section", "article", "subarticle", "heading_path"]
    one = s.groupBy("doc_id", "seg_no").agg(F.min_by(F.struct(*cols), "row_id").alias("s"))
    return one.select("doc_id", "seg_no", *[f"s.{c}" for c in cols])


def toc_merged(spark: SparkSession, d: str) -> DataFrame:
    """The segments with tables of contents merged."""
    return segments.merge_toc(_own_segments(spark, d), 480, _long(spark, d, "segments", "seg_no")).select("doc_id", "seg_no", "section", F.length("text").alias("chars"))


def small_merged(spark: SparkSession, d: str) -> DataFrame:
    """G6, G7."""
    m = segments.merge_small(segments.drop_toc(_own_segments(spark, d)), 50, 480, _long(spark, d, "segments", "seg_no"))
    return m.select("doc_id", "seg_no", "text", "section", "article")


def resolved_structure(spark: SparkSession, d: str) -> DataFrame:
    """M7, M9."""
    r = meta.resolve_structure(*(F.col(c) for c in ("section", "article", "subarticle", "heading_path")))
    return _t(spark, d, "segments").select("row_id", r.alias("r")).select("row_id", "r.section", "r.article", "r.subarticle")


def chunk_articles(spark: SparkSession, d: str) -> DataFrame:
    """M8, M10."""
    a = meta.final_article(F.col("text"), *(F.col(f"metadata.{c}") for c in ("section", "article", "subarticle")))
    return _t(spark, d, "chunks").select("row_id", a.alias("a")).select("row_id", "a.article", "a.subarticle")


def stub_flags(spark: SparkSession, d: str) -> DataFrame:
    """A7."""
    return _t(spark, d, "chunks").select("row_id", meta.is_stub(F.col("text"), token_count("text"), 50).alias("stub"))


def table_normalized(spark: SparkSession, d: str) -> DataFrame:
    """A1, A2."""
    t = F.col("text")
    return _t(spark, d, "chunks").select("row_id", meta.is_table(t).alias("is_table"), meta.normalize_table(t).alias("normalized"))


def pipeline_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks to chunk rows, through T3-T10, A3-A10 and X2."""
    sources = _t(spark, d, "documents").groupBy(F.col("doc_key").alias("doc_id")).agg(
        F.min("source_folder").alias("source_folder"), F.min("source_mode_used").alias("source_mode_used")
    )
    name = F.regexp_extract("source_folder", "([^/]+)$", 1)
    none = F.lit(None).cast("string")
    sources = sources.withColumns({"title": clean.folder_title(name), "source_file": name, "source_md_path": none})
    _, chunks = chunk_blocks(_t(spark, d, "blocks"), sources, PipelineConfig())
    return chunks


# --- duplicates, statistics, quality ---------------------------------------------------------


def global_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """The first chunk of every text."""
    c = _t(spark, d, "chunks").select("row_id", "doc_id", "chunk_index", "text")
    return dedupe.keep_first(c, ["doc_id", "chunk_index", "row_id"]).select("row_id")


def document_stats(spark: SparkSession, d: str) -> DataFrame:
    """J4, R14."""
    docs = _t(spark, d, "documents").select(F.col("doc_key").alias("doc_id"))
    return dedupe.document_stats(docs, _t(spark, d, "chunks").select("doc_id", "page_refs", token_count("text").alias("token_count")))


def duplicate_stats(spark: SparkSession, d: str) -> DataFrame:
    """R9."""
    return dedupe.duplicate_stats(_t(spark, d, "chunks"))


def _evaluated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return _t(spark, d, "chunks"), _t(spark, d, "documents").select(F.col("doc_key").alias("doc_id"), "year", "name")


def quality_counters(spark: SparkSession, d: str) -> DataFrame:
    """R4-R8, J1."""
    return evaluate.counters(*_evaluated(spark, d))


def quality_scores(spark: SparkSession, d: str) -> DataFrame:
    """R2, R12, R13."""
    return evaluate.scores(evaluate.counters(*_evaluated(spark, d)))


def quality_gates(spark: SparkSession, d: str) -> DataFrame:
    """R15."""
    return evaluate.quality_gates(evaluate.counters(*_evaluated(spark, d)))


def deterministic_gates(spark: SparkSession, d: str) -> DataFrame:
    """With the coverage of the documents by their chunks."""
    chunks, docs = _evaluated(spark, d)
    src = _t(spark, d, "documents").select(F.col("doc_key").alias("doc_id"), "text")
    return evaluate.deterministic_gates(chunks, evaluate.counters(chunks, docs), evaluate.coverage_pct(src, chunks))


def char_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Characters of the documents in their chunks."""
    src = _t(spark, d, "documents").select(F.col("doc_key").alias("doc_id"), "text")
    return evaluate.coverage(src, _t(spark, d, "chunks").select("doc_id", "text"))


def consecutive_overlap(spark: SparkSession, d: str) -> DataFrame:
    """W1, T11."""
    return evaluate.consecutive_overlap(_t(spark, d, "chunks"))


def issue_samples(spark: SparkSession, d: str) -> DataFrame:
    """A top-k report."""
    return evaluate.issue_samples(_t(spark, d, "chunks"), "row_id", EvalConfig())


def source_modes(spark: SparkSession, d: str) -> DataFrame:
    """R10."""
    return _t(spark, d, "documents").groupBy("source_mode_used").agg(F.count(F.lit(1)).alias("docs"))


NAMES = (
    source_choice, block_list_read, content_list_read, json_lines_round_trip, p3_found, incremental_split, run_summary, token_counts, chunk_size_report, split_pieces, chunk_sizes, paragraph_blocks, bookmark_noise, line_clean,
    sentence_dedupe, clean_blocks, folder_titles, year_extract, language_hint, document_meta, augmented_text, page_ranges, structure_state,
    heading_paths, built_segments, toc_flags, toc_merged, small_merged, resolved_structure, chunk_articles, stub_flags, table_normalized,
    pipeline_chunks, global_dedupe, document_stats, duplicate_stats, quality_counters, quality_scores, quality_gates, deterministic_gates,
    char_coverage, consecutive_overlap, issue_samples, source_modes,
)


def entry(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: blocks to finished chunks."""
    return pipeline_chunks(spark, d)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in NAMES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


__all__ = ["entry", "oracle_sql", "queries", "token_sql"]
