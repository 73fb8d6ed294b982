"""Quality of chunks: one aggregation for all counters, then scores, bands and gates on its single row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.config import EvalConfig, GateConfig
from quirework.functions import meta
from quirework.functions.clean import nonblank_lines
from quirework.operators.dedupe import duplicate_stats
from quirework.operators.ordered import is_long, scan

# What counts as a leftover.
HTML_LEFT = r"(?i)</?(?:table|tr|td|th)\b"
MATH_LEFT = r"\$[^$\n]+\$"
LATEX_LEFT = r"\\[()\[\]]|\\[A-Za-z]+"
BOOKMARK_LEFT = r"(?iu)errore\.\s*il\s+(?:segnalibro|segnalbro)\s+non\s+[^\n]*?definit[oa]"
CHUNK_FIELDS = ("year", "name", "brief_description", "language_hint", "section", "article", "subarticle")
DOCUMENT_FIELDS = ("year", "name", "brief_description", "language_hint")
BANDS = ((90, "excellent"), (75, "good"), (60, "warning"))


def pct(part: Column, total: Column) -> Column:
    """Percentage to two places, halves to even; 0 without a total."""
    return F.when(total > 0, F.bround(part / total * 100, 2)).otherwise(F.lit(0.0))


def number_stats(c: Column) -> list[Column]:
    """min, median, p95, max and mean; p95 is the sorted element at ``95 n div 100`` without interpolation.

    It is read from the counts of the distinct values, which for token counts are bounded by the size limit of
    chunks rather than by their number.
    """
    return [F.min(c).alias("min"), F.median(c).alias("median"), F.max(c).alias("max"), F.bround(F.avg(c), 2).alias("avg")]


def p95(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """The element at ``max(1, 95 n div 100)`` of the sorted values, by group, from a histogram."""
    by = by or []
    h = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by, F.lit(0)).orderBy(value)
    h = h.withColumn("upto", F.sum("n").over(w)).withColumn("all", F.sum("n").over(Window.partitionBy(*by, F.lit(0))))
    rank = F.greatest(F.lit(1), F.expr("95 * `all` div 100"))
    return h.where(F.col("upto") >= rank).groupBy(*by).agg(F.min(value).alias("p95"))


def size_report(chunks: DataFrame, by: list[str] | None = None, value: str = "token_count") -> DataFrame:
    """count, min, median, p95, max and avg of ``value``, by group; zeros for an empty table without groups."""
    by = by or []
    stats = chunks.groupBy(*by).agg(F.count(value).alias("count"), *number_stats(F.col(value)))
    tail = p95(chunks, value, by)
    if by:
        on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
        return stats.alias("a").join(tail.alias("b"), on, "left").select(*[f"a.{c}" for c in by], "count", "min", "median", "p95", "max", "avg")
    both = stats.withColumn("_j", F.lit(0)).join(tail.withColumn("_j", F.lit(0)), "_j", "left")
    zero = lambda c, t: F.coalesce(c, F.lit(0)).cast(t).alias(c)
    return both.select("count", zero("min", "int"), zero("median", "double"), zero("p95", "int"), zero("max", "int"), zero("avg", "double"))


def article_roots(text: Column) -> Column:
    """Distinct roots of the articles that open a line of the text."""
    hits = F.filter(nonblank_lines(text), lambda x: F.regexp_like(x, F.lit(meta.ARTICLE_START)))
    return F.array_distinct(F.transform(hits, lambda x: F.substring_index(F.regexp_extract(x, meta.ARTICLE_START, 1), ".", 1)))


def empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def counters(chunks: DataFrame, documents: DataFrame, config: EvalConfig = EvalConfig()) -> DataFrame:
    """One row of every counter over the chunks (with ``metadata``), joined to their documents for consistency."""
    docs = documents.groupBy("doc_id").agg(F.max(F.struct("year", "name")).alias("_doc"))
    c = chunks.join(docs, "doc_id", "left").withColumn("_roots", article_roots(F.col("text")))
    tokens, text, article = F.coalesce("token_count", F.lit(0)), F.coalesce("text", F.lit("")), F.col("metadata.article")
    like = lambda p: F.count_if(F.regexp_like(text, F.lit(p)))
    differs = lambda f: F.count_if(~empty(F.col(f"metadata.{f}")) & ~empty(F.col(f"_doc.{f}")) & (F.col(f"metadata.{f}") != F.col(f"_doc.{f}")))
    return c.agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_if(tokens < config.small_tokens).alias("small"),
        F.count_if(tokens < config.moderate_tokens).alias("moderate"),
        F.count_if(tokens > config.max_tokens).alias("oversized"),
        F.count_if(tokens.between(config.small_tokens, config.max_tokens)).alias("in_range"),
        like(HTML_LEFT).alias("html"),
        like(MATH_LEFT).alias("inline_math"),
        like(LATEX_LEFT).alias("latex"),
        like(BOOKMARK_LEFT).alias("bookmark"),
        F.count_if(F.coalesce(F.size("page_refs"), F.lit(0)) <= 0).alias("empty_refs"),
        F.count_if(F.col("page_start").isNull() | F.col("page_end").isNull()).alias("missing_range"),
        F.count_if(F.col("page_start") > F.col("page_end")).alias("invalid_range"),
        F.count_if(F.size("_roots") >= 2).alias("mixed_article"),
        F.count_if(~empty(article) & (F.size("_roots") > 0) & ~F.array_contains("_roots", article)).alias("article_mismatch"),
        *[F.count_if(empty(F.col(f"metadata.{f}"))).alias(f"missing_{f}") for f in CHUNK_FIELDS],
        differs("year").alias("year_differs"),
        differs("name").alias("name_differs"),
    )


def scores(counted: DataFrame) -> DataFrame:
    """size, cleanliness, metadata, provenance and overall score of a row of counters, with its status."""
    p = lambda c: pct(F.col(c), F.col("chunks"))
    floor = lambda c: F.greatest(F.lit(0.0), c)
    meta_loss = (
        (p("missing_year") + p("missing_name") + p("missing_brief_description") + p("missing_language_hint")) * 0.15
        + (p("missing_section") + p("missing_article")) * 0.2
        + p("article_mismatch") * 1.2
        + (p("year_differs") + p("name_differs")) * 2
    )
    parts = counted.select(
        "*",
        floor(100 - p("oversized") * 2 - p("small") * 0.6).alias("size_score"),
        floor(100 - p("html") * 3 - p("inline_math") * 2 - p("latex") * 2.5 - p("bookmark") * 5).alias("cleanliness_score"),
        floor(100 - meta_loss).alias("metadata_score"),
        floor(100 - (p("empty_refs") + p("missing_range")) * 3 - p("invalid_range") * 8).alias("provenance_score"),
    )
    overall = F.col("size_score") * 0.3 + F.col("cleanliness_score") * 0.2 + F.col("metadata_score") * 0.3 + F.col("provenance_score") * 0.2
    names = ("size_score", "cleanliness_score", "metadata_score", "provenance_score")
    return parts.withColumn("overall_score", F.bround(overall, 2)).select(
        *[F.bround(n, 2).alias(n) for n in names], "overall_score", status(F.col("overall_score")).alias("status")
    )


def status(score: Column) -> Column:
    out = F.lit("critical")
    for least, name in reversed(BANDS):
        out = F.when(score >= least, name).otherwise(out)
    return out


def coverage(sources: DataFrame, chunks: DataFrame) -> DataFrame:
    """(doc_id, source_chars, covered_chars, coverage): share of a source's distinct characters in its chunks.

    ``sources`` has (doc_id, text). White space doesn't count. Documents without a source are left out; one with an
    empty source covers 0. The distinct characters of each row are taken first, so little is shuffled.
    """
    def chars(df: DataFrame, name: str) -> DataFrame:
        own = F.array_distinct(F.split(F.regexp_replace("text", r"[\s\p{Z}]", ""), ""))
        return df.where("text is not null").select("doc_id", F.explode(F.filter(own, lambda x: x != "")).alias("ch")).distinct().withColumn(name, F.lit(1))

    src, got = chars(sources, "s"), chars(chunks, "c")
    per = src.join(got, ["doc_id", "ch"], "left").groupBy("doc_id").agg(F.count("s").alias("source_chars"), F.count("c").alias("covered_chars"))
    return sources.where("text is not null").select("doc_id").distinct().join(per, "doc_id", "left").select(
        "doc_id", F.coalesce("source_chars", F.lit(0)).alias("source_chars"), F.coalesce("covered_chars", F.lit(0)).alias("covered_chars"),
        F.coalesce(F.col("covered_chars") / F.col("source_chars"), F.lit(0.0)).alias("coverage"),
    )


def consecutive_overlap(chunks: DataFrame, length: int = 240) -> DataFrame:
    """(doc_id, chunk_index, overlap): characters a chunk shares with the end of the one before it in its document.

    A chunk_index that stands more than once is read once, by the smallest text. The end of the chunk before, whatever
    its index, is carried along by a scan.
    """
    c = chunks.where("chunk_index is not null").groupBy("doc_id", "chunk_index").agg(F.min("text").alias("text"))
    tail = F.struct(F.right("text", F.lit(length)).alias("end"))
    d = scan(c, "doc_id", "chunk_index", {"_was": ("last", tail)}, before=True, long=is_long(chunks, "chunk_index"))
    return d.where("_was is not null").select(
        "doc_id", "chunk_index", meta.overlap_chars(F.col("_was.end"), F.col("text"), length).alias("overlap")
    )


def gate(name: str, actual: Column, expected: Column, least: bool = False) -> Column:
    passed = actual >= expected if least else actual <= expected
    return F.struct(
        F.lit(name).alias("name"), actual.cast("double").alias("actual"), expected.cast("double").alias("expected"), passed.alias("passed")
    )


def quality_gates(counted: DataFrame, config: EvalConfig = EvalConfig()) -> DataFrame:
    """(name, actual, expected, passed): the five gates of the evaluation."""
    p = lambda c: pct(F.col(c), F.col("chunks"))
    noise = F.col("html") + F.col("inline_math") + F.col("latex") + F.col("bookmark")
    source = F.col("empty_refs") + F.col("missing_range") + F.col("invalid_range")
    gates = [
        gate("oversized_chunks", F.col("oversized"), F.lit(0)),
        gate("small_chunks_pct", p("small"), F.lit(config.max_small_pct)),
        gate("mixed_article_pct", p("mixed_article"), F.lit(config.max_mixed_pct)),
        gate("residual_noise", noise, F.lit(0)),
        gate("provenance_issues", source, F.lit(0)),
    ]
    return counted.select(F.explode(F.array(*gates)).alias("g")).select("g.*")


def coverage_pct(sources: DataFrame, chunks: DataFrame) -> DataFrame:
    """(coverage_pct): mean coverage of the sources that have any character; 0 without one."""
    covered = coverage(sources, chunks).where("source_chars > 0")
    return covered.agg(F.coalesce(F.bround(F.avg("coverage") * 100, 2), F.lit(0.0)).alias("coverage_pct"))


def deterministic_gates(chunks: DataFrame, counted: DataFrame, covered: float | DataFrame, config: GateConfig = GateConfig()) -> DataFrame:
    """(name, actual, expected, passed): the seven deterministic gates.

    ``covered`` is the coverage in per cent: a value, or the row of :func:`coverage_pct`.
    """
    required = [F.col(f"metadata.{f}") for f in ("year", "name", "brief_description", "section", "article", "language_hint")]
    missing = required[0].isNull() & F.lit(False)
    for c in required:
        missing = missing | empty(c)
    per = chunks.agg(
        F.count_if(F.coalesce("token_count", F.lit(0)) < config.tiny_tokens).alias("tiny"), F.count_if(missing).alias("incomplete"), F.median("token_count").alias("median")
    )
    tail = p95(consecutive_overlap(chunks, config.scan_chars), "overlap")
    row = counted.select("chunks", "mixed_article")
    if not isinstance(covered, DataFrame):
        covered = counted.select(F.lit(float(covered)).alias("coverage_pct"))
    for part in (per, duplicate_stats(chunks), tail, covered):
        row = row.withColumn("_j", F.lit(0)).join(part.withColumn("_j", F.lit(0)), "_j", "left").drop("_j")
    p = lambda c: pct(F.col(c), F.col("chunks"))
    gates = [
        gate("tiny_chunks_pct", p("tiny"), F.lit(config.max_tiny_pct)),
        gate("duplicate_chunks_pct", p("duplicate_instances"), F.lit(config.max_duplicate_pct)),
        gate("overlap_p95_chars", F.coalesce("p95", F.lit(0)), F.lit(config.max_overlap_p95)),
        gate("missing_metadata_pct", p("incomplete"), F.lit(config.max_missing_pct)),
        gate("mixed_article_pct", p("mixed_article"), F.lit(config.max_mixed_pct)),
        gate("median_tokens", F.coalesce("median", F.lit(0.0)), F.lit(config.min_median_tokens), least=True),
        gate("coverage_pct", F.coalesce("coverage_pct", F.lit(0.0)), F.lit(config.min_coverage), least=True),
    ]
    return row.select(F.explode(F.array(*gates)).alias("g")).select("g.*")


def assert_gates(gates: DataFrame) -> None:
    """Raise AssertionError that names the failed gates."""
    failed = [r.name for r in gates.where("not passed").collect()]
    if failed:
        raise AssertionError("failed gates: " + ", ".join(sorted(failed)))


#: Kinds of issues of which samples are reported.
ISSUES = ("oversized", "small", "mixed_article", "bookmark")


def issue_samples(chunks: DataFrame, key: str = "chunk_id", config: EvalConfig = EvalConfig()) -> DataFrame:
    """(issue, doc_id, chunk_index, key, preview): the first ``samples`` chunks of each kind of issue, a top-k report.

    First is by document, index and ``key``.
    """
    tokens, text = F.coalesce("token_count", F.lit(0)), F.coalesce("text", F.lit(""))
    tests = (
        tokens > config.max_tokens,
        tokens < config.small_tokens,
        F.size(article_roots(text)) >= 2,
        F.regexp_like(text, F.lit(BOOKMARK_LEFT)),
    )
    top = None
    for issue, test in zip(ISSUES, tests):
        rows = chunks.where(test).orderBy("doc_id", "chunk_index", key).limit(config.samples)
        part = rows.select(F.lit(issue).alias("issue"), "doc_id", "chunk_index", key, meta.preview(F.col("text")).alias("preview"))
        top = part if top is None else top.unionByName(part)
    return top
