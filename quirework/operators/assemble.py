"""From segments to chunk rows: pieces, articles, merging of small chunks, numbering."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.config import PipelineConfig
from quirework.functions import meta, splitting
from quirework.functions.clean import strip
from quirework.functions.tokens import py_token_count, token_count
from quirework.operators.ordered import BLOCK, numbered
from quirework.operators.segments import fold_islands, islands, join_texts, may_merge
from quirework.runtime import materialize
from quirework.schemas import PAGE_REFS

#: Positions of a segment's pieces in the order of their document, as many as a piece number can have.
PIECES = 1 << 31

_CARRIED = "doc_id string, seg_no int, section string, article string, subarticle string, heading_path array<string>, page_refs " + PAGE_REFS


def pieces(segments: DataFrame, config: PipelineConfig) -> DataFrame:
    """Each segment cut into pieces (piece_no, text), tiny ones joined and overlaps trimmed; structure resolved."""
    r = meta.resolve_structure(F.col("section"), F.col("article"), F.col("subarticle"), F.col("heading_path"))
    d = segments.withColumn("_r", r).select(
        "doc_id", "seg_no", "text", "heading_path", "page_refs", F.col("_r.section").alias("section"),
        F.col("_r.article").alias("article"), F.col("_r.subarticle").alias("subarticle"),
    )
    c = config

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cut = []
            for text in b["text"]:
                p = splitting.segment_pieces(text or "", c.target_tokens, c.max_tokens, c.overlap_tokens, c.min_chars, c.max_overlap_chars)
                p = splitting.trim_edges(splitting.join_tiny(p, c.min_chunk_tokens, c.max_tokens), c.overlap_tokens)
                cut.append([x for x in map(str.strip, p) if x])
            yield pd.DataFrame({c: b[c].tolist() for c in cols} | {"pieces": cut})

    cols = [x.split()[0] for x in _CARRIED.split(", ")[:6]] + ["page_refs"]
    cut = d.select("text", *cols).mapInPandas(run, _CARRIED + ", pieces array<string>")
    return cut.select(*cols, F.posexplode("pieces").alias("piece_no", "text"))


def chunk_rows(segments: DataFrame, config: PipelineConfig, long: bool = False) -> DataFrame:
    """Chunk rows of each document without its metadata: text, page refs, section, article, subarticle, order.

    Pieces get their article; an exact repeat of a larger piece within its document is dropped; stubs are dropped
    and small chunks merged into compatible neighbours (those under ``min_chunk_tokens`` backwards, then those
    under ``min_viable_chunk_tokens`` backwards or forwards). Only groups of neighbours in which a merge can happen
    are folded, each on its own.
    """
    p = pieces(segments, config)
    p = p.withColumn("_pos", F.col("seg_no").cast("long") * PIECES + F.col("piece_no"))
    fin = meta.final_article(F.col("text"), F.col("section"), F.col("article"), F.col("subarticle"))
    p = p.withColumn("_a", fin).withColumn("_tokens", token_count("text"))
    p = p.withColumn("article", F.col("_a.article")).withColumn("subarticle", F.col("_a.subarticle")).drop("_a")
    p = p.withColumn("page_refs", meta.page_meta(F.col("page_refs")))
    if config.dedupe_chunks:
        large = F.col("_tokens") >= config.min_chunk_tokens
        p = p.withColumn("_k", F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text"), "text", large).orderBy("_pos")))
        p = p.where(~large | (F.col("_k") == 1)).drop("_k")
    p = materialize(p, "pieces")
    p = p.withColumn("stub", meta.is_stub(F.col("text"), F.col("_tokens"), config.min_viable_chunk_tokens))
    # ``emit`` drops these on sight; larger stubs may take in a neighbour first, or be dropped by ``sweep``.
    p = p.where(~(F.col("stub") & (F.col("_tokens") < config.min_chunk_tokens)))
    p = numbered(p, "doc_id", "_pos", "_ord", long, BLOCK * PIECES)
    p = islands(p, "_ord", config.min_viable_chunk_tokens, long, passing=F.col("stub") & (F.col("_tokens") < config.min_viable_chunk_tokens))
    cols = ["doc_id", "_ord", "text", "_tokens", "stub", "section", "article", "subarticle", "heading_path", "page_refs"]
    smallest, viable, limit = config.min_chunk_tokens, config.min_viable_chunk_tokens, config.max_tokens
    schema = (
        "doc_id string, _ord int, text string, section string, article string, subarticle string,"
        f" heading_path array<string>, page_refs {PAGE_REFS}"
    )
    return fold_islands(p.select("island", *cols), "_ord", lambda rows: swept(emitted(rows, smallest, limit), viable, limit), schema)


def _merged(a: dict, b: dict, keep: dict, limit: int) -> dict | None:
    """The row ``keep`` (one of both) with the texts of ``a`` and ``b``, if they may be merged."""
    if not may_merge(a, b):
        return None
    text = join_texts(a["text"], b["text"])
    tokens = py_token_count(text)
    if tokens > limit:
        return None
    refs = {(r["page_idx"], r["block_id"], r["block_position"]): r for r in [*a["page_refs"], *b["page_refs"]] if r["page_idx"] is not None}
    order = sorted(refs, key=lambda k: (k[0], k[2] or "", k[1] or ""))
    return keep | {"text": text, "_tokens": tokens, "page_refs": [refs[k] for k in order], "stub": False}


def emitted(rows: Iterable[dict], smallest: int, limit: int) -> Iterator[dict]:
    """Pieces under ``smallest`` tokens dropped if stubs, else put to the row before if compatible."""
    last = None
    for row in rows:
        if row["_tokens"] < smallest:
            if row["stub"]:
                continue
            if last is not None and (more := _merged(last, row, last, limit)):
                last = more
                continue
        if last is not None:
            yield last
        last = row
    if last is not None:
        yield last


def swept(rows: Iterable[dict], viable: int, limit: int) -> Iterator[dict]:
    """Rows under ``viable`` tokens dropped if stubs, else merged backwards or forwards with rows of their kind."""
    waiting = iter(rows)
    ahead, last = next(waiting, None), None

    def alike(a: dict, b: dict) -> bool:
        return splitting.is_table(a["text"]) == splitting.is_table(b["text"])

    while ahead is not None:
        row, ahead = ahead, next(waiting, None)
        if row["_tokens"] < viable:
            if row["stub"]:
                continue
            if last is not None and alike(last, row) and (back := _merged(last, row, last, limit)):
                last = back
                continue
            if ahead is not None and alike(row, ahead) and (both := _merged(row, ahead, ahead, limit)):
                ahead = both
                continue
        if last is not None:
            yield last
        last = row
    if last is not None:
        yield last


def emit(rows: Iterable[dict], smallest: int, limit: int) -> list[dict]:
    return list(emitted(rows, smallest, limit))


def sweep(rows: Iterable[dict], viable: int, limit: int) -> list[dict]:
    return list(swept(rows, viable, limit))


def document_meta(blocks: DataFrame, fallback: DataFrame, long: bool = False) -> DataFrame:
    """(doc_id, name, year, brief_description, language_hint, blocks) from cleaned blocks.

    ``fallback`` has (doc_id, title). The name is the best title of the first two pages (score at least 20, first
    line), else the first block of 8 characters, else the fallback. The description joins the first three long
    blocks of prose. Year and language come from the first 30 blocks.
    """
    b = materialize(numbered(blocks, "doc_id", "pos", "_n", long), "numbered")
    title = meta.bare(F.col("text"))
    candidate = (
        (F.col("block_type") == "title")
        & (F.element_at("page_refs", 1)["page_idx"] <= 1)
        & (F.length(title) >= 4)
        & ~F.contains(F.lower(title), F.lit("art."))
    )
    b = b.withColumn("_t", title).withColumn("_score", F.when(F.size("page_refs") > 0, F.when(candidate, meta.title_score(title))))
    long = (F.col("block_type") != "title") & (F.length(strip(F.col("text"))) >= 60) & ~F.startswith(F.lower(F.col("text")), F.lit("table:"))
    b = b.withColumn("_long", F.coalesce(long, F.lit(False)))
    w = Window.partitionBy("doc_id", "_long").orderBy("_n")
    best = b.where("_score is not null").groupBy("doc_id").agg(F.max_by(F.struct("_t", "_score"), F.struct(F.col("_score"), -F.col("_n"))).alias("best"))
    eight = b.where("length(_t) >= 8").groupBy("doc_id").agg(F.min_by("_t", "_n").alias("first"))
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("_n", c))), lambda x: x["text"])
    said = b.where("_long").withColumn("_r", F.row_number().over(w)).where("_r <= 3").groupBy("doc_id").agg(ordered("text").alias("said"))
    look = b.where("_n < 30").groupBy("doc_id").agg(F.array_join(ordered("text"), "\n").alias("look"))
    sizes = b.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("blocks"))
    d = sizes.join(fallback, "doc_id", "left").join(look, "doc_id", "left")
    for part in (best, eight, said):
        d = d.join(part, "doc_id", "left")
    name = F.coalesce(F.when(F.col("best._score") >= 20, strip(F.substring_index("best._t", "\n", 1))), F.col("first"), F.col("title"))
    joined = F.regexp_replace(F.array_join(F.transform("said", strip), " "), r"[\s\p{Z}]+", " ")
    short = F.concat(F.regexp_replace(F.left(joined, F.lit(317)), r"\s+$", ""), F.lit("..."))
    return d.select(
        "doc_id", name.alias("name"), meta.extract_year(F.col("look")).alias("year"),
        F.coalesce(F.when(F.length(joined) > 320, short).otherwise(joined), name).alias("brief_description"),
        meta.language_hint(F.col("look")).alias("language_hint"), "blocks",
    )


def finish(rows: DataFrame, documents: DataFrame, long: bool = False) -> DataFrame:
    """Chunk rows with ids, counts, augmented text and metadata; ``documents`` has the metadata and source of each."""
    d = numbered(rows, "doc_id", "_ord", "chunk_index", long).join(documents, "doc_id")
    augmented = meta.augmented_text(*(F.col(c) for c in ("text", "name", "year", "section", "article", "subarticle")))
    head = F.concat_ws(":", "doc_id", F.col("chunk_index").cast("string"), F.left("text", F.lit(80)))
    return d.select(
        F.left(F.sha1(head), F.lit(20)).alias("chunk_id"), "doc_id", "chunk_index", "text", augmented.alias("augmented_text"),
        token_count("text").alias("token_count"), F.length("text").alias("char_count"), F.col("source_folder").alias("source_path"),
        "source_file", meta.page_start(F.col("page_refs")).alias("page_start"), meta.page_end(F.col("page_refs")).alias("page_end"),
        "page_refs",
        F.struct("year", "name", "brief_description", "section", "article", "subarticle", "heading_path", "language_hint").alias("metadata"),
    )
