"""From blocks to segments: structure state, heading paths, boundaries, tables of contents, small segments."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework import schemas
from quirework.functions import meta
from quirework.functions.clean import clean_text, strip
from quirework.functions.tokens import py_token_count, token_count
from quirework.operators.ordered import numbered, scan
from quirework.runtime import materialize, spread

#: Up to this heading level the depth of paths is bounded by it; beyond, the depth that occurs is looked up.
FEW_LEVELS = 9
TOC_LABEL = "TABLE OF CONTENTS"


def distinct_blocks(blocks: DataFrame) -> DataFrame:
    """One row for each (doc_id, pos): of blocks read twice the one with the smaller row_id, or text."""
    tie = "row_id" if "row_id" in blocks.columns else "text"
    cols = ["text", "block_type", "page_refs", "heading_level", "source_hint"]
    return (
        blocks.where("doc_id is not null and pos is not null")
        .groupBy("doc_id", "pos")
        .agg(F.min_by(F.struct(*cols), F.struct(F.col(tie), F.col("text"))).alias("b"))
        .select("doc_id", "pos", *[F.col(f"b.{c}").alias(c) for c in cols])
    )


def clean_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks with cleaned text; those left empty are dropped.

    The empty ones go in a generator: a filter would be pushed below and clean every text twice.
    """
    kept = F.filter(F.array(clean_text("text")), lambda x: x != "")
    return spread(blocks).withColumn("text", F.explode(kept)).select(*blocks.columns)


def structure_state(blocks: DataFrame, strict: bool = False, long: bool = False) -> DataFrame:
    """Add section, article and subarticle in force at each block, and ``changed``: whether the block changes them.

    Two scans: the last section and article opened, then the last subarticle event, which an article may
    also set to null. A dotted number counts only under its own article.
    """
    line = strip(F.coalesce("text", F.lit("")))
    heading = F.col("heading_level").isNotNull()
    d = blocks.withColumn("_line", line).where("_line <> ''")
    d = d.withColumn("_sec", meta.section_event(F.col("_line"), strict)).withColumn("_art", meta.article_event(F.col("_line"), heading))
    d = scan(d, "doc_id", "pos", {"section": ("last", F.col("_sec")), "article": ("last", F.col("_art.article"))}, long=long)
    dotted = meta.dotted_number(F.col("_line"))
    own = F.startswith(dotted, F.concat(F.col("article"), F.lit(".")))
    event = F.when(F.col("_art").isNotNull(), F.struct(F.col("_art.subarticle").alias("v"))).when(own, F.struct(dotted.alias("v")))
    d = scan(d, "doc_id", "pos", {"_sub": ("last", event)}, long=long).withColumn("subarticle", F.col("_sub.v"))
    state = F.struct("section", "article", "subarticle")
    d = scan(d, "doc_id", "pos", {"_was": ("last", state)}, before=True, long=long)
    empty = F.struct(*[F.lit(None).cast("string").alias(c) for c in ("section", "article", "subarticle")])
    return d.withColumn("changed", ~state.eqNullSafe(F.coalesce("_was", empty))).drop("_sec", "_art", "_sub", "_was", "_line")


def heading_paths(blocks: DataFrame, long: bool = False) -> DataFrame:
    """Add ``heading_path``: the stack of headings at each block.

    A heading of level n keeps at most n - 1 of the stack and goes on top. Its depth is therefore the
    smaller of n and the last depth plus one, in closed form ``i + min(0, min over j <= i of level_j - j)`` for
    the i-th heading, and the path holds the last heading of every depth up to the present one.
    """
    level = F.greatest(F.col("heading_level"), F.lit(1))
    is_heading = F.col("heading_level").isNotNull()
    d = scan(blocks, "doc_id", "pos", {"_i": ("sum", is_heading.cast("int"))}, long=long)
    d = scan(d, "doc_id", "pos", {"_low": ("min", F.when(is_heading, level - F.col("_i")))}, long=long)
    d = d.withColumn("_depth", F.when(is_heading, F.col("_i") + F.least(F.lit(0), F.col("_low"))))
    deepest = max(1, blocks.agg(F.max("heading_level")).first()[0] or 1)
    if deepest > FEW_LEVELS:
        d = materialize(d, "depths")
        deepest = d.agg(F.coalesce(F.max("_depth"), F.lit(1))).first()[0]
    title = meta.bare(F.col("text"))
    outs = {"_now": ("last", F.col("_depth"))} | {f"_h{k}": ("last", F.when(F.col("_depth") == k, title)) for k in range(1, deepest + 1)}
    d = scan(d, "doc_id", "pos", outs, long=long)
    path = F.slice(F.array(*[F.col(f"_h{k}") for k in range(1, deepest + 1)]), F.lit(1), F.coalesce(F.col("_now"), F.lit(0)))
    return d.withColumn("heading_path", path).drop("_i", "_low", "_depth", *outs)


def build_segments(blocks: DataFrame, strict: bool = False, long: bool = False) -> DataFrame:
    """Segments of cleaned blocks: a new one at every heading and every change of structure.

    A segment has the structure and path of its first block, the texts parted by empty lines, and each page
    ref once in order. Empty documents have none.
    """
    d = heading_paths(structure_state(blocks, strict, long), long)
    starts = (F.col("heading_level").isNotNull() | F.col("changed")).cast("int")
    d = scan(d, "doc_id", "pos", {"_seg": ("sum", starts)}, long=long)
    first = F.min_by(F.struct("section", "article", "subarticle", "heading_path"), "pos")
    parts = F.array_sort(F.collect_list(F.struct("pos", strip(F.col("text")).alias("text"), "page_refs")))
    g = d.groupBy("doc_id", "_seg").agg(first.alias("s"), parts.alias("p"))
    out = g.select(
        "doc_id",
        "_seg",
        F.array_join(F.transform("p", lambda x: x["text"]), "\n\n").alias("text"),
        F.array_distinct(F.flatten(F.filter(F.transform("p", lambda x: x["page_refs"]), lambda r: r.isNotNull()))).alias("page_refs"),
        "s.section",
        "s.article",
        "s.subarticle",
        "s.heading_path",
    ).where("text <> ''")
    return numbered(out, "doc_id", "_seg", "seg_no", long).select(*_names(schemas.SEGMENT))


def _names(schema: str) -> list[str]:
    depth, names, word = 0, [], ""
    for ch in schema + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            names.append(word.split()[0])
            word = ""
        else:
            word += ch
    return names


def drop_toc(segments: DataFrame) -> DataFrame:
    return segments.where(~meta.is_toc(F.col("text"), F.col("heading_path")))


def merge_toc(segments: DataFrame, max_tokens: int, long: bool = False) -> DataFrame:
    """Tables of contents with their continuations as one segment each, labelled as such.

    A segment belongs to a run if it is one, or a continuation with no ordinary segment since the last one.
    A run over the budget is the label and its first 20 parts.
    """
    toc = meta.is_toc(F.col("text"), F.col("heading_path"))
    d = segments.withColumn("_toc", toc).withColumn("_cont", meta.is_toc_continuation(F.col("text"), F.col("heading_path")))
    d = scan(d, "doc_id", "seg_no", {
        "_last": ("last", F.when(F.col("_toc"), F.col("seg_no"))),
        "_other": ("last", F.when(~F.col("_toc") & ~F.col("_cont"), F.col("seg_no"))),
    }, long=long)
    inside = F.col("_toc") | (F.col("_cont") & (F.coalesce("_last", F.lit(-1)) > F.coalesce("_other", F.lit(-1))))
    d = d.withColumn("_in", inside)
    d = scan(d, "doc_id", "seg_no", {"_was": ("last", F.col("_in"))}, before=True, long=long)
    d = scan(d, "doc_id", "seg_no", {"_run": ("sum", (F.col("_in") & ~F.coalesce("_was", F.lit(False))).cast("int"))}, long=long)
    cols = ["doc_id", "seg_no", "text", "page_refs", "section", "article", "subarticle", "heading_path"]
    parts = F.array_sort(F.collect_list(F.struct("seg_no", strip(F.col("text")).alias("text"), "page_refs")))
    g = d.where("_in").groupBy("doc_id", "_run").agg(F.min("seg_no").alias("seg_no"), parts.alias("p"))
    texts = F.transform("p", lambda x: x["text"])
    whole = F.array_join(texts, "\n\n")
    short = F.concat(F.lit(f"{TOC_LABEL}\n\n"), strip(F.array_join(F.slice(texts, 1, 20), "\n")))
    none = F.lit(None).cast("string")
    merged = g.select(
        "doc_id", "seg_no", F.when(token_count(whole) > max_tokens, short).otherwise(whole).alias("text"),
        F.array_distinct(F.flatten(F.transform("p", lambda x: x["page_refs"]))).alias("page_refs"),
        F.lit(TOC_LABEL).alias("section"), none.alias("article"), none.alias("subarticle"), F.array(F.lit(TOC_LABEL)).alias("heading_path"),
    )
    return d.where("not _in").select(*cols).unionByName(merged)


# --- merging small segments ------------------------------------------------------------------


def islands(rows: DataFrame, pos: str, small: int, long: bool = False, tokens: str = "_tokens", article: str = "article", section: str = "section", passing: Column | None = None) -> DataFrame:
    """Add ``island``: runs of neighbours within which merges of small texts can happen at all.

    Merges need equal articles, or equal sections where there is no article; and never join two neighbours
    that are both large enough. Runs end at both, so a long document is many small groups. Rows that are
    ``passing`` may go during the fold and make others neighbours, so no run ends beside them.
    """
    key = F.concat_ws("\x00", F.coalesce(article, F.lit("")), F.when(F.coalesce(article, F.lit("")) == "", F.coalesce(section, F.lit(""))).otherwise(""))
    passing = F.lit(False) if passing is None else passing
    now = F.struct(key.alias("k"), (F.col(tokens) >= small).alias("big"), passing.alias("passing"))
    d = scan(rows, "doc_id", pos, {"_prev": ("last", now)}, before=True, long=long)
    apart = (F.col("_prev.k") != key) | (F.col("_prev.big") & (F.col(tokens) >= small))
    cut = F.col("_prev").isNull() | (apart & ~F.col("_prev.passing") & ~passing)
    return scan(d, "doc_id", pos, {"island": ("sum", cut.cast("int"))}, long=long).drop("_prev")


def may_merge(a: dict, b: dict) -> bool:
    """Whether two texts' structures allow a merge."""
    if (a["section"], a["article"], a["subarticle"]) == (b["section"], b["article"], b["subarticle"]):
        return True
    if a["article"] or b["article"]:
        return bool(a["article"]) and a["article"] == b["article"]
    return bool(a["section"]) and a["section"] == b["section"]


def join_texts(a: str, b: str) -> str:
    return f"{a.rstrip()}\n\n{b.lstrip()}"


def refs_once(*lists) -> list[dict]:
    seen: dict[tuple, dict] = {}
    for refs in lists:
        for r in refs if refs is not None else ():
            seen.setdefault((r["page_idx"], r["block_id"], r["block_position"]), r)
    return list(seen.values())


def absorb(a: dict, b: dict, limit: int) -> dict | None:
    """``b`` appended to ``a``, if their structures and the limit allow it."""
    if not may_merge(a, b):
        return None
    text = join_texts(a["text"], b["text"])
    tokens = py_token_count(text)
    if tokens > limit:
        return None
    path = a["heading_path"] if a["heading_path"] is not None and len(a["heading_path"]) else b["heading_path"]
    return a | {"text": text, "_tokens": tokens, "page_refs": refs_once(a["page_refs"], b["page_refs"]), "heading_path": path}


def merge_island(rows: Iterable[dict], smallest: int, limit: int) -> Iterator[dict]:
    """Small segments take in what follows while they are small, then go to what precedes. Two rows are held at a time."""
    waiting = iter(rows)
    ahead, last = next(waiting, None), None
    while ahead is not None:
        seg, ahead = ahead, next(waiting, None)
        while ahead is not None and seg["_tokens"] < smallest and (more := absorb(seg, ahead, limit)):
            seg, ahead = more, next(waiting, None)
        if last is not None and seg["_tokens"] < smallest and (back := absorb(last, seg, limit)):
            last = back
            continue
        if last is not None:
            yield last
        last = seg
    if last is not None:
        yield last


#: Rows of a fold's result that are passed on together.
TOGETHER = 2_000


def fold_islands(rows: DataFrame, pos: str, fold: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``fold`` of the rows of every (doc_id, island) in the order of ``pos``.

    Islands go through as streams over sorted partitions: a long one is never held as a whole, and a short one costs no
    call of its own.
    """
    names = _names(schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        records = (r for b in batches for r in b.to_dict("records"))
        out: list[dict] = []
        for _, island in groupby(records, key=lambda r: (r["doc_id"], r["island"])):
            for row in fold(island):
                out.append(row)
                if len(out) >= TOGETHER:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        yield pd.DataFrame(out, columns=names)

    return rows.repartition("doc_id", "island").sortWithinPartitions("doc_id", "island", pos).mapInPandas(run, schema)


def merge_small(segments: DataFrame, smallest: int, limit: int, long: bool = False) -> DataFrame:
    """Segments under ``smallest`` tokens merged with compatible neighbours up to ``limit`` tokens."""
    d = islands(segments.withColumn("_tokens", token_count("text")), "seg_no", smallest, long)
    return fold_islands(d, "seg_no", lambda rows: merge_island(rows, smallest, limit), schemas.SEGMENT)
