"""Readers of extraction folders: discovery, choice of source, block lists, content lists, Markdown, JSON lines."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quirework import schemas
from quirework.functions.clean import IMAGE_LINE, WS, strip
from quirework.operators.ordered import BLOCK, is_long, scan
from quirework.runtime import materialize
from quirework.schemas import PAGE_REFS

BLOCK_TYPES = ("title", "text", "list", "table_body", "equation", "table_caption", "table_footnote")
CONTENT_TYPES = ("text", "list", "table", "equation")
HEADING = rf"^{WS}*(#{{1,6}}){WS}+(.*)$"
NO_SOURCE = "No block_list.json, *_content_list.json, or .md file found"


_FILES = "folder string, name string, path string, rel string, size long, modified timestamp, content binary, depth int"


def files(spark: SparkSession, root: str) -> DataFrame:
    """(folder, name, path, rel, size, modified, content, depth) of every file in the child folders of ``root``.

    ``rel`` is the path below the folder. A missing root has none. The content is read only where it is used.
    """
    try:
        raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    except AnalysisException:
        return spark.createDataFrame([], _FILES)
    base = F.lit(root.rstrip("/").removeprefix("file://"))
    plain = F.regexp_replace(F.col("path"), "^file:/*", "/")
    rest = F.substring(plain, F.length(base) + 2, 1_000_000)
    return raw.select(
        F.regexp_extract(rest, "^([^/]+)/", 1).alias("folder"), F.regexp_extract(rest, "([^/]+)$", 1).alias("name"), plain.alias("path"),
        F.regexp_replace(rest, "^[^/]+/", "").alias("rel"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
        "content", F.size(F.split(rest, "/")).alias("depth"),
    ).where("folder <> ''")


#: Up to so many files are opened by name; more are found by a join over the listing.
NAMED_FILES = 5_000


def contents(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(path, content) of the ``wanted`` files (path) among ``found`` ones; no other file is opened if they are few."""
    wanted = wanted.select("path").distinct()
    few = [r.path for r in wanted.limit(NAMED_FILES + 1).collect()]
    if len(few) > NAMED_FILES:
        return found.select("path", "content").join(wanted, "path", "left_semi")
    if not few:
        return found.sparkSession.createDataFrame([], "path string, content binary")
    raw = found.sparkSession.read.format("binaryFile").load([re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in few])
    return raw.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "content")


def doc_id(folder: Column) -> Column:
    """Id of a document: of its folder's path relative to the input root, so it is the same on every machine."""
    return F.left(F.sha1(folder), F.lit(16))


def choose_sources(found: DataFrame, priority: str = "block_first") -> DataFrame:
    """One row a folder: (folder, doc_id, mode, block_path, content_path, md_path, fallback_reason), by folder name.

    ``found`` has (folder, name, path). The first file by name is taken of each kind.
    """
    if priority != "block_first":
        raise ValueError(f"Unsupported source priority: {priority}")
    top = found.where("depth = 2") if "depth" in found.columns else found
    first = lambda test: F.min(F.when(test, F.col("path")))
    g = top.groupBy("folder").agg(
        first(F.col("name") == "block_list.json").alias("block_path"),
        first(F.endswith("name", F.lit("_content_list.json"))).alias("content_path"),
        first(F.endswith("name", F.lit(".md"))).alias("md_path"),
    )
    b, c, m = (F.col(x).isNotNull() for x in ("block_path", "content_path", "md_path"))
    return g.select(
        "folder", doc_id(F.col("folder")).alias("doc_id"),
        F.when(b, "block_list").when(c, "content_list").when(m, "md").otherwise("none").alias("mode"),
        "block_path", "content_path", "md_path",
        F.when(b, F.lit(None)).when(c, "block_list.json missing").when(m, "block_list.json and *_content_list.json missing").otherwise(NO_SOURCE).alias("fallback_reason"),
    ).orderBy(F.lower("folder"), "folder")


def _text(content: Column) -> Column:
    return F.decode(content, "UTF-8")


def _filled(c: Column) -> Column:
    return F.when(c != "", c)


def block_list(raw: DataFrame) -> DataFrame:
    """Blocks of ``raw`` (doc_id, content) block lists, merge connections applied.

    Discarded and unknown blocks are dropped. A connection joins the texts of its blocks (at least two) into the
    first of them: stripped, empty and equal neighbouring ones left out. Later connections replace earlier ones of
    the same first block; each reads the blocks as they were. Of two blocks at one position the last counts.
    """
    j = materialize(raw.select("doc_id", F.from_json(_text(F.col("content")), schemas.BLOCK_LIST).alias("j")), "block-lists")
    pages = j.select("doc_id", F.posexplode("j.pdfData").alias("page", "items"))
    before = {"_before": ("sum", F.greatest(F.size("items"), F.lit(0)))}
    items = (
        scan(pages, "doc_id", "page", before, before=True, long=is_long(pages, "page"))
        .select("doc_id", "_before", F.posexplode("items").alias("item", "b"))
        .where(~F.coalesce("b.is_discarded", F.lit(False)) & F.trim("b.type").isin(*BLOCK_TYPES))
    )
    table = F.coalesce(_filled(F.col("b.table_body")), _filled(F.col("b.text")), F.lit(""))
    other = F.coalesce(_filled(F.col("b.text")), _filled(F.col("b.content")), F.lit(""))
    kind = F.trim("b.type")
    ref = F.struct(F.col("b.page_idx").alias("page_idx"), F.col("b.id").alias("block_id"), F.col("b.block_position").alias("block_position"))
    base = items.select(
        "doc_id", (F.col("_before") + F.col("item")).cast("int").alias("pos"), F.when(kind == "table_body", table).otherwise(other).alias("text"),
        kind.alias("block_type"), F.when(F.col("b.page_idx").isNotNull(), F.array(ref)).otherwise(F.array()).cast(PAGE_REFS).alias("page_refs"),
        F.when(kind == "title", F.col("b.level")).alias("heading_level"), F.col("b.block_position").alias("source_hint"),
    )
    where = base.where("source_hint is not null").groupBy("doc_id", F.col("source_hint").alias("at")).agg(F.max("pos").alias("pos"))
    conn = (
        j.select("doc_id", F.posexplode("j.mergeConnections").alias("conn", "m"))
        .where("m.type = 'merge'")
        .select("doc_id", "conn", F.explode(F.array_distinct("m.blocks")).alias("at"))
        .join(where, ["doc_id", "at"])
        .select("doc_id", "conn", "pos")
        .distinct()
        .join(base, ["doc_id", "pos"])
    )
    parts = F.array_sort(F.collect_list(F.struct("pos", strip(F.col("text")).alias("text"), "page_refs")))
    g = conn.groupBy("doc_id", "conn").agg(F.min("pos").alias("first"), parts.alias("p")).where("size(p) >= 2")
    texts = F.filter(F.transform("p", lambda x: x["text"]), lambda x: x != "")
    once = F.filter(texts, lambda x, i: (i == 0) | (F.get(texts, i - 1) != x))
    g = g.select("doc_id", "conn", "first", "p", F.array_join(once, "\n").alias("joined"), F.flatten(F.transform("p", lambda x: x["page_refs"])).alias("refs"))
    gone = g.select("doc_id", "first", F.explode(F.transform("p", lambda x: x["pos"])).alias("pos")).where("pos <> first").select("doc_id", "pos").distinct()
    new = g.where("joined <> ''").groupBy("doc_id", F.col("first").alias("pos")).agg(F.max_by(F.struct("joined", "refs"), "conn").alias("new"))
    return (
        base.join(gone, ["doc_id", "pos"], "left_anti")
        .join(new, ["doc_id", "pos"], "left")
        .withColumn("text", F.coalesce("new.joined", "text"))
        .withColumn("page_refs", F.coalesce("new.refs", "page_refs"))
        .drop("new")
    )


def content_list(raw: DataFrame) -> DataFrame:
    """Blocks of ``raw`` (doc_id, content) content lists; tables with their captions and footnotes, levels as headings."""
    j = raw.select("doc_id", F.posexplode(F.from_json(_text(F.col("content")), schemas.CONTENT_LIST)).alias("pos", "b"))
    kind = F.trim("b.type")
    lines = lambda c: F.when(F.size(c) > 0, F.concat(F.lit("\n"), F.array_join(c, " "))).otherwise(F.lit(""))
    table = F.concat(F.coalesce("b.table_body", F.lit("")), lines(F.col("b.table_caption")), lines(F.col("b.table_footnote")))
    heading = (F.col("b.text_level") > 0) & (kind != "table")
    none = F.lit(None).cast("string")
    ref = F.struct(F.col("b.page_idx").alias("page_idx"), none.alias("block_id"), none.alias("block_position"))
    return j.where(kind.isin(*CONTENT_TYPES)).select(
        "doc_id", "pos", F.when(kind == "table", table).otherwise(F.coalesce("b.text", F.lit(""))).alias("text"),
        F.when(heading, "title").when(kind == "table", "table_body").otherwise(kind).alias("block_type"),
        F.when(F.col("b.page_idx").isNotNull(), F.array(ref)).otherwise(F.array()).cast(PAGE_REFS).alias("page_refs"),
        F.when(heading, F.col("b.text_level")).alias("heading_level"), none.alias("source_hint"),
    )


def markdown(texts: DataFrame) -> DataFrame:
    """Blocks of Markdown ``texts`` (doc_id, text): headings, and paragraphs ended by empty lines or headings.

    Image lines are dropped. Blocks have no page refs. Paragraph numbers are a running sum over the lines, taken in
    blocks, so a very long text is no single task.
    """
    long = (texts.agg(F.max(F.size(F.split("text", r"\n")))).first()[0] or 0) >= BLOCK
    lines = texts.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\r\n|\r|\n")).alias("line", "raw"))
    d = lines.withColumn("raw", F.regexp_replace("raw", rf"{WS}+$", "")).where(~F.regexp_like("raw", F.lit(IMAGE_LINE)))
    d = d.withColumn("h", F.regexp_like("raw", F.lit(HEADING))).withColumn("blank", strip(F.col("raw")) == "")
    d = scan(d, "doc_id", "line", {"par": ("sum", (F.col("h") | F.col("blank")).cast("int")), "heads": ("sum", F.col("h").cast("int"))}, long=long)
    d = d.where("not blank")
    none = F.lit(None).cast("string")
    refs = F.array().cast(PAGE_REFS)
    heads = d.where("h").select(
        "doc_id", F.col("line").alias("pos"), strip(F.regexp_extract("raw", HEADING, 2)).alias("text"), F.lit("title").alias("block_type"),
        refs.alias("page_refs"), F.length(F.regexp_extract("raw", HEADING, 1)).alias("heading_level"), none.alias("source_hint"),
    )
    parts = F.array_sort(F.collect_list(F.struct("line", "raw")))
    paras = d.where("not h").groupBy("doc_id", "par").agg(F.min("line").alias("pos"), parts.alias("p"))
    body = paras.select(
        "doc_id", "pos", strip(F.array_join(F.transform("p", lambda x: x["raw"]), "\n")).alias("text"), F.lit("text").alias("block_type"),
        refs.alias("page_refs"), F.lit(None).cast("int").alias("heading_level"), none.alias("source_hint"),
    )
    return heads.unionByName(body)


def load_blocks(found: DataFrame, choices: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blocks, modes, errors): blocks of every folder from its first source that has any, (doc_id, source_mode_used), and
    (doc_id, error) of the folders one of whose sources isn't the JSON it should be."""
    def content(path: str) -> DataFrame:
        named = choices.where(F.col(path).isNotNull()).select("doc_id", F.col(path).alias("path"))
        return named.join(contents(found, named), "path").select("doc_id", "path", "content")

    listed, items = content("block_path"), content("content_path")
    readers = (
        ("block_list", block_list(listed.select("doc_id", "content"))),
        ("content_list", content_list(items.select("doc_id", "content"))),
        ("md", markdown(content("md_path").select("doc_id", _text(F.col("content")).alias("text")))),
    )
    blocks = None
    for rank, (mode, part) in enumerate(readers):
        part = part.withColumn("rank", F.lit(rank)).withColumn("mode", F.lit(mode))
        blocks = part if blocks is None else blocks.unionByName(part)
    used = blocks.groupBy("doc_id").agg(F.min(F.struct("rank", "mode")).alias("used"))
    modes = choices.select("doc_id").join(used, "doc_id", "left").select("doc_id", F.coalesce("used.mode", F.lit("none")).alias("source_mode_used"))
    kept = blocks.join(used.select("doc_id", F.col("used.rank").alias("rank")), ["doc_id", "rank"], "left_semi").drop("rank", "mode")
    return kept, modes, json_errors(listed, "{").unionByName(json_errors(items, "[")).groupBy("doc_id").agg(F.min("error").alias("error"))


def json_errors(raw: DataFrame, opens: str) -> DataFrame:
    """(doc_id, error) of the files of ``raw`` (doc_id, path, content) that aren't JSON, or don't open as they should."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, path, content in zip(b["doc_id"], b["path"], b["content"]):
                try:
                    what = json.loads(bytes(content).decode("utf-8"))
                    error = None if isinstance(what, {"{": dict, "[": list}[opens]) else f"not a JSON {'object' if opens == '{' else 'array'}"
                except (ValueError, RecursionError) as e:
                    error = str(e)
                if error:
                    rows.append((doc_id, f"{path.rsplit('/', 1)[-1]}: {error}"))
            yield pd.DataFrame(rows, columns=["doc_id", "error"])

    return raw.select("doc_id", "path", "content").mapInPandas(run, "doc_id string, error string")


def checksums(found: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(folder, path, rel, size, modified, sum) of every file.

    Files that ``known`` (path, size, modified, sum) has in this size and time aren't read again.
    """
    listed = found.select("folder", "path", "rel", "size", "modified")
    if known is None:
        return found.select(*listed.columns, F.sha2("content", 256).alias("sum"))
    at = ["path", "size", "modified"]
    same = listed.join(known.select(*at, "sum"), at)
    new = materialize(listed.join(known.select(*at), at, "left_anti"), "new-files")
    read = new.join(contents(found, new), "path").select(*listed.columns, F.sha2("content", 256).alias("sum"))
    return same.select(*listed.columns, "sum").unionByName(read)


def folder_hashes(found: DataFrame) -> DataFrame:
    """(doc_id, folder, content_hash): over the paths below the folder and the checksums of all its files, in order.

    ``found`` has (folder, rel) and the files' ``content`` or, from :func:`checksums`, their ``sum``.
    """
    sums = found if "sum" in found.columns else found.withColumn("sum", F.sha2("content", 256))
    g = sums.groupBy("folder").agg(F.array_sort(F.collect_list(F.struct("rel", "sum"))).alias("f"))
    line = lambda x: F.concat(x["rel"], F.lit("\x00"), x["sum"])
    return g.select(doc_id(F.col("folder")).alias("doc_id"), "folder", F.sha1(F.array_join(F.transform("f", line), "\n")).alias("content_hash"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file; none if it is missing. Empty lines are skipped."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
