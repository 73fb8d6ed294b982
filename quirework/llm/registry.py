"""Queries of the operators in this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions.tokens import token_sql
from quirework.llm import dedup, language, leak, markup, mixing, ocr, split, subjects
from quirework.llm.leak_sql import P7_FOUND
from quirework.runtime import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _chunks_and_blocks(spark: SparkSession, d: str, *more: str) -> DataFrame:
    parts = [
        read_table(spark, d, t).select(F.lit(t).alias("tab"), "row_id", "text", *more) for t in ("chunks", "blocks")
    ]
    return parts[0].unionByName(parts[1])


def _noise(spark: SparkSession, d: str) -> ocr.Noise:
    chunks = read_table(spark, d, "chunks").select(
        F.lit("chunks").alias("tab"), "row_id", "doc_id", F.col("chunk_index").alias("pos"), F.lit(False).alias("title"), "text"
    )
    blocks = read_table(spark, d, "blocks").select(
        F.lit("blocks").alias("tab"), "row_id", "doc_id", "pos", (F.col("block_type") == "title").alias("title"), "text"
    )
    return ocr.Noise(chunks.unionByName(blocks))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _noise(spark, d).found()


def p1_repaired(spark: SparkSession, d: str) -> DataFrame:
    return _noise(spark, d).repaired()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.found(_chunks_and_blocks(spark, d))


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.cleaned(_chunks_and_blocks(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return (
        dedup.copies(read_table(spark, d, "chunks").select("row_id", "text"))
        .where("row_id <> rep")
        .select(F.col("rep").alias("row_id"), F.col("row_id").alias("copy_row_id"))
    )


def p4_copies(spark: SparkSession, d: str) -> DataFrame:
    return dedup.collapsed(read_table(spark, d, "chunks").select("row_id", "text"))


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    return dedup.collapsed_records(read_table(spark, d, "chunks"), "row_id", ["text", "metadata"])


def _split_rows(spark: SparkSession, d: str) -> DataFrame:
    chunks = read_table(spark, d, "chunks").select(
        F.lit("chunks").alias("tab"), "row_id", "text", F.col("metadata.heading_path").alias("heading_path")
    )
    segments = read_table(spark, d, "segments").select(F.lit("segments").alias("tab"), "row_id", "text", "heading_path")
    return chunks.unionByName(segments)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return split.oversized(_split_rows(spark, d))


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.split_texts(_split_rows(spark, d))


def _hinted(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, str]]:
    documents = read_table(spark, d, "documents")
    docs = documents.select(
        F.lit("documents").alias("tab"), F.col("doc_id").alias("row_id"), "text", F.col("language_hint").alias("hint")
    )
    chunks = read_table(spark, d, "chunks").select(
        F.lit("chunks").alias("tab"), "row_id", "text", F.col("metadata.language_hint").alias("hint")
    )
    label = language.code_column("language_hint")
    agreed = F.when(label == language.code_column("lang"), label)
    texts = language.train(documents.select(F.col("doc_id").alias("id"), "text", agreed.alias("label")))
    return docs.unionByName(chunks), texts


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return language.mislabelled(*_hinted(spark, d))


def p6_languages(spark: SparkSession, d: str) -> DataFrame:
    return language.identified(*_hinted(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaked(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))


def p7_documents(spark: SparkSession, d: str) -> DataFrame:
    return leak.by_document(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.short_sources(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    documents = read_table(spark, d, "documents")
    return mixing.mix(documents, mixing.plan(documents, read_table(spark, d, "mix_targets")))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))


def _subject_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(read_table(spark, d, t) for t in ("documents", "subject_samples", "subject_areas"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.subjects_of(*_subject_tables(spark, d))


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    return subjects.composition(*_subject_tables(spark, d))


def queries() -> dict[str, Query]:
    return {
        "p1_found": p1_found,
        "p1_repaired": p1_repaired,
        "p2_found": p2_found,
        "p2_clean": p2_clean,
        "p4_found": p4_found,
        "p4_copies": p4_copies,
        "p4_records": p4_records,
        "p5_found": p5_found,
        "p5_pieces": p5_pieces,
        "p6_found": p6_found,
        "p6_languages": p6_languages,
        "p7_found": p7_found,
        "p7_documents": p7_documents,
        "p8_found": p8_found,
        "p8_mix": p8_mix,
        "p8_shares": p8_shares,
        "p9_found": p9_found,
        "p9_composition": p9_composition,
    }


_LETTERS = "regexp_replace(replace(lower(text), 'ß', 'ss'), '[^\\p{L}\\p{N}]+', '', 'g')"

# A closure, by nothing the operator uses: rows are linked by equal letters or equal fields; the smallest row reached.
P4_GROUPS = f"""
with recursive parts as (
  select row_id, {_LETTERS} as letters,
         list_filter(regexp_split_to_array(text, '[|;\\r\\n]+'), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]')) as p, text
  from chunks
), forms as (
  select row_id, coalesce(letters, '') as letters,
         case when len(p) >= 2 and len(list_filter(p, lambda x: not regexp_matches(x, '^[^:]{{0,39}}[\\p{{L}}\\p{{N}}][^:]*:.*[\\p{{L}}\\p{{N}}]'))) = 0
                   and len(list_filter(p, lambda x: strpos(x, ':') > 41)) = 0
         then array_to_string(list_sort(list_transform(p, lambda x:
              {_LETTERS.replace('text', "split_part(x, ':', 1)")} || '=' || {_LETTERS.replace('text', "regexp_replace(x, '^[^:]*:', '')")})), '&') end as sheet
  from parts
), links as (
  select row_id as a, min(row_id) over (partition by letters) as b from forms
  union select row_id, min(row_id) over (partition by sheet) from forms where sheet is not null
), both_ways as (select a, b from links union select b, a from links),
reached as (
  select row_id as a, row_id as b from forms
  union select r.a, l.b from reached r join both_ways l on r.b = l.a
), rooted as (select a as row_id, min(b) as root from reached group by a)"""

_L = lambda x: f"coalesce({_LETTERS.replace('text', x)}, '')"
P4_RECORDS = f"""
with r as (
  select row_id, [{_L('text')}, {', '.join(_L('metadata.' + f) for f in ('year', 'name', 'brief_description', 'section', 'article', 'subarticle', 'language_hint'))}] as plain,
         list_transform(coalesce(metadata.heading_path, []), lambda h: {_L('h')}) as path
  from chunks
) select min(row_id) as row_id, count(*) as copies from r group by plain, path"""

P8_BASE = f"""
with d as (select source, {token_sql('text')}::BIGINT as tokens from documents),
t as (select source, sum(tokens) as tokens from d group by source),
a as (select coalesce(sum(tokens), 0) as all_tokens from d)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": P4_GROUPS
        + " select root as row_id, row_id as copy_row_id from rooted where row_id <> root",
        "p4_copies": P4_GROUPS + " select root as row_id, count(*) as copies from rooted group by root",
        "p4_records": P4_RECORDS,
        "p5_found": f"""
select 'chunks' as tab, row_id from chunks where {token_sql('text')} > 480
union all select 'segments' as tab, row_id from segments where {token_sql('text')} > 480""",
        "p7_found": P7_FOUND,
        "p8_found": P8_BASE
        + """
select m.source from mix_targets m left join t using (source) cross join a
where m.max_repeats * coalesce(t.tokens, 0) < m.target_share * m.budget_ratio * a.all_tokens""",
    }
