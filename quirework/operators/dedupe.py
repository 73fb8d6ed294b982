"""Global duplicates of chunk texts and the statistics that follow from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions.clean import squeeze
from quirework.runtime import join_groups, materialize


def dedupe_key(text: Column) -> Column:
    """SHA-1 of a text with single spaces and folded case."""
    # squeeze stands between upper and lower, as the optimizer reduces lower(upper(x)) to lower(x)
    return F.sha1(F.lower(squeeze(F.upper(F.replace(F.coalesce(text, F.lit("")), F.lit("ẞ"), F.lit("ss"))))))


def keep_first(chunks: DataFrame, order: list[str], key: Column | None = None) -> DataFrame:
    """The first row of each key in the order of the columns ``order`` (which must name a row).

    The first row is found by a partially aggregated minimum, so a key that holds a third of all rows costs one
    row a task. Rows of the same key and order are kept alike.
    """
    k = dedupe_key(F.col("text")) if key is None else key
    keyed = chunks.withColumn("_key", F.unhex(k))
    first = materialize(
        keyed.groupBy("_key").agg(F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_n")), "first"
    )
    same = F.struct(*order).eqNullSafe(F.col("_first"))
    return join_groups(keyed, first, "_key", "_n", chunks.count()).where(same).drop("_key", "_first", "_n")


def document_stats(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """(doc_id, chunks, tokens, pages) of every document after its chunks; 0 where it has none left."""
    pages = (
        chunks.select("doc_id", F.explode("page_refs.page_idx").alias("page")).where("page is not null").distinct()
        .groupBy("doc_id").agg(F.count(F.lit(1)).alias("pages"))
    )
    sums = chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"), F.sum("token_count").alias("tokens"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("int").alias(c)
    return documents.select("doc_id").join(sums, "doc_id", "left").join(pages, "doc_id", "left").select("doc_id", zero("chunks"), zero("tokens"), zero("pages"))


def duplicate_stats(chunks: DataFrame) -> DataFrame:
    """(duplicate_instances, duplicate_texts): rows in, and number of, groups of exactly equal texts."""
    per = chunks.groupBy(F.sha2("text", 256).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return per.where("n > 1").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_instances"), F.count(F.lit(1)).alias("duplicate_texts")
    )
