"""Records that differ only in formatting: one row per content, with the number of its copies.

Method: Merkle-style hashing, bottom up. A leaf's normal form keeps letters and digits, case folded. A node's digest
hashes those of its children: sorted where the order of the children says nothing (fields of a record, keys of a map),
in their order elsewhere (lists). Records are grouped by root digest together with the whole normal form, so equal
digests alone never join two records.

A text is such a record as well: of running text the letters are the one leaf; a sheet of ``label: value`` fields is an
unordered node of its fields. A text that is a sheet has both readings, and what is equal in either is the same content,
so contents are the connected components over both: letters that can be read as several sheets join these.

Everything is built from JVM expressions. Groups are partially aggregated before the shuffle, so a
group that holds a third of all rows costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from quirework.runtime import join_groups, materialize

#: Parts a field sheet's fields are parted by.
FIELD_BREAK = r"[|;\r\n]+"
#: ``label: value`` as a whole field (zero-width and list marks before it allowed).
FIELD = r"^(?=[^:]{1,40}:)[^:]*[\p{L}\p{N}][^:]*:.*[\p{L}\p{N}]"


def canonical(text: Column) -> Column:
    """Letters and digits of a text in order, case folded; '' for a null."""
    # The optimizer reduces lower(upper(x)) to lower(x), which would leave sharp s and ligatures unfolded.
    upper = F.regexp_replace(F.upper(F.replace(text, F.lit("ẞ"), F.lit("ss"))), r"[^\p{L}\p{N}]+", "")
    return F.coalesce(F.lower(upper), F.lit(""))


def sheet_form(text: Column) -> Column:
    """Sorted canonical fields of a benefit sheet, as one string; null for any other text.

    A sheet is a text of at least two fields and nothing else, each with a label of at most
    40 characters. Repeated fields are kept, so sheets match only with equal counts.
    """
    parts = F.filter(F.split(text, FIELD_BREAK), lambda p: F.regexp_like(p, F.lit(r"[\p{L}\p{N}]")))
    is_field = lambda p: F.regexp_like(p, F.lit(FIELD))
    leaf = lambda p: F.concat(
        canonical(F.substring_index(p, ":", 1)), F.lit("="), canonical(F.regexp_replace(p, r"^[^:]*:", ""))
    )
    good = text.contains(":") & (F.size(parts) >= 2) & F.forall(parts, is_field)
    return F.when(good, F.array_join(F.array_sort(F.transform(parts, leaf)), "&"))


def root_digest(leaves: Column) -> Column:
    """Digest of an unordered node: of the sorted digests of its leaves."""
    return F.sha2(F.array_join(F.array_sort(F.transform(F.split(leaves, "&"), lambda x: F.sha2(x, 256))), ","), 256)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that ``edges`` (a, b) lead to from each node on them.

    Large and small stars in turn until nothing changes: the number of rounds grows with the logarithm of the longest
    path, and a node's neighbours are only ever aggregated, never collected. Only such nodes come here as
    have more than one sheet.
    """
    e = materialize(edges.where("a <> b").distinct(), "edges")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        e = materialize(small.select("x.a", "x.b").where("a <> b").distinct(), "edges")
        seen = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == state:
            return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        state = seen


def content_groups(rows: DataFrame, id_col: str = "row_id", text_col: str = "text") -> DataFrame:
    """(digest, rep, copies, n): each literal content with its group's smallest id and size, and its own size.

    Literal contents and sheets are compared in full (they are the grouping keys). A text with the letters of a sheet
    belongs to it even where the marks between its fields are lost; where the same letters make several sheets, all of
    them are one content. Null texts count as empty ones, and all empty texts are one group.
    """
    t = F.col(text_col)
    forms = rows.select(F.col(id_col).alias("row_id"), canonical(t).alias("letters"), sheet_form(t).alias("sheet"))
    sheet = F.when(F.col("sheet").isNotNull(), F.struct(F.unhex(root_digest(F.col("sheet"))).alias("root"), "sheet"))
    read = forms.groupBy("letters", "sheet").agg(F.min("row_id").alias("first"), F.count(F.lit(1)).alias("n"))
    read = materialize(read.select(F.unhex(F.sha2("letters", 256)).alias("digest"), sheet.alias("sheet"), "first", "n"), "contents")
    literal = read.groupBy("digest").agg(
        F.min("first").alias("first"), F.sum("n").alias("n"), F.min("sheet").alias("sheet"), (F.min("sheet") < F.max("sheet")).alias("several")
    )
    linking = literal.where("several").select("digest", F.col("sheet").alias("b"))
    edges = linking.join(read.where("sheet is not null").select("digest", F.col("sheet").alias("a")), "digest").select("a", "b")
    if not edges.isEmpty():
        joined = components(edges).select(F.col("node").alias("sheet"), F.col("root").alias("_to"))
        literal = literal.join(joined, "sheet", "left").withColumn("sheet", F.coalesce("_to", "sheet")).drop("_to")
    literal = literal.withColumn("root", F.coalesce("sheet", F.struct(F.col("digest").alias("root"), F.lit("").alias("sheet"))))
    groups = literal.groupBy("root").agg(F.min("first").alias("rep"), F.sum("n").alias("copies"))
    return literal.join(groups, "root").select("digest", "rep", "copies", "n")


def copies(rows: DataFrame, id_col: str = "row_id", text_col: str = "text") -> DataFrame:
    """(row_id, rep, copies) of every row that has a copy: the smallest id of its group and its size.

    Rows with equal ids stay repeated rows. An empty table gives an empty result. Other columns,
    whatever their names, are ignored.
    """
    groups = materialize(content_groups(rows, id_col, text_col).where("copies > 1"), "groups")
    keyed = rows.select(
        F.col(id_col).alias("row_id"), F.unhex(F.sha2(canonical(F.col(text_col)), 256)).alias("digest")
    )
    return join_groups(keyed, groups, "digest", "n", rows.count()).select("row_id", "rep", "copies")


def collapsed(rows: DataFrame, id_col: str = "row_id", text_col: str = "text") -> DataFrame:
    """(row_id, copies): one row per content, the one with the smallest id, and how many rows hold it."""
    return content_groups(rows, id_col, text_col).select(F.col("rep").alias("row_id"), "copies").distinct()


# --- nested records --------------------------------------------------------------------------


def node(c: Column, t: DataType, join: Callable[[Column, str, str, bool], Column], leaf: Callable[[Column], Column]) -> Column:
    """A nested value folded bottom up: ``leaf`` of its leaves, ``join`` (children, open, close, sorted) of its nodes.

    Fields of records and entries of maps are unordered, elements of lists are ordered. Nulls are leaves like empty
    texts, null records and lists like empty ones.
    """
    inner = lambda x, kind: node(x, kind, join, leaf)
    if isinstance(t, StructType):
        fields = [F.concat(F.lit(f.name.casefold() + "="), inner(c[f.name], f.dataType)) for f in t.fields]
        return join(F.array(*fields) if fields else F.array().cast("array<string>"), "{", "}", True)
    if isinstance(t, ArrayType):
        return join(F.coalesce(F.transform(c, lambda x: inner(x, t.elementType)), F.array().cast("array<string>")), "[", "]", False)
    if isinstance(t, MapType):
        pair = lambda e: F.concat(inner(e["key"], t.keyType), F.lit("="), inner(e["value"], t.valueType))
        return join(F.coalesce(F.transform(F.map_entries(c), pair), F.array().cast("array<string>")), "{", "}", True)
    return leaf(canonical(c.cast("string")))


def record_form(c: Column, t: DataType) -> Column:
    """The whole normal form of a nested value; its marks can't stand in a leaf, so different values differ."""
    ordered = lambda kids, by_value: F.array_sort(kids) if by_value else kids
    return node(c, t, lambda kids, a, b, s: F.concat(F.lit(a), F.array_join(ordered(kids, s), ","), F.lit(b)), lambda x: x)


def record_digest(c: Column, t: DataType) -> Column:
    """Merkle digest of a nested value."""
    ordered = lambda kids, by_value: F.array_sort(kids) if by_value else kids
    digest = lambda x: F.sha2(x, 256)
    return node(c, t, lambda kids, a, b, s: digest(F.concat(F.lit(a), F.array_join(ordered(F.transform(kids, digest), s), ","))), digest)


def collapsed_records(rows: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(row_id, copies): one row per nested record of ``columns``, apart from formatting and the order of fields.

    Rows with equal digests are compared by their whole normal form. Nulls equal empty values.
    """
    record = F.struct(*[F.col(c) for c in columns])
    kind = rows.select(record.alias("r")).schema["r"].dataType
    keyed = rows.select(F.col(id_col).alias("row_id"), record_digest(record, kind).alias("digest"), record_form(record, kind).alias("form"))
    return keyed.groupBy("digest", "form").agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("copies")).select("row_id", "copies")
