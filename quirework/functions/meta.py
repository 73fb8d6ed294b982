"""Document metadata as Catalyst expressions: year, name, description, language, structure, page range."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.functions.clean import WS, nonblank_lines, strip

# Word lists of the language hint and of generic titles.
ITALIAN = ("articolo", "sezione", "borsa", "studenti", "domanda", "graduatoria", "requisiti")
ENGLISH = ("article", "section", "scholarship", "students", "application", "ranking", "requirements")
GENERIC = ("call", "bando", "notice", "avviso", "announcement", "regulation", "regolamento", "policy", "guidelines")

YEAR_SPAN = rf"(20\d{{2}}){WS}*[/_\-]{WS}*(\d{{2,4}})\b"
ACADEMIC_YEAR = rf"(?i)\bA\.?{WS}*Y\.?{WS}*{YEAR_SPAN}"
ANY_YEAR_SPAN = rf"\b{YEAR_SPAN}"
SINGLE_YEAR = r"\b(20\d{2})\b"

# What opens a section or an article. They are the openers that results have to agree on, no others.
SECTION_LINE = (
    rf"(?iu)^{WS}*(?:#{WS}*)?((?:SECTION|SEZIONE|PART|CHAPTER|CAPO|TITOLO){WS}+[IVXLC0-9]+.*|(?:\d+\.)+{WS}+.*"
    rf"|GENERAL SECTION.*|(?:SCHOLARSHIP|BORSA|ACCOMODATION|ACCOMMODATION)\b.*)$"
)
#: A ``strict`` section line has its number end there, so that "Part in ..." is none.
STRICT_SECTION_LINE = SECTION_LINE.replace("[IVXLC0-9]+.*", r"[IVXLC0-9]+\b.*")
ARTICLE_LINE = rf"(?iu)^{WS}*(?:#{WS}*)?(?:ARTICLE|ARTICOLO|ART\.?){WS}*[-.:]?{WS}*(\d+(?:\.\d+)*)\b(.*)$"
ARTICLE_WORD = r"(?iu)\b(?:ART\.?|ARTICLE|ARTICOLO)\b"
ARTICLE_START = rf"(?iu)^{WS}*(?:#{WS}*)?(?:article|articolo|art\.?){WS}*[-.:]?{WS}*(\d+(?:\.\d+)*)\b"
ARTICLE_IN_HEADING = rf"(?iu)\b(?:article|articolo|art\.?){WS}*[-.:]?{WS}*(\d+(?:\.\d+)*)\b"
SECTION_IN_HEADING = rf"(?iu)\b(?:section|sezione){WS}+[IVXLC0-9]+\b"
FRONT_MATTER = "front_matter"


def group(c: Column, pattern: str, n: int) -> Column:
    """A group of the first match; null where there is no match."""
    return F.when(F.regexp_like(c, F.lit(pattern)), F.regexp_extract(c, pattern, n))


def _span(c: Column, pattern: str) -> Column:
    start, end = (F.regexp_extract(c, pattern, n) for n in (1, 2))
    year = start.try_cast("int")
    short = F.floor(year / 100) * 100 + end.try_cast("int")
    rolled = F.when(short < year, short + 100).otherwise(short)
    last = F.when(F.length(end) == 2, rolled).otherwise(end.try_cast("int"))
    return F.when(F.regexp_like(c, F.lit(pattern)), F.concat_ws("-", start, last.cast("string")))


def extract_year(text: Column) -> Column:
    """Year or year range: an academic year first, then any range, then a single year.

    A two-digit end takes the start's century, the next one if it would lie before the start. An ISO date
    such as 2025-06-01 reads as a range.
    """
    return F.coalesce(_span(text, ACADEMIC_YEAR), _span(text, ANY_YEAR_SPAN), group(text, SINGLE_YEAR, 1))


def language_hint(text: Column) -> Column:
    """``it`` or ``en`` where at least three words of its list stand in the text; else null."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([a-z']+)"))
    count = lambda names: F.size(F.filter(words, lambda w: w.isin(*names)))
    it, en = count(ITALIAN), count(ENGLISH)
    return F.when((it >= 3) & (it > en), "it").when((en >= 3) & (en >= it), "en")


def title_score(title: Column) -> Column:
    """Length up to 120 plus 5 a word up to 16, less 20 a generic word; -1 without words."""
    words = F.regexp_extract_all(F.lower(title), F.lit(r"([A-Za-zÀ-ÿ0-9']+)"))
    score = (
        F.least(F.length(title), F.lit(120))
        + F.least(F.size(words), F.lit(16)) * 5
        - F.size(F.filter(words, lambda w: w.isin(*GENERIC))) * 20
    )
    return F.when(F.size(words) == 0, -1).otherwise(score)


def bare(text: Column) -> Column:
    """Stripped text without heading marks."""
    return strip(F.regexp_replace(strip(text), "^#+", ""))


def page_meta(refs: Column) -> Column:
    """Distinct page refs, 1-based, by page, position and id; negative pages are dropped."""
    kept = F.array_distinct(F.filter(F.coalesce(refs, F.array().cast(_REFS)), lambda r: r["page_idx"] >= 0))
    shifted = F.transform(
        kept,
        lambda r: F.struct(
            (r["page_idx"] + 1).cast("int").alias("page_idx"), r["block_id"].alias("block_id"), r["block_position"].alias("block_position")
        ),
    )
    return sort_refs(shifted)


_REFS = "array<struct<page_idx:int,block_id:string,block_position:string>>"


def sort_refs(refs: Column) -> Column:
    key = lambda r: F.struct(
        r["page_idx"], F.coalesce(r["block_position"], F.lit("")), F.coalesce(r["block_id"], F.lit(""))
    )
    return F.array_sort(refs, lambda a, b: F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0))


def page_start(refs: Column) -> Column:
    return F.array_min(F.transform(refs, lambda r: r["page_idx"]))


def page_end(refs: Column) -> Column:
    return F.array_max(F.transform(refs, lambda r: r["page_idx"]))


def meta_value(c: Column) -> Column:
    """A stripped value; null for a blank one, ``n/a`` and ``front_matter``."""
    v = strip(c)
    return F.when((v != "") & ~F.lower(v).isin("n/a", FRONT_MATTER), v)


def augmented_text(text: Column, name: Column, year: Column, section: Column, article: Column, subarticle: Column) -> Column:
    """The chunk under a line of its metadata; bare where that line would be over 0.7 of the words or characters."""
    label = lambda key, v: F.concat(F.lit(f"{key}="), v)
    sec = meta_value(section)
    line = F.concat(
        F.lit("meta: "),
        F.concat_ws(
            " | ",
            label("doc", strip(F.coalesce(name, F.lit("")))),
            label("year", meta_value(year)),
            label("section", F.when(F.length(sec) <= 96, sec)),
            label("article", meta_value(article)),
            label("subarticle", meta_value(subarticle)),
        ),
    )
    body = strip(text)
    words = lambda c: F.size(F.filter(F.split(c, f"{WS}+"), lambda w: w != ""))
    over = lambda a, b: a / (a + b) > 0.7
    return (
        F.when(words(body) == 0, line)
        .when(over(words(line), words(body)) | over(F.length(line), F.length(body)), body)
        .otherwise(F.concat(line, F.lit("\n\n"), body))
    )


# --- structure -------------------------------------------------------------------------------


def section_event(line: Column, strict: bool = False) -> Column:
    """The section a stripped one-line block opens; null if none."""
    return strip(group(line, STRICT_SECTION_LINE if strict else SECTION_LINE, 1))


def article_event(line: Column, heading: Column) -> Column:
    """struct(article, subarticle) that a stripped block opens; null if none.

    A block opens an article if it is a heading, or short or all capitals with one article word only.
    """
    number, rest = F.regexp_extract(line, ARTICLE_LINE, 1), F.regexp_extract(line, ARTICLE_LINE, 2)
    capitals = (F.upper(line) == line) & (F.lower(line) != line)
    titled = heading | (((F.length(line) <= 140) | capitals) & (F.regexp_count(line, F.lit(ARTICLE_WORD)) <= 1))
    inline = F.when(heading, group(rest, r"\((\d+(?:\.\d+)?)\)", 1))
    sub = F.coalesce(inline, F.when(F.contains(number, F.lit(".")), number))
    event = F.struct(F.substring_index(number, ".", 1).alias("article"), sub.alias("subarticle"))
    return F.when(F.regexp_like(line, F.lit(ARTICLE_LINE)) & titled, event)


def dotted_number(line: Column) -> Column:
    """The ``n.m`` a block starts with, unless it has the form of an article line; null if none."""
    return F.when(~F.regexp_like(line, F.lit(ARTICLE_LINE)), group(line, rf"^{WS}*(\d+\.\d+)\b", 1))


def resolve_structure(section: Column, article: Column, subarticle: Column, path: Column) -> Column:
    """struct(section, article, subarticle): what is missing taken from the heading path."""
    present = lambda c: c.isNotNull() & (c != "")
    heads = F.transform(F.coalesce(path, F.array().cast("array<string>")), strip)
    first = lambda keep: F.try_element_at(F.filter(heads, keep), F.lit(1))
    has = lambda pattern: lambda h: F.regexp_like(h, F.lit(pattern))
    numbered = first(has(ARTICLE_IN_HEADING))
    number = group(numbered, ARTICLE_IN_HEADING, 1)
    top = F.try_element_at(heads, F.lit(1))
    found = F.coalesce(
        first(has(SECTION_IN_HEADING)),
        first(lambda h: (h != "") & ~F.regexp_like(h, F.lit(ARTICLE_IN_HEADING))),
        F.when(top != "", top),
    )
    own = present(section) & present(article)
    return F.struct(
        F.when(present(section), section).otherwise(found).alias("section"),
        F.when(present(article), article).otherwise(F.substring_index(number, ".", 1)).alias("article"),
        F.when(own | present(article) | present(subarticle), subarticle)
        .otherwise(F.when(F.contains(number, F.lit(".")), number))
        .alias("subarticle"),
    )


def article_mentions(text: Column) -> Column:
    """Numbers of the articles that open one of the first ten non-empty lines."""
    hits = F.filter(F.slice(nonblank_lines(text), 1, 10), lambda x: F.regexp_like(x, F.lit(ARTICLE_START)))
    return F.transform(hits, lambda x: F.regexp_extract(x, ARTICLE_START, 1))


def chunk_article(text: Column, article: Column, subarticle: Column) -> Column:
    """struct(article, subarticle) of a chunk: the one article its lines name, where the fallback isn't among them."""
    said = article_mentions(text)
    roots = F.array_distinct(F.transform(said, lambda x: F.substring_index(x, ".", 1)))
    first = F.try_element_at(said, F.lit(1))
    root = F.substring_index(first, ".", 1)
    dotted = F.when(F.contains(first, F.lit(".")), first)
    one = F.size(roots) == 1
    return (
        F.when(one & article.isNull(), F.struct(root.alias("article"), dotted.alias("subarticle")))
        .when(one & ~F.array_contains(roots, article), F.struct(root.alias("article"), F.coalesce(dotted, subarticle).alias("subarticle")))
        .otherwise(F.struct(article.alias("article"), subarticle.alias("subarticle")))
    )


def section_article(section: Column) -> Column:
    """struct(article, subarticle) of the number a section label starts with; both null if it has none."""
    n = group(strip(section), r"^(\d+(?:\.\d+)*)\b", 1)
    return F.struct(F.substring_index(n, ".", 1).alias("article"), F.when(F.contains(n, F.lit(".")), n).alias("subarticle"))


def final_article(text: Column, section: Column, article: Column, subarticle: Column) -> Column:
    """:func:`chunk_article`, then the section's number, then ``front_matter``."""
    own, sec = chunk_article(text, article, subarticle), section_article(section)
    missing = own["article"].isNull() & sec["article"].isNotNull()
    return F.struct(
        F.coalesce(own["article"], sec["article"], F.lit(FRONT_MATTER)).alias("article"),
        F.when(missing, F.coalesce(own["subarticle"], sec["subarticle"])).otherwise(own["subarticle"]).alias("subarticle"),
    )


# --- shapes of text --------------------------------------------------------------------------

# What lines of tables of contents and stubs look like.
TOC_WORD = r"(?iu)\b(?:summary|sommario|indice|table of contents)\b"
TOC_ENTRY = rf"(?iu)^(?:#{WS}*)?(?:art\.?|article|articolo){WS}*\d+(?:\.\d+)?\b.*\b\d{{1,3}}{WS}*$"
TOC_NUMBERED = rf"(?iu)^{WS}*(?:\d+(?:\.\d+){{0,4}})(?:\.?{WS}+|[.:])\S.*{WS}+\d{{1,3}}{WS}*$"
PAGE_TAIL = rf"\b\d{{1,3}}{WS}*$"
ARTICLE_REF = rf"(?iu)art\.?{WS}*\d+"
STUB_START = rf"(?iu)^{WS}*(?:#{WS}*)?(?:art\.?|article|articolo|section|sezione)\b"


def _hits(lines: Column, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda x: F.regexp_like(x, F.lit(pattern))))


def is_toc(text: Column, path: Column) -> Column:
    """A table of contents: its word in the headings or the first 240 characters, or lines like entries."""
    t = strip(text)
    lines = nonblank_lines(t)
    entries, numbered, tails = (_hits(lines, p) for p in (TOC_ENTRY, TOC_NUMBERED, PAGE_TAIL))
    word = lambda c: F.regexp_like(c, F.lit(TOC_WORD))
    blob = F.array_join(F.coalesce(path, F.array().cast("array<string>")), " ")
    shaped = (F.size(lines) >= 3) & (
        (entries >= 3) | (numbered >= 3) | (((entries >= 2) | (numbered >= 2)) & (tails >= 3)) | (_hits(lines, ARTICLE_REF) >= 5)
    )
    return (t != "") & (word(blob) | word(F.substring(t, 1, 240)) | shaped)


def is_toc_continuation(text: Column, path: Column) -> Column:
    lines = nonblank_lines(text)
    most = F.greatest(*(_hits(lines, p) for p in (TOC_ENTRY, TOC_NUMBERED, PAGE_TAIL)))
    return (F.coalesce(F.size(path), F.lit(0)) <= 0) & (F.size(lines) >= 2) & (most >= 2)


def is_stub(text: Column, tokens: Column, threshold: int) -> Column:
    """A short text that is structure only: index lines, headings, an article line, capitals or title words."""
    lines = nonblank_lines(text)
    like = lambda p: lambda x: F.regexp_like(x, F.lit(p))
    index = F.forall(lines, lambda x: like(TOC_ENTRY)(x) | like(TOC_NUMBERED)(x)) & F.exists(lines, like(PAGE_TAIL))
    tails = F.forall(lines, like(PAGE_TAIL)) & F.exists(lines, lambda x: like(TOC_NUMBERED)(x) | like(STUB_START)(x))
    joined = F.array_join(lines, " ")
    words = F.regexp_extract_all(joined, F.lit(r"([A-Za-zÀ-ÿ']+)"))
    capitals = (F.upper(joined) == joined) & F.regexp_like(joined, F.lit(r"\p{L}"))
    lettered = F.filter(words, like(r"^\p{L}"))
    titled = F.size(words).between(2, 10) & F.forall(lettered, like(r"^\p{Lu}"))
    prose = (
        F.forall(lines, lambda x: F.startswith(x, F.lit("#")))
        | like(STUB_START)(joined)
        | ((tokens <= 12) & (capitals | titled))
    )
    piped = F.exists(lines, lambda x: F.contains(x, F.lit("|")))
    return (tokens <= threshold) & ((F.size(lines) == 0) | index | tails | (~piped & prose))


def is_table(text: Column) -> Column:
    return F.startswith(F.regexp_replace(text, f"^{WS}+", ""), F.lit("Table:"))


def normalize_table(text: Column) -> Column:
    """A table under a bare ``Table:`` line, lines before its first row joined into a caption row.

    Texts with two lines of pipes, or six pipes, count as tables. What stands behind ``Table:`` on the
    first line is kept as a row.
    """
    lines = nonblank_lines(text)
    piped = lambda x: F.contains(x, F.lit("|"))
    rows = F.filter(lines, piped)
    first = F.array_position(F.transform(lines, piped), F.lit(True)).cast("int")
    lead = F.slice(lines, 1, F.greatest(first - 1, F.lit(0)))
    caption = F.filter(F.array(F.array_join(lead, " | ")), lambda x: x != "")
    head = F.try_element_at(lines, F.lit(1))
    payload = F.filter(F.array(strip(F.regexp_replace(head, "^Table:", ""))), lambda x: x != "")
    under = lambda *parts: F.array_join(F.concat(F.array(F.lit("Table:")), *parts), "\n")
    rest = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    tail = F.slice(lines, F.greatest(first, F.lit(1)), F.size(lines))
    looks = (F.size(rows) >= 2) | (F.regexp_count(text, F.lit(r"\|")) >= 6)
    return (
        F.when(F.size(lines) == 0, F.lit(""))
        .when(F.startswith(head, F.lit("Table:")), under(payload, rest))
        .when(looks, under(caption, tail))
        .otherwise(strip(text))
    )


def preview(text: Column) -> Column:
    """A sample of at most 220 characters on one line."""
    return F.substring(F.regexp_replace(text, "\n", " "), 1, 220)


def overlap_chars(left: Column, right: Column, scan: int = 320) -> Column:
    """Length of the longest end of ``left`` that starts ``right``, within ``scan`` characters; 0 for nulls."""
    a, b = F.right(left, F.lit(scan)), F.substring(right, 1, scan)
    n = F.least(F.length(a), F.length(b))
    lengths = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.right(a, k) == F.left(b, k))
    return F.when(n > 0, F.coalesce(F.array_max(lengths), F.lit(0))).otherwise(F.lit(0))


