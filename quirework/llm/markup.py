"""Markup residue: HTML, Markdown, wiki and LaTeX to clean text that keeps its structure.

Method: tag-path ratios. A text is parsed into leaves, each under its root-to-leaf path of tags (the
constructs of the other three languages count as tags too). Over the whole collection the text
length and punctuation of each path are aggregated against its number of leaves (paths that differ in tags within
lines only are fused), smoothed with the parent path's, joined in one score and thresholded: leaves of paths above it are content, the
others (comments, maintenance templates, rules) are left out of the clean text.

The parser is one pass of one alternation over the text. Rows without any character that markup
needs never leave the JVM.
"""

from __future__ import annotations

import html
import itertools
import re
from collections.abc import Iterator
from functools import lru_cache
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.runtime import materialize

# Element names of HTML.
TAGS = (
    "a abbr address article aside b big blockquote body br button caption center cite code col colgroup dd del div dl dt"
    " em figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link"
    " main mark meta nav ol option p pre q ref s samp script section select small span strike strong style sub sup table"
    " tbody td textarea tfoot th thead title tr tt u ul var video audio canvas details dialog embed fieldset figcaption legend"
    " math noscript object picture span summary svg"
)
#: Elements whose names are words as well count with attributes only.
DRAWN = "path g rect circle line polygon use"
#: Elements that break the line around their text.
BLOCK_TAGS = frozenset("address article aside blockquote body br caption center dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody tfoot thead title tr ul".split())
#: Elements within a line: their paths are fused with that of the element around them.
INLINE_TAGS = frozenset("a abbr b big cite del em font i img ins kbd label mark q ref s samp small span strike strong sub sup tt u var md:link wiki:link".split())
VOID_TAGS = frozenset("br hr img input link meta col".split())
#: Elements that a next one of their kind closes.
SIBLINGS = frozenset("li p td th tr dt dd option".split())
#: Elements whose content is never text.
OPAQUE_TAGS = frozenset("script style".split())

# What LaTeX symbol commands stand for.
SYMBOLS = {
    "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "times": "×", "cdot": "·", "sum": "∑", "prod": "∏", "pm": "±",
    "approx": "≈", "infty": "∞", "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "lambda": "λ", "mu": "μ", "sigma": "σ",
    "ldots": "…", "dots": "…", "euro": "€", "rightarrow": "→", "to": "→", "leftarrow": "←",
}
HEADINGS = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 4, "subparagraph": 5}

_M = re.MULTILINE
PARTS = (
    # html
    ("comment", r"<!--.*?(?:-->|\Z)|<!doctype[^>]*>"),
    ("tag", r"</?(?:" + "|".join(sorted(TAGS.split(), key=len, reverse=True)) + r")(?:\s[^<>]*)?/?>|<(?:" + "|".join(DRAWN.split()) + r")\s[^<>]*=[^<>]*>|</(?:" + "|".join(DRAWN.split()) + r")>"),
    ("entity", r"&(?:#\d{1,7}|#x[0-9a-f]{1,6}|[a-z][a-z0-9]{1,30});"),
    # latex
    ("display", r"\\\[.*?\\\]|\\\(.*?\\\)"),
    ("dollar", r"\$(?=[^$\n]*[\\^_=])[^$\n]{1,200}\$"),
    ("env", r"\\(?:begin|end)\{[^{}\n]*\}(?:\[[^\]\n]*\])?"),
    ("command", r"\\[a-z]+\*?"),
    ("escape", r"\\[\[\]()%&$#_{}]"),
    # wiki
    ("template", r"\{\{[^{}]*\}\}|\{\{|\}\}"),
    ("wtable", r"^[ \t]*\{\|.*$|^[ \t]*\|\}|^[ \t]*\|-+[ \t]*$|\|\||!!|^[ \t]*!(?=[ \t])"),
    ("whead", r"^[ \t]*={2,6}[^=\n]+={2,6}[ \t]*$"),
    ("wquote", r"'{3,5}|''(?=[^'\n]+'')|(?<=[^'\s])''(?!')"),
    ("wfile", r"\[\[(?:[^\[\]|\n]*\|)*|\]\]"),
    ("wlink", r"\[https?://[^\s\]]+[ \t]"),
    # markdown
    ("fence", r"^[ \t]*```.*$|```"),
    ("setext", r"^[ \t]*(?:={3,}|-{3,})[ \t]*$"),
    ("mdef", r"^[ \t]{0,3}\[[^\[\]\n]+\]:[ \t]+<?(?:https?://|[/#.])\S*.*$"),
    ("mref", r"\[(?=[^\[\]\n]+\]\[[^\[\]\n]*\])|\]\[[^\[\]\n]*\]"),
    ("mhead", r"^[ \t]{0,3}#{1,6}[ \t]+(?!\d+[\])}])(?=\S)"),
    ("task", r"^[ \t]*[-*+][ \t]+(?:\*\*)?\[(?:\*\*)?[ x](?:\*\*)?\](?:\*\*)?(?=[ \t])"),
    ("quote", r"^[ \t]{0,3}>(?=[ \t*_])"),
    ("rule", r"^[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*$"),
    ("mrow", r"^[ \t]*\|[ \t]*(?=[^|\n]+\|)(?!.*\|\|)|(?<=[^|])\|[ \t]*$"),
    ("image", r"!\[[^\]\n]*\]\([^)\s]*\)"),
    ("mlopen", r"\[(?=[^\[\]\n]*\]\((?:https?://|mailto:|[/#.])[^)\s]*\))"),
    ("mlink", r"\]\((?:https?://|mailto:|[/#.])[^)\s]*\)"),
    ("strong", r"\*\*|(?<![_\w])__(?=[^\s_])|(?<=[^\s_])__(?![_\w])|(?<=\w)__(?=\s|$)"),
    ("strike", r"~~(?=[^\s~][^~\n]*~~)|(?<=[^\s~])~~"),
    ("em", r"(?<![\w*])\*(?=[^\s*](?:[^*\n]*[^\s*])?\*(?![\w*]))|(?<=[^\s*])\*(?![\w*])(?<=\w\*)"),
    ("code", r"`[^`\n]+`"),
)
LANGUAGE = dict.fromkeys(("comment", "tag", "entity"), "html") | dict.fromkeys(("display", "dollar", "env", "command", "escape"), "latex")
LANGUAGE |= dict.fromkeys(("template", "wtable", "whead", "wquote", "wfile", "wlink"), "wiki")
LANGUAGE |= dict.fromkeys(("fence", "setext", "mdef", "mref", "mhead", "task", "quote", "rule", "mrow", "image", "mlopen", "mlink", "strike", "strong", "em", "code"), "markdown")
#: Where a mark can start at all; tested first, as most characters fail it.
_START = r"(?:(?=[<&\\$`*{}\[\]=|!'_#>:~+-])|(?<![^\n])(?=[ \t]))"
MARK = re.compile(_START + "(?:" + "|".join(f"(?P<{k}>{p})" for k, p in PARTS) + ")", re.I | _M)

_DEFINITION = re.compile(r"(?m)^[ \t]{0,3}\[[^\[\]\n]+\]:[ \t]+<?(?:https?://|[/#.])")
_FENCE = re.compile(r"(?m)^[ \t]*```(?!\w)")

#: A row can hold markup only if this matches (a superset of every pattern above).
TRIGGER = r"[<&\\$`*{}\[=]|__|~~|''|!!|\|\||(?m:^[ \t]{0,3}[#>|])|\|[ \t]*(?m:$)"


def may_hold_markup(text: Column) -> Column:
    return F.regexp_like(text, F.lit(TRIGGER))


def parse(text: str | None) -> tuple[list[tuple[str, str, int]], set[str]]:
    """Leaves (path, text, block) of a text and the set of markup languages found in it.

    The path is that of all tags from the root to the leaf.

    ``block`` is 1 where the leaf starts a new line. A text without markup is one leaf of path ''.
    Unclosed or crossed marks close at the end of the text or with the element around them.
    """
    if not text:
        return [], set()
    out: list[tuple[str, str, int]] = []
    found: set[str] = set()
    stack: list[str] = []
    braces: set[int] = set()
    at, brk = 0, 1
    defined = bool(_DEFINITION.search(text)) if "]:" in text else False

    def leaf(s: str, path: str | None = None) -> None:
        nonlocal brk
        if s:
            out.append(("/".join(stack) if path is None else path, s, brk))
            brk = 0

    def close(name: str) -> None:
        if name in stack:
            del stack[len(stack) - 1 - stack[::-1].index(name) :]

    line_tags = ("li", *(f"h{i}" for i in range(1, 7)))
    in_lines = lambda: any(x in line_tags for x in stack) and not ({"md:code", "pre", "ul", "ol"} & set(stack) or any(x.startswith("env:") for x in stack))

    def flush(upto: int) -> None:
        """Text up to here; tags that live to the end of their line close with it."""
        s = text[at:upto]
        if braces:
            s = "".join(c for i, c in enumerate(s, at) if i not in braces)
        if "wiki:link" in stack and "]" in s:
            head, s = s.split("]", 1)
            leaf(head)
            close("wiki:link")
        if stack and "\n" in s and in_lines():
            head, rest = s.split("\n", 1)
            leaf(head)
            stack[:] = [x for x in stack if x not in line_tags]
            leaf("\n" + rest)
        elif "wiki:table" in stack:
            leaf(re.sub(r"(?m)^[ \t]*\|(?=[ \t])[ \t]*", "", s))
        else:
            leaf(s)

    for m in MARK.finditer(text):
        kind, s = m.lastgroup, m.group()
        if kind == "entity":
            name = s[1:]
            if s[1] != "#" and name not in html5:
                continue
            flush(m.start())
            leaf(html.unescape(s).replace("\xa0", " "))
            found.add("html")
            at = m.end()
            continue
        if kind == "mrow" and "markdown" not in found and not re.match(r"[ \t]*\|", text[text.rfind("\n", 0, m.start() + 1) + 1 :]):
            continue  # a pipe at a line's end belongs to a row only if the row starts with one
        if m.start() < at:
            continue
        if kind == "template" and m.start() in braces:
            continue  # groups of commands
        if kind == "mref" and not defined:
            continue  # two pairs of brackets in prose
        if kind == "setext" and ("-" in s and "markdown" not in found or not text[:m.start()].rpartition("\n")[0].rpartition("\n")[2].strip()):
            continue  # a line of dashes under prose, or under nothing
        flush(m.start())
        at = m.end()
        found.add(LANGUAGE[kind])
        if kind == "comment":
            leaf(s[4:-3].strip(), "/".join([*stack, "comment"]))
        elif kind == "tag":
            name = re.match(r"</?([a-zA-Z0-9]+)", s).group(1).lower()
            if name in BLOCK_TAGS:
                brk = 1
            if s[1] == "/":
                close(name)
            elif name not in VOID_TAGS and not s.endswith("/>"):
                if name in SIBLINGS and name in stack:
                    close(name)
                stack.append(name)
                if name in ("td", "th") and out and out[-1][0].split("/")[-1:] in (["td"], ["th"]) and not brk:
                    leaf(" | ")
        elif kind in ("display", "dollar"):
            leaf(formula(s.strip("$") if kind == "dollar" else s[2:-2]), "/".join([*stack, "formula"]))
        elif kind == "env":
            name = "env:" + re.search(r"\{([^{}]*)\}", s).group(1)
            brk = 1
            if s.startswith("\\begin"):
                stack.append(name)
            else:
                stack[:] = [x for x in stack if x != "li"]
                close(name)
        elif kind == "command":
            name = s.strip("\\*")
            if name == "item":
                brk = 1
                stack[:] = [x for x in stack if x != "li"] + ["li"]
            elif name in SYMBOLS:
                leaf(SYMBOLS[name])
            elif name in HEADINGS:
                brk = 1
                at = _braced(text, at, lambda inner: leaf("#" * HEADINGS[name] + " " + inner, "/".join([*stack, f"h{HEADINGS[name]}"])))
                brk = 1
            elif name in ("footnote", "label", "ref", "cite", "vspace", "hspace"):
                at = _braced(text, at, lambda inner: leaf(f" ({inner})" if name == "footnote" else "", "/".join([*stack, name])))
            else:
                if name == "href":
                    at = _braced(text, at, lambda inner: None)
                _mark_braces(text, at, braces)
        elif kind == "escape":
            leaf(s[1:] if s[1] in "%&$#_{}" else "")
        elif kind == "template":
            leaf(s.strip("{}"), "/".join([*stack, "template:" + re.split(r"[|\s]", s.strip("{}"), maxsplit=1)[0].lower()]))
        elif kind == "wtable":
            if "{|" in s:
                brk = 1
                stack.append("wiki:table")
            elif "|}" in s:
                brk = 1
                close("wiki:table")
            elif s in ("||", "!!"):
                leaf(" | ")
            else:
                brk = 1
        elif kind == "whead":
            brk = 1
            level = len(s.strip()) - len(s.strip().lstrip("="))
            leaf("#" * level + " " + s.strip().strip("=").strip(), "/".join([*stack, f"h{level}"]))
            brk = 1
        elif kind == "wlink":
            stack.append("wiki:link")
        elif kind == "fence":
            brk = 1
            if "md:code" in stack:
                close("md:code")
            else:
                end = _FENCE.search(text, at)
                if end:  # what stands inside is no markup
                    leaf(text[at : end.start()].strip("\n"), "/".join([*stack, "md:code"]))
                    at, brk = end.end(), 1
                else:
                    stack.append("md:code")
        elif kind == "code":
            leaf(s.strip("`"), "/".join([*stack, "code"]))
        elif kind == "mlopen":
            stack.append("md:link")
        elif kind == "mlink":
            close("md:link")
        elif kind == "mref":
            if s == "[":
                stack.append("md:link")
            else:
                close("md:link")
        elif kind == "mdef":
            leaf(s.strip(), "/".join([*stack, "md:definition"]))
            brk = 1
        elif kind == "setext":
            path, said, b = out.pop() if out else ("", "", 1)
            head, _, title = said.rstrip().rpartition("\n")
            if head:
                out.append((path, head + "\n", b))
            level = 1 if "=" in s else 2
            out.append(("/".join([*stack, f"h{level}"]), "#" * level + " " + title.strip(), 1))
            brk = 1
        elif kind == "quote":
            brk = 1
        elif kind == "mhead":
            brk = 1
            level = s.count("#")
            stack.append(f"h{level}")
            leaf("#" * level + " ")
        elif kind == "task":
            brk = 1
            stack.append("li")
        elif kind == "rule":
            brk = 1
    flush(len(text))
    return out, found


def _braced(text: str, at: int, take) -> int:
    """Give the balanced group that starts at ``at`` to ``take``; the offset behind it."""
    if at >= len(text) or text[at] != "{":
        return at
    depth = 0
    for i in range(at, len(text)):
        depth += (text[i] == "{") - (text[i] == "}")
        if not depth:
            take(text[at + 1 : i])
            return i + 1
    return at


def _mark_braces(text: str, at: int, braces: set[int]) -> None:
    """Add where the braces stand of the groups that follow a command, inner ones too; options in brackets are passed over."""
    while at < len(text) and text[at] in "{[":
        end = _braced(text, at, lambda inner: None) if text[at] == "{" else text.find("]", at) + 1
        if end <= at:
            return
        if text[at] == "{":
            braces.update(i for i in range(at, end) if text[i] in "{}")
        at = end


def formula(s: str) -> str:
    """A LaTeX formula as a line of plain text."""
    for _ in range(8):
        t = re.sub(r"\\[dt]?frac\{([^{}]*)\}\{([^{}]*)\}", r"(\1) / (\2)", s)
        t = re.sub(r"\\(?:text|textbf|emph|underline|mathrm|mathbf)\{([^{}]*)\}", r"\1", t)
        if t == s:
            break
        s = t
    s = re.sub(r"\\([a-zA-Z]+)", lambda m: SYMBOLS.get(m.group(1), ""), s)
    return re.sub(r"[ \t]+", " ", s.replace("\\", "")).strip()


def plain(text: str | None) -> str:
    """Text without its markup, in one line structure; for search rather than for reading."""
    if not text:
        return ""
    leaves, found = parse(text)
    if not found:
        return text
    return "".join(("\n" if brk else "") + s for path, s, brk in leaves if "comment" not in path and "template:" not in path)


def render(leaves: list[tuple[str, str, int]], content: frozenset[str] | None) -> str:
    """Clean text of the leaves whose path is content: one line a block, list items and headings marked.

    Spaces between leaves stay; those at the edges of lines and cells go.
    """
    out: list[str] = []
    for path, s, brk in leaves:
        if content is not None and path not in content:
            continue
        tags = path.split("/")
        literal = "md:code" in tags or "pre" in tags
        if brk:
            s = s if literal else s.lstrip()
            if out and not out[-1].endswith("\n"):
                out.append("\n")
        if not s:
            continue
        if s == " | ":
            out[-1:] = [x.rstrip(" \t") for x in out[-1:]]
        elif out and out[-1] == " | " and not literal:
            s = s.lstrip(" \t")
        if brk and tags[-1] == "li" and s:
            out.append("- ")
        if brk and re.fullmatch(r"h[1-6]", tags[-1]) and not s.startswith("#"):
            out.append("#" * int(tags[-1][1]) + " ")
        if not (literal or tags[-1] == "formula") and ("env:" in path or "\\" in s):
            s = re.sub(r"[{}]|\[(?=[^\]]*$)|(?<!\w)\](?!\w)", "", s)
        out.append(s)
    t = "".join(out)
    t = re.sub(r"[ \t]+\n", "\n", t)
    return re.sub(r"\n{3,}", "\n\n", t).strip()


@lru_cache(100_000)
def fused(path: str) -> str:
    """A path without its tags within lines: what stands in a sentence shares the sentence's score."""
    return "/".join(t for t in path.split("/") if t not in INLINE_TAGS)


PARSED = "tab string, row_id long, languages array<string>, paths array<struct<path:string,leaves:long,chars:long,punct:long>>, text string"
_PUNCT = re.compile(r"[.,;:!?]")


def parsed(rows: DataFrame) -> DataFrame:
    """Parse ``rows`` (tab, row_id, text) that may hold markup: languages found and path statistics per row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for tab, row_id, text in zip(b["tab"], b["row_id"], b["text"]):
                leaves, found = parse(text)
                if not found:
                    continue
                stats: dict[str, list[int]] = {}
                for path, s, _ in leaves:
                    st = stats.setdefault(fused(path), [0, 0, 0])
                    st[0] += 1
                    st[1] += len(s.strip())
                    st[2] += len(_PUNCT.findall(s))
                out.append((tab, row_id, sorted(found), [(k, *v) for k, v in stats.items()], text))
            yield pd.DataFrame(out, columns=["tab", "row_id", "languages", "paths", "text"])

    return rows.select("tab", "row_id", "text").where(may_hold_markup(F.col("text"))).mapInPandas(run, PARSED)


def found(rows: DataFrame) -> DataFrame:
    """(tab, row_id, markup): once for each language of markup a row holds.

    Null and empty texts hold none. Rows repeated under one id give repeated results.
    """
    return parsed(rows).select("tab", "row_id", F.explode("languages").alias("markup"))


def path_scores(parse_result: DataFrame) -> DataFrame:
    """(path, leaves, chars, punct, ratio, score): tag-path ratios over the whole collection.

    The ratio of a path is its text length per leaf, and its punctuation per leaf; both are averaged with
    those of the parent path (the smoothing), and their geometric mean is the score.
    """
    per = (
        parse_result.select(F.explode("paths").alias("p"))
        .groupBy("p.path")
        .agg(F.sum("p.leaves").alias("leaves"), F.sum("p.chars").alias("chars"), F.sum("p.punct").alias("punct"))
    )
    parent = F.regexp_replace("path", r"/?[^/]*$", "")
    up = per.select(F.col("path").alias("parent"), (F.col("chars") / F.col("leaves")).alias("c"), (F.col("punct") / F.col("leaves")).alias("q"))
    own_c, own_q = F.col("chars") / F.col("leaves"), F.col("punct") / F.col("leaves")
    return (
        per.withColumn("parent", parent)
        .join(up, "parent", "left")
        .withColumn("ratio", own_c * 0.75 + F.coalesce("c", own_c) * 0.25)
        .withColumn("density", own_q * 0.75 + F.coalesce("q", own_q) * 0.25)
        .withColumn("score", F.sqrt(F.col("ratio") * (F.col("density") + 0.25)))
        .drop("parent", "c", "q")
    )


#: The structure that has to stay, whatever its score: headings, list items, cells, formulas, code, and what is under no tag.
ALWAYS = re.compile(r"(^|/)(h[1-6]|td|th|li|formula|md:code|pre|code|wiki:table)$|^$")
#: What no reader sees.
NEVER = re.compile(r"(^|/)(comment|script|style|md:definition)$")
THRESHOLD = 1.0
#: At most this many paths are sent to the tasks; with more, each row gets its own by join.
MAX_PATHS = 50_000


def cleaned(rows: DataFrame) -> DataFrame:
    """(tab, row_id, text, languages): clean text of every row; rows without markup pass unchanged.

    Null texts become ''.
    """
    p = materialize(parsed(rows), "markup")
    scored = path_scores(p)
    dropped = scored.where((F.col("score") < THRESHOLD) | F.regexp_like("path", F.lit(NEVER.pattern))).where(
        ~F.regexp_like("path", F.lit(ALWAYS.pattern)) | F.regexp_like("path", F.lit(NEVER.pattern))
    )
    dropped = materialize(dropped.select("path"), "furniture")
    cols = ["tab", "row_id", "text", "languages"]
    out = [r.path for r in dropped.limit(MAX_PATHS + 1).collect()]
    if len(out) > MAX_PATHS:
        # Rows of one id may differ, so each is known by its own number.
        numbered = materialize(p.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        own = numbered.select("_row", F.explode("paths.path").alias("path")).join(dropped, "path")
        sets = own.groupBy("_row").agg(F.collect_list("path").alias("furniture"))
        marked = numbered.join(sets, "_row", "left").select(*cols, F.coalesce("furniture", F.array().cast("array<string>")).alias("furniture"))
        furniture = None
    else:
        marked = p.select(*cols)
        furniture = p.sparkSession.sparkContext.broadcast(frozenset(out))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = []
            for text, own in zip(b["text"], b["furniture"] if furniture is None else itertools.repeat(None)):
                left_out = furniture.value if own is None else set(own)
                leaves, _ = parse(text)
                keep = frozenset(x[0] for x in leaves if fused(x[0]) not in left_out)
                texts.append(render(leaves, keep))
            yield pd.DataFrame({"tab": b["tab"].tolist(), "row_id": b["row_id"], "text": texts, "languages": b["languages"].tolist()})

    schema = "tab string, row_id long, text string, languages array<string>"
    with_markup = marked.mapInPandas(run, schema)
    rest = rows.join(p.select("tab", "row_id"), ["tab", "row_id"], "left_anti").select(
        "tab", "row_id", F.coalesce("text", F.lit("")).alias("text"), F.array().cast("array<string>").alias("languages")
    )
    return with_markup.unionByName(rest)
