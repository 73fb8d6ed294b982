"""p2."""

import random
import re

import pytest

from quirework.llm import markup

SCHEMA = "tab string, row_id long, text string"
HOLDS = [
    ("<p>one</p>", {"html"}), ("one <br/> two", {"html"}), ("a&nbsp;b", {"html"}), ("x <!-- note -->", {"html"}),
    ("## Title\nbody", {"markdown"}), ("a **b** c", {"markdown"}), ("a __b c__ d", {"markdown"}), ("[a](https://x.example/y)", {"markdown"}),
    ("- [ ] task", {"markdown"}), ("> quoted", {"markdown"}), ("| a | b |\n|---|--:|\n| 1 | 2 |", {"markdown"}), ("```\ncode\n```", {"markdown"}),
    ("== Title ==\nbody", {"wiki"}), ("'''a''' b", {"wiki"}), ("[[a|b]] c", {"wiki"}), ("{{cn}}", {"wiki"}), ('{| class="x"\n! a !! b\n|}', {"wiki"}),
    ("[https://x.example/y text]", {"wiki"}), (r"\section{A}", {"latex"}), (r"$\frac{1}{2}$", {"latex"}), (r"\[ x \leq 3 \]", {"latex"}), (r"12\%", {"latex"}),
]
PLAIN = [
    None, "", "R&D (n < 30 & m > 12)", "US$ 300 (C#)", "(# 7)", "see (3\n* 4 = 12).", "a) first\nb) second", "1. first", "Table:\na | b\nc | d",
    "Benefit: x | Amount: 3 | Code: 1-2", "MOD_B_07", "# 7) next", "[18]\nThe placement", "disabi|ità e a|tro\n— 35 —", "- 20 -", "x" * 100_000,
]


@pytest.mark.parametrize("text,langs", HOLDS)
def test_holds(text, langs):
    assert markup.parse(text)[1] == langs


@pytest.mark.parametrize("text", PLAIN)
def test_plain(text):
    assert markup.parse(text)[1] == set()


def test_structure_stays():
    text = "<h2>Head</h2><ul><li>one<li>two</ul><table><tr><td>a</td><td>b</td></tr></table>" + r"\[ \frac{a}{b} \leq 1 \]"
    out = markup.render(markup.parse(text)[0], None)
    assert "## Head" in out and "- one" in out and "- two" in out and "a | b" in out and "(a) / (b) ≤ 1" in out
    assert "<" not in out and "\\" not in out
    assert "x = 1" in markup.render(markup.parse("```\nx = 1\n```")[0], None)


def test_operators(spark):
    rows = [("t", i, t) for i, (t, _) in enumerate(HOLDS)] + [("t", 100 + i, t) for i, t in enumerate(PLAIN)]
    df = spark.createDataFrame([(*r, "z") for r in rows], SCHEMA + ", languages string")
    got = sorted((r.row_id, r.markup) for r in markup.found(df).collect())
    assert got == sorted((i, m) for i, (_, s) in enumerate(HOLDS) for m in s)
    clean = {r.row_id: r.text for r in markup.cleaned(df).collect()}
    assert len(clean) == len(rows) and clean[100] == "" and clean[102] == PLAIN[2] and "note" not in clean[3]
    assert markup.found(spark.createDataFrame([], SCHEMA)).count() == 0
    assert markup.cleaned(spark.createDataFrame([], SCHEMA)).count() == 0
    assert markup.found(df.where("row_id = 0").union(df.where("row_id = 0"))).count() == 2


def test_more_furniture_paths_than_are_sent(spark, monkeypatch):
    rows = [("t", i, t) for i, (t, _) in enumerate(HOLDS)] + [("t", 50 + i, f"Text {i}. {{{{t{i}}}}} <div><style>a{i}</style></div><p>More, of it.</p>") for i in range(8)]
    df = spark.createDataFrame([*rows, rows[-1], ("t", 57, "<script>x</script>other text of one id")], SCHEMA)
    got = sorted((r.row_id, r.text, tuple(r.languages)) for r in markup.cleaned(df).collect())
    monkeypatch.setattr(markup, "MAX_PATHS", 1)
    assert sorted((r.row_id, r.text, tuple(r.languages)) for r in markup.cleaned(df).collect()) == got
    assert len(got) == len(rows) + 2 and not any("style" in t or "a3" in t for _, t, _ in got)


def test_code_ends_at_the_next_fence_whatever_follows_it():
    leaves, found = markup.parse("```\nx = 1\n```](https://x.example/y)\n" + "'" * 3 + "a" + "'" * 3 + " \\section{B}\n```\ny\n```")
    assert found == {"markdown", "wiki", "latex"} and "x = 1" in markup.render(leaves, None)


CLEAN = [
    ("x <b>one</b> <i>two</i> y", "x one two y"), ("a **b** **c** d", "a b c d"), ("see [a](https://x.example/z) now", "see a now"),
    ("`d` x *c* y", "d x c y"), (r"\url{x} \textit{y {z}} w", "x y z w"), ("~~x~~ y", "x y"), ("Title\n=====\nbody", "# Title\nbody"),
    ("<svg><path d='x'/></svg> text", "text"), ("[[File:x.png|thumb|cap]] t [[a|b]] c", "cap t b c"), (r"\href{u}{t} and \emph{v}", "t and v"),
    ("| a | b |\n|---|---|\n| 1 | 2 |", "a | b\n1 | 2"), ("```py\n# x\na = b*c*d\n```\nafter", "# x\na = b*c*d\nafter"), ("> quoted\n> more", "quoted\nmore"),
    ("{| class=x\n! A !! B\n|-\n| 1 || 2\n|}", "A | B\n1 | 2"), ("Title\n-----\nno heading", "Title\n-----\nno heading"), ("see [18][19] there", "see [18][19] there"),
]


@pytest.mark.parametrize("text,want", CLEAN)
def test_clean_text(text, want):
    assert markup.render(markup.parse(text)[0], None) == want


def test_definitions_of_links_are_furniture(spark):
    df = spark.createDataFrame([("t", 1, "see [one][1] and [two][2].\n\n[1]: https://x.example/y\n[2]: https://x.example/z")], SCHEMA)
    assert [r.text for r in markup.cleaned(df).collect()] == ["see one and two."]


WRAPS = {
    "html": [("<b>", "</b>"), ("<i>", "</i>"), ('<a href="u">', "</a>"), ("<span>", "</span>"), ("<p>", "</p>"), ("<li>", "</li>"), ("<h2>", "</h2>")],
    "markdown": [("**", "**"), ("*", "*"), ("[", "](https://x.example/a)"), ("`", "`"), ("~~", "~~"), ("\n## ", "\n"), ("\n> ", "\n")],
    "wiki": [("'''", "'''"), ("''", "''"), ("[[", "]]"), ("[[page|", "]]"), ("\n== ", " ==\n"), ("[https://x.example/a ", "]")],
    "latex": [(r"\textbf{", "}"), (r"\emph{", "}"), (r"\section{", "}"), (r"\href{u}{", "}"), (r"\textit{\emph{", "}}")],
}


@pytest.mark.parametrize("language", WRAPS)
def test_no_word_is_lost_or_joined(language):
    """Words wrapped at random, some of them twice: the clean text has the same words, in order, and no mark."""
    r = random.Random(language)
    for _ in range(300):
        words = [f"word{r.randrange(99)}" for _ in range(r.randrange(1, 12))]
        out, k = [], 0
        while k < len(words):
            n = r.randrange(1, 4)
            a, b = r.choice(WRAPS[language]) if r.random() < 0.6 else ("", "")
            out.append(a + " ".join(words[k : k + n]) + b)
            k += n
        text = " ".join(out)
        clean = markup.render(markup.parse(text)[0], None)
        assert re.findall(r"\w+", clean) == words, (text, clean)
        assert not re.search(r"[<>\\{}\[\]*`~']", clean), (text, clean)
