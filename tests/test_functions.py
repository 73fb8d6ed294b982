"""Cleaning, metadata and splitting functions on the cases of the fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from quirework.functions import clean, meta, splitting
from quirework.functions.tokens import py_token_count, token_count


def one(spark, text, *cols):
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


@pytest.mark.parametrize(
    "text,want",
    [
        ("<table><tr><td>A</td><th>B</th></tr><tr><td>1 &amp; 2</td><td></td></tr></table>", "Table:\nA | B\n1 & 2"),
        ("<table>no rows</table>", "Table: no rows"),
        ("Rate \\(66\\%\\) &amp; more Errore. Il segnalibro non è definito. end", "Rate (66%) & more end".replace("(66%)", "66%")),
        (r"$\frac{\frac{A}{B}}{C}$ is \dfrac{x_{1}}{y}", "A / B / C is x_{1} / y"),
        (r"\frac{1} stays", "{1} stays"),
        ("Same sentence stands here twice. Same sentence stands here twice. Other one.", "Same sentence stands here twice. Other one."),
        ("a long line that is repeated after another one, as it is here\nshort\na long line that is repeated after another one, as it is here", "a long line that is repeated after another one, as it is here\nshort"),
        ("x\n\n\n\ny\n=====\n![i](p.png)\ny", "x\n\ny"),
        ("<b>bold</b> 1st2025\r\nnext", "bold 1st 2025\nnext"),
        ("", ""),
        (None, ""),
        ("| a | b |\n| a | b |\nAbc", "| a | b |\nAbc"),
    ],
)
def test_clean_text(spark, text, want):
    assert one(spark, text, clean.clean_text("text"))[0] == want


def test_folder_title(spark):
    assert one(spark, "My_call__x.pdf-12345678-1234-1234-1234-123456789abc", clean.folder_title(F.col("text")))[0] == "My call x"


@pytest.mark.parametrize(
    "text,year",
    [("A.Y. 2025/26 and 2020-2021", "2025-2026"), ("2025 - 2026", "2025-2026"), ("2025_26", "2025-2026"), ("in 2024 only", "2024"), ("2099/01", "2099-2101"), ("1999", None), ("2025-06-01", "2025-2106"), ("", None), (None, None)],
)
def test_year(spark, text, year):
    assert one(spark, text, meta.extract_year(F.col("text")))[0] == year


def test_language_hint(spark):
    it, en = "articolo sezione borsa", "article section ranking"
    for text, want in ((it, "it"), (en, "en"), (it + " " + en, "en"), ("articolo", None), ("", None), (None, None)):
        assert one(spark, text, meta.language_hint(F.col("text")))[0] == want


def test_augmented_text(spark):
    lit = F.lit
    body = "word " * 60
    full = one(spark, body, meta.augmented_text(F.col("text"), lit("Name"), lit("2025"), lit("S"), lit("3"), lit("3.1")))[0]
    assert full.startswith("meta: doc=Name | year=2025 | section=S | article=3 | subarticle=3.1\n\nword")
    none = lit(None).cast("string")
    assert "section" not in one(spark, body, meta.augmented_text(F.col("text"), lit("N"), none, lit("s" * 140), lit("front_matter"), lit("n/a")))[0]
    assert one(spark, "x", meta.augmented_text(F.col("text"), lit("a b c d e f"), none, none, none, none))[0] == "x"
    assert one(spark, " ", meta.augmented_text(F.col("text"), lit("N"), none, none, none, none))[0] == "meta: doc=N"


def test_stub_and_tables(spark):
    stub = lambda t: one(spark, t, meta.is_stub(F.col("text"), token_count("text"), 50))[0]
    assert stub("Art. 3 Scope 12") and stub("Final Ranking Of The Call") and stub("# Head") and stub("ALL CAPITALS") and stub("")
    assert not stub("A plain sentence of the text.") and not stub("a | b 3\nc | d 4") and not stub("Articolato discorso di prova")
    norm = lambda t: one(spark, t, meta.normalize_table(F.col("text")))[0]
    for text in ("Table: x\na | b", "caption\na | b\nc | d", "no table | here", "", "a | b | c | d | e | f | g", "Table:\nplain"):
        assert norm(text) == splitting.as_table(text)


def test_toc(spark):
    toc = lambda t: one(spark, t, meta.is_toc(F.col("text"), F.array().cast("array<string>")))[0]
    assert toc("Summary of it") and toc("11.1.Title 22\n11.2.Other 23\n12.Next 30") and toc("Art. 1 A 3\nArt. 2 B 4\nArt. 3 C 5")
    assert not toc("A plain paragraph\nof two lines\nand a third")


def test_split_cases():
    words = " ".join(f"word{i}" for i in range(1200))
    got = splitting.split_tokens(words, 450, 520, 40)
    assert len(got) >= 3 and all(py_token_count(p) <= 520 for p in got)
    for text, t, m, o in (("The same sentence is here. " * 120, 120, 140, 20), ("First sentence stays. Then another one follows it. " * 120, 90, 110, 35)):
        assert sum(p[0].islower() for p in splitting.split_tokens(text, t, m, o)) <= 1
    text = " ".join(f"Sentence number {i} has some words." for i in range(360))
    got = splitting.split_tokens(text, 80, 100, 30)
    assert all(splitting.shared_edge(a, b) <= 30 for a, b in zip(got, got[1:]))
    assert splitting.split_tokens("", 10, 12, 1) == [] and splitting.split_tokens("a b", 10, 12, 1) == ["a b"]
    with pytest.raises(ValueError):
        splitting.split_tokens("a", 10, 5, 1)


def test_lossless_split_keeps_every_word():
    r = random.Random(3)
    text = " ".join(r.choice(("one", "two,", "Three.", "four;")) for _ in range(900))
    got = splitting.split_tokens(text, 60, 70, 10, lossless=True)
    at = 0
    for p in got:
        k = text.index(p, max(0, at - 40))
        assert k <= at + 1
        at = k + len(p)
    assert at == len(text)


def test_table_rows():
    rows = "\n".join(f"name {i} | value {i}" for i in range(200))
    got = splitting.segment_pieces("Table:\n" + rows, 420, 480, 30, 220)
    assert len(got) == 3 and all(p.startswith("Table:\n") and py_token_count(p) <= 480 for p in got)
    assert sum(p.count("|") for p in got) == 200
    assert splitting.segment_pieces("Table:\nThis is one single sentence of prose that ends here.", 420, 480, 30, 220)[0].startswith("This")


def test_overlap_expression_is_the_function(spark):
    r = random.Random(1)
    rows = [("".join(r.choice("ab") for _ in range(r.randrange(0, 12))), "".join(r.choice("ab") for _ in range(r.randrange(0, 12)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", meta.overlap_chars(F.col("a"), F.col("b")).alias("n"))
    assert all(x.n == splitting.shared_edge(x.a, x.b) for x in df.collect())


def test_token_count(spark):
    for t in ("", None, "a_b c-d é²", "x y €", "12.5%"):
        assert one(spark, t, token_count("text"))[0] == py_token_count(t)
