"""p6: held-out accuracy, the automaton against brute force, and the defined cases."""

import random

import numpy as np

from quirework.llm import language as L
from quirework.runtime import read_table

SCHEMA = "tab string, row_id long, text string, hint string"
TEXTS = {
    "it": "il corso riguarda la storia delle citta e prevede molte ore di lezione per gli studenti della scuola",
    "en": "the course deals with the history of towns and offers many hours of classes for the students of the school",
    "de": "der kurs behandelt die geschichte der stadt und bietet viele stunden unterricht fur die schuler der schule",
}


def phrases(text, s):
    """Longest-match phrases of ``s`` against ``text``, the plain way."""
    n, i = 0, 0
    while i < len(s):
        k = i + 1
        while k <= len(s) and s[i:k] in text:
            k += 1
        i = max(i + 1, k - 1)
        n += 1
    return n


def test_parse_against_brute_force():
    r = random.Random(2)
    p = L.Parser(TEXTS)
    items = ["".join(r.choice("abcdeilnorst ") for _ in range(r.randrange(1, 60))) for _ in range(50)] + list(TEXTS.values())
    rates = p.rates(items)
    for k, name in enumerate(p.names):
        want = [phrases(TEXTS[name], s) * p.bits[k][0] / len(s) for s in items]
        assert np.allclose(rates[k], want), name


def test_units_leave_out_what_does_not_count():
    text = "Title of the call\n\nArt. 3 - Scope\n\nThe first sentence stands here. It has «un termine citato» inside.\n\nTable:\nName | Sum\nthe grant | 12\n\n```\nif x: y\n```"
    kinds = [(k, u) for _, k, u in L.units(text)]
    assert [k for k, _ in kinds] == ["sentence", "sentence", "table"]
    assert "citato" not in kinds[1][1]
    assert L.units(None) == [] and L.units("") == []


def test_held_out_accuracy(spark):
    """Documents whose two labels agree, one half for training; the other half's languages must agree with the labels."""
    d = "/root/testdata/sf0.01"
    docs = read_table(spark, d, "documents")
    code = L.code_column
    agreed = docs.where(code("lang") == code("language_hint"))
    texts = L.train(agreed.where("doc_id % 2 = 0").selectExpr("doc_id as id", "text").withColumn("label", L.F.lit(None).cast("string")).drop("label").join(
        agreed.select(L.F.col("doc_id").alias("id"), code("language_hint").alias("label")), "id"))
    assert set(texts) == set(L.LANGUAGES)
    rest = agreed.where("doc_id % 2 = 1").select(L.F.lit("t").alias("tab"), L.F.col("doc_id").alias("row_id"), "text", L.F.col("language_hint").alias("hint"))
    rows = L.segments(rest, texts).select("row_id", code("hint").alias("label"), "segments").collect()
    best = [(r.label, max(r.segments, key=lambda s: s.letters).lang) for r in rows if r.segments]
    assert len(best) > 100 and sum(a == b for a, b in best) / len(best) > 0.9


def test_cases(spark):
    texts = {k: v for k, v in TEXTS.items()}
    it, en = TEXTS["it"] + ".", TEXTS["en"] + "."
    rows = [
        ("t", 1, it, "it"), ("t", 2, it, "IT"), ("t", 3, it, "ita"), ("t", 4, it, "it-CH"), ("t", 5, it, None), ("t", 6, it, "n/a"), ("t", 7, it, "en"),
        ("t", 8, it + "\n\n" + en, "it"), ("t", 9, None, "it"), ("t", 10, "", None), ("t", 11, "12 / 34", None), ("t", 12, (en + " ") * 3000, "en"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows + rows[6:7]], SCHEMA + ", lang_code string")
    got = sorted((r.row_id, r.lang_code) for r in L.mislabelled(df, texts).collect())
    assert got == [(5, "it"), (6, "it"), (7, "it"), (7, "it"), (8, "en"), (8, "it")]
    conf = {(r.row_id, r.lang_code): r.confidence for r in L.identified(df, texts).collect()}
    assert conf[1, "it"] > 0.5
    assert L.mislabelled(spark.createDataFrame([], SCHEMA), texts).count() == 0
    assert L.train(spark.createDataFrame([], "id long, text string, label string")) == {}
    assert L.mislabelled(df, {}).count() == 0
