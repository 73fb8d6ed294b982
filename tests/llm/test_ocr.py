"""p1: planted noise is found, clean text is not, and the repair brings the text back."""

import random

from quirework.llm import ocr

SCHEMA = "tab string, row_id long, doc_id string, pos int, title boolean, text string"
SENTENCES = [
    "the committee publishes the provisional ranking in the official register",
    "every candidate confirms the requested certificate within thirty days",
    "students submit the residence permit together with the payment receipt",
    "the housing office assigns the available places after the selection",
]


def corpus():
    r = random.Random(4)
    rows = []
    for d in range(40):
        for p in range(6):
            s = [r.choice(SENTENCES).capitalize() + "." for _ in range(5)]
            rows.append(["blocks", d * 10 + p, f"d{d}", p, False, " ".join(s)])
    return rows


def found(spark, rows):
    n = ocr.Noise(spark.createDataFrame([tuple(r) for r in rows], SCHEMA))
    return {(r.row_id, r.noise) for r in n.found().collect()}, n


def test_clean_text_has_none(spark):
    assert found(spark, corpus())[0] == set()


def test_planted_noise_and_repair(spark):
    rows = corpus()
    whole = {r[1]: r[5] for r in rows}
    text = {r[1]: r for r in rows}
    for k, (a, b) in enumerate((("certificate", "certificatc"), ("ranking", "rank|ng"), ("selection", "se1ection"), ("permit", "perrnit"), ("assigns", "as5igns"))):
        row = next(r for r in rows[k * 7 :] if a in r[5])
        row[5] = row[5].replace(a, b, 1)
    wrong = {r[1] for r in rows if r[5] != whole[r[1]]}
    cut = next(r for r in rows[100:] if "candidate" in r[5])
    cut[5] = cut[5].replace("candidate", "candi-\nOffice of Housing   7\ndate", 1)
    mine = [r for r in rows if r[2] == cut[2]]
    for i, r in enumerate(x for x in mine if x is not cut):
        r[5] += "\nOFFICE OF HOUSING" + ("\n- 8 -" if i % 2 else "")
    own = next(r for r in rows[180:] if r[2] != cut[2])
    own[5] += " A well-known and self-\nevident matter, pre-\nand post-war."
    got, noise = found(spark, rows)
    assert {i for i, n in got if n == "misread"} == wrong
    assert {i for i, n in got if n == "hyphen"} == {cut[1]}
    assert {i for i, n in got if n == "header"} == {r[1] for r in mine}
    assert {i for i, n in got if n == "page_number"} == {cut[1]} | {r[1] for r in mine if "- 8 -" in r[5]}
    fixed = {r.row_id: r.text for r in noise.repaired().collect()}
    for i in wrong | {r[1] for r in mine}:
        assert fixed[i] == whole[i], i
    assert len(fixed) == len(text)


def test_cases(spark):
    rows = [("blocks", 1, "d", 0, False, None), ("blocks", 2, None, None, None, ""), ("blocks", 2, "d", 1, False, "x"), ("chunks", 3, "d", 2, True, "Art. 1 - Scope")]
    rows += [("chunks", 4, "d", 3, False, "word " * 60_000)] * 2
    got, noise = found(spark, rows)
    assert got == set() and noise.repaired().count() == len(rows)
    got, noise = found(spark, [])
    assert got == set() and noise.repaired().count() == 0


def test_titles_and_table_lines_are_no_headers(spark):
    rows = [("blocks", i, "d", i, False, f"Art. 3 - Scope\n! band !! euro\nName | Sum\nlabel: value\nsome text {i} that ends here.") for i in range(8)]
    rows += [("blocks", 20 + i, "d", 20 + i, i == 0, "A Title Of The Call") for i in range(4)]
    assert not {x for x in found(spark, rows)[0] if x[1] == "header"}


def test_edits():
    assert "certificate" in ocr.edits("certificatc") and "minute" in ocr.edits("rninutc") and "in" not in ocr.edits("in")


def test_cut_words_beyond_the_frequent_ones(spark, monkeypatch):
    """What is found doesn't depend on how many words are sent to the tasks."""
    rows = corpus()
    for i, (a, b) in enumerate((("candidate", "candi-\nCollegio\ndate"), ("selection", "selec-\nti0n"), ("receipt", "re-\nceipt"), ("permit", "pe-\nCollegio\nrrnit"))):
        r = next(r for r in rows[i * 40 :] if a in r[5])
        r[5] = r[5].replace(a, b, 1)
    whole, _ = found(spark, rows)
    monkeypatch.setattr(ocr, "KNOWN_WORDS", 3)
    few, _ = found(spark, rows)
    assert few == whole and len({i for i, n in few if n == "hyphen"}) >= 4 and len({i for i, n in few if n == "misread"}) >= 2


def test_cut_and_misread_words_are_corrected(spark):
    rows = corpus()
    row = next(r for r in rows if "certificate" in r[5])
    whole, row[5] = row[5], row[5].replace("certificate", "certi-\nficatc", 1)
    got, noise = found(spark, rows)
    assert got == {(row[1], "hyphen"), (row[1], "misread")}
    assert {r.row_id: r.text for r in noise.repaired().collect()}[row[1]] == whole


def test_true_words_beside_a_lookalike_stay(spark):
    """'1st' is one glyph from a frequent word of another language, whose neighbours are others."""
    rows = [("blocks", i, f"d{i}", 0, False, f"Der Antrag ist bis zum {i}. Mai einzureichen und ist im Portal zu finden. Das Amt ist offen.") for i in range(30)]
    rows += [("blocks", 100 + i, f"e{i}", 0, False, "The offices open on the 1st day of the month for every student.") for i in range(4)]
    got, noise = found(spark, rows)
    assert got == set()
    assert {r.text for r in noise.repaired().collect() if r.row_id >= 100} == {rows[-1][5]}


def test_each_occurrence_in_its_own_context(spark):
    """One misreading of two words gets two corrections, and where it is the word itself, none."""
    rows = [("blocks", i, f"d{i}", 0, False, f"The cat sleeps near the warm stove while the dog barks at house {i}.") for i in range(60)]
    rows += [("blocks", 100 + i, f"e{i}", 0, False, f"Il testo era eat lungo prima di ogni correzione numero {i}.".replace("eat", "oat")) for i in range(60)]
    rows += [("blocks", 300, "f", 0, False, "The c@t sleeps near the warm stove while the dog barks at house 7."), ("blocks", 301, "f", 1, False, "Il testo era 0at lungo prima di ogni correzione.")]
    rows += [("blocks", 400, "g", 0, False, "The cat s1eeps near the warm stove; the dog barks at s1eeps house, the cat s|eeps near it.")]
    got, noise = found(spark, rows)
    assert {i for i, n in got if n == "misread"} == {300, 301, 400}
    text = {r.row_id: r.text for r in noise.repaired().collect()}
    assert "The cat sleeps" in text[300] and "era oat lungo" in text[301] and text[400].startswith("The cat sleeps near") and text[400].endswith("the cat sleeps near it.")


def test_words_beyond_the_vocabulary_are_judged_by_their_pairs(spark, monkeypatch):
    rows = corpus()
    row = next(r for r in rows if "certificate" in r[5])
    row[5] = row[5].replace("certificate", "certif1cate", 1)
    whole, _ = found(spark, rows)
    monkeypatch.setattr(ocr, "VOCABULARY", 1)
    few, _ = found(spark, rows)
    assert few == whole == {(row[1], "misread")}


def test_vectors_do_not_depend_on_the_number_of_tasks(spark, monkeypatch):
    stats = ocr.statistics(spark.createDataFrame([tuple(r) for r in corpus()], SCHEMA))
    one = ocr.skip_grams(stats)
    monkeypatch.setattr(ocr, "PAIRS_A_TASK", 20)
    many = ocr.skip_grams(stats)
    likely = [["submit", "the", "permit", "together"], ["the", "publishes"]]
    for v in (one, many):
        good = v.scores(["residence", "committee"], likely)
        bad = v.scores(["committee", "residence"], likely)
        assert good.min() > 0 and (good > bad).all()
        assert str(v.scores(["none", "committee"], [["the"], ["nowhere"]])) == "[nan nan]"


def test_corrections_count_words_as_the_scan_does():
    text = "İstanbul_one c@t, be-\nfore d0g\nSTRASSE Stra​ße c@t"
    words = ocr.said_words(text)
    assert words[-1] == "c@t" and "before" not in words
    at = [i for i, w in enumerate(words) if w == "c@t"]
    fixed = ocr.repair(text, {at[1]: "cat", words.index("d0g"): "dog"}, set(), {})
    assert fixed.count("c@t") == 1 and fixed.endswith("cat") and "dog" in fixed
