"""p5: limits, overlap, round trip, stability under edits."""

import random

import pytest
from hypothesis import given
from hypothesis import settings as hsettings
from hypothesis import strategies as st

from quirework.functions.tokens import py_token_count
from quirework.llm.split import Limits, _best_cut, cut, oversized, split_texts

SCHEMA = "tab string, row_id long, text string, heading_path array<string>"


def sentences(n, seed=1):
    r = random.Random(seed)
    words = [f"w{r.randrange(5000)}" for _ in range(n * 12)]
    return " ".join(" ".join(words[i * 12 : i * 12 + 12]).capitalize() + "." + ("\n\n" if i % 9 == 8 else "") for i in range(n))


def check(text, limits):
    spans = cut(text, limits)
    assert all(py_token_count(text[a:b]) <= limits.max_tokens for a, b in spans)
    assert not spans or (spans[0][0] == 0 and spans[-1][1] == len(text))
    for (a, b), (c, d) in zip(spans, spans[1:]):
        assert a < c <= b < d, "pieces leave nothing out"
    return spans


@hsettings(max_examples=60, deadline=None)
@given(st.text("ab .;\n|é_1:-#", max_size=3000), st.integers(5, 60), st.integers(0, 20))
def test_limits_and_round_trip(text, most, overlap):
    limits = Limits(most, overlap)
    spans = check(text, limits)
    whole, at = "", 0
    for a, b in spans:
        whole += text[max(a, at) : b]
        at = b
    assert whole == text


def test_overlap_is_as_given():
    text = sentences(200)
    spans = check(text, Limits())
    assert len(spans) > 3
    for (_, b), (c, _) in zip(spans, spans[1:]):
        assert py_token_count(text[c:b]) == 30


def test_cuts_fall_at_sentence_ends():
    text = sentences(200)
    assert all(text[b - 1].isspace() for _, b in cut(text)[:-1])


def test_an_edit_moves_only_neighbouring_cuts():
    text = sentences(400)
    k = len(text) // 2
    edited = text[:k] + " inserted words here " + text[k:]
    before = [b for _, b in cut(text)]
    after = [b if b < k else b - 21 for _, b in cut(edited)]
    assert len(set(before) ^ set(after)) <= 6


def test_landmarks_decide_where_to_cut():
    rank = [0] * 200
    for i in range(0, 200, 10):
        rank[i] = 2
    rank[95], rank[150] = 4, 1
    assert _best_cut(rank, [72, 91, 133], [5, 9, 2], 50, 140) == 130, "the least hash"
    assert _best_cut(rank, [72, 91], [9, 5], 50, 140) == 95, "a paragraph before a sentence"
    assert _best_cut(rank, [72], [1], 71, 79) == 72 and _best_cut(rank, [], [], 71, 79) == 79
    assert _best_cut(rank, [20], [1], 60, 100) == 60 and _best_cut(rank, [], [], 145, 149) == 149


def test_an_edit_in_the_middle_of_many_texts_is_local():
    for seed in range(12):
        text = sentences(300, seed)
        k = text.index(" ", len(text) // 2)
        edited = text[:k] + " some other words" + text[k:]
        before, after = (cut(t) for t in (text, edited))
        same = len({text[a:b] for a, b in before} & {edited[a:b] for a, b in after})
        assert same >= len(before) - 4, seed


def test_long_text_without_boundaries():
    check("word" * 10 + " " + "x " * 50_000, Limits())


def test_operator_cases(spark):
    long = sentences(80)
    rows = [("t", 1, None, None), ("t", 2, "", []), ("t", 3, "short", ["a"]), ("t", 4, long, ["h"]), ("t", 4, long, ["h"])]
    df = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA + ", piece_no int")
    got = split_texts(df).collect()
    assert sorted(r.row_id for r in got if r.pieces == 1) == [1, 2, 3]
    mine = [r for r in got if r.row_id == 4]
    assert len(mine) == 2 * mine[0].pieces and all(r.token_count <= 480 and r.heading_path == ["h"] for r in mine)
    assert [r.row_id for r in oversized(df).collect()] == [4, 4]
    assert split_texts(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("tokens", range(1, 60))
def test_words_is_inverse_of_tokens(tokens):
    n = Limits().words(tokens)
    assert (12 * n + 5) // 10 <= tokens < (12 * (n + 1) + 5) // 10
