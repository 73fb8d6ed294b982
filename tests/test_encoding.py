"""The splitter by a tokenizer's own tokens, with the public tokenizers of the box."""

import os
import random

import pytest

from quirework.functions import encoding as E

PATH = os.environ.get("TOKENIZER_JSON", "/opt/tokenizers/byte_bpe_50k.json")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no tokenizer file")


def text(n, seed=1):
    r = random.Random(seed)
    return " ".join("The " + " ".join(r.choice(("office", "publishes", "ranking", "candidates", "within", "days")) for _ in range(r.randrange(5, 20))) + "." for _ in range(n))


def test_pieces_keep_the_limit_and_end_at_sentences():
    t = text(150)
    pieces = E.split_encoded(t, PATH, 120, 140, 20)
    assert len(pieces) > 5 and all(len(E.spans_of(PATH, p)) <= 140 for p in pieces)
    assert all(p.endswith(".") for p in pieces) and all(p.startswith("The") for p in pieces)
    assert set(t.split()) == set(" ".join(pieces).split())


def test_end_chooser_looks_ahead_then_back():
    t = "word " * 100 + "end. " + "word " * 200
    spans = E.spans_of(PATH, t)
    stop = next(i for i, (a, b) in enumerate(spans) if t[a:b].strip() == ".") + 1
    assert E.choose_end(t, spans, 0, stop - 10, 300) == stop, "ahead"
    assert E.choose_end(t, spans, 0, stop + 30, 300) == stop, "back"
    assert E.choose_end(t, spans, 0, stop - 60, 300) == stop - 60, "too far ahead"
    assert E.choose_end(t, spans, stop, 50, 80) == stop + 50, "none"


@pytest.mark.parametrize("t,want", [("so.", True), ('so."  ', True), ("so", False), ("", False), ("a;)", True), ("a. b", False)])
def test_ends_sentence(t, want):
    assert E.ends_sentence(t) is want


def test_overlap_cap():
    t = "x" + "".join(f" and{k} then{k}" for k in range(600))
    pieces = E.split_encoded(t, PATH, 100, 120, 30)
    for a, b in zip(pieces, pieces[1:]):
        assert max((k for k in range(1, 60) if a.endswith(b[:k])), default=0) <= 30


def test_cases(spark):
    assert E.split_encoded("", PATH, 10, 12, 2) == [] and E.split_encoded(" a b ", PATH, 10, 12, 2) == ["a b"]
    with pytest.raises(ValueError):
        E.split_encoded("a", PATH, 10, 5, 2)
    df = spark.createDataFrame([(1, None, 0), (2, "short one", 0), (3, text(60), 0), (3, text(60), 0)], "row_id long, text string, piece_no int")
    got = E.encoded_splitter(PATH, 120, 140, 20)(df).collect()
    assert {r.row_id for r in got} == {2, 3} and all(r.tokens <= 140 for r in got)
    assert len([r for r in got if r.row_id == 3]) % 2 == 0
