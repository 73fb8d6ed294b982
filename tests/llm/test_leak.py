"""p7: against brute force over words."""

import random
import re

import numpy as np

from quirework.llm import leak

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def brute(docs, items):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").casefold())
    out = set()
    for i, t in items:
        w = words(t)
        for d, x in docs:
            text = " ".join(words(x)).join("  ")
            hit = set()
            for k in range(len(w) - 4):
                if " " + " ".join(w[k : k + 5]) + " " in text:
                    hit.update(range(k, k + 5))
            if w and len(hit) >= 0.4 * len(w) and hit:
                out.add((i, d))
    return out


def found(spark, docs, items):
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    return {(r.item_id, r.doc_id) for r in leak.leaked(d, i).collect()}


def corpus(seed=3):
    r = random.Random(seed)
    vocab = [f"v{k}" for k in range(300)]
    items = [(k, " ".join(r.choice(vocab) for _ in range(r.randrange(3, 40)))) for k in range(40)]
    docs = []
    for d in range(120):
        w = [r.choice(vocab) for _ in range(60)]
        item = r.choice(items)[1].split()
        a = r.randrange(len(item))
        part = item[a : a + r.randrange(1, len(item) + 1)]
        if r.random() < 0.3 and len(part) > 8:
            part[r.randrange(len(part))] = "changed"
        docs.append((d, " ".join(w[:30] + part + w[30:])))
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    assert found(spark, docs, items) == brute(docs, items)


def test_rarity_and_size_of_the_map_change_nothing(spark, monkeypatch):
    docs, items = corpus(5)
    whole = found(spark, docs, items)
    monkeypatch.setattr(leak, "RARE", 0)
    assert found(spark, docs, items) == whole
    monkeypatch.setattr(leak, "MAX_BITS", 1 << 10)
    monkeypatch.setattr(leak, "BATCH_WORDS", 100)
    assert found(spark, docs, items) == whole


def test_frequent_phrases_lose_nothing(spark):
    """An item made of what stands in all documents has no rare n-gram and is found in all of them."""
    frame = "every applicant has to confirm the request in due time"
    docs = [(d, f"{frame} and w{d} too") for d in range(120)] + [(200, "every applicant has to pay")]
    assert found(spark, docs, [(1, frame), (2, "quite another text of seven words here")]) == {(1, d) for d in range(120)}


def test_edited_copy_is_reported_with_its_score(spark):
    """No five words of it are unbroken: none by the rule, but the alignment finds it."""
    words = [f"item{k}" for k in range(40)]
    edited = " ".join("changed" if k % 5 == 4 else w for k, w in enumerate(words))
    d = spark.createDataFrame([(1, f"before it {edited} after it"), (2, "nothing of it at all")], DOCS)
    i = spark.createDataFrame([(7, " ".join(words))], ITEMS)
    (r,) = leak.by_document(d, i).collect()
    # 32 equal words less seven gaps between them, of 40
    assert (r.doc_id, r.items, r.edited, r.best_share) == (1, [], [7], 0.0) and r.best_score == (2 * 32 - 7) / 80
    assert leak.leaked(d, i).count() == 0


def test_item_on_one_line_three_times(spark):
    item = " ".join(f"word{k}" for k in range(16))
    assert found(spark, [(1, f"start\n{item}\nmiddle\n{item}\nmore\n{item}\nend")], [(1, item)]) == {(1, 1)}


def test_layout_and_tags_aside(spark):
    item = "every remote banner delays one missing cloakroom and no informal meter copies the banner"
    docs = [
        (1, "x " + item.upper().replace(" ", ", ")),
        (2, item.replace("remote", "<b>remote</b>").replace("meter", "**meter**")),
        (3, "every remote ban-\nHeader line\n12\nHeader line\nner delays one mis-\nsing cloakroom and no informal\nHeader line\nmeter copies the banner"),
        (4, "every remote banner. Nothing else of it"),
        (5, None),
        (6, ""),
    ]
    assert {d for _, d in found(spark, docs, [(1, item), (2, None), (3, ""), (4, "too short item")])} >= {1, 2}
    assert {d for _, d in found(spark, docs, [(1, item)])} <= {1, 2, 3}


def test_empty_repeats_and_extra_columns(spark):
    items = [(1, "a b c d e f")]
    assert found(spark, [], items) == set() and found(spark, [(1, "a b c d e f")], []) == set()
    d = spark.createDataFrame([(1, "a b c d e f", 9), (1, "a b c d e f", 9)], DOCS + ", item_id long")
    got = leak.by_document(d, spark.createDataFrame(items, ITEMS)).collect()
    assert [(r.doc_id, r.items, r.edited) for r in got] == [(1, [1], [])]


def test_smith_waterman_against_plain():
    r = random.Random(1)
    pairs = [[[r.randrange(2, 6) for _ in range(r.randrange(0, 12))] for _ in range(2)] for _ in range(40)]
    want = []
    for a, b in pairs:
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        want.append(max(map(max, h)))
    got = leak.smith_waterman(*([np.array(p[k], np.uint64) for p in pairs] for k in (0, 1)))
    assert got.tolist() == want


def test_passage_that_returns_line_by_line(spark):
    """A passage repeated with the same line breaks is found, with and without a running header in it."""
    lines = ["every remote banner delays one missing cloakroom", "and no informal meter copies the banner", "while seven quiet clerks file the yellow reports", "under lamps that nobody ever turns off again"]
    header = "Register of the northern harbour"
    plain_doc = "\n".join(["start of it", *lines, "between the places"] * 3)
    with_header = "\n".join(["start of it", *lines[:2], header, "12", *lines[2:], "between the places"] * 3)
    words = " ".join(lines).split()
    narrow = "\n".join(" ".join(words[k : k + 3]) for k in range(0, len(words), 3))
    docs = [(1, plain_doc), (2, with_header), (3, "\n".join([narrow, "between the places"] * 3)), (4, "\n".join([header] * 4))]
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, " ".join(lines))], ITEMS)
    got = {r.doc_id: r.share for r in leak.overlaps(d, i).collect()}
    assert set(got) == {1, 2, 3} and got[1] == got[2] == 1.0 and got[3] >= 0.9
