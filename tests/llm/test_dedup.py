"""p4: against brute force, and the defined cases."""

import itertools
import re

from hypothesis import given
from hypothesis import settings as hsettings
from hypothesis import strategies as st

from quirework.llm import dedup

SCHEMA = "row_id long, text string"


def form(text):
    letters = lambda s: "".join(c for c in s.casefold() if c.isalnum())
    parts = [p for p in re.split(r"[|;\r\n]+", text or "") if letters(p)]
    fields = [p.split(":", 1) for p in parts if re.match(r"^[^:]{0,39}\w[^:]*:.*\w", p) and p.index(":") <= 40]
    sheet = tuple(sorted((letters(a), letters(b)) for a, b in fields)) if len(parts) >= 2 and len(fields) == len(parts) else None
    return letters(text or ""), sheet


def brute(rows):
    """Pairs (smallest, other) of the same content, by comparing all."""
    same = lambda a, b: a[0] == b[0] or (a[1] is not None and a[1] == b[1])
    forms = [(i, form(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, (_, fa)), (b, (_, fb)) in itertools.combinations(enumerate(forms), 2):
        if same(fa, fb):
            x, y = sorted((root(a), root(b)), key=lambda k: rows[k][0])
            parent[y] = x
    return sorted((rows[root(k)][0], rows[k][0]) for k in range(len(rows)) if rows[root(k)][0] != rows[k][0])


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((r.rep, r.row_id) for r in dedup.copies(df).collect() if r.rep != r.row_id)


ROWS = [
    (5, "Benefit: the Grant; Amount: 12; Code: a-1"),
    (2, "amount:12 | CODE: A1 | benefit: the grant"),
    (9, "Benefit: 12; Amount: the grant; Code: a-1"),
    (3, "Hello, World! Straße"),
    (7, "hello   world -- STRASSE"),
    (8, "world hello strasse"),
    (1, None),
    (4, ""),
    (6, " .;: "),
    (10, "Benefit the grant amount 12 code a1"),
    (11, "A: 1; A: 1"),
    (12, "A: 1"),
    (13, "A: 1;\nA: 1"),
    (14, "x" * 200_000),
    (15, "X" * 200_000 + "!"),
    (21, "a: bc; d: e; f: g"),
    (22, "ab: c; d: e; f: g"),
    (23, "f: g; ab: c; d: e"),
    (24, "fgabcde"),
    (25, "f g: abc; d: e"),
    (26, "d: e; fg: abc"),
]


def test_against_brute_force(spark):
    assert found(spark, ROWS) == brute(ROWS)


def test_cases(spark):
    got = dict((b, a) for a, b in found(spark, ROWS))
    assert got[5] == 2 and got[10] == 2 and 9 not in got and got[7] == 3 and 8 not in got
    assert {got[k] for k in (22, 23, 24, 25, 26)} == {21}, "letters and fields link by turns"
    assert got[4] == 1 and got[6] == 1 and got[13] == 11 and 12 not in got and got[15] == 14


def test_empty_and_extra_columns(spark):
    assert found(spark, []) == []
    df = spark.createDataFrame([(1, "a", 0, "r"), (2, "A", 1, "g")], SCHEMA + ", copies int, rep string")
    assert [(r.row_id, r.rep, r.copies) for r in dedup.copies(df).orderBy("row_id").collect()] == [(1, 1, 2), (2, 1, 2)]
    assert [(r.row_id, r.copies) for r in dedup.collapsed(df).collect()] == [(1, 2)]


def test_repeated_rows_and_hot_group(spark):
    rows = [(i, "Same text" if i % 3 else f"other {i}") for i in range(3000)]
    got = found(spark, rows)
    assert len(got) == 1999 and {a for a, _ in got} == {1}
    assert sorted(r.row_id for r in dedup.copies(spark.createDataFrame([(1, "a"), (1, "a")], SCHEMA)).collect()) == [1, 1]


@hsettings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text("aB :;|\n1é", max_size=12)), max_size=12))
def test_random(spark, texts):
    rows = [(i, t[0]) for i, t in enumerate(texts)]
    assert found(spark, rows) == brute(rows)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7)]
    got = {r.node: r.root for r in dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}


def test_nested_records(spark):
    schema = "row_id long, text string, tags array<string>, more struct<b: struct<x: string, y: string>, m: map<string,int>>"
    rows = [
        (1, "One, two", ["a", "b"], (("P", "q"), {"k": 1, "l": 2})),
        (2, "one two", ["A", "b."], (("p", "Q!"), {"L": 2, "K": 1})),
        (3, "one two", ["b", "a"], (("p", "q"), {"k": 1, "l": 2})),
        (4, "one two", ["a", "b"], (("q", "p"), {"k": 1, "l": 2})),
        (5, None, None, None),
        (6, "", [], ((None, ""), {})),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {(r.row_id, r.copies) for r in dedup.collapsed_records(df, "row_id", ["text", "tags", "more"]).collect()}
    assert got == {(1, 2), (3, 1), (4, 1), (5, 2)}
    assert {r.row_id for r in dedup.collapsed_records(df.select("row_id", "more", "tags", "text"), "row_id", ["more", "text", "tags"]).collect()} == {1, 3, 4, 5}
    assert dedup.collapsed_records(df.limit(0), "row_id", ["text", "more"]).count() == 0
