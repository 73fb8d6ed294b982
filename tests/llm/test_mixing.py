"""p8."""

import math

from quirework.llm import mixing

DOCS = "doc_id long, text string, source string"
TARGETS = "source string, target_share double, max_repeats int, budget_ratio double"


def docs(spark):
    rows = [(i, "one two three four five", "a") for i in range(100)] + [(100 + i, "one two three four five", "b") for i in range(20)]
    rows += [(200, None, "a"), (201, "", "b"), (202, "x y", None)]
    return spark.createDataFrame(rows, DOCS)


def test_plan_and_mix(spark):
    t = spark.createDataFrame([("a", 0.5, 1, 0.8), ("b", 0.3, 4, 0.8), ("c", 0.2, 3, 0.8), (None, 0.1, 1, 0.8)], TARGETS)
    p = mixing.plan(docs(spark), t)
    rows = {r.source: r for r in p.collect()}
    assert rows["c"].short and rows["c"].take == 0 and not rows["a"].short and not rows["b"].short
    made = mixing.mix(docs(spark), p).collect()
    assert all(r.repeats <= rows[r.source].max_repeats for r in made)
    assert len({r.doc_id for r in made}) == len(made)
    for s in ("a", "b"):
        total = sum(r.tokens * r.repeats for r in made if r.source == s)
        assert abs(total - rows[s].take) <= 6 * 2
    share = {r.source: r.actual_share for r in mixing.shares(docs(spark), t).collect()}
    assert abs(sum(share.values()) - 1) < 1e-6


def test_short_against_definition(spark):
    t = spark.createDataFrame([("a", 0.9, 1, 1.0), ("b", 0.3, 1, 1.0)], TARGETS)
    assert sorted(r.source for r in mixing.short_sources(docs(spark), t).collect()) == ["a", "b"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    t = spark.createDataFrame([("a", 1.0, 1, 1.0)], TARGETS)
    assert mixing.short_sources(none, t).count() == 0  # 0 < 0 holds for none
    assert mixing.short_sources(docs(spark), spark.createDataFrame([], TARGETS)).count() == 0
    assert mixing.shares(none, t).first().mixed_tokens == 0


def test_tempered_meets_entropy():
    w, a = mixing.tempered({"x": 900, "y": 90, "z": 10, "e": 0}, 0.9)
    assert abs(sum(w.values()) - 1) < 1e-9 and w["e"] == 0 and 0 < a < 1
    assert abs(-sum(p * math.log(p) for p in w.values() if p) - 0.9) < 1e-6
    assert mixing.tempered({}, 1.0) == ({}, 1.0)


def test_what_a_source_lacks_is_spread_by_tempered_weights(spark):
    """Each source keeps its share; the exponent is the greatest at which the others' passes reach."""
    text = "one two three four five"  # 6 tokens
    rows = [(i, text, "x") for i in range(10)] + [(100 + i, text, "y") for i in range(60)] + [(200 + i, text, "z") for i in range(400)]
    d = spark.createDataFrame(rows, DOCS)
    t = spark.createDataFrame([("x", 0.4, 1, 0.2), ("y", 0.3, 1, 0.2), ("z", 0.3, 1, 0.2)], TARGETS)
    p = {r.source: r for r in mixing.plan(d, t).collect()}
    budget = 0.2 * 6 * 470
    assert p["x"].short and p["x"].take == 60 and abs(sum(r.take for r in p.values()) - budget) < 1e-6
    assert p["x"].exponent == 1 and abs(p["y"].take - budget * 0.3 - (budget * 0.4 - 60) / 2) < 1e-6
    t = spark.createDataFrame([("x", 0.4, 1, 0.32), ("y", 0.3, 1, 0.32), ("z", 0.3, 1, 0.32)], TARGETS)
    p = {r.source: r for r in mixing.plan(d, t).collect()}
    assert 0 < p["y"].exponent < 1 and abs(p["y"].take - p["y"].most) < 0.01 and p["z"].take > p["z"].wanted
    assert abs(sum(r.take for r in p.values()) - 0.32 * 6 * 470) < 1e-6
    made = mixing.mix(d, mixing.plan(d, t)).groupBy("source").sum("tokens").collect()
    assert all(abs(r[1] - p[r.source].take) <= 6 for r in made)
    t = spark.createDataFrame([("x", 0.5, 1, 3.0), ("y", 0.5, 1, 3.0)], TARGETS)
    assert {r.source: r.take for r in mixing.plan(d, t).collect()} == {"x": 60, "y": 360}
