"""Ordered scans, structure, segments, dedupe, evaluation and gates."""

import random

import pytest
from pyspark.sql import functions as F

from quirework import schemas
from quirework.config import GateConfig, PipelineConfig
from quirework.operators import assemble, dedupe, evaluate, segments
from quirework.operators.ordered import numbered, scan

SEG = schemas.SEGMENT
CHUNK = "doc_id string, chunk_index int, chunk_id string, text string, token_count int, char_count int, page_start int, page_end int, page_refs " + schemas.PAGE_REFS + ", metadata " + schemas.METADATA


def test_long_scan_equals_window(spark):
    r = random.Random(1)
    rows = [(k, p, r.choice((None, r.randrange(50))), r.choice((None, f"s{p}"))) for k in "ab" for p in range(300)]
    df = spark.createDataFrame(rows, "k string, pos int, n int, s string")
    outs = {"sum": ("sum", F.col("n")), "min": ("min", F.col("n")), "last": ("last", F.col("s"))}
    for before in (False, True):
        plain = {(x.k, x.pos): tuple(x)[4:] for x in scan(df, "k", "pos", outs, before).collect()}
        cut = {(x.k, x.pos): tuple(x)[4:] for x in scan(df, "k", "pos", outs, before, long=True, block=37).collect()}
        assert plain == cut and len(plain) == 600
    a = numbered(df, "k", "pos", "i", long=True, block=37).where("i <> pos").count()
    assert a == 0


def blocks(spark, rows):
    return spark.createDataFrame([("d", i, t, "title" if h else "text", [], h, None) for i, (t, h) in enumerate(rows)], schemas.BLOCK)


def test_structure_state(spark):
    rows = [("SEZIONE II Borse", 1), ("ART. 14.2 Requisiti", 2), ("14.3 dotted", None), ("Body that names Article 3 of another Article 4 of the law.", None), ("15.1 other", None), ("Art. 15 (2) Next", 2), ("plain", None)]
    got = segments.structure_state(blocks(spark, rows)).orderBy("pos").collect()
    assert [(x.article, x.subarticle) for x in got] == [(None, None), ("14", "14.2"), ("14", "14.3"), ("14", "14.3"), ("14", "14.3"), ("15", "2"), ("15", "2")]
    assert [x.changed for x in got] == [True, True, True, False, False, True, False]
    assert {x.section for x in got} == {"SEZIONE II Borse"}


def stack(levels):
    out, path = [], []
    for i, n in enumerate(levels):
        if n is not None:
            del path[max(n, 1) - 1 :]
            path.append(f"h{i}")
        out.append(list(path))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_heading_paths_against_a_stack(spark, seed):
    r = random.Random(seed)
    levels = [r.choice((None, 1, 2, 3, 4, 6)) for _ in range(60)]
    got = segments.heading_paths(blocks(spark, [(f"h{i}", n) for i, n in enumerate(levels)])).orderBy("pos").collect()
    assert [x.heading_path for x in got] == stack(levels)


def test_segments_and_small_merge(spark):
    rows = [("Article 1", 1), ("Body one.", None), ("Article 2", 1), ("Body two.", None), ("2.1 Sub", None), ("more", None)]
    s = segments.build_segments(blocks(spark, rows)).orderBy("seg_no").collect()
    assert [(x.seg_no, x.article) for x in s] == [(0, "1"), (1, "2"), (2, "2")]
    assert s[0].text == "Article 1\n\nBody one."
    m = segments.merge_small(segments.build_segments(blocks(spark, rows)), 50, 480).orderBy("seg_no").collect()
    assert [x.article for x in m] == ["1", "2"] and m[1].text.endswith("more")
    assert segments.build_segments(blocks(spark, rows).where("false")).count() == 0


def test_toc_merge(spark):
    rows = [("d", 0, "Summary\n1. A 3", [], None, None, None, ["Summary"]), ("d", 1, "2. B 4\n3. C 5", [], None, None, None, []), ("d", 2, "Article 1 text", [], None, "1", None, ["Article 1"])]
    df = spark.createDataFrame(rows, SEG)
    got = segments.merge_toc(df, 480).orderBy("seg_no").collect()
    assert [x.section for x in got] == [segments.TOC_LABEL, None] and "3. C 5" in got[0].text
    assert segments.drop_toc(df).count() == 2


def row(text, tokens=10, stub=False, article="1", page=1):
    return {"text": text, "_tokens": tokens, "stub": stub, "section": None, "article": article, "subarticle": None, "heading_path": [], "page_refs": [{"page_idx": page, "block_id": None, "block_position": None}]}


def test_sweep():
    big = row("long text " * 30, 72)
    out = assemble.sweep([big, row("tail", 3, page=2)], 50, 480)
    assert len(out) == 1 and [r["page_idx"] for r in out[0]["page_refs"]] == [1, 2]
    assert assemble.sweep([big, row("1. Index 4", 5, stub=True)], 50, 480) == [big]
    assert len(assemble.sweep([row("Table:\na | b", 6), big], 50, 480)) == 2
    assert len(assemble.sweep([big, row("tail", 3, article="2")], 50, 480)) == 2
    assert [r["text"] for r in assemble.emit([row("a", 3, stub=True), row("b", 3), row("c", 3)], 24, 480)] == ["b\n\nc"]


def meta_row(**kw):
    base = {"year": "2025", "name": "N", "brief_description": "B", "section": "S", "article": "1", "subarticle": None, "heading_path": [], "language_hint": "it"}
    return tuple((base | kw)[k] for k in base)


def chunks(spark, rows):
    return spark.createDataFrame([(d, i, f"{d}{i}", t, n, len(t or ""), 1, 1, [(1, None, None)], meta_row(**m)) for d, i, t, n, m in rows], CHUNK)


DOCS = "doc_id string, year string, name string"


def test_gates_pass_and_fail(spark):
    docs = spark.createDataFrame([("a", "2025", "N")], DOCS)
    good = [("a", 0, "First text " * 60, 150, {}), ("a", 1, "Second words " * 60, 160, {})]

    def gates(rows, **kw):
        c = chunks(spark, rows)
        return {r.name: r.passed for r in evaluate.deterministic_gates(c, evaluate.counters(c, docs), 99.0, GateConfig(**kw)).collect()}

    assert all(gates(good).values())
    tail = "x" * 80
    assert not gates([("a", 0, "Some text " * 50 + tail, 150, {}), ("a", 1, tail + " other " * 50, 150, {})])["overlap_p95_chars"]
    assert not gates(good + [("a", 2, "tiny one", 3, {})])["tiny_chunks_pct"]
    assert not gates(good + [("a", 2, "First text " * 60, 150, {})])["duplicate_chunks_pct"]
    assert not gates([("a", 0, "First text " * 60, 150, {"language_hint": ""})])["missing_metadata_pct"]
    assert not gates([("a", 0, "Art. 1 a\nArt. 2 b", 150, {})])["mixed_article_pct"]


def test_counters_and_scores(spark):
    docs = spark.createDataFrame([("a", "2024", "N")], DOCS)
    c = chunks(spark, [("a", 0, "word " * 500, 603, {}), ("a", 1, "tiny", 4, {}), ("a", 2, None, None, {"year": None})])
    k = evaluate.counters(c, docs).first()
    assert (k.chunks, k.oversized, k.small, k.missing_year, k.year_differs) == (3, 1, 2, 1, 2)
    s = evaluate.scores(evaluate.counters(c, docs)).first()
    assert 0 <= s.overall_score <= 100 and s.status in ("excellent", "good", "warning", "critical")
    empty = evaluate.scores(evaluate.counters(c.where("false"), docs)).first()
    assert empty.overall_score == 100.0
    sizes = evaluate.size_report(c.where("false")).first()
    assert (sizes["count"], sizes["min"], sizes.p95) == (0, 0, 0)
    assert {r.issue for r in evaluate.issue_samples(c).collect()} == {"oversized", "small"}


@pytest.mark.parametrize("n", [1, 2, 19, 20, 21, 40, 101])
def test_p95_is_the_element_of_the_reference_formula(spark, n):
    r = random.Random(n)
    v = [r.randrange(30) for _ in range(n)]
    got = evaluate.p95(spark.createDataFrame([(x,) for x in v], "v int"), "v").first().p95
    assert got == sorted(v)[max(0, int(0.95 * n) - 1)]


def test_keep_first_and_stats(spark):
    c = chunks(spark, [("b", 0, "Same  text", 3, {}), ("a", 1, "same TEXT ", 3, {}), ("a", 2, "Straße", 2, {}), ("b", 3, "STRASSE", 2, {}), ("b", 4, None, 0, {}), ("c", 0, "", 0, {})])
    got = sorted((r.doc_id, r.chunk_index) for r in dedupe.keep_first(c, ["doc_id", "chunk_index"]).collect())
    assert got == [("a", 1), ("a", 2), ("b", 4)]
    docs = spark.createDataFrame([("a",), ("z",)], "doc_id string")
    stats = {r.doc_id: (r.chunks, r.tokens, r.pages) for r in dedupe.document_stats(docs, c).collect()}
    assert stats == {"a": (2, 5, 1), "z": (0, 0, 0)}


def test_coverage(spark):
    src = spark.createDataFrame([("a", "abc d"), ("b", ""), ("c", None), ("d", "xy")], "doc_id string, text string")
    c = chunks(spark, [("a", 0, "ab zz", 1, {})])
    got = {r.doc_id: (r.source_chars, r.covered_chars) for r in evaluate.coverage(src, c).collect()}
    assert got == {"a": (4, 2), "b": (0, 0), "d": (2, 0)}


def stub_documents(seed):
    """Documents of small and large texts, some of them with stubs of other articles in between."""
    r = random.Random(seed)
    out = [("fixed", 0, "A text of some words that goes on for a while " * 3), ("fixed", 1, "# Title"), ("fixed", 2, "and a small rest of it")]
    for d in range(12):
        for k in range(14):
            kind = r.choice(("small", "small", "large", "stub", "long stub"))
            words = " ".join(f"w{d}x{k}x{r.randrange(99)}" for _ in range({"small": 14, "large": 60, "stub": 2, "long stub": 27}[kind]))
            out.append((f"d{d}", k, ("# " if "stub" in kind else "") + words))
    articles = {"fixed": [None, "2", None]}
    return [(d, k, t, [(k, None, None)], None, articles[d][k] if d in articles else r.choice((None, "2")), None, []) for d, k, t in out]


def test_stubs_between_rows_that_merge(spark, monkeypatch):
    """Islands give what the fold of whole documents gives."""
    df = spark.createDataFrame(stub_documents(4), SEG)
    got = sorted((r.doc_id, r._ord, r.text) for r in assemble.chunk_rows(df, PipelineConfig()).collect())
    assert [t.endswith("a small rest of it") for d, _, t in got if d == "fixed"] == [True]
    monkeypatch.setattr(assemble, "islands", lambda rows, *a, **k: rows.withColumn("island", F.lit(0)))
    whole = sorted((r.doc_id, r._ord, r.text) for r in assemble.chunk_rows(df, PipelineConfig()).collect())
    assert [(d, t) for d, _, t in got] == [(d, t) for d, _, t in whole]


def test_overlap_carries_over_the_borders_of_blocks(spark):
    """The chunk before is the one before, whatever its index and however long the document."""
    index = [0, 19_998, 20_001, 20_002, 60_000]
    c = spark.createDataFrame([("d", i, f"tail{k} text tail{k + 1}") for k, i in enumerate(index)], "doc_id string, chunk_index int, text string")
    got = {r.chunk_index: r.overlap for r in evaluate.consecutive_overlap(c).collect()}
    assert got == {i: 5 for i in index[1:]}


def test_heading_paths_of_any_depth(spark):
    levels = [*range(1, 16), 3, 40, 41, 2, None]
    got = segments.heading_paths(blocks(spark, [(f"h{i}", n) for i, n in enumerate(levels)])).orderBy("pos").collect()
    assert [x.heading_path for x in got] == stack(levels)


def test_very_many_pieces_keep_their_order(spark):
    """Positions beyond what 32 bits hold: a segment of a high number with many pieces."""
    n = 17_000
    text = "Table:\n" + "\n".join(f"{k} | " + "w " * 300 for k in range(n))
    rows = [("d", 200_000, text, [], None, None, None, [])]
    got = assemble.chunk_rows(spark.createDataFrame(rows, SEG), PipelineConfig()).orderBy("_ord").select(F.regexp_extract("text", r"(\d+) \|", 1).cast("int").alias("k")).collect()
    first = [r.k for r in got if r.k is not None]
    assert first == sorted(first) and len(first) > 16_500
