"""Folders to chunks, end to end."""

import json

import pytest
from pyspark.sql import functions as F

from quirework.config import PipelineConfig
from quirework.plans.pipeline import run_evaluation, run_gates, run_pipeline
from quirework.sources import readers


def write(path, payload):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(payload if isinstance(payload, str) else json.dumps(payload), encoding="utf-8")


def block(page, i, kind, text, **more):
    key = "table_body" if kind == "table_body" else "text"
    return {"type": kind, key: text, "page_idx": page, "block_position": f"{page}-{i}", "id": f"b{page}{i}"} | more


@pytest.fixture()
def folders(tmp_path):
    root = tmp_path / "in"
    pages = [
        [
            block(0, 0, "title", "Header", level=1, is_discarded=True),
            block(0, 1, "title", "Article 1 Purpose", level=1),
            block(0, 2, "text", "Academic year A.Y. 2025/26. " + "The applicants describe their studies in detail. " * 4),
            block(0, 3, "table_body", "<table><tr><td>A</td><td>B</td></tr></table>"),
        ],
        [block(1, 0, "table_body", "<table><tr><td>C</td><td>D</td></tr></table>"), block(1, 1, "text", "Closing words about the selection, which are long enough to stay.")],
    ]
    merge = [{"id": "m", "type": "merge", "blocks": ["0-3", "1-0"]}]
    write(root / "Alpha_call.pdf-12345678-1234-1234-1234-123456789abc" / "block_list.json", {"pdfData": pages, "mergeConnections": merge})
    write(root / "Alpha_call.pdf-12345678-1234-1234-1234-123456789abc" / "ignored.md", "# Ignored\n\nnothing of this")
    items = [
        {"type": "text", "text": "Year 2024-2025", "text_level": 1, "page_idx": 0},
        {"type": "text", "text": "Article 2 Ranking", "text_level": 1, "page_idx": 0},
        {"type": "text", "text": "Every candidate is ranked by merit and by the income of the household concerned.", "page_idx": 1},
        {"type": "table", "table_body": "<table><tr><td>x</td><td>y</td></tr></table>", "table_caption": ["cap"], "table_footnote": ["foot"], "page_idx": 1},
    ]
    write(root / "beta" / "x_content_list.json", items)
    same = "# Notes\n\nExactly   the same paragraph stands in two documents and is long enough to be its own chunk, as it has many words in it indeed.\n"
    write(root / "gamma" / "a.md", "![pic](x.png)\n" + same)
    write(root / "delta" / "a.md", same.replace("   ", " "))
    write(root / "empty" / "notes.txt", "no source here")
    return root


def config(root, tmp_path, **more):
    return PipelineConfig(input_dir=str(root), output_dir=str(tmp_path / "out"), **more)


def test_readers(spark, folders):
    found = readers.files(spark, str(folders))
    c = {r.folder.split(".")[0].lower(): r for r in readers.choose_sources(found).collect()}
    assert [c[k].mode for k in ("alpha_call", "beta", "gamma", "empty")] == ["block_list", "content_list", "md", "none"]
    assert c["alpha_call"].fallback_reason is None and "missing" in c["beta"].fallback_reason
    blocks, modes, errors = readers.load_blocks(found, readers.choose_sources(found))
    assert errors.count() == 0
    a = [r for r in blocks.orderBy("pos").collect() if r.doc_id == c["alpha_call"].doc_id]
    assert [r.block_type for r in a] == ["title", "text", "table_body", "text"]
    assert a[2].text.count("<table>") == 2 and [r.page_idx for r in a[2].page_refs] == [0, 1]
    b = [r for r in blocks.orderBy("pos").collect() if r.doc_id == c["beta"].doc_id]
    assert [(r.block_type, r.heading_level) for r in b] == [("title", 1), ("title", 1), ("text", None), ("table_body", None)]
    assert b[3].text.endswith("\ncap\nfoot")
    g = [r.text for r in blocks.orderBy("pos").collect() if r.doc_id == c["gamma"].doc_id]
    assert g[0] == "Notes" and g[1].startswith("Exactly")
    with pytest.raises(ValueError):
        readers.choose_sources(found, "md_first")
    assert readers.files(spark, str(folders / "missing")).count() == 0
    assert readers.json_lines(spark, str(folders / "missing.jsonl"), "a int").count() == 0


def test_run_reuse_and_change(spark, folders, tmp_path):
    m = run_pipeline(spark, config(folders, tmp_path))
    assert m["documents"] == 4 and m["source_modes"] == {"block_list": 1, "content_list": 1, "md": 2}
    assert [e["source_folder"] for e in m["errors"]] == ["empty"]
    chunks, docs = (spark.read.parquet(str(tmp_path / "out" / t)) for t in ("chunks", "documents"))
    rows = chunks.collect()
    assert sum("same paragraph" in r.text for r in rows) == 1
    alpha = next(r for r in docs.collect() if r.name.startswith("Article 1") or "Alpha" in r.name)
    assert alpha.year == "2025-2026"
    assert any("Table:\nA | B" in r.text and "C | D" in r.text for r in rows)
    assert all(r.page_start is None or r.page_start <= r.page_end for r in rows)
    assert all(r.token_count <= 480 for r in rows)
    assert sorted(r.stats.chunks for r in docs.where("source_mode_used = 'md'").collect()) == [0, 1]

    again = run_pipeline(spark, config(folders, tmp_path))
    assert again["incremental"] == {"enabled": True, "processed_documents": 0, "reused_documents": 4}
    assert again["chunks"] == m["chunks"] and m["error_count"] == 1
    results = spark.read.parquet(again["document_results"]).collect()
    assert len(results) == 4 and all(r.reused and r.fallback_reason == "incremental reuse" for r in results)
    write(folders / "delta" / "a.md", "# Notes\n\nA wholly different paragraph that stands alone and has quite enough words to make up a chunk of its own today.\n")
    third = run_pipeline(spark, config(folders, tmp_path))
    assert third["incremental"]["processed_documents"] == 1 and third["incremental"]["reused_documents"] == 3
    texts = [r.text for r in spark.read.parquet(str(tmp_path / "out" / "chunks")).collect()]
    assert sum("same paragraph" in t for t in texts) == 1 and sum("wholly different" in t for t in texts) == 1

    report = run_evaluation(*(spark.read.parquet(str(tmp_path / "out" / t)) for t in ("chunks", "documents")))
    assert report["counters"]["oversized"] == 0 and 0 <= report["scores"]["overall_score"] <= 100
    with pytest.raises(AssertionError):
        run_gates(*(spark.read.parquet(str(tmp_path / "out" / t)) for t in ("chunks", "documents")), coverage_pct=0.0)


def test_stream_runs_what_is_there(spark, folders, tmp_path):
    from quirework.streaming.watch import watch

    seen = []
    watch(spark, config(folders, tmp_path), str(tmp_path / "cp"), seen.append).awaitTermination(120)
    assert seen and seen[0]["documents"] == 4


def test_fail_fast(spark, folders, tmp_path):
    with pytest.raises(ValueError):
        run_pipeline(spark, config(folders, tmp_path, fail_fast=True))


def test_order_of_chunks_is_contiguous(spark, folders, tmp_path):
    run_pipeline(spark, config(folders, tmp_path, dedupe_chunks=False))
    c = spark.read.parquet(str(tmp_path / "out" / "chunks")).groupBy("doc_id").agg(F.max("chunk_index").alias("m"), F.count_distinct("chunk_index").alias("n"))
    assert all(r.m + 1 == r.n for r in c.collect())


def snapshot(spark, out):
    return sorted((r.doc_id, r.chunk_index, r.text) for r in spark.read.parquet(str(out / "chunks")).collect())


def test_a_run_that_breaks_off_leaves_one_whole_state(spark, folders, tmp_path, monkeypatch):
    """Killed before any of its writes, a run leaves the results as they were; the next one makes what one run makes."""
    from pyspark.sql import DataFrameWriter

    from quirework.plans import pipeline

    out = tmp_path / "out"
    for name in ("Alpha_call.pdf-12345678-1234-1234-1234-123456789abc", "beta"):
        for f in (folders / name).iterdir():
            f.unlink()
    run_pipeline(spark, config(folders, tmp_path))
    before = snapshot(spark, out)
    write(folders / "delta" / "a.md", "# Notes\n\nA wholly different paragraph that stands alone and has quite enough words to make up a chunk of its own today.\n")

    def boom(*a, **k):
        raise RuntimeError("lost")

    def broken(patch):
        with monkeypatch.context() as m:
            patch(m)
            with pytest.raises(RuntimeError):
                run_pipeline(spark, config(folders, tmp_path))

    parquet, add, put = DataFrameWriter.parquet, pipeline.Commits.add, pipeline.publish
    for stop in ("entries", "document_results"):
        fail = lambda self, path, *a, stop=stop, **k: boom() if str(out) in path and stop in path else parquet(self, path, *a, **k)
        broken(lambda m: m.setattr(DataFrameWriter, "parquet", fail))
        assert snapshot(spark, out) == before, stop
    broken(lambda m: m.setattr(pipeline.Commits, "add", boom))
    assert snapshot(spark, out) == before
    calls = []
    broken(lambda m: m.setattr(pipeline, "publish", lambda *a: calls.append(a) or (boom() if len(calls) > 1 else put(*a))))
    assert snapshot(spark, out) == before and pipeline.Commits.add is add
    m = run_pipeline(spark, config(folders, tmp_path))
    assert m["incremental"]["processed_documents"] == 0, "the run before was committed"
    texts = [t for *_, t in snapshot(spark, out)]
    assert len(texts) == len(before) + 1 and sum("wholly different" in t for t in texts) == 1 and sum("same paragraph" in t for t in texts) == 1


def test_folder_hash_knows_where_a_file_lies(spark, tmp_path):
    from quirework.sources.readers import checksums, files, folder_hashes

    write(tmp_path / "in" / "x" / "s1" / "a.md", "one")
    first = folder_hashes(files(spark, str(tmp_path / "in"))).first().content_hash
    (tmp_path / "in" / "x" / "s2").mkdir()
    (tmp_path / "in" / "x" / "s1" / "a.md").rename(tmp_path / "in" / "x" / "s2" / "a.md")
    found = files(spark, str(tmp_path / "in"))
    second = folder_hashes(found).first().content_hash
    assert first != second
    known = checksums(found)
    assert folder_hashes(checksums(found, known)).first().content_hash == second


def test_malformed_sources_are_reported_with_their_cause(spark, tmp_path):
    root = tmp_path / "in"
    write(root / "broken" / "block_list.json", '{"pdfData": [[')
    write(root / "list" / "block_list.json", "[1]")
    write(root / "second" / "block_list.json", "nothing")
    write(root / "second" / "a.md", "# T\n\nThe Markdown beside it is read instead, which has enough words to be a chunk of its own.\n")
    m = run_pipeline(spark, config(root, tmp_path))
    errors = {e["source_folder"]: e["error"] for e in m["errors"]}
    assert m["documents"] == 1 and set(errors) == {"broken", "list"}
    assert errors["broken"].startswith("block_list.json: Expecting") and errors["list"] == "block_list.json: not a JSON object"


def test_cli_measures_coverage(spark, folders, tmp_path, capsys):
    from quirework import cli

    out = str(tmp_path / "out")
    assert cli.main(["run", "--input-dir", str(folders), "--output-dir", out]) == 0
    report, gates = str(tmp_path / "r.json"), str(tmp_path / "g.json")
    assert cli.main(["evaluate", "--artifacts-dir", out, "--output-json", report, "--output-md", str(tmp_path / "r.md")]) == 0
    covered = json.load(open(report))["coverage_pct"]
    assert 0 < covered <= 100 and "scorecard" in open(tmp_path / "r.md").read()
    for more in ([], ["--eval-report", report]):
        cli.main(["gates", "--artifacts-dir", out, "--output-json", gates, *more])
        checks = {c["name"]: c for c in json.load(open(gates))["checks"]}
        assert checks["coverage_pct"]["actual"] == covered
    rows = [json.loads(x) for x in "".join(p.read_text() for p in sorted((tmp_path / "out" / "chunks.jsonl").glob("part-*"))).splitlines()]
    assert len(rows) == spark.read.parquet(out + "/chunks").count() and "text" in rows[0]
    assert readers.json_lines(spark, out + "/documents.jsonl", "doc_id string, name string").count() == 4
    assert json.load(open(tmp_path / "out" / "run_manifest.json"))["documents"] == 4


def test_unmeasured_coverage_fails_its_gate(spark, folders, tmp_path):
    run_pipeline(spark, config(folders, tmp_path))
    report = run_gates(*(spark.read.parquet(str(tmp_path / "out" / t)) for t in ("chunks", "documents")), coverage_pct=None, check=False)
    assert not next(c for c in report["checks"] if c["name"] == "coverage_pct")["passed"]


def test_public_names():
    import quirework

    assert all(getattr(quirework, n) is not None for n in quirework.__all__)
