"""p3 and the manifest of processed files."""

import pytest
from pyspark.sql import functions as F

from quirework.operators import incremental as inc

H = "run_id int, generated_at_utc string, version int, doc_id string, source_folder string, content_hash string, processing_signature string"
M = "run_id int, processed_at_utc string, doc_id string, source_folder string, source_mode_used string, fallback_reason string, warnings array<string>, reused boolean, error string"
S = "doc_id string, source_folder string, source_mode string, content_hash string, processing_signature string, seen_at timestamp, loaded_at timestamp"


def due(spark, hashes, results, scans):
    h = spark.createDataFrame([(r, "t", 2, d, "f", c, s, 1) for r, d, c, s in hashes], H + ", content int")
    m = spark.createDataFrame([(r, "t", d, "f", "md", None, [], u, e) for r, d, u, e in results], M)
    t = spark.createDataFrame([(d, "f", "md", c, s, at) for d, c, s, at in scans], "doc_id string, source_folder string, source_mode string, content_hash string, processing_signature string, at string")
    t = t.withColumn("seen_at", F.to_timestamp("at")).withColumn("loaded_at", F.col("seen_at")).drop("at")
    return sorted(r.doc_id for r in inc.to_process(h, m, t).collect())


def test_cases(spark):
    hashes = [(1, "same", "sha1:00AB", "CD"), (1, "changed", "aa", "cd"), (1, "signature", "aa", "xx0"), (2, "failed", "bb", "cd"), (1, "failed", "aa", "cd"), (2, "reused", "bb", "cd"), (1, "reused", "aa", "cd"), (1, "noresult", "aa", "cd"), (1, "gone", "aa", "cd"), (1, "same", "sha1:00AB", "CD")]
    results = [(1, "same", False, None), (1, "same", False, None), (1, "changed", False, None), (1, "signature", False, None), (2, "failed", False, "boom"), (1, "failed", False, None), (2, "reused", True, None), (1, "reused", False, None), (1, "gone", False, None), (3, "same", None, None)]
    scans = [("same", "ab", "cd", "2025-01-01"), ("changed", "ab", "cd", "2025-01-01"), ("signature", "aa", "cd", "2025-01-01"), ("failed", "aa", "cd", "2025-01-01"), ("reused", "aa", "cd", "2025-01-01"), ("noresult", "aa", "cd", "2025-01-01"), ("new", "aa", "cd", "2025-01-01"), ("unreadable", None, "cd", "2025-01-01"), ("older", "aa", "cd", "2024-01-01"), ("same", "ff", "cd", "2024-12-31"), ("same", None, "cd", "2025-02-01"), (None, "aa", "cd", "2025-01-01")]
    assert due(spark, hashes, results, scans) == ["changed", "new", "noresult", "older", "signature"]


def test_empty_tables(spark):
    assert due(spark, [], [], []) == []
    assert due(spark, [], [], [("a", "1", "2", "2025-01-01")]) == ["a"]
    assert due(spark, [(1, "a", "1", "2")], [(1, "a", False, None)], []) == []


@pytest.mark.parametrize("raw,want", [("sha1:0A", "a"), ("0x0f", "f"), ("00", "0"), (" AB cd ", "abcd"), ("", None), (None, None), ("sha256=FF", "ff")])
def test_hex_value(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "h string").select(inc.hex_value("h")).first()[0] == want


def test_manifest_survives_failures(spark, tmp_path):
    src, out, root = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "manifest")
    src.mkdir()
    (src / "a.txt").write_text("one\ntwo\n")

    def read(due):
        paths = [r.path for r in due.collect()]
        return spark.read.text(paths).select("value") if paths else spark.createDataFrame([], "value string")

    def broken(due):
        read(due).write.mode("overwrite").parquet(f"{out}/batch=1")  # leaves output behind
        raise RuntimeError("lost")

    m = inc.Manifest(spark, root)
    listing = lambda: inc.file_listing(spark, str(src))
    with pytest.raises(RuntimeError):
        m.run(listing(), broken, out, "1")
    assert m.commits() == [] and m.committed(out) is None
    assert sorted(r.value for r in m.run(listing(), read, out, "1").collect()) == ["one", "two"]
    assert m.run(listing(), read, out, "1") is None
    (src / "b.txt").write_text("three\n")
    assert m.pending(listing()).count() == 1
    m.run(listing(), read, out, "2")
    (src / "a.txt").write_text("one changed\n")
    m.run(listing(), read, out, "3")
    assert sorted(r.value for r in m.committed(out).collect()) == ["one", "one changed", "three", "two"]
    assert m.pending(listing()).count() == 0


def read_with_path(spark):
    def read(due):
        paths = [r.path for r in due.collect()]
        empty = spark.createDataFrame([], "value string, path string")
        return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path")) if paths else empty

    return read


def test_a_file_that_changes_while_its_batch_runs_is_processed_again(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    (src / "a.txt").write_text("old\n")
    m = inc.Manifest(spark, str(tmp_path / "manifest"))
    read = read_with_path(spark)

    def slow(due):
        rows = read(due).collect()
        (src / "a.txt").write_text("quite new\n")
        return spark.createDataFrame(rows, "value string, path string")

    m.run(inc.file_listing(spark, str(src)), slow, out, "1")
    assert m.pending(inc.file_listing(spark, str(src))).count() == 1
    m.run(inc.file_listing(spark, str(src)), read, out, "2")
    assert [r.value for r in m.committed(out).collect()] == ["quite new"], "the old rows are superseded"
    assert m.pending(inc.file_listing(spark, str(src))).count() == 0


def test_a_file_that_a_listing_lacks_stays_processed(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    for n in "ab":
        (src / f"{n}.txt").write_text(f"{n}\n")
    m = inc.Manifest(spark, str(tmp_path / "manifest"))
    whole = inc.file_listing(spark, str(src)).collect()
    listing = lambda rows: spark.createDataFrame(rows, "path string, size long, checksum string")
    m.run(listing(whole), read_with_path(spark), out, "1")
    m.run(listing(whole[:1]), read_with_path(spark), out, "2")
    assert m.pending(listing(whole)).count() == 0
    assert sorted(r.value for r in m.committed(out).collect()) == ["a", "b"]
    with pytest.raises(RuntimeError):
        inc.Commits(spark, str(tmp_path / "manifest" / "commits")).add(1, {})
