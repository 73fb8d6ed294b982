"""Incremental processing: which records changed since the last successful run, and how a run commits.

A run is planned by an anti-join of the present listing against the last committed state,
its output is written under the batch identifier (a repeated attempt overwrites its own
output and nothing else), and only then is the manifest committed, by one atomic rename.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quirework.runtime import materialize
from quirework.sources.shared import Files


def hex_value(col: Column | str) -> Column:
    """A hash spelled as the bare hexadecimal number it stands for.

    Spaces, an algorithm name or ``0x`` before the digits, separators between them, letter
    case and leading zeros don't matter. Null for a null or a text without a hexadecimal digit.
    """
    c = F.col(col) if isinstance(col, str) else col
    c = F.lower(F.regexp_replace(c, r"\s", ""))
    c = F.regexp_replace(c, r"^[a-z][a-z0-9_-]*[:=]", "")
    c = F.regexp_replace(c, r"^(0x|\\x)", "")
    c = F.regexp_replace(c, r"[^0-9a-f]", "")
    stripped = F.regexp_replace(c, r"^0+", "")
    return F.when(F.length(c) > 0, F.when(F.length(stripped) > 0, stripped).otherwise(F.lit("0")))


def present_state(scan: DataFrame) -> DataFrame:
    """One row a document: the sighting with the latest ``seen_at`` among those with a hash.

    Ties in ``seen_at`` go to the later ``loaded_at``, then to the greater hash and signature.
    A document of which every sighting lacks a hash has no present state.
    """
    return (
        scan.where(hex_value("content_hash").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(
            F.max_by(
                F.struct("content_hash", "processing_signature"),
                F.struct("seen_at", "loaded_at", "content_hash", "processing_signature"),
            ).alias("s")
        )
        .select(
            "doc_id",
            hex_value("s.content_hash").alias("content"),
            hex_value("s.processing_signature").alias("signature"),
        )
    )


def last_processed(hashes: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row a document: the cache entry of its last run that succeeded and didn't reuse.

    A success is a manifest row of the same run and document without an error and with
    ``reused = false``. Entries left by failed or broken-off work therefore don't count.
    Where a run wrote an entry more than once, the later ``generated_at_utc`` wins.
    """
    done = (
        manifest.where(F.col("error").isNull() & (F.col("reused") == F.lit(False)))
        .select("run_id", "doc_id")
        .distinct()
    )
    return (
        hashes.join(done, ["run_id", "doc_id"], "left_semi")
        .groupBy("doc_id")
        .agg(
            F.max_by(
                F.struct("content_hash", "processing_signature"),
                F.struct("run_id", "generated_at_utc", "version", "content_hash", "processing_signature"),
            ).alias("s")
        )
        .select(
            "doc_id",
            hex_value("s.content_hash").alias("content"),
            hex_value("s.processing_signature").alias("signature"),
        )
    )


def changed(present: DataFrame, last: DataFrame, key: str = "doc_id") -> DataFrame:
    """Anti-join: rows of ``present`` without an equal (key, content, signature) in ``last``.

    Nulls compare as equal values, so an entry without a hash matches nothing but itself.
    """
    a, b = present.alias("a"), last.alias("b")
    same = (
        (F.col(f"a.{key}") == F.col(f"b.{key}"))
        & F.col("a.content").eqNullSafe(F.col("b.content"))
        & F.col("a.signature").eqNullSafe(F.col("b.signature"))
    )
    return a.join(b, same, "left_anti")


def unchanged(present: DataFrame, last: DataFrame, key: str = "doc_id") -> DataFrame:
    """The complement of :func:`changed`: what a run may reuse."""
    a, b = present.alias("a"), last.alias("b")
    same = (
        (F.col(f"a.{key}") == F.col(f"b.{key}"))
        & F.col("a.content").eqNullSafe(F.col("b.content"))
        & F.col("a.signature").eqNullSafe(F.col("b.signature"))
    )
    return a.join(b, same, "left_semi")


def to_process(hashes: DataFrame, manifest: DataFrame, scan: DataFrame) -> DataFrame:
    """``doc_id`` of every document the coming run has to process.

    Empty tables: without a scan nothing is due; without entries or results all scanned
    documents are. Extra columns are ignored.
    """
    return changed(present_state(scan), last_processed(hashes, manifest)).select("doc_id")


# --- manifest of processed input files -------------------------------------------------------


class Commits:
    """Numbered commits of a job in a shared folder.

    ``<root>/<n>.json`` holds one finished commit. It comes to be by one rename of a finished file to a name that must
    not exist, so of two writers one fails. What no commit names is ignored.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.files = root.rstrip("/"), Files(spark)

    def all(self) -> list[dict]:
        return [json.loads(self.files.read(f"{self.root}/{n}")) for n in self.files.names(self.root) if _COMMIT.fullmatch(n)]

    def last(self) -> tuple[int, dict | None]:
        """(how many there are, the last one)"""
        names = [n for n in self.files.names(self.root) if _COMMIT.fullmatch(n)]
        return len(names), json.loads(self.files.read(f"{self.root}/{names[-1]}")) if names else None

    def add(self, n: int, body: dict) -> None:
        """The ``n``-th commit, counted from 0."""
        path = f"{self.root}/{n:08d}.json"
        if not self.files.create(path, json.dumps(body)):
            raise RuntimeError(f"another run committed first: {path}")


_COMMIT = re.compile(r"\d{8}\.json")


class Manifest:
    """Committed state of an incremental job in a shared folder.

    ``commits`` names the batches and their outputs (:class:`Commits`). ``state/<batch>`` says of every file ever seen
    with which size and checksum it was processed last, and in which batch.
    """

    SCHEMA = "path string, size long, checksum string, batch string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._commits = Commits(spark, f"{self.root}/commits")

    def commits(self) -> list[dict]:
        return self._commits.all()

    def state(self) -> DataFrame:
        _, last = self._commits.last()
        return self.spark.read.schema(self.SCHEMA).parquet(last["state"]) if last else self.spark.createDataFrame([], self.SCHEMA)

    def pending(self, listing: DataFrame) -> DataFrame:
        """Files of ``listing`` (path, size, checksum) that were not processed last in this size and checksum."""
        return listing.select("path", "size", "checksum").distinct().join(
            self.state(), ["path", "size", "checksum"], "left_anti"
        )

    def run(self, listing: DataFrame, process: Callable[[DataFrame], DataFrame], output: str, batch: str) -> DataFrame | None:
        """Process what is pending and commit it; None if the batch was committed before.

        After a failure the same call again overwrites the partial output of its own batch, so no record is skipped or
        written twice. The listing is taken once, before anything is processed: a file that changes meanwhile is recorded
        as it was listed, so the next run processes it again. Files that a listing lacks stay processed.
        """
        done = self.commits()
        if any(c["batch"] == batch for c in done):
            return None
        seen = materialize(listing.select("path", "size", "checksum").distinct(), "listing")
        due = materialize(self.pending(seen), "due")
        target = f"{output.rstrip('/')}/batch={batch}"
        process(due).write.mode("overwrite").parquet(target)
        state = f"{self.root}/state/{batch}"
        kept = self.state().join(due.select("path"), "path", "left_anti")
        kept.unionByName(due.withColumn("batch", F.lit(batch))).write.mode("overwrite").parquet(state)
        self._commits.add(len(done), {"batch": batch, "output": target, "state": state})
        return self.spark.read.parquet(target)

    def committed(self, output: str) -> DataFrame | None:
        """Output of the committed batches only.

        Where it has a column ``path``, rows of a file come from the batch that processed the file last; those of earlier
        batches are superseded.
        """
        paths = [c["output"] for c in self.commits() if c["output"].startswith(output.rstrip("/"))]
        try:
            rows = self.spark.read.option("basePath", output).option("mergeSchema", "true").parquet(*paths) if paths else None
        except AnalysisException:
            return None
        if rows is None or "path" not in rows.columns:
            return rows
        last = self.state().select(F.col("path").alias("_path"), F.col("batch").alias("_batch"))
        now = (F.col("path") == F.col("_path")) & (F.col("batch").cast("string") == F.col("_batch"))
        return rows.join(last, now, "left_semi")


def file_listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, size and SHA-256 of every file below ``path``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("checksum"))
    )
