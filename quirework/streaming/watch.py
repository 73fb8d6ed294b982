"""A file stream over extraction folders: each micro-batch of new files triggers an incremental run.

The dedupe of chunks needs the keys of all documents, so it is rebuilt from the committed state in each batch rather
than kept as unbounded stream state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quirework.config import PipelineConfig
from quirework.plans.pipeline import run_pipeline


def watch(
    spark: SparkSession,
    config: PipelineConfig,
    checkpoint: str,
    done: Callable[[dict], None] = lambda manifest: None,
    once: bool = True,
) -> StreamingQuery:
    """Run the pipeline whenever files arrive below ``input_dir``; with ``once``, for what is there now."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .load(config.input_dir)
        .select("path", "length")
    )

    def batch(df: DataFrame, _: int) -> None:
        if df.limit(1).count():
            done(run_pipeline(df.sparkSession, config))

    writer = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
