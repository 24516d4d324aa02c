"""Runs that go on where they stopped: manifests as a stream of files, pages with output left out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources import files


def finished(spark: SparkSession, output: str, key: str, kind: str) -> DataFrame:
    """The keys that have output."""
    if not files.exists(spark, output):
        return spark.createDataFrame([], f"`{key}` {kind}")
    return spark.read.parquet(output).select(F.col(key).cast(kind).alias(key))


def run_manifests(spark: SparkSession, manifests: str, output: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], schema: str, key: str = "page_id", files_at_once: int | None = None) -> None:
    """Run `work` on the pages of all manifests in a folder (JSON lines of `schema`) that no run has finished, and append what it returns (key and more, a row a page) to `output` as Parquet.

    Manifests that come later are taken by the next call, which starts from the checkpoint.  A micro-batch that was
    written but not recorded, or written in part, is met again after a restart: its pages with output are found by an anti-join, so each page is written once.
    A page listed more than once counts once; a null key names no page.
    """
    source = spark.readStream.schema(schema)
    stream = (source.option("maxFilesPerTrigger", files_at_once) if files_at_once else source).json(manifests)
    kind = stream.schema[key].dataType.simpleString()

    def each(batch: DataFrame, _: int) -> None:
        own = batch.sparkSession
        todo = batch.filter(F.col(key).isNotNull()).dropDuplicates([key]).join(finished(own, output, key, kind), key, "left_anti")
        work(todo).write.mode("append").parquet(output)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
