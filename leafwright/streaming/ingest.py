"""Resumable passes over arriving result files, as a stream that processes what is there and stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.operators.evaluate import pending
from leafwright.sources.readers import page_of_path, parse_results

MAX_PASSES = 5


def ingest_results(spark: SparkSession, path: str, out: str, checkpoint: str) -> DataFrame:
    """Take in result files that have not been taken in before; the checkpoint remembers which have.

    Called again after more files have arrived, it reads only those. Files that are cut off give no rows.
    """
    files = spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").load(path)
    rows = parse_results(files.select(page_of_path(F.input_file_name()).alias("page"), F.col("value").alias("json")), strict=False)
    q = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)


def run_until_done(listed: DataFrame, done: Callable[[], DataFrame], skipped: Callable[[], DataFrame], work: Callable[[DataFrame], None], page: str = "page", passes: int = MAX_PASSES) -> int:
    """Work off what is pending, at most ``passes`` times, and stop early when a pass makes no progress.

    Returns how many pages are still pending. Each pass derives its list anew from what has been written, so
    a run that was killed goes on where it stopped.
    """
    left = None
    for _ in range(passes):
        todo = pending(listed, done(), skipped(), page=page)
        n = todo.count()
        if n == 0 or n == left:
            return n
        left = n
        work(todo)
    return pending(listed, done(), skipped(), page=page).count()
