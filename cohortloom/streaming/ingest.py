"""Structured Streaming: files that keep arriving, folded into the catalog."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_events(spark: SparkSession, folder: str, schema: str, max_files: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream; ``max_files`` per batch holds a burst back."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def append_log(stream: DataFrame, log: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, once: bool = True) -> StreamingQuery:
    """Append a stream to a Parquet change log, each batch once, also after a restart.

    A batch's files are in a folder with its number and replace what an interrupted try left there.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{log}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def stage_counts(stream: DataFrame, time: str, kind: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events of each kind per time window; those later than ``late`` no longer count."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, window), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), kind, "n")


def current_states(stream: DataFrame, key: str, seq: str, state: str) -> DataFrame:
    """The state of the highest ``seq`` of each key so far, for complete or update output."""
    return stream.groupBy(key).agg(F.max_by(state, seq).alias(state), F.max(seq).alias(seq))


def alongside(query: StreamingQuery, step: Callable[[], bool], idle: float = 2.0) -> int:
    """Run batch work while a stream goes on: ``step`` is called again and again, after a pause where it
    found nothing to do, and until nothing is left once the stream has ended. Gives the steps that did something.

    An error of the stream is raised after the work that it left is done.
    """
    done = 0
    while query.isActive:
        if step():
            done += 1
        else:
            time.sleep(idle)
    while step():
        done += 1
    if query.exception() is not None:
        raise query.exception()
    return done
