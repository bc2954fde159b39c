"""Structured Streaming: rates by window, dedup within a watermark, liveness, ordered micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, schema: str, at: str = "ts", files_per_batch: int = 16) -> DataFrame:
    """A file stream with a bounded batch; times become instants, which watermarks need."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path).withColumn(at, F.col(at).cast("timestamp"))


def window_counts(events: DataFrame, width: str, slide: str | None = None, key: str = "event_type", at: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Counts by (sliding) window and key; the same for a stream and a table."""
    own = events.withWatermark(at, late) if events.isStreaming else events
    out = own.groupBy(F.window(at, width, slide or width), key).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n")


def once(events: DataFrame, key: str, at: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Each key once, as far back as the watermark reaches."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])


def sessions(heartbeats: DataFrame, worker: str, gap: str = "2 minutes", at: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Spans in which a worker kept reporting; a gap ends its session."""
    own = heartbeats.withWatermark(at, late) if heartbeats.isStreaming else heartbeats
    out = own.groupBy(F.session_window(at, gap), worker).agg(F.count("*").alias("n_beats"))
    return out.select(worker, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n_beats")


def drain(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """All that is available now, as a table in memory (for tests and small reports)."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, order: tuple[str, ...] = ()) -> None:
    """Hands micro-batches over in order (a queue by priority and time, say)."""

    def run(batch: DataFrame, epoch: int) -> None:
        handle(batch.orderBy(*order) if order else batch, epoch)

    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
