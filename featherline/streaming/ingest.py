"""Structured Streaming: incremental ingest, windowed densities, sessions, stateful islands."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest_records(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str) -> StreamingQuery:
    """New Parquet files of a folder into a versioned table, each file once: the checkpoint is the resume state."""
    stream = spark.readStream.schema(schema).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/_batch={number}")  # a retried batch replaces itself

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def window_counts(events: DataFrame, size: str, step: str, late: str = "10 minutes", t: str = "ts", key: str = "event_type") -> DataFrame:
    """Counts and sums by sliding window; windows close when the watermark has passed them. For batches and streams alike."""
    e = events.withWatermark(t, late) if events.isStreaming else events
    g = e.groupBy(F.window(t, size, step), key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n", "total")


def sessions(events: DataFrame, gap: str, late: str = "10 minutes", t: str = "ts", key: str = "user_id") -> DataFrame:
    """Runs of a key's events less than a gap apart: session_window, so state is one row an open session."""
    e = events.withWatermark(t, late) if events.isStreaming else events
    g = e.groupBy(F.session_window(t, gap), key).agg(F.count(F.lit(1)).alias("n"))
    return g.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def last_values(events: DataFrame, key: str = "user_id") -> DataFrame:
    """The running count and latest value of each key across micro-batches, kept as custom state."""

    def update(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, at, value = state.get if state.exists else (0, -1, 0.0)
        for f in frames:
            n += len(f)
            i = f["micros"].idxmax()
            if f["micros"][i] > at:
                at, value = int(f["micros"][i]), float(f["value"][i])
        state.update((n, at, value))
        yield pd.DataFrame({key: [k[0]], "n": [n], "micros": [at], "value": [value]})

    e = events.select(key, F.unix_micros("ts").alias("micros"), "value")
    return e.groupBy(key).applyInPandasWithState(update, f"{key} long, n long, micros long, value double", "n long, micros long, value double", "update", "NoTimeout")
