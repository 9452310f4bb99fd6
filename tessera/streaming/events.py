"""Structured Streaming forms: windowed counts, sessions, first-wins duplicates and a leased queue.

Every stream runs to its end with the availableNow trigger as a batch would, so each equals its batch form.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream of its files; TIMESTAMP_NTZ columns become timestamps, which watermarks need."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    s = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return s.select(*[F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name) for f in schema])


def window_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their values by tumbling window and type."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding_counts(events: DataFrame, width: str, step: str, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width, step).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Each user's stretches of events without a longer gap."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "n")


def first_seen(events: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """The first event of each key within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def last_state(events: DataFrame) -> DataFrame:
    """Each user's running count of events and errors, as custom state."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, bad = state.get if state.exists else (0, 0)
        for pdf in batches:
            n, bad = n + len(pdf), bad + int((pdf["event_type"] == "error").sum())
        state.update((n, bad))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "errors": [bad]})

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, n long, errors long", "n long, errors long", "update", GroupStateTimeout.NoTimeout)


def run_to_end(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Runs until all that there is has been read; sink gets each micro-batch, exactly once by its number."""
    q = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
