"""Structured Streaming: stale records turned away (T9), streaks of failures (T4)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brightreel.session import shared_dir

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, folder: str, name: str = "events.parquet", files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", name).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def hourly(stream: DataFrame, late: str = "2 hours") -> DataFrame:
    """Counts per hour and type, of hours that are over by more than ``late``; rows that come later still are turned away."""
    s = stream.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return s.groupBy(F.window("at", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))


def breaker(stream: DataFrame, failure: str = "error", threshold: int = 3) -> DataFrame:
    """T4: one row whenever a user's streak of failures reaches the threshold; a success resets it."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak = state.get[0] if state.exists else 0
        rows = []
        for frame in frames:
            for at, kind in frame.sort_values(["ts", "event_id"])[["ts", "event_type"]].itertuples(index=False):
                streak = streak + 1 if kind == failure else 0
                if streak == threshold:
                    rows.append((key[0], at))
        state.update((streak,))
        yield pd.DataFrame(rows, columns=["user_id", "opened_at"]).astype({"user_id": "int64"})

    return stream.groupBy("user_id").applyInPandasWithState(step, "user_id bigint, opened_at timestamp_ntz", "streak int", "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame) -> DataFrame:
    """Runs an appending stream over what is there now and returns its result, written to the shared folder."""
    spark = stream.sparkSession
    at = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    q = stream.writeStream.outputMode("append").format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")
