"""Structured Streaming over arriving tables (an extension for continuous corpora)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paperloom.session import ensure_checkpoint_dir


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as a stream, with the schema of the batch table."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    raw = reader.parquet(path) if os.path.isdir(path) else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    times = {f.name: F.col(f.name).cast("timestamp") for f in raw.schema if f.dataType.typeName() == "timestamp_ntz"}
    return raw.withColumns(times) if times else raw


def windowed_counts(events: DataFrame, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Events per type and day; later ones than the watermark are dropped."""
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", size).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n", "total")
    )


def user_sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Sessions of each user: events not further apart than ``gap``."""
    return (
        events.withWatermark("ts", late)
        .groupBy(F.session_window("ts", gap).alias("w"), "user_id")
        .agg(F.count("*").alias("n"))
        .select("user_id", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")
    )


def run_to_table(df: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over what is there now; its result lies as files in the shared folder, not in the driver.

    In complete mode each batch replaces the result, else it adds to it.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"
    spark.createDataFrame([], df.schema).write.parquet(f"{folder}/result")

    def each(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{folder}/result")

    q: StreamingQuery = df.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/result")


def ingest(blocks: DataFrame, check, sink: str, checkpoint: str) -> StreamingQuery:
    """Applies a batch check to each arriving batch of blocks and appends its findings."""

    def each(batch: DataFrame, epoch: int) -> None:
        check(batch).withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(sink)

    return blocks.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
