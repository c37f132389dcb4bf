"""Run logs as a stream: new JSON lines are folded into the last row of each document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def follow(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).json(path)


def first_seen(rows: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Each key once; state is dropped after the delay."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def counts(rows: DataFrame, time: str, width: str = "10 minutes", delay: str = "1 hour", by: str = "status") -> DataFrame:
    return rows.withWatermark(time, delay).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))


def drain(rows: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Write what is there now, then stop."""
    rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
