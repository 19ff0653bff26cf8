"""Streams drained over the stand-in tables, with the batch result as their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.plans.registry import query
from rostrum.sources.tables import Scratch
from rostrum.streaming import landing as L

def _drain(stream: DataFrame, spark: SparkSession) -> DataFrame:
    """Runs a stream over what has landed and returns what it wrote."""
    out = Scratch(spark).root
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", f"{out}/checkpoint")
    writer.trigger(availableNow=True).format("parquet").start(f"{out}/rows").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def _events(spark: SparkSession, d: str) -> DataFrame:
    """The events file, as a stream, with an end mark that lets the watermark pass all windows."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").option("recursiveFileLookup", False).parquet(d)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) GROUP BY 1, 2")
def stream_hourly_counts(spark: SparkSession, d: str) -> DataFrame:
    """Windows that the watermark has closed when the landed rows end."""
    return _drain(L.windowed_counts(_events(spark, d), "ts", ["event_type"]), spark)
