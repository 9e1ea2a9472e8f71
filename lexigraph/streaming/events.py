"""Structured Streaming forms over a folder of event files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lexigraph.session import scratch

EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def read_events(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """The events below a folder as a stream, times as timestamps; `files` a batch where given."""
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events*")
    s = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type")
    return w.agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("v")).select(F.unix_timestamp("window.start").alias("start"), "event_type", "n", "v")


def sliding(events: DataFrame, width: str = "2 hours", step: str = "1 hour", late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width, step))
    return w.agg(F.count("*").alias("n")).select(F.unix_timestamp("window.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id")
    return w.agg(F.count("*").alias("n")).select(F.unix_timestamp("session_window.start").alias("start"), "user_id", "n")


def deduplicated(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def run_to_end(stream: DataFrame, mode: str = "append") -> DataFrame:
    """What a stream gives over the files that are there now, written to the shared folder by foreachBatch and read back."""
    spark = stream.sparkSession
    out, marks = scratch(spark, "stream-out"), scratch(spark, "stream-marks")

    def put(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

    q = stream.writeStream.queryName(f"q{uuid.uuid4().hex[:8]}").outputMode(mode).option("checkpointLocation", marks).trigger(availableNow=True).foreachBatch(put).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema.add("batch", "long")).option("basePath", out).parquet(out)
