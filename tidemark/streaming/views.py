"""Structured Streaming forms of the views: the same rows as in batch, from the events as they come."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.rounds import checkpointed


def events(spark: SparkSession, sf_dir: str, late: str = "2 days") -> DataFrame:
    """The events as a stream, with a watermark; timestamps without a zone are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.schemaInference", "true")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return raw.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def finished(stream: DataFrame, mode: str) -> DataFrame:
    """Runs a stream over all input that there is, and returns what it has written, from a table in the shared folder."""
    spark = stream.sparkSession
    checkpointed(spark.range(0))  # sets the shared folder where it is unset
    base = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start()
    else:
        # each batch holds all rows that changed; the last batch of a complete output is the result, and writing it again gives the same
        q = stream.writeStream.foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{base}/out")).option("checkpointLocation", f"{base}/state").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def late_counts(parts: list[DataFrame], late: str = "2 days") -> DataFrame:
    """SM-8: tumbling days that the watermark has closed, of parts of the events that come one after another.

    Each part is a run of its own, from the checkpoint of the one before. Windows are written once, when they are closed; a row that comes
    after that is left out."""
    spark = parts[0].sparkSession
    checkpointed(spark.range(0))
    base = f"{spark.sparkContext.getCheckpointDir()}/late-{uuid.uuid4().hex}"
    for part in parts:
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(parts[0].schema).parquet(f"{base}/in").withWatermark("ts", late)
        n = stream.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"))
        out = n.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")
        q = out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")


def daily_counts(stream: DataFrame) -> DataFrame:
    """SM-5: tumbling days."""
    n = stream.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return n.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", "total")


def sliding_counts(stream: DataFrame) -> DataFrame:
    """SM-6: three days, by one."""
    n = stream.groupBy(F.window("ts", "3 days", "1 day"), "event_type").agg(F.count("*").alias("n"))
    return n.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def sessions(stream: DataFrame, gap: str = "6 hours") -> DataFrame:
    """SM-7: stretches of a source and item without a gap."""
    n = stream.groupBy(F.session_window("ts", gap), "event_type", (F.col("user_id") % 20).alias("item_key")).agg(F.count("*").alias("n"))
    return n.select(F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("started"), "event_type", "item_key", "n")


def first_seen(stream: DataFrame) -> DataFrame:
    """SM-2, SM-4: the first event of each source and user."""
    n = stream.groupBy("event_type", "user_id").agg(F.min("event_id").alias("first_event"), F.count("*").alias("n"))
    return n
