"""Structured Streaming: daily counts, captures within a window, and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax.functions.lineage import new_path


def with_time(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time as an instant, for watermarks."""
    return events.withColumn("at", F.col(ts).cast("timestamp"))


def daily_counts(events: DataFrame, late: str = "16 hours") -> DataFrame:
    """(day, event_type, n, total) per calendar day; rows later than the watermark are dropped once a day is closed."""
    counted = with_time(events).withWatermark("at", late).groupBy(F.window("at", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))


def new_captures(rows: DataFrame, seen: str = "at", late: str = "16 hours", key: str = "url") -> DataFrame:
    """Rows whose key the window before doesn't have: one per key within the watermark's reach."""
    return rows.withWatermark(seen, late).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "16 hours") -> DataFrame:
    """(user_id, started, n): bursts of events of a user with no longer pause than the gap."""
    held = with_time(events).withWatermark("at", late).groupBy("user_id", F.session_window("at", gap).alias("w")).agg(F.count("*").alias("n"))
    return held.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("started"), "n")


def run_to_end(spark: SparkSession, stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now and return what it wrote; offsets and state are in the shared folder."""
    out, state = new_path(spark, name), new_path(spark, f"{name}-state")
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode(mode).trigger(availableNow=True).start()
    else:
        query = stream.writeStream.option("checkpointLocation", state).outputMode(mode).trigger(availableNow=True).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
