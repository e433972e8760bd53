"""Structured Streaming counterparts of the crawl feed and the change feed (STM-01, STM-02, STM-06..08)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dossier.operators.refresh import diff

EVENT_KEYS = ("organisation_number", "page_kind", "final_url", "content_sha256", "status")


def read_events(spark: SparkSession, path: str, schema) -> DataFrame:
    """Page events of a folder of JSON lines, with an event time."""
    return spark.readStream.schema(schema).json(path).withColumn("event_time", F.to_timestamp("retrieved_at"))


def dedupe(events: DataFrame, horizon: str = "45 days") -> DataFrame:
    """The first event per key within the horizon; state older than the watermark is let go."""
    return events.withWatermark("event_time", horizon).dropDuplicatesWithinWatermark(list(EVENT_KEYS))


def start(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is available and stop; a later start resumes from the checkpoint."""
    return events.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)


def counts(events: DataFrame, width: str = "1 day", horizon: str = "45 days", slide: str | None = None) -> DataFrame:
    """Events per window and status, late ones within the horizon included; with ``slide`` windows overlap."""
    return events.withWatermark("event_time", horizon).groupBy(F.window("event_time", width, slide), "status").agg(F.count("*").alias("n"))


def sessions(events: DataFrame, key: str, gap: str = "30 minutes", horizon: str = "45 days") -> DataFrame:
    """Events per session of ``key``: a session ends where nothing came for ``gap``."""
    held = events.withWatermark("event_time", horizon).groupBy(F.session_window("event_time", gap).alias("session"), key)
    return held.agg(F.count("*").alias("n")).select(key, F.col("session.start").alias("started"), F.col("session.end").alias("ended"), "n")


def change_feed(snapshots: DataFrame, state_path: str, changes_path: str, checkpoint: str, order: tuple[str, ...] = ()) -> StreamingQuery:
    """Diff every micro-batch of profiles against the last state and append the changes; a version per batch makes a repeated batch
    harmless. Of a company's rows in one batch the greatest by ``order``, then by all columns, counts, so a repeat sees the same."""

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = spark.read.parquet(f"{state_path}/v{number - 1}") if number else batch.limit(0)
        own = F.struct(*(F.col(c) for c in order), *(F.col(c) for c in batch.columns if c not in order))  # ties by all columns
        latest = batch.groupBy("organisation_number").agg(F.max(own).alias("r"))
        batch = latest.select(*(F.col(f"r.{c}").alias(c) for c in batch.columns))
        diff(old, batch).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{changes_path}/batch={number}")
        kept = old.join(batch.select("organisation_number"), "organisation_number", "left_anti")
        kept.unionByName(batch).write.mode("overwrite").parquet(f"{state_path}/v{number}")

    return snapshots.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
