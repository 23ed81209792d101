"""Streaming forms: event-time clusters of anchors, and upserts from a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from anchorline.operators.tables import upsert_latest

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of event files."""
    return spark.readStream.schema(EVENTS).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def session_clusters(events: DataFrame, gap: str = "40 seconds", late: str = "10 minutes") -> DataFrame:
    """Events of one kind that follow each other within ``gap``: count, span and strongest value.

    State is one row for each open session; the watermark closes sessions and drops their state.
    """
    w = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "event_type")
    return w.agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("strength")).select("event_type", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n", "strength")


def upsert_stream(changes: DataFrame, path: str, keys: Sequence[str], order: str, checkpoint: str) -> StreamingQuery:
    """Write the last row of each key of each batch to a folder of the batch's own; ``read_upserts`` merges them.

    A batch's work follows its changes, not the table; one that is run again after a failure overwrites its own folder only.
    """

    def one(batch: DataFrame, epoch: int) -> None:
        upsert_latest(batch.limit(0), batch, keys, order).write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return changes.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_upserts(spark: SparkSession, path: str, keys: Sequence[str], order: str) -> DataFrame:
    """The table that the batches below ``path`` make: of each key the row of its last batch, combined before the shuffle."""
    every = spark.read.parquet(path)
    values = [c for c in every.columns if c not in (*keys, "batch")]
    last = every.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct("batch", order)).alias("v"))
    return last.select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


def compact_upserts(spark: SparkSession, path: str, to: str, keys: Sequence[str], order: str) -> None:
    """The merged table as the one batch of a new folder, for a stream that goes on there."""
    read_upserts(spark, path, keys, order).write.parquet(f"{to}/batch=-1")
