"""Landed pages as a stream: each micro-batch runs the batch chain and is merged into the event store. An extension: the reference
has no stream operators. Replayed batches change nothing: the merge is by identity, and the time at which a batch was first seen is
kept beside the checkpoint and used again."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.state import EventStore, Versions
from ..plans.pipeline import acquire
from ..schema import RAW_PAGE


def stream_pages(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(RAW_PAGE).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def first_seen(spark: SparkSession, path: str, now: datetime) -> datetime:
    """The time noted at the path, which is `now` if none is."""
    noted = Versions(spark, path)
    if (known := noted.latest()) is None:
        known = noted.write(spark.createDataFrame([(now,)], "seen timestamp_ntz"))
    return known.first()["seen"]


def into_store(pages: DataFrame, sources: DataFrame, store: EventStore, checkpoint: str, seen_at=datetime.now) -> StreamingQuery:
    def merge(batch: DataFrame, number: int) -> None:
        store.upsert(acquire(batch, sources), first_seen(batch.sparkSession, f"{checkpoint}-seen/{number}", seen_at()))

    return pages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def activity(events: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Counts and sums of events(ts, event_type, value) by window and type; rows later than `late` are left out."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
