"""Journal as a stream: file source, exact re-deliveries dropped inside a watermark, upsert by key in each micro-batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.operators.ingest import replay_journal
from foliospark.sources.shared import shared_folder


def stream_of(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)


def deduplicated(stream: DataFrame, key: list[str], event_time: str, late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(key)


def upsert_sink(target: str, key: str, order: list[str], ok: str):
    """A foreachBatch function: merges a batch into versioned Parquet; a batch that is run again gives the same version."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if number:
            rows = spark.read.schema(batch.schema).parquet(f"{target}/v{number - 1}").unionByName(batch)
        replay_journal(rows, key, order, ok).select(*batch.columns).write.mode("overwrite").parquet(f"{target}/v{number}")

    return merge


def replay_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last state of each user after the events table has run through the stream."""
    root = shared_folder(spark)
    target = f"{root}/journal-{uuid.uuid4().hex[:12]}"
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # One table may be one file or a folder of files; the glob takes both.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    fresh = deduplicated(stream.withColumn("ts", F.col("ts").cast("timestamp")), ["event_id"], "ts").withColumn("ok", F.col("event_type") != "error")
    sink = upsert_sink(f"{target}/state", "user_id", ["ts", "event_id"], "ok")
    run = fresh.writeStream.outputMode("append").option("checkpointLocation", f"{target}/log").trigger(availableNow=True).foreachBatch(sink).start()
    run.awaitTermination()
    last = run.lastProgress["batchId"]
    return spark.read.parquet(f"{target}/state/v{last}")
