"""Extension: transcripts as a stream, and sessions' activity by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemon.operators import archive


def message_stream(spark: SparkSession, path: str, schema: str, files_a_trigger: int = 100) -> DataFrame:
    """Message rows from Parquet files as they appear."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(path)


def activity(events: DataFrame, time: str = "ts", key: str = "event_type", every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window and key; rows later than ``late`` are dropped."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, every), key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select(F.col("window.start").alias("window_start"), key, "n", "total")
    )


def upsert_batches(stream: DataFrame, table: str, key: tuple[str, ...], checkpoint: str, parts: int = archive.PARTS):
    """A query that upserts each batch into the table at ``table``; a batch rewrites the parts that its keys fall into.

    A batch that runs again after a failure leaves the same rows.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)

    def put(batch: DataFrame, _: int) -> None:
        archive.put(batch, table, key, schema, parts)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
