"""Windows over event streams; the same plans run on a table or on a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def event_stream(spark: SparkSession, path: str, files: int = 16) -> DataFrame:
    """New Parquet files of a folder, as a stream."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def windowed_counts(events: DataFrame, ts: str, key: str, value: str, width: str, late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Rows and sum of values by window and key; a stream drops rows later than ``late``."""
    stamped = events.withColumn(ts, F.col(ts).cast("timestamp"))
    stamped = stamped.withWatermark(ts, late) if events.isStreaming else stamped
    grouped = stamped.groupBy(F.window(ts, width, slide) if slide else F.window(ts, width), key)
    counted = grouped.agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n", "total")


def sessions(events: DataFrame, ts: str, key: str, gap: str, late: str = "1 hour") -> DataFrame:
    """Sessions of a key that end after a gap."""
    stamped = events.withColumn(ts, F.col(ts).cast("timestamp"))
    stamped = stamped.withWatermark(ts, late) if events.isStreaming else stamped
    counted = stamped.groupBy(F.session_window(ts, gap), key).agg(F.count("*").alias("n"))
    return counted.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")


def sync_upserts(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand what is new to ``apply``, batch by batch, and stop; a rerun goes on where this one ended."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def parquet_upsert(path: str, keys: Sequence[str], order: str) -> Callable[[DataFrame, int], None]:
    """Batch function that keeps the newest row of each key in versioned Parquet folders under a path."""
    from strandline.operators.relational import latest_per_key

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = f"{path}/v{number - 1}"
        rows = batch if number == 0 else batch.unionByName(spark.read.parquet(before))
        newest = latest_per_key(rows.withColumn("__key", F.struct(*keys)), "__key", order, keys[0]).drop("__key")
        newest.write.mode("overwrite").parquet(f"{path}/v{number}")

    return apply
