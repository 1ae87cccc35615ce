"""Landing as a stream, and streamed weekly sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.landing import RAW
from ledgerloom.sources.versioned import merge_table


def land_available(spark: SparkSession, root: str, path: str, checkpoint: str) -> None:
    """Merges every record file that hasn't been merged yet into the versioned table at ``path``, then stops.
    A batch rewrites only the buckets it touches; readers see the table before or after it."""
    rows = spark.readStream.schema(RAW).option("recursiveFileLookup", True).json(root).filter("payload is not null")

    def merge(batch: DataFrame, _: int) -> None:
        merge_table(batch, path, ["_merge_key", "_source_endpoint"], [F.desc("_ingested_at"), F.desc("_row_hash")])

    rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def weekly(events: DataFrame, time: str, value: str, by: list[str], late: str = "1 hour") -> DataFrame:
    """Sums by tumbling week from Monday; late records count up to the watermark. Batch or stream."""
    if events.isStreaming:
        events = events.withWatermark(time, late)
    week = F.window(time, "7 days", startTime="4 days")  # the epoch was a Thursday
    return events.groupBy(week.alias("w"), *by).agg(F.sum(value).alias("amount"), F.count("*").alias("records")).select(F.to_date("w.start").alias("week_start"), *by, "amount", "records")


def distinct_events(events: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
