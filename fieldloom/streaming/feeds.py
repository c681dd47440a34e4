"""The feeds as streams: an addition to the batch pipeline, with the same results on the same files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def parquet_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def text_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """New tab-separated files of a folder as they come; malformed numbers become nulls."""
    return spark.readStream.schema(schema).option("sep", "\t").option("quote", "").option("maxFilesPerTrigger", files_per_trigger).csv(path)


def first_deliveries(events: DataFrame, key: str, time: str, wait: str = "1 day") -> DataFrame:
    """Each key once; state is kept for ``wait`` behind the newest time only."""
    return events.withWatermark(time, wait).dropDuplicatesWithinWatermark([key])


def window_counts(events: DataFrame, time: str, group: str, value: str, size: str = "15 minutes", wait: str = "1 day") -> DataFrame:
    """Rows and sum of ``value`` per window and group; a window comes out once it can't change."""
    counted = events.withWatermark(time, wait).groupBy(F.window(time, size).alias("w"), group).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return counted.select(F.col("w.start").alias("start"), group, "n", "total")


def upsert_periods(stream: DataFrame, path: str, checkpoint: str, period: str = "period") -> StreamingQuery:
    """Writes each batch into its period's folder, everything available now."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period, "batch").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
