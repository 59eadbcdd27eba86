"""Structured Streaming form of the sequence count: files are counted as they arrive, and a restart goes on from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lexiforge.functions.text import pystrip


def arriving_texts(spark: SparkSession, folder: str, schema: StructType, text: str = "text", files_per_trigger: int = 64) -> DataFrame:
    """Texts of Parquet files that arrive in a folder; each file is read once."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return rows.select(pystrip(F.col(text)).alias("text")).where("text <> ''")


def partial_counts(texts: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Counts of each micro-batch, appended as partial counts with the batch's number.

    No state is kept: partial counts merge in ``merged`` like those of any two shards. A batch that is run again overwrites itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.groupBy("text").agg(F.count("*").alias("count")).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return texts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(spark: SparkSession, target: str) -> DataFrame:
    """(text, count) over all batches so far."""
    return spark.read.parquet(target).groupBy("text").agg(F.sum("count").alias("count"))


def running_counts(texts: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """The same as a stateful aggregation in update mode, for alphabets of bounded size such as characters or languages."""
    return texts.groupBy("text").count().writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events of each type in tumbling windows; rows later than the watermark are dropped by Spark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
