"""Incremental extraction: new page images as a stream.

The stream's checkpoint takes the place of the test for existing outputs. Extraction is
run a micro-batch at a time and its raw output is written by batch id, so a batch that is
run again overwrites itself. Pairing stays a batch step: a block closes at a manual's end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsloom.config import Config
from partsloom.functions.text import page_of_name
from partsloom.operators.extract import extract, sanitized

_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def image_stream(spark: SparkSession, path: str, per_batch: int = 1000) -> DataFrame:
    """(pdf_id, page_number, png) of images below `path` as they arrive."""
    files = spark.readStream.format("binaryFile").schema(_SCHEMA).option("pathGlobFilter", "*.png").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_batch).load(path)
    part = lambda n: F.element_at(F.split("path", "/"), -n)
    return files.select(part(3).alias("pdf_id"), page_of_name(part(1), "png").alias("page_number"), F.col("content").alias("png"))


def start(spark: SparkSession, path: str, out: str, checkpoint: str, cfg: Config, per_batch: int = 1000):
    """Runs over what is there and ends; call again, or replace the trigger, to go on."""

    def batch(df: DataFrame, number: int) -> None:
        sanitized(extract(df, cfg)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = image_stream(spark, path, per_batch).writeStream.foreachBatch(batch)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(rows: DataFrame, time: str = "received_at", late: str = "1 day", window: str = "1 hour") -> DataFrame:
    """Rows a window and source, with a watermark: late rows within `late` still count."""
    return rows.withWatermark(time, late).groupBy(F.window(time, window), "source").agg(F.count("*").alias("n"))


def arrivals_run(stream: DataFrame, out: str, checkpoint: str, time: str = "received_at") -> DataFrame:
    """(hour, source, n) of all rows a stream has brought so far, after a run over what is there.

    State and watermark live in the checkpoint: a later run goes on from there, late rows within the watermark still
    count, and each batch writes the windows it changed. The last count of a window holds.
    """

    def save(df: DataFrame, number: int) -> None:
        rows = df.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "source", "n")
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    run = arrivals(timed, time).writeStream.outputMode("update").foreachBatch(save)
    run.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    rows = stream.sparkSession.read.parquet(out)
    return rows.groupBy("hour", "source").agg(F.max_by("n", "batch").alias("n"))
