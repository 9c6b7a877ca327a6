"""Molecule counts over a stream of read or molecule files. An extension: the batch path needs none of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def molecule_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def running_counts(stream: DataFrame) -> DataFrame:
    """Reads per cell, UMI and bead; partial sums are kept as state, one row per molecule."""
    rows = stream.filter("cb_index IS NOT NULL AND umi_2bit IS NOT NULL AND sb_index IS NOT NULL")
    return rows.groupBy("cb_index", "umi_2bit", "sb_index").agg(F.coalesce(F.sum("reads"), F.lit(0)).alias("reads"))


def daily_counts(stream: DataFrame, late: str = "30 days") -> DataFrame:
    """Rows and reads per run and day of loading; days older than the watermark leave the state and later rows of them are dropped."""
    rows = stream.withColumn("at", F.col("loaded_at").cast("timestamp")).withWatermark("at", late)
    return rows.groupBy(F.window("at", "1 day").alias("w"), "bcl").agg(F.count("*").alias("n"), F.coalesce(F.sum("reads"), F.lit(0)).alias("reads")).select(F.col("w.start").alias("day"), "bcl", "n", "reads")


def start(df: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> StreamingQuery:
    """Everything there is, then stop; the checkpoint makes a second start go on where the first ended."""
    return df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
