"""Bead position files in their several forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beadloom.functions.seq import BARCODE


def read_puck(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``sb, x, y``; a line of another shape fails the read."""
    return spark.read.schema("sb string, x double, y double").option("mode", "FAILFAST").csv(path)


def puck_faults(puck: DataFrame) -> DataFrame:
    """``n, n_null, n_length, n_repeated`` of a puck; all but the first must be 0."""
    many = F.count("*").over(Window.partitionBy("sb")) > 1
    p = puck.withColumn("many", many)
    return p.agg(
        F.count("*").alias("n"), F.count_if(F.col("sb").isNull() | F.col("x").isNull() | F.col("y").isNull()).alias("n_null"),
        F.count_if(F.length("sb") != BARCODE).alias("n_length"), F.count_if(F.col("many")).alias("n_repeated"),
    )


def read_bead_pair(spark: SparkSession, barcodes: str, locations: str) -> DataFrame:
    """``nth, sb, x, y`` from one file with a base per field and a bead per line, and one with a line of x and a line of y.

    The line's number comes from the file's order, so both small vendor files are read as one partition each.
    """
    line = lambda p: spark.read.text(p, wholetext=True).select(F.posexplode(F.filter(F.split("value", r"\r?\n"), lambda v: F.trim(v) != "")).alias("nth", "value"))
    sb = line(barcodes).select("nth", F.array_join(F.split("value", ","), "").alias("sb"))
    at = line(locations).select("nth", F.posexplode(F.split("value", ",")).alias("bead", "v"))
    axis = lambda k, name: at.filter(F.col("nth") == k).select(F.col("bead").alias("nth"), F.trim("v").try_cast("double").alias(name))
    return sb.join(axis(0, "x"), "nth", "left").join(axis(1, "y"), "nth", "left")


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """``id, sb, x, y`` of a vendor list with at least four fields; unusable numbers become null."""
    f = F.split("value", ",")
    rows = spark.read.text(path).filter(F.trim("value") != "").select(f.alias("f")).filter(F.size("f") >= 4)
    return rows.select(F.trim(F.col("f")[0]).alias("id"), F.trim(F.col("f")[1]).alias("sb"), *(F.trim(F.col("f")[k]).try_cast("double").alias(c) for k, c in ((2, "x"), (3, "y"))))


def tab_to_puck(spark: SparkSession, path: str, out: str) -> None:
    """A tab file with a header, ``barcode, x, y`` first, to a headerless puck file."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    df.select(*df.columns[:3]).write.mode("overwrite").csv(out, header=False)


def split_puck(puck: DataFrame) -> DataFrame:
    """``part, text``: barcodes with commas between bases, a line per bead, and both axes as one line each, in order of ``nth``."""
    bases = F.array_join(F.split("sb", ""), ",")
    ordered = F.array_sort(F.collect_list(F.struct("nth", bases.alias("b"), "x", "y")))
    one = puck.agg(ordered.alias("r"))
    text = lambda f, sep: F.array_join(F.transform("r", f), sep)
    both = F.array(F.struct(F.lit("barcodes").alias("part"), text(lambda s: s["b"], "\n").alias("text")),
                   F.struct(F.lit("locations").alias("part"), F.concat(text(lambda s: s["x"].cast("string"), ","), F.lit("\n"), text(lambda s: s["y"].cast("string"), ",")).alias("text")))
    return one.select(F.inline(both))
