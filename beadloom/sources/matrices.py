"""Expression matrices: MatrixMarket text, compressed columns, unique names, pages and wide summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beadloom.runtime import beside


def read_market(spark: SparkSession, path: str) -> DataFrame:
    """``row, col, value`` (from 1) of a MatrixMarket file: comments and the line of sizes left out."""
    t = spark.read.text(path).filter(~F.col("value").startswith("%")).select(F.split(F.trim("value"), r"\s+").alias("f"), F.monotonically_increasing_id().alias("at"))
    body = t.filter(F.col("at") > t.agg(F.min("at")).scalar())
    return body.select(*(F.col("f")[k].cast("long").alias(c) for k, c in ((0, "row"), (1, "col"), (2, "value"))))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """``nth`` (from 1) and the tab-separated fields ``f`` of each line, in the file's order."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.filter(F.split("value", r"\r?\n"), lambda v: v != "")).alias("k", "line"))
    return lines.select((F.col("k") + 1).cast("long").alias("nth"), F.split("line", "\t").alias("f"))


def named_matrix(market: DataFrame, genes: DataFrame, cells: DataFrame) -> DataFrame:
    """``gene, cell, value`` by the 1-based places in both name lists."""
    g = genes.select(F.col("nth").alias("row"), F.col("f")[0].alias("gene"))
    c = cells.select(F.col("nth").alias("col"), F.col("f")[0].alias("cell"))
    return market.join(g, "row").join(c, "col").select("gene", "cell", "value")


def transposed(market: DataFrame) -> DataFrame:
    return market.select(F.col("col").alias("row"), F.col("row").alias("col"), "value")


def from_columns(indptr: DataFrame, indices: DataFrame) -> DataFrame:
    """Entries of a compressed-column matrix: ``indptr`` is ``nth, start`` (from 0, one more than columns), ``indices`` is ``at, row, value``.

    Each column's range is opened and joined by place, which is linear in the entries.
    """
    w = Window.orderBy("nth")  # one row per column, not per entry
    span = indptr.withColumn("stop", F.lead("start").over(w)).filter("stop > start")
    at = span.select(F.col("nth").alias("col"), F.explode(F.sequence("start", F.col("stop") - 1)).alias("at"))
    return at.join(indices, "at").select("row", "col", "value")


def unique_names(names: DataFrame) -> DataFrame:
    """``nth, name``: a name that comes again gets ``.1``, ``.2`` and so on, in order of ``nth``."""
    k = F.row_number().over(Window.partitionBy("name").orderBy("nth")) - 1
    return names.select("nth", F.when(k > 0, F.concat("name", F.lit("."), k.cast("string"))).otherwise(F.col("name")).alias("name"))


def wide_to_long(wide: DataFrame) -> DataFrame:
    """One wide row to ``metric, value`` pairs of text."""
    text = wide.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in wide.columns))
    return text.unpivot([], text.columns, "metric", "value")


def page_data(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The JSON after ``const data =`` of report pages."""
    body = F.regexp_extract("value", r"(?s)const data = (\{.*?\});?\s*</script>", 1)
    return spark.read.text(path, wholetext=True).select(F.from_json(body, schema).alias("data"))


def sniffed_rows(spark: SparkSession, path: str) -> DataFrame:
    """``nth, f`` of a sheet separated by semicolon, tab or comma, whichever its first line has first in that order; comments and blanks left out."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", "^﻿", ""), r"\r?\n")).alias("nth", "line"))
    kept = lines.filter((F.trim("line") != "") & ~F.col("line").startswith("#"))
    sep = F.when(F.col("head").contains(";"), ";").when(F.col("head").contains("\t"), "\t").otherwise(",")
    head = kept.agg(F.min_by("line", "nth").alias("head")).select(sep.alias("sep"))
    cut = lambda s: F.transform(F.split("line", s), lambda v: F.trim(v))
    return beside(kept, head).select("nth", F.when(F.col("sep") == ";", cut(";")).when(F.col("sep") == "\t", cut("\t")).otherwise(cut(",")).alias("f"))
