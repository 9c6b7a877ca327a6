"""What is written, and how."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_matrix(molecules: DataFrame, folder: str) -> None:
    """The molecule matrix, sorted by cell inside each file so that readers of one cell skip the rest."""
    molecules.repartition("cb_index").sortWithinPartitions("cb_index", "umi_2bit").write.mode("overwrite").parquet(folder)


def write_csv(df: DataFrame, folder: str, header: bool = True, gzip: bool = False) -> None:
    df.write.mode("overwrite").option("header", header).option("compression", "gzip" if gzip else "none").csv(folder)


def write_market(entries: DataFrame, folder: str, n_rows: int, n_cols: int) -> None:
    """Entries ``row, col, value`` as text, the head with the sizes as a file of its own, first by name."""
    n = entries.count()
    spark = entries.sparkSession
    head = spark.createDataFrame([("%%MatrixMarket matrix coordinate integer general",), (f"{n_rows} {n_cols} {n}",)], "value string").coalesce(1)
    head.write.mode("overwrite").text(f"{folder}/0_head")
    entries.select(F.concat_ws(" ", "row", "col", "value").alias("value")).write.mode("overwrite").text(f"{folder}/1_body")


def metadata_json(counts: DataFrame) -> DataFrame:
    """``section, key, value`` rows to one JSON text of a map per section."""
    per = counts.groupBy("section").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("m"))
    return per.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("section", F.to_json("m").alias("j")))))).alias("json"))
