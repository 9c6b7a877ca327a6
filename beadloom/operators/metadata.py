"""Sample sheets: which rows a run takes, duplicates and conflicts, library rows, completeness, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beadloom.functions.formats import cleaned

#: Columns that tell a sample; ``row_id`` and ``updated_at`` are only about the row.
CONTENT = [
    "run", "email", "sample_name", "bcl", "species", "chemistry", "rna_index", "lane", "sb_index", "sb_lane", "puck_id",
    "merge_rna_from_bcl", "merge_spatial_from_bcl", "add_rna_index", "add_sb_index", "add_puck_id", "cellranger", "flex_probe_barcode_ids",
]


def declares(column: str) -> Column:
    return cleaned(F.col(column)) != ""


def selected(rows: DataFrame) -> DataFrame:
    """Rows to be run: ``Run`` is YES or Y in any case."""
    return rows.filter(F.upper("run").isin("YES", "Y"))


def normal(rows: DataFrame) -> DataFrame:
    return rows.select("row_id", *(cleaned(F.col(c)).alias(c) for c in CONTENT))


def without_repeats(rows: DataFrame) -> DataFrame:
    """One row, the first, of every set of rows equal in all cleaned cells; copies are folded before anything is shuffled."""
    return normal(rows).groupBy(*CONTENT).agg(F.min("row_id").alias("row_id"), F.count("*").alias("n_rows")).select("row_id", "n_rows", *CONTENT)


def conflicts(rows: DataFrame) -> DataFrame:
    """``bcl, sample_name, n_versions, differing``: samples of a run told in different ways, with the columns that disagree."""
    one = without_repeats(rows)
    others = [c for c in CONTENT if c not in ("bcl", "sample_name")]
    # minimum and maximum differ where there is more than one value; no distinct sets are held
    agg = one.groupBy("bcl", "sample_name").agg(F.count("*").alias("n_versions"), *(F.when(F.min(c) != F.max(c), F.lit(c)).alias(c) for c in others))
    return agg.filter("n_versions > 1").select("bcl", "sample_name", "n_versions", F.array_join(F.array(*others), ",").alias("differing"))


def mixed_runs(rows: DataFrame) -> DataFrame:
    """Runs with more than one species or chemistry among their rows; missing values do not count."""
    s = normal(selected(rows))
    value = lambda c: F.when(F.col(c) != "", F.col(c))
    n = s.groupBy("bcl").agg(F.min(value("species")).alias("s0"), F.max(value("species")).alias("s1"), F.min(value("chemistry")).alias("c0"), F.max(value("chemistry")).alias("c1"))
    return n.select("bcl", F.coalesce(F.col("s0") != F.col("s1"), F.lit(False)).alias("many_species"), F.coalesce(F.col("c0") != F.col("c1"), F.lit(False)).alias("many_chemistries")).filter("many_species OR many_chemistries")


def library_rows(rows: DataFrame) -> DataFrame:
    """``bcl, sample, lane, index``: one row per lane of every library, spatial ones as ``_sb``."""
    s = normal(selected(rows))
    gex = s.filter("rna_index <> ''").select("bcl", F.col("sample_name").alias("sample"), F.explode(F.split("lane", ",")).alias("lane"), F.col("rna_index").alias("index")).filter("lane <> ''")
    sb = s.filter("sb_index <> ''").select("bcl", F.concat("sample_name", F.lit("_sb")).alias("sample"), F.explode(F.split("sb_lane", ",")).alias("lane"), F.col("sb_index").alias("index"))
    return gex.unionByName(sb)


def library_faults(rows: DataFrame) -> DataFrame:
    """``row_id, fault``: no index and nothing merged (``indexless``), or no spatial library (``no_spatial``)."""
    s = normal(selected(rows))
    a = s.filter("rna_index = '' AND merge_rna_from_bcl = ''").select("row_id", F.lit("indexless").alias("fault"))
    b = s.filter("sb_index = '' AND merge_spatial_from_bcl = ''").select("row_id", F.lit("no_spatial").alias("fault"))
    return a.unionByName(b)


def merged_runs(rows: DataFrame) -> DataFrame:
    """``bcl, other, nth``: further runs each run takes reads from, without repeats, RNA ones first, in order of the rows."""
    s = normal(selected(rows))
    both = s.select("bcl", F.expr("stack(2, 0, merge_rna_from_bcl, 1, merge_spatial_from_bcl) AS (kind, other)"), "row_id").filter("other <> '' AND other <> bcl")
    first = both.groupBy("bcl", "other").agg(F.min(F.struct("kind", "row_id")).alias("at"))
    return first.select("bcl", "other", F.row_number().over(Window.partitionBy("bcl").orderBy("at")).alias("nth"))


def missing_files(needed: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return needed.join(present, keys, "left_anti")


def freshness(stages: DataFrame) -> DataFrame:
    """``stage, state`` from ``stage, newest_input, oldest_output``: missing without output, fresh if every input is older, else stale."""
    state = F.when(F.col("oldest_output").isNull(), "missing").when(F.coalesce(F.col("newest_input") < F.col("oldest_output"), F.lit(False)), "fresh").otherwise("stale")
    return stages.select("stage", state.alias("state"))
