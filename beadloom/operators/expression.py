"""Expression counts in long form (cell, gene, n): normal forms, shares, tests and spatial autocorrelation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beadloom.operators.proximity import near_pairs


def cell_totals(counts: DataFrame) -> DataFrame:
    """``cell, n_counts, n_genes, pct_mt, log10_counts`` of every cell."""
    mt = F.sum(F.when(F.col("gene").rlike("^(MT-|mt-)"), F.col("n")).otherwise(0))
    return counts.filter("n > 0").groupBy("cell").agg(
        F.sum("n").alias("n_counts"), F.count("*").alias("n_genes"), (mt * 100.0 / F.sum("n")).alias("pct_mt"), F.log10(F.sum("n")).alias("log10_counts")
    )


def log_normal(counts: DataFrame, scale: float = 1e4) -> DataFrame:
    """``cell, gene, value``: logarithm of 1 plus the count as a share of the cell's counts, scaled."""
    total = counts.groupBy("cell").agg(F.sum("n").alias("total"))
    return counts.filter("n > 0").join(total, "cell").select("cell", "gene", F.log1p(F.col("n") / F.col("total") * scale).alias("value"))


def tf_idf(counts: DataFrame) -> DataFrame:
    """``cell, gene, value``: log of 1 plus 10 000 times the share of the cell times the number of cells over those that have the gene."""
    c = counts.filter("n > 0")
    total = c.groupBy("cell").agg(F.sum("n").alias("total"))
    have = c.groupBy("gene").agg(F.sum("n").alias("have"))
    cells = total.agg(F.count("*").alias("cells")).scalar()
    return c.join(total, "cell").join(have, "gene").select("cell", "gene", F.log1p(F.col("n") / F.col("total") * cells / F.col("have") * 1e4).alias("value"))


def variable_genes(normal: DataFrame, n_cells: DataFrame, k: int) -> DataFrame:
    """The ``k`` genes of most variance over all cells, absent ones as 0; ties by name. ``n_cells`` is one row, one column."""
    cells = n_cells.scalar()
    per = normal.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    var = (F.col("q") - F.col("s") * F.col("s") / cells) / (cells - 1)
    return per.select("gene", var.alias("variance")).orderBy(F.round("variance", 9).desc(), "gene").limit(k)


def rank_sums(normal: DataFrame, groups: DataFrame) -> DataFrame:
    """``grp, gene, u, n_in, n_out``: the rank-sum statistic of every gene, each group against the rest.

    Cells without the gene all tie at 0. Only present values are ranked, one gene at a time; the tied zeros enter
    by their number, so nothing is expanded to cells times genes.
    """
    size = groups.groupBy("grp").agg(F.count("*").alias("n_in"))
    cells = groups.agg(F.count("*").alias("c")).scalar()
    v = normal.filter("value > 0").join(groups, "cell").withColumn("value", F.round("value", 9))
    tied = v.groupBy("gene", "value").agg(F.count("*").alias("t"))
    below = F.sum("t").over(Window.partitionBy("gene").orderBy("value")) - F.col("t")
    ranked = tied.withColumn("below", below).withColumn("present", F.sum("t").over(Window.partitionBy("gene")))
    # average rank: zeros first, then smaller present values
    rank = ranked.select("gene", "value", "present", ((cells - F.col("present")) + F.col("below") + (F.col("t") + 1) / 2.0).alias("rank"))
    sums = v.join(rank, ["gene", "value"]).groupBy("grp", "gene").agg(F.sum("rank").alias("r"), F.count("*").alias("k"), F.first("present").alias("present"))
    zero = (cells - F.col("present") + 1) / 2.0
    met = sums.join(size, "grp")
    u = F.col("r") + (F.col("n_in") - F.col("k")) * zero - F.col("n_in") * (F.col("n_in") + 1) / 2.0
    return met.select("grp", "gene", u.alias("u"), "n_in", (cells - F.col("n_in")).alias("n_out"))


def morans_i(values: DataFrame, places: DataFrame, radius: float) -> DataFrame:
    """``gene, moran``: autocorrelation of each gene over cells, weight 1 for pairs at most ``radius`` apart; null without variance or pairs.

    ``values``: ``cell, gene, value`` of present values, absent ones count as 0; ``places``: ``cell, x, y``.
    With m the mean, the sum of (a-m)(b-m) over pairs is taken apart, so that only pairs with both values present and sums by degree are needed.
    """
    pairs = near_pairs(places.withColumn("g", F.lit(0)), radius, "g", "cell").select("a", "b")
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy(F.col("a").alias("cell")).agg(F.count("*").alias("d"))
    n, w = places.agg(F.count("*").alias("n")).scalar(), both.agg(F.count("*").alias("w")).scalar()
    v = values.join(places.select("cell"), "cell", "left_semi")
    per = v.join(degree, "cell", "left").groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"), F.sum(F.col("value") * F.coalesce("d", F.lit(0))).alias("sd"))
    cross = v.select(F.col("cell").alias("a"), "gene", F.col("value").alias("va")).join(both, "a").join(v.select(F.col("cell").alias("b"), "gene", F.col("value").alias("vb")), ["b", "gene"])
    prod = cross.groupBy("gene").agg(F.sum(F.col("va") * F.col("vb")).alias("p"))
    mean = F.col("s") / n
    top = F.coalesce("p", F.lit(0.0)) - 2 * mean * F.col("sd") + mean * mean * w
    low = F.col("q") - F.col("s") * F.col("s") / n
    return per.join(prod, "gene", "left").select("gene", F.when((low > 1e-12) & (w > 0), n * top / (w * low)).alias("moran"))
