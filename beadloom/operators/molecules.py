"""From molecules (cell, UMI, bead, reads) to the cell-bead table: chimeras, bead checks, cut-offs, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beadloom.functions.seq import longest_run, most_common
from beadloom.runtime import cut


def matrix(rows: DataFrame) -> DataFrame:
    """One row per cell, UMI and bead with its reads; rows without one of the three are left out, null reads count 0."""
    return rows.filter("cb_index IS NOT NULL AND umi_2bit IS NOT NULL AND sb_index IS NOT NULL").groupBy("cb_index", "umi_2bit", "sb_index").agg(F.coalesce(F.sum("reads"), F.lit(0)).alias("reads"))


def flag_chimeras(m: DataFrame) -> DataFrame:
    """``chimeric``: not the one bead of its cell and UMI with the most reads; a tie at the top makes all of them chimeric.

    One aggregation per cell and UMI finds the largest count and how often it occurs, which needs no sort.
    """
    w = Window.partitionBy("cb_index", "umi_2bit")
    top = F.max("reads").over(w)
    ties = F.sum(F.when(F.col("reads") == F.col("top"), 1).otherwise(0)).over(w)
    return m.withColumn("top", top).withColumn("chimeric", (F.col("reads") < F.col("top")) | (ties > 1)).drop("top")


def bead_checks(puck: DataFrame) -> DataFrame:
    """Puck rows (``sb`` trimmed, upper case) with ``is_dup, is_n, is_degenerate``; rows without a barcode or a place are left out."""
    p = puck.filter("sb IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)").withColumn("sb", F.upper(F.trim("sb")))
    # counted first and joined back: a barcode of very many rows leaves each task as one count, and the join may be split
    dups = p.groupBy("sb").agg(F.count("*").alias("n")).filter("n > 1").select("sb", F.lit(True).alias("dup"))
    met = p.join(dups, "sb", "left")
    return met.select("bead_id", "sb", "x", "y", "puck_index", F.coalesce("dup", F.lit(False)).alias("is_dup"), F.col("sb").contains("N").alias("is_n"), ((most_common("sb") > 10) | (longest_run("sb") > 7)).alias("is_degenerate"))


def scale_of(n: Column) -> Column:
    """Micrometres per unit by the number of beads of a puck."""
    return F.when(n < 150_000, 0.73).when(n < 600_000, 1.46).otherwise(0.645)


def lay_out(puck: DataFrame) -> DataFrame:
    """Good beads in micrometres, pucks side by side along x without gaps: ``bead_id, sb, puck_index, x_um, y_um``.

    The running offset is made over one row per puck, not over beads.
    """
    checked = bead_checks(puck)
    per = puck.groupBy("puck_index").agg(F.count("*").alias("n"))
    good = checked.filter("NOT is_dup AND NOT is_n AND NOT is_degenerate").join(per, "puck_index")
    um = cut(good.select("bead_id", "sb", "puck_index", (F.col("x") * scale_of(F.col("n"))).alias("x"), (F.col("y") * scale_of(F.col("n"))).alias("y")))
    edge = um.groupBy("puck_index").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"))
    before = F.coalesce(F.sum(F.col("x1") - F.col("x0")).over(Window.orderBy("puck_index").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return um.join(edge.withColumn("start", before), "puck_index").select("bead_id", "sb", "puck_index", (F.col("x") - F.col("x0") + F.col("start")).alias("x_um"), (F.col("y") - F.col("y0")).alias("y_um"))


def placed_beads(puck: DataFrame, sb_list: DataFrame) -> DataFrame:
    """``sb_index, x_um, y_um, puck_index`` of the good beads of the whitelist."""
    return lay_out(puck).join(sb_list.select("sb_index", F.col("barcode").alias("sb")), "sb").select("sb_index", "x_um", "y_um", "puck_index")


def staged(m: DataFrame, good: DataFrame) -> DataFrame:
    """Molecules with the first stage that drops them: ``chimeric``, ``lowQsb``, ``uncalled``, else ``final``."""
    met = flag_chimeras(m).join(good.select("sb_index", F.lit(True).alias("known")), "sb_index", "left")
    stage = F.when(F.col("chimeric"), "chimeric").when(F.col("known").isNull(), "lowQsb").when(F.col("cb_index") <= 0, "uncalled").otherwise("final")
    return met.withColumn("stage", stage).drop("known", "chimeric")


def count_umis(m: DataFrame) -> DataFrame:
    """``cb_index, sb_index, umi``: rows with reads per cell and bead."""
    return m.filter("reads > 0").groupBy("cb_index", "sb_index").agg(F.count("*").alias("umi"))


def umi_cutoff(per_bead: DataFrame, top_percent: float = 1.0) -> DataFrame:
    """One row ``cutoff``: the exact interpolated quantile of ``umi`` above which beads are dropped."""
    return per_bead.agg(F.percentile("umi", 1 - top_percent / 100).alias("cutoff"))


def cell_beads(m: DataFrame, beads: DataFrame, top_percent: float | None = 1.0) -> DataFrame:
    """``cb_index, x_um, y_um, umi`` of called cells, without chimeras, unknown beads and the beads of most UMIs.

    Beads and counts are each read more than once below, and written once: one row per bead, and one per cell and bead.
    """
    beads = cut(beads)
    kept = staged(m, beads).filter("stage = 'final'")
    counts = count_umis(kept) if top_percent is None else cut(count_umis(kept))
    if top_percent is not None:
        per_bead = counts.groupBy("sb_index").agg(F.sum("umi").alias("umi"))
        high = per_bead.filter(F.col("umi") > umi_cutoff(per_bead, top_percent).scalar()).select("sb_index")
        counts = counts.join(high, "sb_index", "left_anti")
    return counts.join(beads, "sb_index").select("cb_index", "x_um", "y_um", "umi")


def expected_saturation(m: DataFrame, fractions: list[float]) -> DataFrame:
    """``fraction, reads, umis``: expected molecules when that share of reads is drawn without replacement.

    Molecules are first grouped by depth, so the sum runs over one row per depth. ``v`` molecules of depth ``k`` lose
    one with the chance that none of its reads is drawn.
    """
    depth = m.filter("reads > 0").groupBy(F.col("reads").alias("k")).agg(F.count("*").alias("v"))
    each = depth.withColumn("fraction", F.explode(F.array(*map(F.lit, fractions))))
    k, v = F.col("k").cast("double"), F.col("v").cast("double")
    # draws from this depth class; 1 - C(kv - k, n) / C(kv, n) by log-gamma is a product over k factors
    n = F.round(k * v * F.col("fraction"))
    missed = F.aggregate(F.sequence(F.lit(0), F.col("k").cast("int") - 1), F.lit(1.0), lambda p, i: p * F.greatest(F.lit(0.0), (k * v - n - i) / (k * v - i)))
    return each.groupBy("fraction").agg(F.sum(n).cast("long").alias("reads"), F.sum(v * (1 - missed)).alias("umis"))


def under_cap(counts: DataFrame, cap: int) -> DataFrame:
    """Cell-bead rows of beads with fewer than ``cap`` UMIs over all cells."""
    total = F.sum("umi").over(Window.partitionBy("sb_index"))
    return counts.withColumn("t", total).filter(F.col("t") < cap).drop("t")
