"""Fuzzy dictionaries of barcodes, built by expanding the whitelist, and matching against them.

A key reached by two generated rows is ambiguous and gets index 0; an exact barcode overrides whatever was generated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beadloom.functions.seq import BARCODE, HALF, deletions, most_common
from beadloom.runtime import parts


def _changed(barcodes: DataFrame, length: int) -> DataFrame:
    """``barcodes`` (with ``barcode``) and ``form, pos``: every string with one other base of ACGTN.

    Two generators and a filter stay in generated code. A whitelist file is small and its forms are many: it is spread
    over all tasks first.
    """
    spread = barcodes.repartition(parts(barcodes.sparkSession), "barcode")
    at = spread.select("*", F.explode(F.array(*map(F.lit, range(1, length + 1)))).alias("pos"))
    each = at.select("*", F.explode(F.array(*map(F.lit, "ACGTN"))).alias("base")).filter(F.col("base") != F.substr("barcode", "pos", F.lit(1)))
    return each.withColumn("form", F.overlay("barcode", "base", F.col("pos"), F.lit(1))).drop("base")


def bead_dictionary(beads: DataFrame) -> DataFrame:
    """``sb1, sb2, sb_index, pos`` from ``sb_index, barcode`` (14 bases each).

    ``pos`` is 0 for an exact barcode, 1 to 14 for a substituted base, −1 to −8 for a deletion in the first half. A barcode with
    one N stands for all its expansions; one with more takes no part. The result is about 65 rows per barcode.
    """
    b = beads.filter(F.length("barcode") == BARCODE).select("sb_index", "barcode", F.length(F.regexp_replace("barcode", "[^N]", "")).alias("n"))
    clean, one_n = b.filter("n = 0"), b.filter("n = 1")
    halves = lambda f: (F.substring(f, 1, HALF).alias("sb1"), F.substring(f, HALF + 1, BARCODE - HALF).alias("sb2"))
    changed = _changed(clean.select("sb_index", "barcode"), BARCODE).select(*halves("form"), "sb_index", "pos")
    shorter = clean.select("sb_index", "barcode", F.inline(deletions(F.substring("barcode", 1, HALF), HALF))).select(
        F.col("form").alias("sb1"), F.substring("barcode", HALF + 1, BARCODE - HALF).alias("sb2"), "sb_index", (-F.col("pos")).alias("pos")
    )
    forms = F.array(F.col("barcode"), *(F.replace("barcode", F.lit("N"), F.lit(x)) for x in "ACGT"))
    open_n = one_n.select("sb_index", F.instr("barcode", "N").alias("pos"), F.explode(forms).alias("form")).select(*halves("form"), "sb_index", "pos")
    exact = clean.select(*halves("barcode"), "sb_index", F.lit(0).alias("pos"))
    # exact rows win inside one aggregation, which spares an anti-join
    every = changed.unionByName(shorter).unionByName(open_n).unionByName(exact)
    is_exact = F.col("pos") == 0
    keyed = every.groupBy("sb1", "sb2").agg(F.max(F.when(is_exact, F.col("sb_index"))).alias("own"), F.count("*").alias("n"), F.min("sb_index").alias("sb_index"), F.min("pos").alias("pos"))
    return keyed.select(
        "sb1", "sb2", F.when(F.col("own").isNotNull(), F.col("own")).when(F.col("n") > 1, 0).otherwise(F.col("sb_index")).alias("sb_index"),
        F.when(F.col("own").isNotNull() | (F.col("n") > 1), 0).otherwise(F.col("pos")).alias("pos"),
    )


def deletion_dictionary(beads: DataFrame) -> DataFrame:
    """``sb1, sb2, sb_index, pos``: first half as it is, second half with one base left out (5 bases), pos −9 to −14."""
    tail = BARCODE - HALF
    made = beads.filter((F.length("barcode") == BARCODE) & ~F.col("barcode").contains("N")).select(
        F.substring("barcode", 1, HALF).alias("sb1"), "sb_index", F.inline(deletions(F.substring("barcode", HALF + 1, tail), tail))
    )
    keyed = made.groupBy("sb1", F.col("form").alias("sb2")).agg(F.count("*").alias("n"), F.min("sb_index").alias("sb_index"), F.min("pos").alias("pos"))
    several = F.col("n") > 1
    return keyed.select("sb1", "sb2", F.when(several, 0).otherwise(F.col("sb_index")).alias("sb_index"), F.when(several, 0).otherwise(-(F.col("pos") + HALF)).alias("pos"))


def match_beads(reads: DataFrame, beads: DataFrame) -> DataFrame:
    """``reads`` (with ``sb1, sb2``) and ``sb_index, pos, match``: the full key first, then the deletion key if that missed.

    ``reads`` is read twice, so it should be narrow and written (``cut``), best as counts per key. Keys are looked up, not reads: each distinct
    key once, whatever the number of its reads; what the full key has settled meets no deletion key. Reads then take the answer of their key.
    """
    keys = reads.select("sb1", "sb2").distinct()
    one = bead_dictionary(beads).withColumnsRenamed({"sb_index": "i1", "pos": "p1"})
    two = deletion_dictionary(beads).select("sb1", F.col("sb2").alias("tail"), F.col("sb_index").alias("i2"), F.col("pos").alias("p2"))
    # a settled key gets a tail that no bead has, its own, so that settled keys stay spread
    asked = keys.join(one, ["sb1", "sb2"], "left").withColumn("tail", F.when(F.col("i1").isNull(), F.substring("sb2", 1, 5)).otherwise(F.concat(F.lit("-"), "sb2")))
    met = asked.join(two, ["sb1", "tail"], "left")
    match = (
        F.when((F.col("i1") > 0) & (F.col("p1") == 0), "exact").when(F.col("i1") > 0, "HD1").when(F.col("i1") == 0, "HD1ambig")
        .when(F.col("i2") > 0, "SB2del").when(F.col("i2") == 0, "SB2delambig").otherwise("none")
    )
    told = met.select("sb1", "sb2", F.nullif(F.coalesce("i1", "i2"), F.lit(0)).alias("sb_index"), F.coalesce("p1", "p2").alias("pos"), match.alias("match"))
    return reads.join(told, ["sb1", "sb2"], "left")


def cell_matches(observed: DataFrame, whitelist: DataFrame, length: int) -> DataFrame:
    """``cb_index, match, cell``: each observed barcode's whitelist position, exact, by one other base, or ambiguous.

    ``observed``: ``cb_index, barcode``; ``whitelist``: ``cell, barcode``, both unique. Neighbours are made from the observed side's
    whitelist only, so 64 rows per whitelist entry meet the observed barcodes by equality. Both joins are by sorted partitions, at any size: the
    planner takes the neighbours for as small as the whitelist they are made of, and would collect and broadcast all 64 rows an entry.
    """
    exact = whitelist.select("barcode", F.col("cell").alias("own"))
    near = _changed(whitelist.select("cell", "barcode"), length).groupBy(F.col("form").alias("barcode")).agg(F.count("*").alias("n"), F.min("cell").alias("near"))
    met = observed.join(exact.hint("merge"), "barcode", "left").join(near.hint("merge"), "barcode", "left")
    match = F.when(F.col("own").isNotNull(), "exact").when(F.col("n") == 1, "HD1").when(F.col("n") > 1, "HD1ambig").otherwise("none")
    return met.select("cb_index", match.alias("match"), F.coalesce("own", F.when(F.col("n") == 1, F.col("near"))).alias("cell"))


def low_complexity(barcode: str) -> Column:
    """Whether one base makes up more than four fifths of the barcode (rounded down)."""
    return most_common(barcode) > F.floor(F.length(barcode) * 0.8)


def blocked_edit_match(observed: DataFrame, beads: DataFrame, blocks: tuple[tuple[int, int], ...] = ((1, 6), (5, 6), (9, 6))) -> DataFrame:
    """``barcode, bead, distance``: exact, else the bead within edit distance 1 that shares a block.

    ``observed``: distinct ``barcode``; ``beads``: distinct ``bead``; beads of low complexity take no part. Two strings are within one edit
    only if they are equal after at most one base is left out of each, so candidates meet by equality of these forms, 15 a barcode, and
    their number does not grow with the product of both sides. Of several, the closest wins, then one with the same last base, then the
    smaller barcode.
    """
    beads = beads.filter(~low_complexity("bead"))
    exact = observed.join(beads, F.col("barcode") == F.col("bead")).select("barcode", "bead", F.lit(0).alias("distance"))
    left = observed.join(beads, F.col("barcode") == F.col("bead"), "left_anti")

    def forms(c: str) -> Column:
        shorter = F.transform(F.sequence(F.lit(1), F.length(c)), lambda k: F.overlay(F.col(c), F.lit(""), k, F.lit(1)))
        return F.explode(F.array_distinct(F.concat(F.array(c), shorter))).alias("form")

    same = lambda a, n: F.substring("barcode", a, n) == F.substring("bead", a, n)
    met = left.select("barcode", forms("barcode")).join(beads.select("bead", forms("bead")), "form").select("barcode", "bead").distinct()
    near = met.filter((F.levenshtein("barcode", "bead", 1) == 1) & reduce(lambda x, y: x | y, (same(a, n) for a, n in blocks))).withColumn("distance", F.lit(1))
    rank = F.struct("distance", (F.substring("barcode", -1, 1) != F.substring("bead", -1, 1)).alias("end"), "bead")
    best = near.groupBy("barcode").agg(F.min(rank).alias("best")).select("barcode", "best.bead", "best.distance")
    return exact.unionByName(best)
