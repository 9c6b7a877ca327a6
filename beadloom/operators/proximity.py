"""Points near points, and points inside regions, by ranges of a space-filling curve.

Cells of a square grid get a Z-order number: the bits of the two cell coordinates, interleaved. A
disc or rectangle covers a few cells; their numbers, sorted and joined where they follow one another,
are a few closed ranges. The range join meets in aligned blocks of the curve (its high bits): a range
is cut at block borders, blocks are matched by equality, and the remaining low bits by comparison.
What meets is then checked with exact distances.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beadloom.runtime import cut

#: Cell coordinates are clamped to 30 bits and moved to be non-negative.
_HALF = 1 << 29


def grid(v: Column, side: float) -> Column:
    """Cell coordinate of ``v``; far values share the outermost cells, which keeps neighbours neighbours."""
    return F.greatest(F.lit(-_HALF), F.least(F.lit(_HALF - 1), F.floor(v / side))).cast("long") + _HALF


def spread(v: Column) -> Column:
    """The bits of ``v`` with a zero before each: its binary digits read in base 4. ``v`` stands in it once, so expressions stay small."""
    return F.conv(F.bin(v), 4, 10).cast("long")


def z_order(ix: Column, iy: Column) -> Column:
    """Interleaved bits of two non-negative cell coordinates below 2^30."""
    return spread(ix).bitwiseOR(F.shiftleft(spread(iy), 1))


def z_ranges(cells: str) -> Column:
    """Column of sorted distinct cell numbers → array of closed ranges ``(lo, hi)`` of consecutive numbers.

    A range begins where the number before is not in the array and ends where the next is not. The numbers must be a column of
    their own, so that they are made once.
    """
    c = F.col(cells)
    lo = F.filter(c, lambda x, i: (i == 0) | (F.get(c, i - 1) != x - 1))
    hi = F.filter(c, lambda x, i: (i == F.size(c) - 1) | (F.get(c, i + 1) != x + 1))
    return F.arrays_zip(lo.alias("lo"), hi.alias("hi"))


def _has_place(x: str = "x", y: str = "y") -> Column:
    """Neither null nor NaN; an infinite place is near nothing and is left out as well."""
    inf = F.lit(float("inf"))
    return ~F.isnan(x) & ~F.isnan(y) & (F.abs(F.col(x)) < inf) & (F.abs(F.col(y)) < inf)


def box_cells(x0: Column, x1: Column, y0: Column, y1: Column, side: float) -> Column:
    """Sorted numbers of the cells that the closed rectangle touches; digits of each row and column are spread once."""
    xs = F.transform(F.sequence(grid(x0, side), grid(x1, side)), lambda a: spread(a))
    ys = F.transform(F.sequence(grid(y0, side), grid(y1, side)), lambda b: F.shiftleft(spread(b), 1))
    return F.array_sort(F.flatten(F.transform(xs, lambda a: F.transform(ys, lambda b: a.bitwiseOR(b)))))


def near_pairs(points: DataFrame, radius: float, group: str, ident: str, block_bits: int = 4) -> DataFrame:
    """All pairs of points of one ``group`` at most ``radius`` apart, each once: ``group, a, b, gap2`` with a < b.

    ``points`` has ``group``, the unique ``ident`` and doubles ``x, y``. A point with a null group or
    without a place has no neighbour. Two points at one place are 0 apart. An empty input gives no pairs.
    """
    side = 2 * radius if radius > 0 else 1.0
    p = points.filter(_has_place() & F.col(group).isNotNull()).select(F.col(group).alias("g"), F.col(ident).alias("id"), "x", "y")
    cells = p.withColumn("code", z_order(grid(F.col("x"), side), grid(F.col("y"), side)))
    right = cells.select(F.col("g"), F.shiftright("code", block_bits).alias("block"), "code", F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"))
    disc = box_cells(F.col("x") - radius, F.col("x") + radius, F.col("y") - radius, F.col("y") + radius, side)
    covered = p.select("g", F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), disc.alias("cells"))
    left = covered.select("g", "a", "ax", "ay", F.inline(z_ranges("cells"))).select("g", "a", "ax", "ay", "lo", "hi", F.explode(F.sequence(F.shiftright("lo", block_bits), F.shiftright("hi", block_bits))).alias("block"))
    gap2 = (F.col("ax") - F.col("bx")) * (F.col("ax") - F.col("bx")) + (F.col("ay") - F.col("by")) * (F.col("ay") - F.col("by"))
    met = left.join(right, ["g", "block"]).filter((F.col("a") < F.col("b")) & F.col("code").between(F.col("lo"), F.col("hi")))
    return met.select(F.col("g").alias(group), "a", "b", gap2.alias("gap2")).filter(F.col("gap2") <= radius * radius)


#: Cells of a side that a rectangle is covered with, at most one more.
COVER = 8


def points_in_boxes(points: DataFrame, boxes: DataFrame, side: float, block_bits: int = 6) -> DataFrame:
    """Points inside closed rectangles of the same group: ``ident, box``.

    ``points``: ``g, ident, x, y``; ``boxes``: ``g, box, x0, x1, y0, y1``. A rectangle with a null bound or
    with its bounds exchanged holds nothing. A point on an edge shared by two rectangles is in both. Each rectangle is covered with cells of
    its own level of the curve, ``side`` wide or a power of two times that, so that at most 81 cells cover it, however large it is. A
    point stands once for each level that some rectangle has, of which there are at most 30.
    """
    b = boxes.filter("x0 <= x1 AND y0 <= y1")
    b = b.select("g", "box", "x0", "x1", "y0", "y1", *(grid(F.col(c), side).alias(f"c{c}") for c in ("x0", "x1", "y0", "y1")))
    cells = F.greatest(F.col("cx1") - F.col("cx0"), F.col("cy1") - F.col("cy0")) + 1
    b = b.withColumn("level", F.greatest(F.lit(0), F.ceil(F.log2(cells / COVER))).cast("int"))
    levels = [r["level"] for r in b.select("level").distinct().collect()]  # at most 30 numbers
    at = lambda c: F.expr(f"shiftright({c}, level)")
    xs = F.transform(F.sequence(at("cx0"), at("cx1")), lambda a: spread(a))
    ys = F.transform(F.sequence(at("cy0"), at("cy1")), lambda a: F.shiftleft(spread(a), 1))
    b = b.withColumn("cells", F.array_sort(F.flatten(F.transform(xs, lambda a: F.transform(ys, lambda c: a.bitwiseOR(c))))))
    b = b.select("g", "box", "x0", "x1", "y0", "y1", "level", F.inline(z_ranges("cells")))
    b = b.withColumn("block", F.explode(F.sequence(F.shiftright("lo", block_bits), F.shiftright("hi", block_bits))))
    p = points.filter(_has_place()).select("g", "ident", "x", "y", z_order(grid(F.col("x"), side), grid(F.col("y"), side)).alias("code"))
    p = p.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("code", F.expr("shiftright(code, 2 * level)"))
    p = p.withColumn("block", F.shiftright("code", block_bits))
    inside = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))
    return p.join(b, ["g", "level", "block"]).filter(F.col("code").between(F.col("lo"), F.col("hi")) & inside).select("ident", "box")


def close_beads(puck: DataFrame, radius: float = 2.0) -> DataFrame:
    """Pairs of puck rows of one puck, different in ``sb`` (trimmed, upper case), at most ``radius`` apart.

    Rows that agree in puck, barcode and place are copies: one stands for all in the search, and pairs
    are given to the copies afterwards, so a crowd of copies never meets itself. Rows with a null
    barcode, puck or place take no part.
    """
    rows = puck.select("bead_id", F.upper(F.trim("sb")).alias("sb"), "x", "y", "puck_index").filter(
        _has_place() & F.col("sb").isNotNull() & F.col("puck_index").isNotNull()
    )
    same = ["puck_index", "sb", "x", "y"]
    one = rows.groupBy(*same).agg(F.min("bead_id").alias("bead_id"), F.count("*").alias("n"))
    told = one.select("puck_index", F.struct(F.col("bead_id").alias("id"), "sb", "n").alias("who"), "x", "y")
    pairs = near_pairs(told, radius, "puck_index", "who").filter(F.col("a.sb") != F.col("b.sb"))
    # far fewer than rows, and read three times below
    pairs = cut(pairs.select(F.col("a.id").alias("ra"), F.col("a.n").alias("na"), F.col("b.id").alias("rb"), F.col("b.n").alias("nb")))
    lone = pairs.filter("na = 1 AND nb = 1").select(F.col("ra").alias("p"), F.col("rb").alias("q"))
    many = one.filter("n > 1").drop("n").withColumnRenamed("bead_id", "rep")
    members = rows.join(many, same).select("rep", "bead_id")
    rest = pairs.filter("NOT (na = 1 AND nb = 1)")
    for r, n, to in (("ra", "na", "p"), ("rb", "nb", "q")):
        own = rest.filter(F.col(n) == 1).withColumn(to, F.col(r))
        rest = own.unionByName(rest.filter(F.col(n) > 1).join(members.select(F.col("rep").alias(r), F.col("bead_id").alias(to)), r).select(*own.columns))
    both = lone.unionByName(rest.select("p", "q"))
    return both.select(F.least("p", "q").alias("bead_a"), F.greatest("p", "q").alias("bead_b"))
