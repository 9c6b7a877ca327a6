"""Column expressions over barcode and read sequences; all stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The linker between both halves of a bead barcode, bases in the order of their 2-bit codes, and lengths.
LINKER = "TCTTCAGCGTTCCCGAGA"
BASES = "ACTG"
BARCODE, HALF, UMI, CELL = 14, 8, 12, 16


def _c(v: str | Column) -> Column:
    return F.col(v) if isinstance(v, str) else v


def mismatches(a: str | Column, b: str | Column, n: int) -> Column:
    """Places of the first ``n`` at which two strings differ."""
    return reduce(lambda x, y: x + y, (F.when(F.substring(_c(a), k, 1) != F.substring(_c(b), k, 1), 1).otherwise(0) for k in range(1, n + 1)))


def base_count(s: str | Column, base: str) -> Column:
    return F.length(_c(s)) - F.length(F.replace(_c(s), F.lit(base), F.lit("")))


def most_common(s: str | Column) -> Column:
    """Count of the most frequent of A, C, G, T and N."""
    return F.greatest(*(base_count(s, b) for b in "ACGTN"))


def longest_run(s: str | Column) -> Column:
    """Longest run of one base; 0 for an empty string."""
    runs = F.regexp_extract_all(_c(s), F.lit("(A+|C+|G+|T+|N+)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def umi_encode(s: str | Column) -> Column:
    """12 bases to a number, two bits each, first base lowest."""
    return reduce(lambda x, y: x + y, ((F.instr(F.lit(BASES), F.substring(_c(s), k + 1, 1)) - 1).cast("long") * (4**k) for k in range(UMI)))


def dna(v: str | Column, n: int) -> Column:
    """A number in base 4 as ``n`` bases, highest first."""
    return F.translate(F.lpad(F.conv(_c(v).cast("string"), 10, 4), n, "0"), "0123", BASES)


def umi_decode(v: str | Column) -> Column:
    return F.reverse(dna(v, UMI))


def near_homopolymer(s: str | Column, within: int = 2, n: int = UMI) -> Column:
    """At most ``within`` of ``n`` bases differ from one base throughout."""
    return reduce(lambda x, y: x | y, (base_count(s, b) >= n - within for b in "ACGTN"))


def umi_state(umi: str | Column) -> Column:
    """``umi_N``, ``umi_homopolymer`` or ``ok``; the first that holds."""
    return F.when(_c(umi).contains("N"), "umi_N").when(near_homopolymer(umi), "umi_homopolymer").otherwise("ok")


def deletions_of(s: str) -> list[str]:
    return sorted({s[:k] + s[k + 1 :] for k in range(len(s))})


def with_linker(df: DataFrame, r2: str = "r2") -> DataFrame:
    """Adds ``linker``, how the linker lies in the first 32 bases of read 2: the first rule that holds.

    Both mismatch counts are columns of their own first, so that the rules do not count again.
    """
    here, left, short = F.substring(r2, 9, 18), F.substring(r2, 8, 18), F.substring(r2, 9, 17)
    off, off_left = F.col("_off"), F.col("_off_left")
    counted = df.withColumns({"_off": mismatches(here, F.lit(LINKER), 18), "_off_left": mismatches(left, F.lit(LINKER), 18)})
    state = (
        F.when(off == 0, "exact").when(off == 1, "-1X").when(base_count(here, "G") >= 15, "GG").when(off_left == 0, "1D-")
        .when(off_left == 1, "1D-1X").when(short.isin(deletions_of(LINKER)), "-1D").when(off == 2, "-2X").otherwise("none")
    )
    return counted.withColumn("linker", state).drop("_off", "_off_left")


def halves(r2: str | Column, state: str | Column) -> tuple[Column, Column]:
    """Both halves of the bead barcode, as the linker's state places them."""
    r2, state = _c(r2), _c(state)
    one = F.when(state.isin("1D-", "1D-1X"), F.substring(r2, 1, 7)).otherwise(F.substring(r2, 1, 8))
    two = F.when(state.isin("1D-", "1D-1X", "-1D"), F.substring(r2, 26, 6)).otherwise(F.substring(r2, 27, 6))
    return one, two


def swap_middle(s: str | Column) -> Column:
    """Bases 8 and 9 exchanged for their counterpart (TC and AG, GT and CA); others stay."""
    pair = F.substring(_c(s), 8, 2)
    other = F.when(pair == "TC", "AG").when(pair == "AG", "TC").when(pair == "GT", "CA").when(pair == "CA", "GT").otherwise(pair)
    return F.concat(F.substring(_c(s), 1, 7), other, F.substring(_c(s), 10, 1000))


def deletions(s: str | Column, n: int) -> Column:
    """Array of ``(form, pos)``: every string with one base left out; equal forms are kept apart."""
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.struct(F.concat(F.substring(_c(s), F.lit(1), k - 1), F.substring(_c(s), k + 1, F.lit(n))).alias("form"), k.cast("int").alias("pos")))
