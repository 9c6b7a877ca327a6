"""Inputs of the profile path: barcode lists, clean-up, translation, wells, sub-samples, sorted numbering, sheets by section."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beadloom.operators.profile_reads import index_digits
from beadloom.runtime import cut, parts

#: Linkers between the three keys of an indexed cell barcode, and the bases put before it by the quarter of the first key.
KEY_LINKERS = ("GTGA", "GACA")
INSERTS = ("", "A", "GT", "TCA")
#: Fixed value: micrometres per unit on the profile path.
SCALE = 0.647
#: Columns of a run's summary and the names reports expect.
SUMMARY_NAMES = {
    "Estimated.number.of.cells": "Estimated Number of Cells",
    "GEX.Mean.raw.reads.per.cell": "Mean Reads per Cell",
    "GEX.Median.genes.per.cell": "Median Genes per Cell",
    "GEX.Sequenced.read.pairs": "Number of Reads",
    "GEX.Valid.barcodes": "Valid Barcodes",
    "GEX.Percent.duplicates": "Sequencing Saturation",
    "GEX.Q30.bases.in.barcode": "Q30 Bases in Barcode",
    "GEX.Q30.bases.in.read.2": "Q30 Bases in RNA Read",
    "GEX.Q30.bases.in.UMI": "Q30 Bases in UMI",
    "GEX.Reads.mapped.to.genome": "Reads Mapped to Genome",
    "GEX.Reads.mapped.confidently.to.genome": "Reads Mapped Confidently to Genome",
    "GEX.Reads.mapped.confidently.to.intergenic.regions": "Reads Mapped Confidently to Intergenic Regions",
    "GEX.Reads.mapped.confidently.to.intronic.regions": "Reads Mapped Confidently to Intronic Regions",
    "GEX.Reads.mapped.confidently.to.exonic.regions": "Reads Mapped Confidently to Exonic Regions",
    "GEX.Reads.mapped.confidently.to.transcriptome": "Reads Mapped Confidently to Transcriptome",
    "GEX.Reads.mapped.antisense.to.gene": "Reads Mapped Antisense to Gene",
    "GEX.Fraction.of.transcriptomic.reads.in.cells": "Fraction Reads in Cells",
    "GEX.Total.genes.detected": "Total Genes Detected",
    "GEX.Median.UMI.counts.per.cell": "Median UMI Counts per Cell",
}
_COUNTS = ("Estimated Number of Cells", "Mean Reads per Cell", "Median Genes per Cell", "Number of Reads", "Total Genes Detected", "Median UMI Counts per Cell")


def listed_barcode(line: str) -> Column:
    """The barcode of a list's line: what stands before the first hyphen, else before a blank; null where the line has neither."""
    c = F.col(line)
    return F.when(c.contains("-"), F.substring_index(c, "-", 1)).when(c.rlike(r"\s"), F.regexp_extract(F.trim(c), r"^\S+", 0))


def clean_barcode(line: str) -> tuple[Column, Column]:
    """The first 16 characters with ``-1`` behind them, and what is wrong with the line: ``short``, ``hyphen``, ``digit`` or null."""
    key = F.substring(line, 1, 16)
    fault = F.when(F.length(F.rtrim(line)) < 16, "short").when(key.contains("-"), "hyphen").when(key.contains("1"), "digit")
    return F.when(fault.isNull(), F.concat(key, F.lit("-1"))), fault


def translation(lines: DataFrame) -> DataFrame:
    """``barcode, to`` of a two-column whitelist's lines; lines of another number of columns are left out, the last of equal barcodes wins by its text."""
    f = F.split(F.rtrim("line"), "\t")
    return lines.filter(F.size(f) == 2).select(f[0].alias("barcode"), f[1].alias("to")).groupBy("barcode").agg(F.max("to").alias("to"))


def translated(cells: DataFrame, pairs: DataFrame, tag: str = "_UNMAPPED") -> DataFrame:
    """``cells`` with ``translated``: the pair's other barcode, or the own one tagged."""
    return cells.join(pairs, "barcode", "left").withColumn("translated", F.coalesce("to", F.concat("barcode", F.lit(tag)))).drop("to")


def index_sequence(index: Column, keys: tuple[list[str], list[str], list[str]]) -> Column:
    """The whole sequence of a cell number: bases that shift it, then the three keys with linkers between."""
    one, two, three = index_digits(index, len(keys[0]))
    of = lambda k, d: F.element_at(F.array(*map(F.lit, k)), (d + 1).cast("int"))
    insert = F.element_at(F.array(*map(F.lit, INSERTS)), (F.floor(one % 96 / 24) + 1).cast("int"))
    return F.concat(insert, of(keys[0], one), F.lit(KEY_LINKERS[0]), of(keys[1], two), F.lit(KEY_LINKERS[1]), of(keys[2], three))


def well_barcodes(cells: DataFrame, wells: DataFrame) -> DataFrame:
    """``cells`` (``w1, w2, w3``) with ``barcode``, the sequences of the third, second and first well, and ``unmapped``, the first well without one.

    ``wells``: ``place`` (1 to 3), ``well, seq``.
    """
    out = cells
    for k in (1, 2, 3):
        out = out.join(wells.filter(F.col("place") == k).select(F.col("well").alias(f"w{k}"), F.col("seq").alias(f"s{k}")), f"w{k}", "left")
    missing = F.coalesce(*(F.when(F.col(f"s{k}").isNull(), F.col(f"w{k}")) for k in (1, 2, 3)))
    return out.withColumn("barcode", F.concat("s3", "s2", "s1")).withColumn("unmapped", missing).drop("s1", "s2", "s3")


def folders(files: DataFrame, libraries: DataFrame) -> DataFrame:
    """``library, folder, collision``: where each file's library goes; unmatched ones have no folder, a library of several folders collides and has the first."""
    one = libraries.groupBy("library").agg(F.min("folder").alias("folder"), (F.count_distinct("folder") > 1).alias("collision"))
    return files.join(one, "library", "left").withColumn("collision", F.coalesce("collision", F.lit(False)))


def first_match(names: DataFrame, rows: DataFrame, key: str, order: str) -> DataFrame:
    """``names`` (distinct ``key``) with the smallest ``order`` of the rows of that key, null where there is none."""
    return names.join(rows.groupBy(key).agg(F.min(order).alias(order)), key, "left")


def smallest_by_hash(rows: DataFrame, key: Column, n: Column, bits: int = 16) -> DataFrame:
    """Exactly ``n`` rows (a scalar column): those of the smallest md5 of ``key``, ties by nothing but it.

    A histogram over the first ``bits`` of the hash tells up to where all rows are taken; only the bin in which the number is
    reached is sorted.
    """
    h = cut(rows.withColumn("_h", F.md5(key)).withColumn("_bin", F.substring("_h", 1, bits // 4)))
    bins = h.groupBy("_bin").agg(F.count("*").alias("_n"))
    upto = bins.withColumn("_upto", F.sum("_n").over(Window.orderBy("_bin"))).withColumn("_take", F.greatest(F.lit(0), n - (F.col("_upto") - F.col("_n"))))
    met = h.join(F.broadcast(upto.filter("_take > 0").select("_bin", "_n", "_take")), "_bin")
    edge = met.filter("_take < _n").withColumn("_place", F.row_number().over(Window.partitionBy("_bin").orderBy("_h"))).filter("_place <= _take").drop("_place")
    return met.filter("_take >= _n").unionByName(edge).drop("_h", "_bin", "_n", "_take")


def sorted_index(values: DataFrame, column: str) -> DataFrame:
    """``column, nth``: the place from 1 of each distinct value in sorted order, by ranges of values and not in one task."""
    ranged = cut(values.select(column).distinct().repartitionByRange(parts(values.sparkSession), column).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    return ranged.withColumn("_own", own).join(F.broadcast(before), "_part").select(column, (F.col("_before") + F.col("_own")).alias("nth"))


def turned(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """``points`` with the axes flipped (``x_flip, y_flip``) and turned by a quarter (``x_turn, y_turn``)."""
    return points.withColumns({"x_flip": -F.col(x), "y_flip": -F.col(y), "x_turn": F.col(y), "y_turn": -F.col(x)})


def standard_summary(summary: DataFrame) -> DataFrame:
    """A run's summary under the names reports expect, shares as percent; saturation is 1 less unique over all reads, that is the share of repeats."""
    def told(old: str, new: str) -> Column:
        c = F.col(f"`{old}`")
        if new in _COUNTS:
            return c.alias(new)
        if new == "Sequencing Saturation":
            reads = F.col("`GEX.Sequenced.read.pairs`")
            c = 1 - reads * (1 - c) / reads
        return F.concat(F.round(c.cast("double") * 100, 10).cast("string"), F.lit("%")).alias(new)

    return summary.select(*(told(a, b) for a, b in SUMMARY_NAMES.items()))


def sheet_sections(rows: DataFrame, header: dict[str, str], key: str, columns: list[str]) -> DataFrame:
    """``key, ord, line``: a sheet per ``key`` with a ``[Header]`` section of settings and a ``[Data]`` section of its rows."""
    fixed = ["[Header]", *(f"{k},{v}" for k, v in header.items()), "[Data]", ",".join(columns)]
    top = rows.select(key).distinct().select(key, F.posexplode(F.array(*map(F.lit, fixed))).alias("ord", "line"))
    line = F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    body = rows.select(key, line.alias("line")).withColumn("ord", F.row_number().over(Window.partitionBy(key).orderBy("line")) + len(fixed) - 1)
    return top.select(key, "ord", "line").unionByName(body.select(key, "ord", "line"))


def write_sheets(sections: DataFrame, key: str, folder: str) -> None:
    """One folder of text per sheet, lines in order."""
    sections.repartition(key).sortWithinPartitions(key, "ord").select(key, "line").write.mode("overwrite").partitionBy(key).text(folder)


def value_faults(rows: DataFrame, ident: str, rules: dict[str, Column]) -> DataFrame:
    """``ident, fault`` for every rule that a row breaks; a rule is true where the row is fine, and a null breaks it."""
    broken = F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()))
    return rows.select(ident, F.explode(F.filter(broken, lambda x: x.isNotNull())).alias("fault"))


def even_bins(values: DataFrame, column: str, n: int = 30) -> DataFrame:
    """``bin, n``: ``n`` bins of equal width between the least and the largest of a whole-numbered column, the largest in the last."""
    ends = values.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    told = values.groupBy(column).agg(F.count("*").alias("n"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    at = F.least(F.floor((F.col(column) - lo) * n / F.greatest(hi - lo, F.lit(1))), F.lit(n - 1)).cast("int")
    return told.groupBy(at.alias("bin")).agg(F.sum("n").alias("n"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
