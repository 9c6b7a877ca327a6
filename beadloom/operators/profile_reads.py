"""Read handling of the profile path: slices by layout, pairing by id, counters, demultiplexing, mismatch profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beadloom.functions.seq import LINKER, mismatches

#: Least length, slices of the cell barcode and slice of the UMI (start from 1, length) of each read layout.
LAYOUTS: dict[str, tuple[int, tuple[tuple[int, int], ...], tuple[int, int] | None]] = {
    "cell16_umi12": (28, ((1, 16),), (17, 12)),
    "cell16": (16, ((1, 16),), None),
    "umi10_cell24": (58, ((11, 8), (31, 8), (51, 8)), (1, 10)),
    "cell40_umi8": (48, ((1, 40),), (41, 8)),
    "cell27_fixed": (63, ((21, 9), (34, 9), (47, 9)), (56, 8)),
}
#: Layouts whose slices are moved by where a linker is found: least length, window and motif, slices, UMI, last base used.
SHIFTED: dict[str, tuple[int, tuple[int, int], str, tuple[tuple[int, int], ...], tuple[int, int] | None, int]] = {
    "cell28_linker": (39, (27, 8), "TCGAG", ((1, 8), (12, 6), (21, 6), (32, 8)), None, 39),
    "cell27_linker": (43, (10, 7), "GTGA", ((1, 9), (14, 9), (27, 9)), (36, 8), 43),
}
#: The sample tags' eight bases, by label.
TAGS: dict[str, str] = {
    "AB001": "AGGCTCCT GGCTCCTC CCTTGTAG CTTGTAGC GTCAAGGA TCAAGGAC TAAGCATC AAGCATCC",
    "AB002": "ACGACTGC CGACTGCC CAACACAA AACACAAC GTTGTACG TTGTACGC TGCTGGTT GCTGGTTC",
    "AB003": "AGTCTGGA GTCTGGAC CAAACCTG AAACCTGC GTGGGAAC TGGGAACC TCCTATCT CCTATCTC",
    "AB004": "AACGGAGG ACGGAGGC CCATTGAT CATTGATC GTGCATCA TGCATCAC TGTACCTC GTACCTCC",
    "AB005": "AGACCTAG GACCTAGC CAGTAGTT AGTAGTTC GTCATAGC TCATAGCC TCTGGCCA CTGGCCAC",
    "AB006": "AGTTCTAC GTTCTACC CCAAGCGA CAAGCGAC GACCAATT ACCAATTC TTGGTGCG TGGTGCGC",
    "AB007": "ACTGAAAC CTGAAACC CTATGTGA TATGTGAC GACACCCT ACACCCTC TGGCTGTG GGCTGTGC",
    "AB008": "AGCACTGG GCACTGGC CTTCTAAC TTCTAACC GAGGAGCT AGGAGCTC TCATGCTA CATGCTAC",
    "AB009": "ATGCGTAG TGCGTAGC CCCGTGTT CCGTGTTC GAATCAGC AATCAGCC TGTAACCA GTAACCAC",
    "AB010": "ACATTGGC CATTGGCC CTCACTTT TCACTTTC GATGACCA ATGACCAC TGGCGAAG GGCGAAGC",
    "AB011": "ATCTGTTC TCTGTTCC CGAGTCGA GAGTCGAC GAGCCAAT AGCCAATC TCTAAGCG CTAAGCGC",
    "AB012": "ATAGTGTC TAGTGTCC CCGTGAGA CGTGAGAC GATCCTCT ATCCTCTC TGCAACAG GCAACAGC",
    "AB013": "AGTCTCAC GTCTCACC CAGGATTA AGGATTAC GCCAGACT CCAGACTC TTATCGGG TATCGGGC",
    "AB014": "AACGAACA ACGAACAC CGTTTGGG GTTTGGGC GCAAGCTT CAAGCTTC TTGCCTAC TGCCTACC",
    "AB015": "ATGCAGGT TGCAGGTC CATGCCAG ATGCCAGC GCATTACA CATTACAC TGCAGTTC GCAGTTCC",
    "AB016": "AGTCCATC GTCCATCC CTAGATGG TAGATGGC GACTTCCA ACTTCCAC TCGAGGAT CGAGGATC",
}


def cell_and_umi(seq: str, layout: str) -> tuple[Column, Column]:
    """Cell barcode and UMI of read 1; empty strings where the read is too short or its linker is missing."""
    s = F.col(seq)
    if layout in LAYOUTS:
        least, cuts, umi = LAYOUTS[layout]
        there = F.length(s) >= least
        cell = F.concat(*(F.substring(s, a, n) for a, n in cuts))
        tag = F.substring(s, *umi) if umi else F.lit("")
    else:
        least, window, motif, cuts, umi, last = SHIFTED[layout]
        move = F.instr(F.substring(s, *window), motif) - 1
        there = (F.length(s) >= least) & (move >= 0) & (F.length(s) >= last + move)
        cell = F.concat(*(F.substring(s, F.lit(a) + move, F.lit(n)) for a, n in cuts))
        tag = F.substring(s, F.lit(umi[0]) + move, F.lit(umi[1])) if umi else F.lit("")
    return F.when(there, cell).otherwise(""), F.when(there, tag).otherwise("")


def index_digits(index: Column, n: int) -> tuple[Column, Column, Column]:
    """The three digits in base ``n`` of a number from 1, the slowest first."""
    i = index - 1
    return F.floor(i / (n * n)) % n, F.floor(i / n) % n, i % n


def index_to_barcode(index: Column, keys: tuple[list[str], list[str], list[str]]) -> Column:
    """A cell number from 1 in base ``len(keys[0])``, as three key sequences put together; the first key turns slowest."""
    digits = index_digits(index, len(keys[0]))
    return F.concat(*(F.element_at(F.array(*map(F.lit, k)), (d + 1).cast("int")) for k, d in zip(keys, digits)))


def linker_ok(seq: str, anywhere: bool = False) -> Column:
    """The linker at bases 9 to 26 with at most one mismatch in a read of 32 bases or more; or anywhere as it is."""
    s = F.col(seq)
    here = (F.length(s) >= 32) & (mismatches(F.substring(s, 9, 18), F.lit(LINKER), 18) <= 1)
    return here | s.contains(LINKER) if anywhere else here


def bead_barcode(seq: str) -> Column:
    return F.concat(F.substring(seq, 1, 8), F.substring(seq, 27, 6))


def pair_by_id(r1: DataFrame, r2: DataFrame, cells: DataFrame) -> DataFrame:
    """Reads 2 with the cell and UMI of their read 1: accepted are cells of the list with over 15 bases and UMIs with over 7."""
    good = r1.filter((F.length("cb") > 15) & (F.length("umi") > 7)).join(cells.select("cb").distinct(), "cb", "left_semi")
    return r2.join(good, "read_id")


def tags(spark) -> DataFrame:
    """``code, label``: 128 rows, fixed."""
    return spark.createDataFrame([(c, label) for label, codes in TAGS.items() for c in codes.split()], "code string, label string")


def demultiplex(reads: DataFrame) -> DataFrame:
    """Read pairs with the label of bases 76 to 83 of read 2; null where the read is shorter or the tag unknown."""
    return reads.withColumn("code", F.when(F.length("r2") >= 83, F.substring("r2", 76, 8))).join(F.broadcast(tags(reads.sparkSession)), "code", "left")


def demux_summary(labelled: DataFrame, named: list[str]) -> DataFrame:
    """``label, n, pct, kept``: labels that are named or hold at least 1 % of the labelled reads are kept."""
    n = labelled.filter("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n"))
    pct = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())
    out = n.withColumn("pct", F.round(pct, 4))
    return out.withColumn("kept", F.col("label").isin(named) | (F.col("pct") >= 1))


def mismatch_profile(matches: DataFrame, length: int = 14) -> DataFrame:
    """``pos, reads``: reads whose barcode differs from its bead at each place, from ``barcode, bead, n_reads``."""
    sums = matches.agg(*(F.coalesce(F.sum(F.when(F.substring("barcode", k, 1) != F.substring("bead", k, 1), F.col("n_reads"))), F.lit(0)).alias(str(k)) for k in range(1, length + 1)))
    return sums.unpivot([], [str(k) for k in range(1, length + 1)], "pos", "reads").withColumn("pos", F.col("pos").cast("int"))
