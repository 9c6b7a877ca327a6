"""Queries from reads to the cell-bead table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beadloom.functions import seq
from beadloom.operators import dictionary as D
from beadloom.operators import molecules as M
from beadloom.plans import views as V
from beadloom.plans.registry import Catalogue, with_
from beadloom.runtime import beside, cut, table

query = Catalogue()
QUERIES, ORACLE = query.queries, query.oracle

#: The categories of the counters, in order.
LINKER_STATES = ("umi_N", "umi_homopolymer", "exact", "-1X", "GG", "1D-", "1D-1X", "-1D", "-2X", "none")
MATCH_STATES = ("exact", "HD1", "HD1ambig", "SB2del", "SB2delambig", "none")


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    r = V.reads(spark, sf).withColumn("umi", F.substring("r1", 17, 12))
    r = seq.with_linker(r.withColumn("umi_state", seq.umi_state("umi")))
    one, two = seq.halves("r2", "linker")
    return r.withColumn("sb1", one).withColumn("sb2", two)


def _matched(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    """Reads that may be looked up, counted (``n``) by ``keep`` and key, with their match; the reads themselves are made and classified once."""
    kept = _classified(spark, sf).filter("umi_state = 'ok' AND linker NOT IN ('GG', 'none')").drop("sb_index")
    counts = cut(kept.groupBy(*keep, "sb1", "sb2").agg(F.count("*").alias("n")))
    return D.match_beads(counts, table(spark, sf, "sb_list"))


def _zero_filled(counts: DataFrame, name: str, categories: tuple) -> DataFrame:
    """Counts joined to all categories; the category list is a literal of fixed length."""
    spark = counts.sparkSession
    every = spark.createDataFrame([(c,) for c in categories], [name])
    if dict(counts.dtypes)[name] == "int":
        every = every.withColumn(name, F.col(name).cast("int"))
    return every.join(counts, name, "left").select(name, F.coalesce("n", F.lit(0)).alias("n"))


@query("umi_encode_decode", f"SELECT DISTINCT umi_2bit, {V.sql_umi('umi_2bit')} AS umi, umi_2bit AS code FROM molecules WHERE umi_2bit IS NOT NULL")
def umi_encode_decode(spark: SparkSession, sf: str) -> DataFrame:
    u = table(spark, sf, "molecules").select("umi_2bit").filter("umi_2bit IS NOT NULL").distinct().withColumn("umi", seq.umi_decode("umi_2bit"))
    return u.withColumn("code", seq.umi_encode("umi"))


@query("umi_filter", with_(V.STATES, "SELECT umi_state, count(*) AS n FROM st GROUP BY 1"))
def umi_filter(spark: SparkSession, sf: str) -> DataFrame:
    return V.reads(spark, sf).groupBy(seq.umi_state(F.substring("r1", 17, 12)).alias("umi_state")).agg(F.count("*").alias("n"))


@query("up_classify", with_(V.STATES, "SELECT kind, linker, count(*) AS n FROM st GROUP BY 1, 2"))
def up_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf).groupBy("kind", "linker").agg(F.count("*").alias("n"))


_STATE_LIST = ", ".join(f"'{s}'" for s in LINKER_STATES)


@query("up_counts", with_(V.STATES, f"SELECT c.state, count(st.r1) AS n FROM (SELECT unnest([{_STATE_LIST}]) AS state) c LEFT JOIN st ON c.state = CASE WHEN umi_state <> 'ok' THEN umi_state ELSE linker END GROUP BY 1"))
def up_counts(spark: SparkSession, sf: str) -> DataFrame:
    state = F.when(F.col("umi_state") != "ok", F.col("umi_state")).otherwise(F.col("linker"))
    return _zero_filled(_classified(spark, sf).groupBy(state.alias("state")).agg(F.count("*").alias("n")), "state", LINKER_STATES)


@query(
    "read_swap",
    with_(V.READS, f"""SELECT pair_id, count(*) FILTER (substr(r2, 9, 18) = '{seq.LINKER}') AS hits_1, count(*) FILTER (substr(r1, 9, 18) = '{seq.LINKER}') AS hits_2,
        count(*) FILTER (substr(r2, 9, 18) = '{seq.LINKER}') > count(*) FILTER (substr(r1, 9, 18) = '{seq.LINKER}') AS swapped FROM reads GROUP BY 1"""),
)
def read_swap(spark: SparkSession, sf: str) -> DataFrame:
    """Mates handed over the wrong way round; the linker tells per pair of files which mate is which."""
    r = V.reads(spark, sf).select("pair_id", F.col("r2").alias("m1"), F.col("r1").alias("m2"))
    hit = lambda c: F.count_if(F.substring(c, 9, 18) == seq.LINKER)
    return r.groupBy("pair_id").agg(hit("m1").alias("hits_1"), hit("m2").alias("hits_2")).withColumn("swapped", F.col("hits_1") > F.col("hits_2"))


@query("read_lengths", with_(V.READS, "SELECT pair_id, count(DISTINCT length(r1)) = 1 AS one_r1, count(DISTINCT length(r2)) = 1 AS one_r2, max(length(r1))::INT AS len_r1, max(length(r2))::INT AS len_r2 FROM reads GROUP BY 1"))
def read_lengths(spark: SparkSession, sf: str) -> DataFrame:
    a, b = F.length("r1"), F.length("r2")
    return V.reads(spark, sf).groupBy("pair_id").agg((F.min(a) == F.max(a)).alias("one_r1"), (F.min(b) == F.max(b)).alias("one_r2"), F.max(a).alias("len_r1"), F.max(b).alias("len_r2"))


_SUMMARY = "SELECT pos::INT AS pos, count(*) AS n, count(*) FILTER (sb_index = 0) AS n_ambiguous, sum(sb_index)::BIGINT AS sum_index, min(sb1 || sb2) AS first_key FROM {} GROUP BY 1"


def _summary(d: DataFrame) -> DataFrame:
    return d.groupBy(F.col("pos").cast("int").alias("pos")).agg(
        F.count("*").alias("n"), F.count_if(F.col("sb_index") == 0).alias("n_ambiguous"), F.sum("sb_index").alias("sum_index"), F.min(F.concat("sb1", "sb2")).alias("first_key")
    )


@query("sb_dictionary", with_(V.DICTIONARY, _SUMMARY.format("dict")))
def sb_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(D.bead_dictionary(table(spark, sf, "sb_list")))


@query("sb_deletion_dictionary", with_(V.DICTIONARY, _SUMMARY.format("dict2")))
def sb_deletion_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(D.deletion_dictionary(table(spark, sf, "sb_list")))


@query("sb_match", with_(V.MATCHED, "SELECT linker, match, count(*) AS n, coalesce(sum(sb_index), 0)::BIGINT AS sum_index FROM mt GROUP BY 1, 2"))
def sb_match(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf, "linker").groupBy("linker", "match").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.col("sb_index") * F.col("n")), F.lit(0)).alias("sum_index"))


@query("sb_position_hist", with_(V.MATCHED, "SELECT c.pos::INT AS pos, count(mt.r1) AS n FROM (SELECT unnest(range(-14, 15)) AS pos) c LEFT JOIN mt ON mt.pos = c.pos AND mt.sb_index > 0 GROUP BY 1"))
def sb_position_hist(spark: SparkSession, sf: str) -> DataFrame:
    n = _matched(spark, sf).filter("sb_index > 0").groupBy(F.col("pos").cast("int").alias("pos")).agg(F.sum("n").alias("n"))
    return _zero_filled(n, "pos", tuple(range(-14, 15)))


@query("fuzzy_profile", with_(V.MATCHED, "SELECT (CASE WHEN pos > 8 THEN pos + 18 ELSE pos END)::INT AS read_pos, count(*) AS n FROM mt WHERE sb_index > 0 AND pos > 0 GROUP BY 1"))
def fuzzy_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Corrected positions as places in the read: the second half lies behind the linker."""
    at = F.when(F.col("pos") > 8, F.col("pos") + 18).otherwise(F.col("pos")).cast("int")
    return _matched(spark, sf).filter("sb_index > 0 AND pos > 0").groupBy(at.alias("read_pos")).agg(F.sum("n").alias("n"))


@query("match_rollup", with_(V.MATCHED, "SELECT match, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 4) AS pct FROM mt GROUP BY 1"))
def match_rollup(spark: SparkSession, sf: str) -> DataFrame:
    n = _matched(spark, sf).groupBy("match").agg(F.sum("n").alias("n"))
    return n.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4))


@query("molecule_counts", with_(V.MATCHED, "SELECT cell, umi_2bit, sb_index, count(*) AS reads FROM mt WHERE sb_index > 0 GROUP BY ALL"))
def molecule_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Read counts per cell barcode, UMI and bead: counts per key first, added up once keys have become beads."""
    return _matched(spark, sf, "cell", "umi_2bit").filter("sb_index > 0").groupBy("cell", "umi_2bit", "sb_index").agg(F.sum("n").alias("reads"))


@query(
    "read_invariants",
    with_(V.MATCHED, """SELECT (SELECT count(*) FROM st) AS n_reads, (SELECT count(*) FROM ok) AS n_linked, count(*) AS n_looked_up, count(*) FILTER (sb_index > 0) AS n_matched,
        count(*) FILTER (match = 'exact') = count(*) FILTER (sb_index > 0 AND pos = 0) AS exact_is_pos_0 FROM mt"""),
)
def read_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """The run-time checks of the read path as one row."""
    all_reads = _classified(spark, sf)
    linked = (F.col("umi_state") == "ok") & ~F.col("linker").isin("GG", "none")
    a = all_reads.agg(F.count("*").alias("n_reads"), F.count_if(linked).alias("n_linked"))
    m = _matched(spark, sf)
    b = m.agg(F.sum("n").alias("n_looked_up"), F.coalesce(F.sum(F.when(F.col("sb_index") > 0, F.col("n"))), F.lit(0)).alias("n_matched"),
        (F.count_if(F.col("match") == "exact") == F.count_if((F.col("sb_index") > 0) & (F.col("pos") == 0))).alias("exact_is_pos_0"))
    return beside(a, b)


# --- cells ---

_OBSERVED = """ob AS (SELECT cb_index, CASE WHEN cb_index % 11 = 0 THEN translate(left(barcode, 2), 'ACGT', 'TGCA') || substr(barcode, 3)
    WHEN cb_index % 3 = 0 THEN substr(barcode, 1, (cb_index % 16)::INT) || translate(substr(barcode, (cb_index % 16 + 1)::INT, 1), 'ACGT', 'CATG') || substr(barcode, (cb_index % 16 + 2)::INT) ELSE barcode END AS barcode FROM cb_list)"""
_CELL_MATCH = [
    _OBSERVED,
    "nb AS (SELECT f AS barcode, count(*) AS n, min(cb_index) AS near FROM (SELECT cb_index, barcode AS o, substr(barcode, 1, p - 1) || b || substr(barcode, p + 1) AS f FROM cb_list, (SELECT unnest(range(1, 17)) AS p), (SELECT unnest(['A', 'C', 'G', 'T', 'N']) AS b)) WHERE f <> o GROUP BY 1)",
    """cm AS (SELECT ob.cb_index, CASE WHEN w.cb_index IS NOT NULL THEN 'exact' WHEN nb.n = 1 THEN 'HD1' WHEN nb.n > 1 THEN 'HD1ambig' ELSE 'none' END AS match, coalesce(w.cb_index, CASE WHEN nb.n = 1 THEN near END) AS cell
        FROM ob LEFT JOIN cb_list w ON w.barcode = ob.barcode LEFT JOIN nb ON nb.barcode = ob.barcode)""",
]


def _observed(spark: SparkSession, sf: str) -> DataFrame:
    """Called cells as a library might show them: some with one base exchanged, a few with two."""
    cb, b = F.col("cb_index"), F.col("barcode")
    at = (cb % 16 + 1).cast("int")
    one = F.overlay(b, F.translate(F.substring(b, at, F.lit(1)), "ACGT", "CATG"), at, F.lit(1))
    two = F.concat(F.translate(F.substring(b, 1, 2), "ACGT", "TGCA"), F.substring(b, 3, 100))
    return table(spark, sf, "cb_list").select("cb_index", F.when(cb % 11 == 0, two).when(cb % 3 == 0, one).otherwise(b).alias("barcode"))


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    return D.cell_matches(_observed(spark, sf), table(spark, sf, "cb_list").withColumnRenamed("cb_index", "cell"), 16)


@query("cb_fuzzy_match", with_(_CELL_MATCH, "SELECT * FROM cm"))
def cb_fuzzy_match(spark: SparkSession, sf: str) -> DataFrame:
    return _cells(spark, sf)


_REINDEX = """ri AS (SELECT CASE WHEN m.cb_index > 0 THEN coalesce(cm.cell, -m.cb_index) ELSE m.cb_index END AS cb_index, umi_2bit, sb_index, sum(reads)::BIGINT AS reads FROM mol m LEFT JOIN cm ON cm.cb_index = m.cb_index GROUP BY 1, 2, 3)"""


@query("cb_reindex", with_([*V.MOLECULES, *_CELL_MATCH, _REINDEX], "SELECT * FROM ri"))
def cb_reindex(spark: SparkSession, sf: str) -> DataFrame:
    """Molecules under whitelist positions; unmatched cells keep their number negated, fuzzy ones are added to exact ones.

    Cells are joined by sorted partitions at any number of them, never sent whole to the driver.
    """
    met = V.matrix(spark, sf).join(_cells(spark, sf).hint("merge"), "cb_index", "left")
    cb = F.when(F.col("cb_index") > 0, F.coalesce("cell", -F.col("cb_index"))).otherwise(F.col("cb_index"))
    return met.withColumn("to", cb).groupBy(F.col("to").alias("cb_index"), "umi_2bit", "sb_index").agg(F.sum("reads").alias("reads"))


@query("cb_match_counts", with_([*V.MOLECULES, *_CELL_MATCH], "SELECT coalesce(cm.match, 'none') AS match, sum(reads)::BIGINT AS reads FROM mol LEFT JOIN cm USING (cb_index) GROUP BY 1"))
def cb_match_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Reads by match. Cells are joined by sorted partitions at any number of them, never sent whole to the driver."""
    met = V.matrix(spark, sf).groupBy("cb_index").agg(F.sum("reads").alias("reads")).join(_cells(spark, sf).hint("merge"), "cb_index", "left")
    return met.groupBy(F.coalesce("match", F.lit("none")).alias("match")).agg(F.sum("reads").alias("reads"))


_SWAP = "substr(barcode, 1, 7) || CASE substr(barcode, 8, 2) WHEN 'TC' THEN 'AG' WHEN 'AG' THEN 'TC' WHEN 'GT' THEN 'CA' WHEN 'CA' THEN 'GT' ELSE substr(barcode, 8, 2) END || substr(barcode, 10)"


@query(
    "cb_remap_choice",
    with_([*V.MOLECULES, f"lib AS (SELECT cb_index, {_SWAP} AS barcode FROM cb_list WHERE cb_index % 5 <> 0)", f"wl AS (SELECT barcode, {_SWAP} AS other FROM cb_list)"],
    """SELECT coalesce(sum(reads) FILTER (barcode IN (SELECT barcode FROM wl)), 0)::BIGINT AS reads_plain, coalesce(sum(reads) FILTER (barcode IN (SELECT other FROM wl)), 0)::BIGINT AS reads_swapped,
    coalesce(sum(reads) FILTER (barcode IN (SELECT other FROM wl)), 0) > coalesce(sum(reads) FILTER (barcode IN (SELECT barcode FROM wl)), 0) AS remap FROM mol JOIN lib USING (cb_index)"""),
)
def cb_remap_choice(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the library carries the whitelist with bases 8 and 9 exchanged: the form that more reads match."""
    cb = table(spark, sf, "cb_list")
    lib = cb.filter("cb_index % 5 <> 0").select("cb_index", seq.swap_middle("barcode").alias("barcode"))
    per_cell = V.matrix(spark, sf).groupBy("cb_index").agg(F.sum("reads").alias("reads")).join(lib, "cb_index")
    plain, swapped = cb.select("barcode", F.lit(True).alias("plain")), cb.select(seq.swap_middle("barcode").alias("barcode"), F.lit(True).alias("swapped"))
    met = per_cell.join(plain, "barcode", "left").join(swapped, "barcode", "left")
    n = lambda c: F.coalesce(F.sum(F.when(F.col(c), F.col("reads"))), F.lit(0))
    return met.agg(n("plain").alias("reads_plain"), n("swapped").alias("reads_swapped")).withColumn("remap", F.col("reads_swapped") > F.col("reads_plain"))


@query(
    "cb_remap_choice_all",
    with_([*V.MOLECULES, f"lib AS (SELECT cb_index, CASE WHEN cb_index % 5 = 0 THEN barcode ELSE {_SWAP} END AS barcode FROM cb_list)", f"wl AS (SELECT barcode, {_SWAP} AS other FROM cb_list)"],
    """SELECT coalesce(sum(reads) FILTER (barcode IN (SELECT barcode FROM wl)), 0)::BIGINT AS reads_plain, coalesce(sum(reads) FILTER (barcode IN (SELECT other FROM wl)), 0)::BIGINT AS reads_swapped,
    coalesce(sum(reads) FILTER (barcode IN (SELECT other FROM wl)), 0) > coalesce(sum(reads) FILTER (barcode IN (SELECT barcode FROM wl)), 0) AS remap FROM mol JOIN lib USING (cb_index)"""),
)
def cb_remap_choice_all(spark: SparkSession, sf: str) -> DataFrame:
    """``cb_remap_choice`` over the reads of all called cells; a fifth of the library's barcodes are left as they are."""
    cb = table(spark, sf, "cb_list")
    lib = cb.select("cb_index", F.when(F.col("cb_index") % 5 == 0, F.col("barcode")).otherwise(seq.swap_middle("barcode")).alias("barcode"))
    per_cell = V.matrix(spark, sf).groupBy("cb_index").agg(F.sum("reads").alias("reads")).join(lib, "cb_index")
    plain, swapped = cb.select("barcode", F.lit(True).alias("plain")), cb.select(seq.swap_middle("barcode").alias("barcode"), F.lit(True).alias("swapped"))
    met = per_cell.join(plain, "barcode", "left").join(swapped, "barcode", "left")
    n = lambda c: F.coalesce(F.sum(F.when(F.col(c), F.col("reads"))), F.lit(0))
    return met.agg(n("plain").alias("reads_plain"), n("swapped").alias("reads_swapped")).withColumn("remap", F.col("reads_swapped") > F.col("reads_plain"))


# --- molecules and beads ---


@query("chimera_filter", with_(V.MOLECULES, "SELECT cb_index, umi_2bit, sb_index, reads FROM chim WHERE NOT chimeric"))
def chimera_filter(spark: SparkSession, sf: str) -> DataFrame:
    return M.flag_chimeras(V.matrix(spark, sf)).filter("NOT chimeric").drop("chimeric")


@query("chimera_loss", with_(V.MOLECULES, "SELECT chimeric, count(*) AS n_rows, sum(reads)::BIGINT AS reads FROM chim GROUP BY 1"))
def chimera_loss(spark: SparkSession, sf: str) -> DataFrame:
    return M.flag_chimeras(V.matrix(spark, sf)).groupBy("chimeric").agg(F.count("*").alias("n_rows"), F.sum("reads").alias("reads"))


@query("bead_qc", with_(V.BEADS[:2], """SELECT puck_index, count(*) AS n_beads, count(*) FILTER (is_dup) AS n_dup, count(*) FILTER (is_n) AS n_n, count(*) FILTER (is_degenerate) AS n_degenerate,
    count(*) FILTER (NOT is_dup AND NOT is_n AND NOT is_degenerate) AS n_kept FROM qc GROUP BY 1"""))  # fmt: skip
def bead_qc(spark: SparkSession, sf: str) -> DataFrame:
    c = M.bead_checks(table(spark, sf, "puck"))
    n = lambda e, a: F.count_if(F.expr(e)).alias(a)
    return c.groupBy("puck_index").agg(F.count("*").alias("n_beads"), n("is_dup", "n_dup"), n("is_n", "n_n"), n("is_degenerate", "n_degenerate"), n("NOT is_dup AND NOT is_n AND NOT is_degenerate", "n_kept"))


@query("bead_complexity", with_(V.BEADS[:1], f"SELECT {V._DEGENERATE}::INT AS most_common, {V._RUN}::INT AS longest_run, count(*) AS n, count(*) FILTER ({V._DEGENERATE} > 11) AS low_complexity FROM pk GROUP BY 1, 2"))
def bead_complexity(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "puck").filter("sb IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)").select(F.upper(F.trim("sb")).alias("sb"))
    mc = seq.most_common("sb")
    return p.groupBy(mc.alias("most_common"), seq.longest_run("sb").alias("longest_run")).agg(F.count("*").alias("n"), F.count_if(mc > 11).alias("low_complexity"))


@query("bead_layout", with_(V.BEADS, "SELECT bead_id, sb, puck_index, round(x_um, 6) AS x_um, round(y_um, 6) AS y_um FROM lay"))
def bead_layout(spark: SparkSession, sf: str) -> DataFrame:
    return M.lay_out(table(spark, sf, "puck")).select("bead_id", "sb", "puck_index", F.round("x_um", 6).alias("x_um"), F.round("y_um", 6).alias("y_um"))


@query("duplicate_beads", with_(V.BEADS[:1], "SELECT sb, count(*) AS n, count(DISTINCT puck_index) AS n_pucks FROM pk GROUP BY 1 HAVING count(*) > 1"))
def duplicate_beads(spark: SparkSession, sf: str) -> DataFrame:
    # pre-aggregated by puck, so the distinct count needs no second shuffle of rows
    p = M.bead_checks(table(spark, sf, "puck")).groupBy("sb", "puck_index").agg(F.count("*").alias("n"))
    return p.groupBy("sb").agg(F.sum("n").alias("n"), F.count("*").alias("n_pucks")).filter("n > 1")


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return M.staged(V.matrix(spark, sf), V.beads(spark, sf))


_STAGES = "'chimeric', 'lowQsb', 'uncalled', 'final'"


@query("read_waterfall", with_(V.CELL_BEADS, "SELECT stage, count(*) AS n_rows, sum(reads)::BIGINT AS reads FROM sg GROUP BY 1"))
def read_waterfall(spark: SparkSession, sf: str) -> DataFrame:
    return _staged(spark, sf).groupBy("stage").agg(F.count("*").alias("n_rows"), F.sum("reads").alias("reads"))


@query("waterfall_pct", with_([*V.CELL_BEADS, f"w AS (SELECT stage, sum(reads)::BIGINT AS reads, list_position([{_STAGES}], stage) AS o FROM sg GROUP BY 1)"],
    "SELECT stage, reads, round(reads * 100.0::DOUBLE / (sum(reads) OVER () - coalesce(sum(reads) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)), 4) AS pct FROM w"))
def waterfall_pct(spark: SparkSession, sf: str) -> DataFrame:
    order = F.expr(f"array_position(array({_STAGES}), stage)")
    w = _staged(spark, sf).groupBy("stage").agg(F.sum("reads").alias("reads")).withColumn("o", order)
    gone = F.coalesce(F.sum("reads").over(Window.orderBy("o").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return w.select("stage", "reads", F.round(F.col("reads") * 100.0 / (F.sum("reads").over(Window.partitionBy()) - gone), 4).alias("pct"))


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return M.count_umis(_staged(spark, sf).filter("stage = 'final'"))


def _per_bead(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf).groupBy("sb_index").agg(F.sum("umi").alias("umi"))


@query("umi_counts", with_(V.CELL_BEADS, "SELECT cb_index, sb_index, umi FROM cu"))
def umi_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf)


@query("bead_umi_cutoff", with_(V.CELL_BEADS, "SELECT quantile_cont(umi, 0.99) AS cutoff, count(*) AS n_beads FROM pb"))
def bead_umi_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    return _per_bead(spark, sf).agg(F.percentile("umi", 0.99).alias("cutoff"), F.count("*").alias("n_beads"))


@query("high_umi_beads", with_(V.CELL_BEADS, "SELECT sb_index, umi FROM pb SEMI JOIN hi USING (sb_index)"))
def high_umi_beads(spark: SparkSession, sf: str) -> DataFrame:
    p = cut(_per_bead(spark, sf))
    return p.filter(F.col("umi") > M.umi_cutoff(p).scalar())


@query("bead_umi_cap", with_(V.CELL_BEADS, "SELECT cu.cb_index, cu.sb_index, cu.umi FROM cu JOIN pb USING (sb_index) WHERE pb.umi < 8"))
def bead_umi_cap(spark: SparkSession, sf: str) -> DataFrame:
    """The profile path's cap: beads of that many UMIs or more leave, by one window in place of a self-join."""
    total = F.sum("umi").over(Window.partitionBy("sb_index"))
    return _counts(spark, sf).withColumn("t", total).filter("t < 8").drop("t")


#: Beads of that many UMIs or more leave in the reference's profile path.
UMI_CAP = 256


@query("bead_umi_cap_full", with_(V.CELL_BEADS, f"SELECT cu.cb_index, cu.sb_index, cu.umi FROM cu JOIN pb USING (sb_index) WHERE pb.umi < {UMI_CAP}"))
def bead_umi_cap_full(spark: SparkSession, sf: str) -> DataFrame:
    """The profile path's cap at the reference's value; ``bead_umi_cap`` has one for small tables."""
    return M.under_cap(_counts(spark, sf), UMI_CAP)


@query("cell_bead_umi", with_(V.CELL_BEADS, "SELECT cb_index, round(x_um, 6) AS x_um, round(y_um, 6) AS y_um, umi FROM cell_bead"))
def cell_bead_umi(spark: SparkSession, sf: str) -> DataFrame:
    return V.cell_beads(spark, sf).select("cb_index", F.round("x_um", 6).alias("x_um"), F.round("y_um", 6).alias("y_um"), "umi")


@query("umi_per_puck", with_([*V.CELL_BEADS, "bo AS (SELECT puck_index, min(x_um) AS lo, max(x_um) AS hi FROM lay GROUP BY 1)"], "SELECT bo.puck_index, sum(umi)::BIGINT AS umi, count(*) AS n FROM cell_bead c JOIN bo ON c.x_um BETWEEN bo.lo AND bo.hi GROUP BY 1"))
def umi_per_puck(spark: SparkSession, sf: str) -> DataFrame:
    """UMIs by the x-range of each puck, both ends inside; the ranges are one row per puck."""
    edges = M.lay_out(table(spark, sf, "puck")).groupBy("puck_index").agg(F.min("x_um").alias("lo"), F.max("x_um").alias("hi"))
    # places are few beside rows: they are added up before they meet the ranges
    by_x = V.cell_beads(spark, sf).groupBy("x_um").agg(F.sum("umi").alias("umi"), F.count("*").alias("n"))
    # ranges are opened into bins of x, so that places meet them by equality
    bin_of = lambda c: F.floor(F.col(c) / 500.0)
    opened = edges.withColumn("bin", F.explode(F.sequence(bin_of("lo"), bin_of("hi"))))
    met = by_x.withColumn("bin", bin_of("x_um")).join(opened, "bin").filter(F.col("x_um").between(F.col("lo"), F.col("hi")))
    return met.groupBy("puck_index").agg(F.sum("umi").alias("umi"), F.sum("n").alias("n"))


def _curve(counts: DataFrame) -> DataFrame:
    """Rank curve from a histogram: the last rank of each count, without sorting the things counted."""
    h = counts.groupBy("umi").agg(F.count("*").alias("n"))
    return h.withColumn("last_rank", F.sum("n").over(Window.orderBy(F.desc("umi"))))


_CURVE = "SELECT umi, count(*) AS n, (sum(count(*)) OVER (ORDER BY umi DESC))::BIGINT AS last_rank FROM {} GROUP BY 1"


@query("cell_rank_curve", with_([*V.CELL_BEADS, "pc AS (SELECT cb_index, sum(umi)::BIGINT AS umi FROM cu GROUP BY 1)"], _CURVE.format("pc")))
def cell_rank_curve(spark: SparkSession, sf: str) -> DataFrame:
    return _curve(_counts(spark, sf).groupBy("cb_index").agg(F.sum("umi").alias("umi")))


@query("bead_rank_curve", with_(V.CELL_BEADS, _CURVE.format("pb")))
def bead_rank_curve(spark: SparkSession, sf: str) -> DataFrame:
    return _curve(_per_bead(spark, sf))


@query("reads_per_umi_hist", with_(V.MOLECULES, "SELECT least(reads, 10)::BIGINT AS depth, count(*) AS n FROM mol GROUP BY 1"))
def reads_per_umi_hist(spark: SparkSession, sf: str) -> DataFrame:
    return V.matrix(spark, sf).groupBy(F.least("reads", F.lit(10).cast("long")).alias("depth")).agg(F.count("*").alias("n"))


@query("saturation", with_(V.MOLECULES, "SELECT round(1 - count(*)::DOUBLE / sum(reads), 6) AS saturation, count(*) AS molecules, sum(reads)::BIGINT AS reads FROM mol"))
def saturation(spark: SparkSession, sf: str) -> DataFrame:
    return V.matrix(spark, sf).agg(F.round(1 - F.count("*").cast("double") / F.sum("reads"), 6).alias("saturation"), F.count("*").alias("molecules"), F.sum("reads").alias("reads"))


_LGAMMA = "v * (1 - CASE WHEN n > k * v - k THEN 0 ELSE exp(lgamma(k * v - k + 1) - lgamma(k * v - k - n + 1) - lgamma(k * v + 1) + lgamma(k * v - n + 1)) END)"


@query(
    "saturation_curve",
    with_([*V.MOLECULES, "dp AS (SELECT reads::DOUBLE AS k, count(*)::DOUBLE AS v FROM mol WHERE reads > 0 GROUP BY 1)", "fr AS (SELECT *, round(k * v * f) AS n FROM dp, (SELECT unnest(range(0, 21)) / 20.0::DOUBLE AS f))"],
    f"SELECT f AS fraction, sum(n)::BIGINT AS reads, round(sum({_LGAMMA}), 1) AS umis FROM fr GROUP BY 1"),
)
def saturation_curve(spark: SparkSession, sf: str) -> DataFrame:
    return M.expected_saturation(V.matrix(spark, sf), [k / 20 for k in range(21)]).withColumn("umis", F.round("umis", 1))


@query("thin_rows", None)
def thin_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A fifth of the matrix rows, chosen by a hash of their keys: the same rows on every run and at every partitioning."""
    keep = F.pmod(F.xxhash64("cb_index", "umi_2bit", "sb_index", F.lit(42)), F.lit(1_000_000)) < 200_000
    return V.matrix(spark, sf).filter(keep)


@query("bead_edit_match", with_([*V.STATES, "o AS (SELECT DISTINCT left(r2, 8) || substr(r2, 27, 6) AS barcode FROM st WHERE linker = 'exact')", f"w AS (SELECT DISTINCT barcode AS bead FROM sb_list WHERE {V.SQL_COMPLEX})",
    "e AS (SELECT barcode, bead, 0 AS distance FROM o JOIN w ON barcode = bead)", "l AS (SELECT * FROM o ANTI JOIN e USING (barcode))",
    "c AS (SELECT barcode, bead FROM l JOIN w ON left(barcode, 6) = left(bead, 6) UNION SELECT barcode, bead FROM l JOIN w ON substr(barcode, 5, 6) = substr(bead, 5, 6) UNION SELECT barcode, bead FROM l JOIN w ON substr(barcode, 9, 6) = substr(bead, 9, 6))",
    "r AS (SELECT barcode, bead, 1 AS distance FROM c WHERE levenshtein(barcode, bead) = 1 QUALIFY row_number() OVER (PARTITION BY barcode ORDER BY right(barcode, 1) <> right(bead, 1), bead) = 1)"],
    "SELECT barcode, bead, distance FROM e UNION ALL SELECT * FROM r"))
def bead_edit_match(spark: SparkSession, sf: str) -> DataFrame:
    r = V.reads(spark, sf).filter(F.substring("r2", 9, 18) == seq.LINKER).select(F.concat(F.substring("r2", 1, 8), F.substring("r2", 27, 6)).alias("barcode")).distinct()
    return D.blocked_edit_match(r, table(spark, sf, "sb_list").select(F.col("barcode").alias("bead")).distinct())
