"""Queries over the inputs of the profile path, the whole read waterfall, metric tables and layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beadloom.functions import formats as N
from beadloom.operators import dictionary as D
from beadloom.operators import metadata as S
from beadloom.operators import molecules as M
from beadloom.operators import positioning as P
from beadloom.operators import profile_inputs as I
from beadloom.operators import profile_reads as R
from beadloom.plans import molecule_queries as MQ
from beadloom.plans import position_queries as PQ
from beadloom.plans import sheet_queries as SQ
from beadloom.plans import views as V
from beadloom.plans.registry import Catalogue, with_
from beadloom.runtime import beside, cut, table

query = Catalogue()
QUERIES, ORACLE = query.queries, query.oracle


# --- barcode lists ---


@query("barcode_list", """WITH l AS (SELECT CASE cb_index % 6 WHEN 0 THEN barcode || '-1' WHEN 1 THEN barcode || ' 1' WHEN 2 THEN barcode ELSE barcode || '-2' END AS line FROM cb_list)
    SELECT CASE WHEN line LIKE '%-%' THEN split_part(line, '-', 1) WHEN line LIKE '% %' THEN split_part(line, ' ', 1) END AS barcode, count(*) AS n FROM l GROUP BY 1""")  # fmt: skip
def barcode_list(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct barcodes of a list's lines; lines without a suffix are invalid and counted under null."""
    k, b = F.col("cb_index") % 6, F.col("barcode")
    line = F.when(k == 0, F.concat(b, F.lit("-1"))).when(k == 1, F.concat(b, F.lit(" 1"))).when(k == 2, b).otherwise(F.concat(b, F.lit("-2")))
    return table(spark, sf, "cb_list").select(line.alias("line")).groupBy(I.listed_barcode("line").alias("barcode")).agg(F.count("*").alias("n"))


@query("flex_barcodes", """WITH l AS (SELECT cb_index, CASE cb_index % 9 WHEN 0 THEN left(barcode, 10) WHEN 1 THEN left(barcode, 8) || '-' || substr(barcode, 9) WHEN 2 THEN left(barcode, 15) || '1' ELSE barcode || '-1' END AS line FROM cb_list),
    f AS (SELECT cb_index, left(line, 16) AS key, CASE WHEN length(line) < 16 THEN 'short' WHEN left(line, 16) LIKE '%-%' THEN 'hyphen' WHEN left(line, 16) LIKE '%1%' THEN 'digit' END AS fault FROM l)
    SELECT cb_index, CASE WHEN fault IS NULL THEN key || '-1' END AS barcode, fault FROM f""")  # fmt: skip
def flex_barcodes(spark: SparkSession, sf: str) -> DataFrame:
    k, b = F.col("cb_index") % 9, F.col("barcode")
    line = F.when(k == 0, F.substring(b, 1, 10)).when(k == 1, F.concat(F.substring(b, 1, 8), F.lit("-"), F.substring(b, 9, 8))).when(k == 2, F.concat(F.substring(b, 1, 15), F.lit("1"))).otherwise(F.concat(b, F.lit("-1")))
    barcode, fault = I.clean_barcode("line")
    return table(spark, sf, "cb_list").select("cb_index", line.alias("line")).select("cb_index", barcode.alias("barcode"), fault.alias("fault"))


@query("barcode_translation", "SELECT cb_index, barcode, CASE WHEN cb_index % 7 = 0 THEN barcode || '_UNMAPPED' ELSE reverse(barcode) END AS translated FROM cb_list")
def barcode_translation(spark: SparkSession, sf: str) -> DataFrame:
    """Cells under the whitelist's other barcode; every seventh line of the whitelist has one column only."""
    cb = table(spark, sf, "cb_list").select("cb_index", "barcode")
    lines = cb.select(F.when(F.col("cb_index") % 7 == 0, F.col("barcode")).otherwise(F.concat("barcode", F.lit("\t"), F.reverse("barcode"))).alias("line"))
    return I.translated(cb, I.translation(lines))


@query("lane_suffix", "SELECT sb_index, CASE WHEN sb_index % 5 = 0 THEN barcode || '-x' ELSE barcode END AS barcode FROM sb_list")
def lane_suffix(spark: SparkSession, sf: str) -> DataFrame:
    """Barcodes without the lane behind their last hyphen; ``-x`` is no lane."""
    k = F.col("sb_index")
    named = F.concat("barcode", F.when(k % 5 == 0, F.lit("-x")).when(k % 3 == 0, F.lit("-")).otherwise(F.concat(F.lit("-"), (k % 12).cast("string"))))
    return table(spark, sf, "sb_list").select("sb_index", F.regexp_replace(named, "-[0-9]*$", "").alias("barcode"))


def _keys(n: int) -> tuple[list[str], list[str], list[str]]:
    made = lambda a: ["".join("ACTG"[((k * a + 7) >> (2 * i)) & 3] for i in range(9)) for k in range(n)]
    return made(677), made(911), made(1213)


_DIGITS = "dg AS (SELECT sb_index, ((sb_index - 1) // 147456) % 384 AS a, ((sb_index - 1) // 384) % 384 AS b, (sb_index - 1) % 384 AS c FROM sb_list)"


@query("index_sequences", with_([_DIGITS], f"SELECT sb_index, ['', 'A', 'GT', 'TCA'][((a % 96) // 24 + 1)::INT] || {SQ._key_sql(677, 'a')} || 'GTGA' || {SQ._key_sql(911, 'b')} || 'GACA' || {SQ._key_sql(1213, 'c')} AS sequence FROM dg"))
def index_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Whole sequences of cell numbers from three tables of 384 keys; a library hands in its own, here they are made by a rule."""
    return table(spark, sf, "sb_list").select("sb_index", I.index_sequence(F.col("sb_index"), _keys(384)).alias("sequence"))


_WELL = "array_to_string(list_transform(range(0, 4), lambda i: substr('ACTG', (1 + ((({0} * {1} + 5) >> (2 * i)::INT) & 3))::INT, 1)), '')"
_WELLS = "wl AS (SELECT cb_index, cb_index % 97 AS w1, (cb_index // 7) % 97 AS w2, (cb_index // 11) % 96 AS w3 FROM cb_list)"


@query("well_barcodes", with_([_WELLS], f"SELECT cb_index, CASE WHEN w1 < 96 AND w2 < 96 THEN {_WELL.format('w3', 29)} || {_WELL.format('w2', 17)} || {_WELL.format('w1', 13)} END AS barcode, CASE WHEN w1 = 96 THEN w1 WHEN w2 = 96 THEN w2 END AS unmapped FROM wl"))
def well_barcodes(spark: SparkSession, sf: str) -> DataFrame:
    """Cells by the sequences of their three wells; well 96 is in no list."""
    seq = lambda k, a: "".join("ACTG"[((k * a + 5) >> (2 * i)) & 3] for i in range(4))
    wells = spark.createDataFrame([(p, k, seq(k, a)) for p, a in ((1, 13), (2, 17), (3, 29)) for k in range(96)], "place int, well long, seq string")
    c = F.col("cb_index")
    cells = table(spark, sf, "cb_list").select("cb_index", (c % 97).alias("w1"), (F.floor(c / 7) % 97).alias("w2"), (F.floor(c / 11) % 96).alias("w3"))
    return I.well_barcodes(cells, wells).select("cb_index", "barcode", "unmapped")


@query("fastq_folders", """WITH l AS (SELECT sample_name AS library, min(bcl) AS folder, count(DISTINCT bcl) > 1 AS collision FROM example_metadata WHERE sample_name IS NOT NULL GROUP BY 1),
    f AS (SELECT DISTINCT CASE WHEN doc_id % 10 = 0 THEN sample_name || '_x' ELSE sample_name END AS library FROM documents WHERE sample_name IS NOT NULL)
    SELECT library, folder, coalesce(collision, false) AS collision FROM f LEFT JOIN l USING (library)""")  # fmt: skip
def fastq_folders(spark: SparkSession, sf: str) -> DataFrame:
    d, s = table(spark, sf, "documents").filter("sample_name IS NOT NULL"), F.col("sample_name")
    files = d.select(F.when(F.col("doc_id") % 10 == 0, F.concat(s, F.lit("_x"))).otherwise(s).alias("library")).distinct()
    return I.folders(files, table(spark, sf, "example_metadata").filter("sample_name IS NOT NULL").select(s.alias("library"), F.col("bcl").alias("folder")))


@query("partition_rows", """WITH n AS (SELECT DISTINCT bcl || '/' || sample_name AS name FROM documents WHERE bcl IS NOT NULL AND sample_name IS NOT NULL), m AS (SELECT bcl || '/' || sample_name AS name, min(row_id) AS row_id FROM example_metadata GROUP BY 1)
    SELECT name, row_id FROM n LEFT JOIN m USING (name)""")  # fmt: skip
def partition_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The first metadata row of each partition's composed name; null where there is none."""
    name = F.concat("bcl", F.lit("/"), "sample_name").alias("name")
    names = table(spark, sf, "documents").select(name).filter("name IS NOT NULL").distinct()
    return I.first_match(names, table(spark, sf, "example_metadata").select(name, "row_id"), "name", "row_id")


# --- matches with places ---

_LONE = "lo AS (SELECT sb AS bead, min(x) AS xcoord, min(y) AS ycoord FROM pk GROUP BY 1 HAVING count(*) = 1)"
_PLACED = [*SQ._EDIT, *V.BEADS[:1], _LONE, "pm AS (SELECT barcode, bead, xcoord, ycoord, n_reads FROM mm JOIN lo USING (bead))"]


def _placed(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "puck").filter("sb IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    lone = p.groupBy(F.upper(F.trim("sb")).alias("bead")).agg(F.count("*").alias("n"), F.min("x").alias("xcoord"), F.min("y").alias("ycoord")).filter("n = 1").drop("n")
    return SQ._edits(spark, sf).select("barcode", "bead", "n_reads").join(lone, "bead")


@query("placed_matches", with_(_PLACED, "SELECT barcode, bead, xcoord, ycoord FROM pm"))
def placed_matches(spark: SparkSession, sf: str) -> DataFrame:
    """The match table: observed barcode, bead and the bead's place."""
    return _placed(spark, sf).select("barcode", "bead", "xcoord", "ycoord")


_COLLAPSED = [*_PLACED, "cs AS (SELECT cb, sb AS barcode, count(DISTINCT umi) AS n_umi FROM pd GROUP BY 1, 2)", "cp AS (SELECT cb, barcode, bead, n_umi, xcoord, ycoord FROM cs JOIN pm USING (barcode))",
    "ct AS (SELECT bead, sum(n_umi)::BIGINT AS n_collapsed FROM cp GROUP BY 1)"]


@query("collapsed_beads", with_(_COLLAPSED, f"SELECT cb, barcode, bead, n_umi, n_collapsed, round(xcoord * {I.SCALE}, 8) AS x_um, round(ycoord * {I.SCALE}, 8) AS y_um FROM cp JOIN ct USING (bead) WHERE n_collapsed < 256"))
def collapsed_beads(spark: SparkSession, sf: str) -> DataFrame:
    """UMIs of each cell and barcode with those of its bead over all of them, under 256, in micrometres; one window in place of joins back."""
    n = SQ._paired(spark, sf).groupBy("cb", F.col("sb").alias("barcode")).agg(F.count_distinct("umi").alias("n_umi"))
    met = n.join(_placed(spark, sf).drop("n_reads"), "barcode").withColumn("n_collapsed", F.sum("n_umi").over(Window.partitionBy("bead"))).filter("n_collapsed < 256")
    um = lambda c: F.round(F.col(c) * I.SCALE, 8)
    return met.select("cb", "barcode", "bead", "n_umi", "n_collapsed", um("xcoord").alias("x_um"), um("ycoord").alias("y_um"))


@query("axis_turns", "SELECT bead_id, -x AS x_flip, -y AS y_flip, y AS x_turn, -x AS y_turn FROM puck WHERE x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
def axis_turns(spark: SparkSession, sf: str) -> DataFrame:
    return I.turned(table(spark, sf, "puck").filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")).select("bead_id", "x_flip", "y_flip", "x_turn", "y_turn")


@query("layout_numbers", with_(V.CELL_BEADS, "SELECT round(max(x_um) - min(x_um), 6) AS x_range, round(max(y_um) - min(y_um), 6) AS y_range, count(DISTINCT cb_index) AS cells, count(*) AS n FROM cell_bead"))
def layout_numbers(spark: SparkSession, sf: str) -> DataFrame:
    per = V.cell_beads(spark, sf).groupBy("cb_index").agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("x_um", "y_um")), F.count("*").alias("n"))
    span = lambda c: F.round(F.max(f"max_{c}") - F.min(f"min_{c}"), 6)
    return per.agg(span("x_um").alias("x_range"), span("y_um").alias("y_range"), F.count("*").alias("cells"), F.sum("n").alias("n"))


# --- samples of exact size ---


@query("sweep_subsample", with_([*V.CELL_BEADS, "cc AS (SELECT DISTINCT cb_index FROM cell_bead)", "nn AS (SELECT count(*) AS n FROM cc)", "rk AS (SELECT cb_index, row_number() OVER (ORDER BY md5(cb_index || ':123')) AS k FROM cc)"],
    "SELECT cb_index FROM rk, nn WHERE k <= CASE WHEN n < 5 THEN n ELSE least(5000, n // 5) END"))
def sweep_subsample(spark: SparkSession, sf: str) -> DataFrame:
    """A fifth of the cells, 5,000 at most, for a sweep; all of them where a fifth is none."""
    cells = cut(V.cell_beads(spark, sf).select("cb_index").distinct())
    n = cells.agg(F.count("*").alias("n")).select(F.when(F.col("n") < 5, F.col("n")).otherwise(F.least(F.lit(5000), F.floor(F.col("n") / 5))).alias("n")).scalar()
    return I.smallest_by_hash(cells, F.concat(F.col("cb_index").cast("string"), F.lit(":123")), n)


_THIN = [*V.MOLECULES, "hk AS (SELECT *, row_number() OVER (ORDER BY md5(cb_index || ':' || umi_2bit || ':' || sb_index || ':42')) AS k, count(*) OVER () AS n FROM mol)"]


@query("thin_exact", with_(_THIN, "SELECT cb_index, umi_2bit, sb_index, reads FROM hk WHERE k <= n * 20 // 100"))
def thin_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Exactly a fifth (rounded down) of the matrix rows, those of the smallest hash."""
    m = cut(V.matrix(spark, sf))
    n = m.agg(F.floor(F.count("*") * 20 / 100).alias("n")).scalar()
    return I.smallest_by_hash(m, F.concat_ws(":", "cb_index", "umi_2bit", "sb_index", F.lit("42")), n)


@query("thin_counters", with_(V.MOLECULES, "SELECT sum(reads)::BIGINT AS reads_total, (sum(reads) * 20 // 100)::BIGINT AS reads_thinned, (count(*) * 20 // 100)::BIGINT AS rows_thinned FROM mol"))
def thin_counters(spark: SparkSession, sf: str) -> DataFrame:
    """The counters of a thinned matrix, rescaled by the same rate."""
    t = V.matrix(spark, sf).agg(F.sum("reads").alias("reads_total"), F.count("*").alias("n"))
    fifth = lambda c: F.floor(F.col(c) * 20 / 100)
    return t.select("reads_total", fifth("reads_total").alias("reads_thinned"), fifth("n").alias("rows_thinned"))


# --- numbering ---


@query("whitelist_index", "SELECT barcode, row_number() OVER (ORDER BY barcode) AS nth FROM (SELECT DISTINCT barcode FROM sb_list)")
def whitelist_index(spark: SparkSession, sf: str) -> DataFrame:
    return I.sorted_index(table(spark, sf, "sb_list"), "barcode")


@query("cell_index", "SELECT barcode, dense_rank() OVER (ORDER BY barcode) AS nth FROM (SELECT DISTINCT barcode FROM cb_list)")
def cell_index(spark: SparkSession, sf: str) -> DataFrame:
    """Cells numbered without gaps; order of appearance does not exist over a cluster, so they are by barcode."""
    return I.sorted_index(table(spark, sf, "cb_list"), "barcode")


# --- the whole waterfall ---

_FROM_READS = "mol AS (SELECT cb_index, umi_2bit, sb_index, count(*) AS reads FROM mt WHERE sb_index > 0 GROUP BY ALL)"
_STEPS = ("noumi", "noup", "nosb", "chimeric", "lowQsb", "uncalled", "final")
_FALL = [*V.MATCHED, _FROM_READS, *V.CELL_BEADS[1:],
    """fw AS (SELECT 'noumi' AS step, count(*) AS reads FROM st WHERE umi_state <> 'ok' UNION ALL SELECT 'noup', count(*) FROM st WHERE umi_state = 'ok' AND linker IN ('GG', 'none')
        UNION ALL SELECT 'nosb', count(*) FROM mt WHERE sb_index IS NULL UNION ALL SELECT s.stage, coalesce(sum(sg.reads), 0)::BIGINT FROM (SELECT unnest(['chimeric', 'lowQsb', 'uncalled', 'final']) AS stage) s LEFT JOIN sg USING (stage) GROUP BY 1)"""]  # fmt: skip


def _fall(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """``step, reads`` and the staged molecules made from the reads."""
    c = MQ._classified(spark, sf)
    state = F.when(F.col("umi_state") != "ok", "noumi").when(F.col("linker").isin("GG", "none"), "noup").otherwise("looked_up")
    keyed = cut(c.groupBy(state.alias("state"), *(F.when(state == "looked_up", F.col(x)).alias(x) for x in ("cb_index", "umi_2bit", "sb1", "sb2"))).agg(F.count("*").alias("n")))
    lost = keyed.filter("state <> 'looked_up'").groupBy(F.col("state").alias("step")).agg(F.sum("n").alias("reads"))
    met = cut(D.match_beads(keyed.filter("state = 'looked_up'").drop("state"), table(spark, sf, "sb_list")))
    nosb = met.filter("sb_index IS NULL").agg(F.lit("nosb").alias("step"), F.coalesce(F.sum("n"), F.lit(0)).alias("reads"))
    m = met.filter("sb_index > 0").groupBy("cb_index", "umi_2bit", "sb_index").agg(F.sum("n").alias("reads"))
    staged = cut(M.staged(m, V.beads(spark, sf)))
    told = I.union_all([lost, nosb, staged.groupBy(F.col("stage").alias("step")).agg(F.sum("reads").alias("reads"))])
    every = spark.createDataFrame([(s,) for s in _STEPS], "step string")
    return every.join(told, "step", "left").select("step", F.coalesce("reads", F.lit(0)).alias("reads")), staged


@query("full_waterfall", with_(_FALL, """SELECT * FROM fw UNION ALL SELECT 'total', count(*) FROM reads UNION ALL SELECT 'umis_final', coalesce(sum(umi), 0)::BIGINT FROM cu ANTI JOIN hi USING (sb_index)
    UNION ALL SELECT 'umis_high_bead', coalesce(sum(umi), 0)::BIGINT FROM cu SEMI JOIN hi USING (sb_index)"""))  # fmt: skip
def full_waterfall(spark: SparkSession, sf: str) -> DataFrame:
    """Reads that each step takes away, all of them, and UMIs kept and lost with the beads of most UMIs."""
    steps, staged = _fall(spark, sf)
    total = steps.agg(F.lit("total").alias("step"), F.sum("reads").alias("reads"))
    per = cut(M.count_umis(staged.filter("stage = 'final'")).groupBy("sb_index").agg(F.sum("umi").alias("umi")))
    high = F.col("umi") > M.umi_cutoff(per).scalar()
    sums = per.agg(*(F.coalesce(F.sum(F.when(c, F.col("umi"))), F.lit(0)).alias(n) for n, c in (("umis_final", ~high), ("umis_high_bead", high))))
    return I.union_all([steps, total, sums.unpivot([], ["umis_final", "umis_high_bead"], "step", "reads")])


_ORDER = ", ".join(f"'{s}'" for s in _STEPS)


@query("full_waterfall_pct", with_([*_FALL, f"wo AS (SELECT step, reads, list_position([{_ORDER}], step) AS o FROM fw)"],
    "SELECT step, reads, round(CASE WHEN t - g = 0 THEN 0 ELSE reads * 100.0::DOUBLE / (t - g) END, 2) AS pct FROM (SELECT *, sum(reads) OVER () AS t, coalesce(sum(reads) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM wo) WHERE step <> 'final'"))
def full_waterfall_pct(spark: SparkSession, sf: str) -> DataFrame:
    """Each step's share of the reads that reach it."""
    w = _fall(spark, sf)[0].withColumn("o", F.expr(f"array_position(array({_ORDER}), step)"))
    gone = F.coalesce(F.sum("reads").over(Window.orderBy("o").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    told = w.withColumn("left", F.sum("reads").over(Window.partitionBy()) - gone)
    return told.filter("step <> 'final'").select("step", "reads", F.round(N.ratio_or_zero(F.col("reads"), F.col("left")), 2).alias("pct"))


# --- metric tables ---


@query("position_confidence_wide", PQ._recursive(PQ._POSITIONS, "SELECT (SELECT count(*) FROM cb_list) - count(*) AS with_invalid, " + ", ".join(f"count(*) FILTER (number_clusters = {k}) AS n_{k}" for k in range(4)) + ", count(*) FILTER (number_clusters > 3) AS n_4_up FROM sv"))
def position_confidence_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Cells by number of places in one row; listed cells without spatial barcodes are invalid."""
    n = F.col("number_clusters")
    s = P.salvage(PQ._profile(spark, sf)).agg(F.count("*").alias("there"), *(F.count_if(n == k).alias(f"n_{k}") for k in range(4)), F.count_if(n > 3).alias("n_4_up"))
    both = beside(s, table(spark, sf, "cb_list").agg(F.count("*").alias("listed")))
    return both.select((F.col("listed") - F.col("there")).alias("with_invalid"), *(f"n_{k}" for k in range(4)), "n_4_up")


@query("rna_and_spatial", PQ._recursive([*PQ._ONE, PQ._PLACES, "rn AS (SELECT cb_index, sum(reads)::BIGINT AS rna_reads FROM molecules WHERE cb_index > 0 GROUP BY 1)"],
    "SELECT c.cb_index, coalesce(rna_reads, 0)::BIGINT AS rna_reads, coalesce(umi, 0)::BIGINT AS sb_umi, coalesce(clusters, 0)::BIGINT AS clusters, x_um IS NOT NULL AS placed FROM cb_list c LEFT JOIN rn USING (cb_index) LEFT JOIN dc USING (cb_index)"))
def rna_and_spatial(spark: SparkSession, sf: str) -> DataFrame:
    """Every called cell with its reads, spatial UMIs and clusters, 0 where it has none, and whether it is placed."""
    rna = table(spark, sf, "molecules").filter("cb_index > 0").groupBy("cb_index").agg(F.sum("reads").alias("rna_reads"))
    places = P.cluster_places(PQ._clusters(spark, sf)).select("cb_index", "x_um", "umi", "clusters")
    met = table(spark, sf, "cb_list").select("cb_index").join(rna, "cb_index", "left").join(places, "cb_index", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return met.select("cb_index", zero("rna_reads").alias("rna_reads"), zero("umi").alias("sb_umi"), zero("clusters").alias("clusters"), F.col("x_um").isNotNull().alias("placed"))


@query("barcode_counts_equal", "SELECT (SELECT count(*) FROM cb_list) AS listed, count(DISTINCT cb_index) AS seen, (SELECT count(*) FROM cb_list) = count(DISTINCT cb_index) AS equal FROM molecules WHERE cb_index > 0")
def barcode_counts_equal(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "molecules").filter("cb_index > 0").agg(F.count_distinct("cb_index").alias("seen"))
    return beside(seen, table(spark, sf, "cb_list").agg(F.count("*").alias("listed"))).select("listed", "seen", (F.col("listed") == F.col("seen")).alias("equal"))


#: What a sheet may hold.
YES_NO, SPECIES = ("YES", "NO", "Y", "N"), ("HUMAN", "MOUSE")


@query("sheet_values", r"""SELECT row_id, 'run' AS fault FROM example_metadata WHERE NOT coalesce(upper(trim(run)) IN ('YES', 'NO', 'Y', 'N'), false) UNION ALL SELECT row_id, 'species' FROM example_metadata WHERE NOT coalesce(upper(trim(species)) IN ('HUMAN', 'MOUSE'), false)
    UNION ALL SELECT row_id, 'lane' FROM example_metadata WHERE NOT coalesce(regexp_full_match(lane, '[*]|[1-8](,[1-8])*'), false) UNION ALL SELECT row_id, 'puck_id' FROM example_metadata WHERE NOT coalesce(regexp_full_match(puck_id, 'P[0-9]{5}'), false)""")  # fmt: skip
def sheet_values(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of a sheet that hold none of the allowed values, one row each."""
    rules = {
        "run": F.upper(F.trim("run")).isin(*YES_NO), "species": F.upper(F.trim("species")).isin(*SPECIES),
        "lane": F.col("lane").rlike("^(?:[*]|[1-8](?:,[1-8])*)$") & ~F.col("lane").contains("\n"), "puck_id": F.col("puck_id").rlike("^P[0-9]{5}$") & ~F.col("puck_id").contains("\n"),
    }
    return I.value_faults(table(spark, sf, "example_metadata"), "row_id", rules)


@query("run_dates_or", "SELECT bcl, coalesce(try_strptime(regexp_extract(bcl, '^([0-9]{8})_', 1), '%Y%m%d')::DATE, DATE '2024-01-01') AS run_date, count(*) AS n FROM molecules GROUP BY 1, 2")
def run_dates_or(spark: SparkSession, sf: str) -> DataFrame:
    """The run's date, or the day of the report where its id begins with none."""
    date = F.coalesce(N.run_date(F.col("bcl")), F.lit("2024-01-01").cast("date"))
    return table(spark, sf, "molecules").groupBy("bcl", date.alias("run_date")).agg(F.count("*").alias("n"))


@query("display_names", "SELECT DISTINCT puck_id, regexp_replace(puck_id, '[^A-Za-z0-9]', '', 'g') AS name FROM example_metadata WHERE puck_id IS NOT NULL")
def display_names(spark: SparkSession, sf: str) -> DataFrame:
    """Puck files under the name reports show: without folder and suffix."""
    clean = F.regexp_replace("puck_id", "[^A-Za-z0-9]", "")
    path = F.concat(F.lit("/data/run.1/"), clean, F.lit(".csv.gz"))
    return table(spark, sf, "example_metadata").filter("puck_id IS NOT NULL").select("puck_id", F.regexp_extract(path, r"([^/]*?)(?:\.csv)?(?:\.gz)?$", 1).alias("name")).distinct()


_CELL_SUMS = "cs AS (SELECT cb_index, count(*) AS n, coalesce(sum(reads), 0)::BIGINT AS reads FROM molecules WHERE cb_index > 0 GROUP BY 1)"


def _cell_sums(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "molecules").filter("cb_index > 0").groupBy("cb_index").agg(F.count("*").alias("n"), F.coalesce(F.sum("reads"), F.lit(0)).alias("reads"))


@query("reads_hist_30", with_([_CELL_SUMS, "mm AS (SELECT min(n) AS lo, max(n) AS hi FROM cs)"], "SELECT least((n - lo) * 30 // greatest(hi - lo, 1), 29)::INT AS bin, count(*) AS n FROM cs, mm GROUP BY 1"))
def reads_hist_30(spark: SparkSession, sf: str) -> DataFrame:
    """Cells by number of molecules in 30 even bins."""
    return I.even_bins(_cell_sums(spark, sf).select(F.col("n").alias("v")), "v")


@query("cells_2d_bins", with_([_CELL_SUMS], "SELECT n // 100 AS molecules_bin, reads // 1000 AS reads_bin, count(*) AS cells FROM cs WHERE n >= 500 GROUP BY 1, 2"))
def cells_2d_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of 500 molecules or more by molecules and reads."""
    at = lambda c, w: F.floor(F.col(c) / w)
    return _cell_sums(spark, sf).filter("n >= 500").groupBy(at("n", 100).alias("molecules_bin"), at("reads", 1000).alias("reads_bin")).agg(F.count("*").alias("cells"))


@query("platform_slices_more", with_([SQ._LAYOUT_SQL], """SELECT sb_index, substr(s, 1, 40) AS cb_a, substr(s, 41, 8) AS umi_a, CASE WHEN length(s) >= 63 THEN substr(s, 21, 9) || substr(s, 34, 9) || substr(s, 47, 9) ELSE '' END AS cb_b, CASE WHEN length(s) >= 63 THEN substr(s, 56, 8) ELSE '' END AS umi_b,
    CASE WHEN i >= 0 AND length(s) >= 39 + i THEN substr(s, 1 + i, 8) || substr(s, 12 + i, 6) || substr(s, 21 + i, 6) || substr(s, 32 + i, 8) ELSE '' END AS cb_c, substr(s, 1, 16) AS cb_d
    FROM (SELECT *, instr(substr(s, 27, 8), 'TCGAG') - 1 AS i FROM t)"""))  # fmt: skip
def platform_slices_more(spark: SparkSession, sf: str) -> DataFrame:
    """The four layouts that ``platform_slices`` leaves out; two of them have no UMI in read 1."""
    b = F.col("barcode")
    s = F.concat(F.repeat(b, 3), F.lit("GTGATCGAG"), F.repeat(b, 2))
    t = table(spark, sf, "sb_list").select("sb_index", F.substring(s, (F.col("sb_index") % 9 + 1).cast("int"), F.lit(1000)).alias("s"))
    (ca, ua), (cb, ub), (cc, _), (cd, _) = (R.cell_and_umi("s", k) for k in ("cell40_umi8", "cell27_fixed", "cell28_linker", "cell16"))
    return t.select("sb_index", ca.alias("cb_a"), ua.alias("umi_a"), cb.alias("cb_b"), ub.alias("umi_b"), cc.alias("cb_c"), cd.alias("cb_d"))


_SHEET_COLUMNS = ["lane", "sample", "index"]


@query("sheet_sections", with_([SQ._NORM, SQ._SEL, "lb AS (SELECT bcl, sample_name AS sample, lane, rna_index AS index FROM sl WHERE rna_index <> '')"],
    """SELECT bcl, ord, line FROM (SELECT DISTINCT bcl FROM lb), (SELECT unnest(['[Header]', 'FileFormatVersion,2', '[Data]', 'lane,sample,index']) AS line, unnest(range(0, 4))::INT AS ord)
    UNION ALL SELECT bcl, (row_number() OVER (PARTITION BY bcl ORDER BY lane || ',' || sample || ',' || index) + 3)::INT, lane || ',' || sample || ',' || index FROM lb"""))  # fmt: skip
def sheet_sections(spark: SparkSession, sf: str) -> DataFrame:
    """A sectioned sample sheet for each run, line by line; ``write_sheets`` writes it."""
    rows = S.normal(S.selected(table(spark, sf, "example_metadata"))).filter("rna_index <> ''").select("bcl", "lane", F.col("sample_name").alias("sample"), F.col("rna_index").alias("index"))
    return I.sheet_sections(rows, {"FileFormatVersion": "2"}, "bcl", _SHEET_COLUMNS)


#: The eight metrics that are added up over partitions, and the shares made of them again.
SUMMED = (
    "Total_nuclei_from_single-nuclei_sequencing_library", "Nuclei_from_single-nuclei_sequencing_library_found_in_Trekker_library",
    "Nuclei_from_single-nuclei_sequencing_library_found_in_Trekker_library_with_valid_spatial_barcodes", "Total_readpairs_in_Trekker_library", "Readpairs_with_proper_structure",
    "Readpairs_used_for_matching_to_single_nuclei_barcodes", "Readpairs_matched_single_nuclei_barcodes", "Readpairs_matched_to_single_nuclei_barcodes_with_valid_spatial_barcodes",
)
SHARES = (
    ("Pct_nuclei_in_Trekker_library", 1, 0), ("Pct_nuclei_in_Trekker_library_with_valid_spatial_barcodes", 2, 0), ("Pct_readpairs_with_proper_structure", 4, 3),
    ("Pct_readpairs_used_for_matching", 5, 3), ("Pct_readpairs_matched", 6, 3), ("Pct_readpairs_matched_with_valid_spatial_barcodes", 7, 3),
)
_PARTS = """pt AS (SELECT pair_id, (SELECT count(*) FROM cb_list) AS m0, count(DISTINCT CASE WHEN k THEN cb END) AS m1, count(DISTINCT CASE WHEN k AND g THEN cb END) AS m2, count(*) AS m3, count(*) FILTER (linked) AS m4,
    count(*) FILTER (linked AND umi NOT LIKE '%N%') AS m5, count(*) FILTER (k) AS m6, count(*) FILTER (k AND g) AS m7
    FROM (SELECT v.*, linked AND cb IN (SELECT barcode FROM cb_list) AS k, sb IN (SELECT barcode FROM sb_list) AS g FROM v) GROUP BY 1)"""
_MERGED = [*SQ._VALID, _PARTS, "su AS (SELECT " + ", ".join(f"sum(m{k})::BIGINT AS m{k}" for k in range(8)) + " FROM pt)"]


@query("metrics_merged", with_(_MERGED, " UNION ALL ".join([f"SELECT '{n}' AS metric, printf('%.0f', m{k}::DOUBLE) AS value FROM su" for k, n in enumerate(SUMMED)]
    + [f"SELECT '{n}', printf('%.2f', CASE WHEN m{b} = 0 THEN 0 ELSE m{a} * 100.0::DOUBLE / m{b} END) FROM su" for n, a, b in SHARES])))
def metrics_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Eight metrics of every partition added up, and six shares of the sums."""
    flag = lambda name, col, as_: table(spark, sf, name).select(F.col("barcode").alias(col), F.lit(True).alias(as_))
    r = V.reads(spark, sf).select("pair_id", F.substring("r1", 1, 16).alias("cb"), F.substring("r1", 17, 12).alias("umi"), R.linker_ok("r2").alias("linked"), R.bead_barcode("r2").alias("sb"))
    # rows are counted by what tells them apart before they meet the lists
    n = r.groupBy("pair_id", "cb", "sb", "linked", F.col("umi").contains("N").alias("open")).agg(F.count("*").alias("n"))
    met = n.join(flag("cb_list", "cb", "listed"), "cb", "left").join(flag("sb_list", "sb", "known"), "sb", "left")
    k, g = F.col("linked") & F.col("listed").isNotNull(), F.col("known").isNotNull()
    add = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    parts = met.groupBy("pair_id").agg(
        F.count_distinct(F.when(k, F.col("cb"))).alias("m1"), F.count_distinct(F.when(k & g, F.col("cb"))).alias("m2"), F.sum("n").alias("m3"), add(F.col("linked")).alias("m4"),
        add(F.col("linked") & ~F.col("open")).alias("m5"), add(k).alias("m6"), add(k & g).alias("m7"),
    )
    listed = table(spark, sf, "cb_list").agg(F.count("*").alias("c"))
    sums = beside(parts.agg(*(F.sum(f"m{i}").alias(f"m{i}") for i in range(1, 8)), F.count("*").alias("p")), listed).withColumn("m0", F.col("c") * F.col("p"))
    whole = lambda i: F.format_string("%.0f", F.col(f"m{i}").cast("double"))
    rows: list[tuple[str, Column]] = [(n_, whole(i)) for i, n_ in enumerate(SUMMED)]
    rows += [(n_, F.format_string("%.2f", N.ratio_or_zero(F.col(f"m{a}"), F.col(f"m{b}")))) for n_, a, b in SHARES]
    return sums.select(F.inline(F.array(*(F.struct(F.lit(n_).alias("metric"), v.alias("value")) for n_, v in rows))))


#: Blocks of the assembled metrics: registered queries of one row, whose columns become metrics.
BLOCKS = ("parser_summary", "useful_reads", "saturation", "bead_umi_cutoff", "run_metrics", "position_confidence_wide", "bead_removal_summary", "layout_numbers", "thin_counters", "barcode_counts_equal")


#: Columns of the blocks that are numbers.
COLUMNS = {
    "parser_summary": ("total_reads", "linked_reads", "cells_listed", "cells_matched", "reads_matched", "median_reads", "mean_reads"),
    "useful_reads": ("cells", "reads", "median_reads", "mean_reads"), "saturation": ("saturation", "molecules", "reads"), "bead_umi_cutoff": ("cutoff", "n_beads"),
    "run_metrics": ("cells", "confident", "positioned", *(f"{k}_{c}" for c in PQ._MEANS for k in ("mean", "median"))),
    "position_confidence_wide": ("with_invalid", *(f"n_{k}" for k in range(4)), "n_4_up"),
    "bead_removal_summary": ("cells_2", "cells_3", "cells_4", "saved_2", "saved_3", "saved_4"), "layout_numbers": ("x_range", "y_range", "n"),
    "thin_counters": ("reads_total", "reads_thinned", "rows_thinned"), "barcode_counts_equal": ("listed", "seen"),
}


@query("metrics_assembled", None)
def metrics_assembled(spark: SparkSession, sf: str) -> DataFrame:
    """All blocks of a run's metrics as one long table: ``block, ord, metric, value``.

    Each block is a query of one row that has SQL of its own.
    """
    known = {**SQ.QUERIES, **MQ.QUERIES, **PQ.QUERIES, **QUERIES}
    frames, ord_ = [], 0
    for b in BLOCKS:
        row = known[b](spark, sf).select(*(F.col(c).cast("double").alias(c) for c in COLUMNS[b]))
        told = F.inline(F.array(*(F.struct(F.lit(ord_ + k).alias("ord"), F.lit(c).alias("metric"), F.format_string("%.4f", F.col(c)).alias("value")) for k, c in enumerate(COLUMNS[b]))))
        frames.append(row.select(F.lit(b).alias("block"), told))
        ord_ += len(COLUMNS[b])
    return I.union_all(frames)
