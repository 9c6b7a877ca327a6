"""Queries over an expression matrix; the driver's tables have none, so one is made of molecules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beadloom.operators import expression as E
from beadloom.operators import positioning as P
from beadloom.plans import position_queries as Q
from beadloom.plans import views as V
from beadloom.plans.registry import Catalogue, with_
from beadloom.runtime import cut, table

query = Catalogue()
QUERIES, ORACLE = query.queries, query.oracle

_EX = "ex AS (SELECT cb_index AS cell, CASE WHEN sb_index % 40 < 4 THEN 'MT-' ELSE 'G' END || (sb_index % 40) AS gene, count(*) AS n FROM mol WHERE cb_index > 0 GROUP BY ALL)"
_EXPR = [*V.MOLECULES, _EX]


def expression(spark: SparkSession, sf: str) -> DataFrame:
    """Molecules of called cells under forty gene names, four of them mitochondrial."""
    k = F.col("sb_index") % 40
    gene = F.concat(F.when(k < 4, "MT-").otherwise("G"), k.cast("string"))
    return V.matrix(spark, sf).filter("cb_index > 0").groupBy(F.col("cb_index").alias("cell"), gene.alias("gene")).agg(F.count("*").alias("n"))


_round = lambda df, *cols: df.select(*(F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns))


@query("cell_totals", with_(_EXPR, "SELECT cell, sum(n)::BIGINT AS n_counts, count(*) AS n_genes, round(coalesce(sum(n) FILTER (gene LIKE 'MT-%'), 0) * 100.0::DOUBLE / sum(n), 6) AS pct_mt, round(log10(sum(n)), 6) AS log10_counts FROM ex GROUP BY 1"))
def cell_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _round(E.cell_totals(expression(spark, sf)), "pct_mt", "log10_counts")


_LOGN = "ln AS (SELECT cell, gene, ln(1 + n / sum(n) OVER (PARTITION BY cell) * 1e4::DOUBLE) AS value FROM ex)"


@query("log_normalize", with_([*_EXPR, _LOGN], "SELECT cell, gene, round(value, 6) AS value FROM ln"))
def log_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _round(E.log_normal(expression(spark, sf)), "value")


@query("tf_idf", with_(_EXPR, "SELECT cell, gene, round(ln(1 + n::DOUBLE / sum(n) OVER (PARTITION BY cell) * (SELECT count(DISTINCT cell) FROM ex) / sum(n) OVER (PARTITION BY gene) * 1e4), 6) AS value FROM ex"))
def tf_idf(spark: SparkSession, sf: str) -> DataFrame:
    return _round(E.tf_idf(expression(spark, sf)), "value")


@query("variable_genes", with_([*_EXPR, _LOGN, "nc AS (SELECT count(DISTINCT cell) AS c FROM ex)"], "SELECT gene, round(v, 6) AS variance FROM (SELECT gene, (sum(value * value) - sum(value) * sum(value) / any_value(c)) / (any_value(c) - 1) AS v FROM ln, nc GROUP BY 1) ORDER BY round(v, 9) DESC, gene LIMIT 10"))
def variable_genes(spark: SparkSession, sf: str) -> DataFrame:
    """The ten genes of most variance: a top-k report."""
    ex = expression(spark, sf)
    return _round(E.variable_genes(E.log_normal(ex), ex.agg(F.count_distinct("cell")), 10), "variance")


_RANKS = [*_EXPR, _LOGN, "cs AS (SELECT DISTINCT cell, (cell % 3)::INT AS grp FROM ex)", "gn AS (SELECT DISTINCT gene FROM ex)",
    "fl AS (SELECT gn.gene, cs.cell, cs.grp, round(coalesce(ln.value, 0), 9) AS value FROM gn CROSS JOIN cs LEFT JOIN ln ON ln.gene = gn.gene AND ln.cell = cs.cell)",
    "rk AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY value) + (count(*) OVER (PARTITION BY gene, value) - 1) / 2.0::DOUBLE AS r, count(*) OVER (PARTITION BY gene) AS c FROM fl)"]


@query("rank_sums", with_(_RANKS, "SELECT grp, gene, round(sum(r) - count(*) * (count(*) + 1) / 2.0::DOUBLE, 4) AS u, count(*) AS n_in, any_value(c) - count(*) AS n_out FROM rk GROUP BY 1, 2 HAVING max(value) > 0"))
def rank_sums(spark: SparkSession, sf: str) -> DataFrame:
    ex = cut(expression(spark, sf))
    groups = ex.select("cell", (F.col("cell") % 3).cast("int").alias("grp")).distinct()
    return E.rank_sums(E.log_normal(ex), groups).withColumn("u", F.round("u", 4))


def _places(spark: SparkSession, sf: str) -> DataFrame:
    return P.cluster_places(P.clusters(V.cell_beads(spark, sf), Q.EPS, Q.MIN_PTS)).filter("x_um IS NOT NULL").select(F.col("cb_index").alias("cell"), F.col("x_um").alias("x"), F.col("y_um").alias("y"))


_MORAN = [*Q._ONE, Q._PLACES, _EX, _LOGN, "pt AS (SELECT cb_index AS cell, x_um AS x, y_um AS y FROM dc WHERE x_um IS NOT NULL)",
    "nn AS (SELECT a.cell AS a, b.cell AS b FROM pt a JOIN pt b ON a.cell <> b.cell AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 40000)",
    "gn AS (SELECT DISTINCT gene FROM ln SEMI JOIN pt USING (cell))", "fv AS (SELECT gn.gene, pt.cell, coalesce(ln.value, 0) AS v FROM gn CROSS JOIN pt LEFT JOIN ln ON ln.gene = gn.gene AND ln.cell = pt.cell)",
    "dv AS (SELECT *, v - avg(v) OVER (PARTITION BY gene) AS d FROM fv)"]


@query("morans_i", Q._recursive(_MORAN, "SELECT gene, round((SELECT count(*) FROM pt) * sum(pr) / ((SELECT count(*) FROM nn) * any_value(low)), 5) AS moran FROM (SELECT x.gene, sum(x.d * y.d) AS pr FROM dv x JOIN nn ON nn.a = x.cell JOIN dv y ON y.gene = x.gene AND y.cell = nn.b GROUP BY 1) JOIN (SELECT gene, sum(d * d) AS low FROM dv GROUP BY 1) USING (gene) GROUP BY 1"))
def morans_i(spark: SparkSession, sf: str) -> DataFrame:
    """Spatial autocorrelation of every gene over placed cells."""
    places = cut(_places(spark, sf))
    return E.morans_i(cut(E.log_normal(expression(spark, sf))), places, 200.0).withColumn("moran", F.round("moran", 5))


@query("intronic_share", "SELECT cb_index AS cell, round(avg((umi_2bit % 3 = 0)::INT) * 100, 6) AS pct_intronic, count(*) AS n FROM molecules WHERE cb_index > 0 GROUP BY 1")
def intronic_share(spark: SparkSession, sf: str) -> DataFrame:
    """Share of molecules whose kind is 0, here every third UMI."""
    kind = F.when(F.col("umi_2bit") % 3 == 0, 1.0).when(F.col("umi_2bit").isNotNull(), 0.0)
    return table(spark, sf, "molecules").filter("cb_index > 0").groupBy(F.col("cb_index").alias("cell")).agg(F.round(F.avg(kind) * 100, 6).alias("pct_intronic"), F.count("*").alias("n"))


@query("placed_by_group", Q._recursive([*Q._ONE, Q._PLACES], "SELECT (cb_index % 5)::INT AS grp, count(*) AS n, round(count(x_um) * 100.0::DOUBLE / count(*), 0)::BIGINT || '%' AS placed FROM cb_list LEFT JOIN dc USING (cb_index) GROUP BY 1"))
def placed_by_group(spark: SparkSession, sf: str) -> DataFrame:
    p = P.cluster_places(P.clusters(V.cell_beads(spark, sf), Q.EPS, Q.MIN_PTS)).select("cb_index", "x_um")
    met = table(spark, sf, "cb_list").select("cb_index").join(p, "cb_index", "left")
    pct = F.round(F.count("x_um") * 100.0 / F.count("*"), 0).cast("long").cast("string")
    return met.groupBy((F.col("cb_index") % 5).cast("int").alias("grp")).agg(F.count("*").alias("n"), F.concat(pct, F.lit("%")).alias("placed"))


@query("merged_samples", with_(V.MOLECULES, "SELECT chr((65 + cb_index % 2)::INT) || '_' || cb_index AS cell, count(*) AS n, sum(reads)::BIGINT AS reads FROM mol WHERE cb_index > 0 GROUP BY 1"))
def merged_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Two samples put together, cells told apart by their sample's name before them."""
    per = V.matrix(spark, sf).filter("cb_index > 0").groupBy("cb_index").agg(F.count("*").alias("n"), F.sum("reads").alias("reads"))
    named = lambda k, s: per.filter(F.col("cb_index") % 2 == k).select(F.concat(F.lit(s), "cb_index").alias("cell"), "n", "reads")
    return named(0, "A_").unionByName(named(1, "B_"))


@query("umi_bins", with_([*V.CELL_BEADS, "mx AS (SELECT min(log10(umi)) AS lo, max(log10(umi)) AS hi FROM pb)"], "SELECT least(floor((log10(umi) - lo) / (hi - lo) * 100), 99)::INT AS bin, count(*) AS n FROM pb, mx GROUP BY 1"))
def umi_bins(spark: SparkSession, sf: str) -> DataFrame:
    """A histogram of 100 bins over the logarithm, the last bin closed."""
    pb = cut(_per_bead(spark, sf)).select(F.log10("umi").alias("v"))
    lo, hi = pb.agg(F.min("v")).scalar(), pb.agg(F.max("v")).scalar()
    return pb.groupBy(F.least(F.floor((F.col("v") - lo) / (hi - lo) * 100), F.lit(99)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def _per_bead(spark: SparkSession, sf: str) -> DataFrame:
    from beadloom.operators import molecules as M

    kept = M.staged(V.matrix(spark, sf), V.beads(spark, sf)).filter("stage = 'final'")
    return M.count_umis(kept).groupBy("sb_index").agg(F.sum("umi").alias("umi"))


@query("class_samples", None)
def class_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Twelve cells at most of each number of clusters, chosen by a hash: a sampling operator."""
    p = P.cluster_places(P.clusters(V.cell_beads(spark, sf), Q.EPS, Q.MIN_PTS)).select("cb_index", F.least("clusters", F.lit(5)).alias("kind"))
    nth = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("cb_index"), "cb_index"))
    return p.withColumn("nth", nth).filter("nth <= 12")


_Z = "(u - n_in * n_out / 2.0::DOUBLE) / sqrt(n_in * n_out * (n_in + n_out + 1) / 12.0::DOUBLE)"


@query("marker_genes", with_([*_RANKS, "us AS (SELECT grp, gene, sum(r) - count(*) * (count(*) + 1) / 2.0::DOUBLE AS u, count(*) AS n_in, any_value(c) - count(*) AS n_out FROM rk GROUP BY 1, 2 HAVING max(value) > 0)"],
    f"SELECT grp, gene, round({_Z}, 4) AS z, row_number() OVER (PARTITION BY grp ORDER BY round({_Z}, 4) DESC, gene) AS place FROM us WHERE {_Z} > 0 QUALIFY place <= 5"))
def marker_genes(spark: SparkSession, sf: str) -> DataFrame:
    """The five genes of each group that stand highest above the rest: a top-k report."""
    ex = cut(expression(spark, sf))
    s = E.rank_sums(E.log_normal(ex), ex.select("cell", (F.col("cell") % 3).cast("int").alias("grp")).distinct())
    both = F.col("n_in") * F.col("n_out")
    z = (F.col("u") - both / 2.0) / F.sqrt(both * (F.col("n_in") + F.col("n_out") + 1) / 12.0)
    w = Window.partitionBy("grp").orderBy(F.desc("z"), "gene")
    return s.select("grp", "gene", F.round(z, 4).alias("z")).filter("z > 0").withColumn("place", F.row_number().over(w).cast("long")).filter("place <= 5")
