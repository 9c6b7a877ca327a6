"""Queries that place cells: clusters, parameter sweep, two-peak density, and the profile path."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beadloom.operators import positioning as P
from beadloom.plans import views as V
from beadloom.plans.registry import Catalogue, with_
from beadloom.runtime import cut, table

query = Catalogue()
QUERIES, ORACLE = query.queries, query.oracle

#: Parameters of the queries whose result depends on one pair; the sweep finds the best one.
EPS, MIN_PTS = 50.0, 4
#: Added before rounding, so that exact halves do not fall either way by the last bit of a sum.
NUDGE = 1.7e-07
SWEEP = tuple(range(3, 43, 3))
PROFILE_EPS, PROFILE_SWEEP, UMI_FLOOR, CLOSE = 50.0, tuple(range(2, 11)), 1, 100.0

_NODES = [*V.CELL_BEADS, "nd AS (SELECT cb_index, x_um, y_um, umi, row_number() OVER (PARTITION BY cb_index ORDER BY x_um, y_um, umi) AS i FROM cell_bead)"]
_PAIRS = "pr AS (SELECT a.cb_index, a.i, b.i AS j, b.umi AS w, (a.x_um - b.x_um) ** 2 + (a.y_um - b.y_um) ** 2 AS d2 FROM nd a JOIN nd b USING (cb_index))"


def _labels(eps: tuple[float, ...], min_pts: tuple[int, ...]) -> list[str]:
    """``lb``: core points with the first core point of their cluster, for every pair of parameters."""
    return [
        *_NODES, _PAIRS,
        f"ow AS (SELECT cb_index, i, eps, sum(w) AS own FROM pr, (SELECT unnest([{', '.join(map(str, eps))}]::DOUBLE[]) AS eps) WHERE d2 <= eps * eps GROUP BY ALL)",
        f"co AS (SELECT cb_index, i, eps, mp FROM ow, (SELECT unnest([{', '.join(map(str, min_pts))}]::INT[]) AS mp) WHERE own >= mp)",
        "ed AS (SELECT a.eps, a.mp, a.cb_index, a.i, b.i AS j FROM co a JOIN pr USING (cb_index, i) JOIN co b ON b.cb_index = a.cb_index AND b.i = pr.j AND b.eps = a.eps AND b.mp = a.mp WHERE d2 <= a.eps * a.eps)",
        "re AS (SELECT * FROM ed UNION SELECT re.eps, re.mp, re.cb_index, re.i, ed.j FROM re JOIN ed ON ed.eps = re.eps AND ed.mp = re.mp AND ed.cb_index = re.cb_index AND ed.i = re.j)",
        "lb AS (SELECT eps, mp, cb_index, i, min(j) AS low FROM re GROUP BY ALL)",
    ]


def _recursive(parts: list[str], body: str) -> str:
    return "WITH RECURSIVE " + ", ".join(parts) + " " + body


_SWEPT = [*_labels(P.EPS, SWEEP), "ct AS (SELECT eps, mp, cb_index, count(DISTINCT low) AS c FROM lb GROUP BY ALL)", "al AS (SELECT count(DISTINCT cb_index) AS n FROM nd)",
    f"gr AS (SELECT unnest([{', '.join(map(str, P.EPS))}]::DOUBLE[]) AS eps)", f"gm AS (SELECT unnest([{', '.join(map(str, SWEEP))}]::INT[]) AS mp)",
    "sw AS (SELECT gr.eps, gm.mp AS min_pts, any_value(al.n) AS n_cells, count(*) FILTER (c = 1) AS n_one, count(*) FILTER (c >= 1) AS n_some FROM gr CROSS JOIN gm CROSS JOIN al LEFT JOIN ct ON ct.eps = gr.eps AND ct.mp = gm.mp GROUP BY ALL)"]


@query("dbscan_sweep", _recursive(_SWEPT, "SELECT * FROM sw"))
def dbscan_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return P.sweep(V.cell_beads(spark, sf), P.EPS, SWEEP)


@query("dbscan_best")
def dbscan_best(spark: SparkSession, sf: str) -> DataFrame:
    """The whole search: 2 x 40 pairs a round, more rounds while the best lies at the edge."""
    eps, min_pts, rows = P.best_parameters(cut(V.cell_beads(spark, sf)))
    top = max((r["n_one"] / r["n_cells"] for r in rows), default=0.0)
    return spark.createDataFrame([(float(eps), int(min_pts), float(top), len(rows))], "eps double, min_pts int, share_one double, n_tried int")


_ONE = [*_labels((EPS,), (MIN_PTS,)), "cl AS (SELECT nd.*, CASE WHEN low IS NULL THEN 0 ELSE dense_rank() OVER (PARTITION BY nd.cb_index ORDER BY coalesce(low, 1e9)) END::INT AS cluster FROM nd LEFT JOIN lb ON lb.cb_index = nd.cb_index AND lb.i = nd.i)"]


def _clusters(spark: SparkSession, sf: str) -> DataFrame:
    return P.clusters(V.cell_beads(spark, sf), EPS, MIN_PTS)


@query("dbscan_clusters", _recursive(_ONE, "SELECT cb_index, round(x_um, 6) AS x_um, round(y_um, 6) AS y_um, umi, cluster FROM cl"))
def dbscan_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return _clusters(spark, sf).select("cb_index", F.round("x_um", 6).alias("x_um"), F.round("y_um", 6).alias("y_um"), "umi", "cluster")


_PLACES = "dc AS (SELECT cb_index, CASE WHEN max(cluster) = 1 THEN sum(umi * x_um) FILTER (cluster = 1) / sum(umi) FILTER (cluster = 1) END AS x_um, CASE WHEN max(cluster) = 1 THEN sum(umi * y_um) FILTER (cluster = 1) / sum(umi) FILTER (cluster = 1) END AS y_um, max(cluster) AS clusters, sum(umi)::BIGINT AS umi, count(*) AS beads, CASE WHEN max(cluster) = 1 THEN sum(umi) FILTER (cluster = 1)::DOUBLE / sum(umi) END AS snr FROM cl GROUP BY 1)"


def _rounded(df: DataFrame, places: int = 4, nudge: float = NUDGE) -> DataFrame:
    return df.select(*(F.round(F.col(c) + nudge, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@query("dbscan_coords", _recursive([*_ONE, _PLACES], "SELECT cb_index, round(x_um + 1.7e-07, 4) AS x_um, round(y_um + 1.7e-07, 4) AS y_um, clusters, umi, beads, round(snr + 1.7e-07, 4) AS snr FROM dc"))
def dbscan_coords(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(P.cluster_places(_clusters(spark, sf)))


_PEAKS = [
    "kb AS (SELECT *, count(*) OVER (PARTITION BY cb_index) AS n, max(umi) OVER (PARTITION BY cb_index) AS top FROM nd)",
    "kk AS (SELECT * FROM kb WHERE n = 1 OR top < 3 OR umi > 1)",
    "kd AS (SELECT a.cb_index, a.i, a.x_um, a.y_um, a.umi, a.top, sum(b.umi * exp(-((a.x_um - b.x_um) ** 2 + (a.y_um - b.y_um) ** 2) / 800)) AS dens FROM kk a JOIN kk b USING (cb_index) GROUP BY ALL)",
    "k1 AS (SELECT * FROM kd QUALIFY row_number() OVER (PARTITION BY cb_index ORDER BY round(dens, 9) DESC, x_um, y_um) = 1)",
    "kn AS (SELECT kd.*, (kd.x_um - k1.x_um) ** 2 + (kd.y_um - k1.y_um) ** 2 < 40000 AS near FROM kd JOIN k1 USING (cb_index))",
    "k2 AS (SELECT * FROM kn WHERE NOT near QUALIFY row_number() OVER (PARTITION BY cb_index ORDER BY round(dens, 9) DESC, x_um, y_um) = 1)",
    "km AS (SELECT kn.*, coalesce((kn.x_um - k2.x_um) ** 2 + (kn.y_um - k2.y_um) ** 2 < 40000, false) AS near2, row_number() OVER (PARTITION BY kn.cb_index, kn.near ORDER BY kn.umi DESC, kn.i) AS nth FROM kn LEFT JOIN k2 USING (cb_index))",
    """ka AS (SELECT cb_index, sum(umi * x_um) FILTER (near) / sum(umi) FILTER (near) AS x_um, sum(umi * y_um) FILTER (near) / sum(umi) FILTER (near) AS y_um,
        sum(umi * x_um) FILTER (near2) / sum(umi) FILTER (near2) AS x2_um, sum(umi * y_um) FILTER (near2) / sum(umi) FILTER (near2) AS y2_um, sum(umi) FILTER (near)::DOUBLE AS sumi,
        count(*) FILTER (near) AS sbeads, max(top)::DOUBLE AS max, sum(umi) FILTER (near)::DOUBLE / max(umi) FILTER (near) AS r, max(least(umi, nth)) FILTER (near)::BIGINT AS h FROM km GROUP BY 1)""",
    "kp AS (SELECT ka.cb_index, ka.x_um, ka.y_um, x2_um, y2_um, k1.dens AS d1, coalesce(k2.dens, 0) AS d2, sumi, sbeads, ka.max, r, h, coalesce(k2.dens, 0) / k1.dens AS ratio FROM ka JOIN k1 USING (cb_index) LEFT JOIN k2 USING (cb_index))",
]
_R4 = lambda *c: ", ".join(f"round({x} + {NUDGE}, 4) AS {x}" for x in c)


def _peaks(spark: SparkSession, sf: str) -> DataFrame:
    return P.peaks(V.cell_beads(spark, sf))


@query("kde_peaks", with_([*_NODES, *_PEAKS], f"SELECT cb_index, {_R4('x_um', 'y_um', 'x2_um', 'y2_um', 'd1', 'd2', 'sumi')}, sbeads, {_R4('max', 'r')}, h, {_R4('ratio')} FROM kp"))
def kde_peaks(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_peaks(spark, sf))


@query("h_index", with_(_NODES, "SELECT cb_index, max(least(umi, nth))::BIGINT AS h FROM (SELECT cb_index, umi, row_number() OVER (PARTITION BY cb_index ORDER BY umi DESC, i) AS nth FROM nd) GROUP BY 1"))
def h_index(spark: SparkSession, sf: str) -> DataFrame:
    """Largest h with at least h beads of h UMIs or more, from a histogram per cell."""
    n = V.cell_beads(spark, sf).groupBy("cb_index", "umi").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("cb_index").orderBy(F.desc("umi")))
    return n.withColumn("upto", upto).groupBy("cb_index").agg(F.max(F.least("umi", "upto")).alias("h"))


_BOTH = [*_ONE, _PLACES, *_PEAKS, """pl AS (SELECT cb_index, CASE WHEN ratio < 1.0 / 3 THEN dc.x_um END AS x_um, CASE WHEN ratio < 1.0 / 3 THEN dc.y_um END AS y_um, dc.x_um AS x_um_dbscan, dc.y_um AS y_um_dbscan,
    clusters, umi, beads, kp.x_um AS x_um_kde, kp.y_um AS y_um_kde, d1, d2, ratio FROM dc JOIN kp USING (cb_index))"""]  # fmt: skip


def _placed(spark: SparkSession, sf: str) -> DataFrame:
    beads = cut(V.cell_beads(spark, sf))  # read by both views of a cell
    return P.placement(P.cluster_places(P.clusters(beads, EPS, MIN_PTS)), P.peaks(beads))


@query("final_placement", _recursive(_BOTH, f"SELECT cb_index, {_R4('x_um', 'y_um', 'x_um_dbscan', 'y_um_dbscan')}, clusters, umi, beads, {_R4('x_um_kde', 'y_um_kde', 'd1', 'd2', 'ratio')} FROM pl"))
def final_placement(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_placed(spark, sf).select("cb_index", "x_um", "y_um", "x_um_dbscan", "y_um_dbscan", "clusters", "umi", "beads", "x_um_kde", "y_um_kde", "d1", "d2", "ratio"))


@query("placement_contingency", _recursive(_BOTH, "SELECT clusters = 1 AS dbscan_pass, ratio <= 1.0 / 3 AS kde_pass, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 4) AS pct FROM pl GROUP BY 1, 2"))
def placement_contingency(spark: SparkSession, sf: str) -> DataFrame:
    return P.agreement(_placed(spark, sf))


@query("all_cells_coords", _recursive([*_ONE, _PLACES], "SELECT c.cb_index, round(x_um + 1.7e-07, 4) AS x_um, round(y_um + 1.7e-07, 4) AS y_um, clusters FROM cb_list c LEFT JOIN dc USING (cb_index)"))
def all_cells_coords(spark: SparkSession, sf: str) -> DataFrame:
    """Every called cell, with nulls where it has no place."""
    places = P.cluster_places(_clusters(spark, sf)).select("cb_index", "x_um", "y_um", "clusters")
    return _rounded(table(spark, sf, "cb_list").select("cb_index").join(places, "cb_index", "left"))


@query("cluster_hist", _recursive([*_ONE, _PLACES], "SELECT least(clusters, 5)::INT AS clusters, count(*) AS n, round(median(umi), 4) AS median_umi, round(avg(snr), 6) AS mean_snr FROM dc GROUP BY 1"))
def cluster_hist(spark: SparkSession, sf: str) -> DataFrame:
    p = P.cluster_places(_clusters(spark, sf))
    return p.groupBy(F.least("clusters", F.lit(5)).cast("int").alias("clusters")).agg(F.count("*").alias("n"), F.round(F.median("umi"), 4).alias("median_umi"), F.round(F.avg("snr"), 6).alias("mean_snr"))


# --- the profile path ---

_MEDIAN = """(SELECT cb_index, cluster, CASE WHEN lo IS NULL THEN hi WHEN hi IS NULL THEN lo ELSE lo + (0.5 - lm) / (hm - lm) * (hi - lo) END AS {v} FROM
    (SELECT cb_index, cluster, arg_max({v}, mid) FILTER (mid <= 0.5) AS lo, max(mid) FILTER (mid <= 0.5) AS lm, arg_min({v}, mid) FILTER (mid > 0.5) AS hi, min(mid) FILTER (mid > 0.5) AS hm FROM
    (SELECT cb_index, cluster, {v}, (sum(umi) OVER (PARTITION BY cb_index, cluster ORDER BY {v}, i ROWS UNBOUNDED PRECEDING) - umi / 2.0::DOUBLE) / sum(umi) OVER (PARTITION BY cb_index, cluster) AS mid FROM pf WHERE cluster > 0) GROUP BY ALL))"""


def _profiled(eps: float, min_pts: int, floor: int = UMI_FLOOR) -> list[str]:
    return [
        *_labels((eps,), (min_pts,)),
        "cr AS (SELECT cb_index, i, dense_rank() OVER (PARTITION BY cb_index ORDER BY low) AS cluster FROM lb)",
        f"bo AS (SELECT pr.cb_index, pr.i, min(cr.cluster) AS cluster FROM pr JOIN cr ON cr.cb_index = pr.cb_index AND cr.i = pr.j ANTI JOIN cr c0 ON c0.cb_index = pr.cb_index AND c0.i = pr.i WHERE d2 <= {eps * eps} GROUP BY 1, 2)",
        "pf AS (SELECT nd.*, coalesce(cr.cluster, bo.cluster, 0) AS cluster FROM nd LEFT JOIN cr USING (cb_index, i) LEFT JOIN bo USING (cb_index, i))",
        f"md AS (SELECT * FROM {_MEDIAN.format(v='x_um')} JOIN {_MEDIAN.format(v='y_um')} USING (cb_index, cluster))",
        "ck AS (SELECT cb_index, cluster, count(DISTINCT (x_um, y_um)) AS spots, max(umi) AS top FROM pf WHERE cluster > 0 GROUP BY 1, 2)",
        f"gd AS (SELECT * FROM ck JOIN md USING (cb_index, cluster) WHERE spots > 1 AND top > {floor})",
        "ds AS (SELECT a.cb_index, max(sqrt((a.x_um - b.x_um) ** 2 + (a.y_um - b.y_um) ** 2)) AS d, count(DISTINCT a.cluster) AS n FROM gd a JOIN gd b USING (cb_index) GROUP BY 1)",
        "bs AS (SELECT pf.cb_index, pf.cluster FROM pf SEMI JOIN gd USING (cb_index, cluster) QUALIFY row_number() OVER (PARTITION BY pf.cb_index ORDER BY umi DESC, i) = 1)",
        """ag AS (SELECT cb_index, max(cluster) AS m, count(*) AS sb_total, sum(umi)::BIGINT AS sb_umi_total, count(*) FILTER (cluster = 0) AS sb_noise, coalesce(sum(umi) FILTER (cluster = 0), 0)::BIGINT AS sb_umi_noise,
            count(*) FILTER (cluster = 1) AS sb_top_cluster, coalesce(sum(umi) FILTER (cluster = 1), 0)::BIGINT AS sb_umi_top_cluster, max(umi)::BIGINT AS umimax FROM pf GROUP BY 1)""",
        "ln AS (SELECT cb_index, count(*) FILTER (spots = 1) AS n_lone, min(cluster) FILTER (spots <> 1) AS other FROM ck GROUP BY 1)",
        f"""po AS (SELECT ag.cb_index, coalesce(mb.x_um, 0) AS x_um, coalesce(mb.y_um, 0) AS y_um, CASE WHEN m = 0 OR ds.n IS NULL THEN 0 WHEN m > 1 AND ds.d <= {CLOSE} THEN 1 ELSE m END AS number_clusters,
            sb_total, sb_umi_total, sb_noise, sb_umi_noise, sb_top_cluster, sb_umi_top_cluster, umimax, m AS nc_0, CASE WHEN m > 1 THEN coalesce(ds.d, 0) ELSE 0 END AS dist_max, coalesce(n_lone, 0) AS n_lone,
            CASE WHEN m > 1 AND n_lone = m - 1 THEN ms.x_um ELSE 0 END AS sx_um, CASE WHEN m > 1 AND n_lone = m - 1 THEN ms.y_um ELSE 0 END AS sy_um
            FROM ag LEFT JOIN ds USING (cb_index) LEFT JOIN bs USING (cb_index) LEFT JOIN md mb ON mb.cb_index = ag.cb_index AND mb.cluster = bs.cluster
            LEFT JOIN ln ON ln.cb_index = ag.cb_index LEFT JOIN md ms ON ms.cb_index = ag.cb_index AND ms.cluster = ln.other)""",
        """sv AS (SELECT cb_index, CASE WHEN number_clusters > 1 AND nc_0 > 1 AND n_lone = nc_0 - 1 THEN sx_um ELSE x_um END AS x_um, CASE WHEN number_clusters > 1 AND nc_0 > 1 AND n_lone = nc_0 - 1 THEN sy_um ELSE y_um END AS y_um,
            CASE WHEN number_clusters > 1 AND nc_0 > 1 AND n_lone = nc_0 - 1 THEN 1 ELSE number_clusters END AS number_clusters, number_clusters AS number_clusters_o,
            (number_clusters > 1 AND nc_0 > 1 AND n_lone = nc_0 - 1)::INT AS rep_status, nc_0 FROM po)""",
    ]


_POSITIONS = _profiled(PROFILE_EPS, 4)
_POS_COLS = f"cb_index, {_R4('x_um', 'y_um')}, number_clusters, sb_total, sb_umi_total, sb_noise, sb_umi_noise, sb_top_cluster, sb_umi_top_cluster, umimax, nc_0, {_R4('dist_max')}, n_lone, {_R4('sx_um', 'sy_um')}"


def _profile(spark: SparkSession, sf: str, min_pts: int = 4) -> DataFrame:
    return P.profile(V.cell_beads(spark, sf), PROFILE_EPS, min_pts, UMI_FLOOR, CLOSE)


@query("profile_positions", _recursive(_POSITIONS, f"SELECT {_POS_COLS} FROM po"))
def profile_positions(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_profile(spark, sf))


@query("profile_shares", _recursive(_POSITIONS, "SELECT cb_index, round(sb_noise::DOUBLE / sb_total, 4) AS prop_sb_noise, round(sb_umi_noise::DOUBLE / sb_umi_total, 4) AS prop_umi_noise, round(sb_top_cluster::DOUBLE / sb_total, 4) AS prop_sb_top, round(sb_umi_top_cluster::DOUBLE / sb_umi_total, 4) AS prop_umi_top FROM po"))
def profile_shares(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(P.with_shares(_profile(spark, sf)).select("cb_index", "prop_sb_noise", "prop_umi_noise", "prop_sb_top", "prop_umi_top"), nudge=0.0)


_PSWEEP = [*_labels((PROFILE_EPS,), PROFILE_SWEEP), "ct AS (SELECT mp, cb_index, count(DISTINCT low) AS c FROM lb GROUP BY ALL)", "al AS (SELECT count(DISTINCT cb_index) AS n FROM nd)",
    f"gm AS (SELECT unnest([{', '.join(map(str, PROFILE_SWEEP))}]::INT[]) AS mp)"]


@query("profile_sweep", _recursive(_PSWEEP, f"SELECT {PROFILE_EPS}::DOUBLE AS eps, gm.mp AS min_pts, round(100.0::DOUBLE * count(*) FILTER (c = 1) / any_value(al.n), 2) AS pct_one, round(100.0::DOUBLE * count(*) FILTER (c >= 1) / any_value(al.n), 2) AS pct_some FROM gm CROSS JOIN al LEFT JOIN ct USING (mp) GROUP BY 1, 2"))
def profile_sweep(spark: SparkSession, sf: str) -> DataFrame:
    s = P.sweep(V.cell_beads(spark, sf), (PROFILE_EPS,), PROFILE_SWEEP)
    pct = lambda c, a: F.round(100.0 * F.col(c) / F.col("n_cells"), 2).alias(a)
    return s.select("eps", "min_pts", pct("n_one", "pct_one"), pct("n_some", "pct_some"))


@query("salvage", _recursive(_POSITIONS, f"SELECT cb_index, {_R4('x_um', 'y_um')}, number_clusters, number_clusters_o, rep_status FROM sv"))
def salvage(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(P.salvage(_profile(spark, sf)).drop("nc_0"))


def _rescued(spark: SparkSession, sf: str) -> DataFrame:
    """Cells without any cluster are clustered again, by themselves, with half the weight asked for."""
    beads = cut(V.cell_beads(spark, sf))
    first = cut(P.salvage(P.profile(beads, PROFILE_EPS, 4, UMI_FLOOR, CLOSE)))
    lost = beads.join(first.filter("nc_0 = 0").select("cb_index"), "cb_index", "left_semi")
    return P.rescue(first, P.profile(lost, PROFILE_EPS, 2, UMI_FLOOR, CLOSE))


def _again(parts: list[str]) -> list[str]:
    """The steps after the pairs once more, under names of their own."""
    own = re.compile(r"\b(ow|co|ed|re|lb|cr|bo|pf|md|ck|gd|ds|bs|ag|ln|po|sv)\b(?! \()")
    return [own.sub(r"\1_2", p) for p in parts[len(_NODES) + 1 :]]


_RESCUED = [*_POSITIONS, *_again(_profiled(PROFILE_EPS, 2))]
_USE = "sv.nc_0 = 0 AND coalesce(po_2.number_clusters, 0) > 0"


@query(
    "zero_rescue",
    _recursive(_RESCUED, f"""SELECT cb_index, round(CASE WHEN {_USE} THEN po_2.x_um ELSE sv.x_um END + {NUDGE}, 4) AS x_um, round(CASE WHEN {_USE} THEN po_2.y_um ELSE sv.y_um END + {NUDGE}, 4) AS y_um,
        CASE WHEN {_USE} THEN po_2.number_clusters ELSE sv.number_clusters END AS number_clusters, number_clusters_o, CASE WHEN {_USE} THEN 2 ELSE rep_status END::INT AS rep_status FROM sv LEFT JOIN po_2 USING (cb_index)"""),
)
def zero_rescue(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_rescued(spark, sf))


@query("rep_crosstab", _recursive(_POSITIONS, "SELECT least(number_clusters_o, 4)::INT AS clusters, count(*) FILTER (rep_status = 0) AS rep_0, count(*) FILTER (rep_status = 1) AS rep_1, count(*) FILTER (rep_status = 2) AS rep_2 FROM sv GROUP BY 1"))
def rep_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    s = P.salvage(_profile(spark, sf)).select(F.least("number_clusters_o", F.lit(4)).cast("int").alias("clusters"), "rep_status")
    wide = s.groupBy("clusters").pivot("rep_status", [0, 1, 2]).count().fillna(0)
    return wide.select("clusters", *(F.col(str(k)).alias(f"rep_{k}") for k in range(3)))


@query("bead_removal_summary", _recursive(_POSITIONS, "SELECT count(*) FILTER (number_clusters_o = 2) AS cells_2, count(*) FILTER (number_clusters_o = 3) AS cells_3, count(*) FILTER (number_clusters_o >= 4) AS cells_4, count(*) FILTER (number_clusters_o = 2 AND rep_status = 1) AS saved_2, count(*) FILTER (number_clusters_o = 3 AND rep_status = 1) AS saved_3, count(*) FILTER (number_clusters_o >= 4 AND rep_status = 1) AS saved_4 FROM sv"))
def bead_removal_summary(spark: SparkSession, sf: str) -> DataFrame:
    s, n, r = P.salvage(_profile(spark, sf)), F.col("number_clusters_o"), F.col("rep_status") == 1
    bins = {"2": n == 2, "3": n == 3, "4": n >= 4}
    return s.agg(*(F.count_if(c).alias(f"cells_{k}") for k, c in bins.items()), *(F.count_if(c & r).alias(f"saved_{k}") for k, c in bins.items()))


@query("position_confidence", _recursive(_POSITIONS, "SELECT CASE WHEN number_clusters = 0 THEN 'none' WHEN number_clusters >= 4 THEN '4+' ELSE number_clusters::VARCHAR END AS bucket, count(*) AS n FROM sv GROUP BY 1"))
def position_confidence(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("number_clusters")
    bucket = F.when(c == 0, "none").when(c >= 4, "4+").otherwise(c.cast("string"))
    return P.salvage(_profile(spark, sf)).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


_MEANS = ["sb_total", "sb_umi_total", "sb_noise", "sb_umi_noise", "sb_top_cluster", "sb_umi_top_cluster"]


@query("run_metrics", _recursive(_POSITIONS, "SELECT count(*) AS cells, count(*) FILTER (number_clusters = 1) AS confident, count(*) FILTER (number_clusters >= 1) AS positioned, " + ", ".join(f"round(avg({c}), 4) AS mean_{c}, round(median({c}), 4) AS median_{c}" for c in _MEANS) + " FROM po"))
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    p = _profile(spark, sf)
    stats = [f for c in _MEANS for f in (F.round(F.avg(c), 4).alias(f"mean_{c}"), F.round(F.median(c), 4).alias(f"median_{c}"))]
    return p.agg(F.count("*").alias("cells"), F.count_if(F.col("number_clusters") == 1).alias("confident"), F.count_if(F.col("number_clusters") >= 1).alias("positioned"), *stats)


# --- whole searches, beside the queries above with fixed parameters; recursive SQL is too slow for them ---

_FINAL = ["cb_index", "x_um", "y_um", "x_um_dbscan", "y_um_dbscan", "clusters", "umi", "beads", "x_um_kde", "y_um_kde", "d1", "d2", "ratio"]
#: Covers the sweeps of all platforms of the reference, which end at 15 to 80.
PROFILE_GRID = tuple(range(4, 81))


@query("final_placement_best")
def final_placement_best(spark: SparkSession, sf: str) -> DataFrame:
    """``final_placement`` with the pair that the search finds."""
    return _rounded(P.placed_at_best(cut(V.cell_beads(spark, sf))).select(*_FINAL))


@query("zero_rescue_best")
def zero_rescue_best(spark: SparkSession, sf: str) -> DataFrame:
    """``zero_rescue`` with minPts from one sweep over all cells and one over those without a cluster."""
    return _rounded(P.profile_at_best(cut(V.cell_beads(spark, sf)), PROFILE_EPS, PROFILE_GRID, UMI_FLOOR, CLOSE))


@query("dbscan_sweep_full")
def dbscan_sweep_full(spark: SparkSession, sf: str) -> DataFrame:
    """All 80 pairs of the reference grid."""
    return P.sweep(V.cell_beads(spark, sf))


@query("profile_sweep_full")
def profile_sweep_full(spark: SparkSession, sf: str) -> DataFrame:
    """``profile_sweep`` over the grids of all platforms."""
    s = P.sweep(V.cell_beads(spark, sf), (PROFILE_EPS,), PROFILE_GRID)
    pct = lambda c, a: F.round(100.0 * F.col(c) / F.col("n_cells"), 2).alias(a)
    return s.select("eps", "min_pts", pct("n_one", "pct_one"), pct("n_some", "pct_some"))
