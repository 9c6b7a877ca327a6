"""Places of cells from their beads: parameter sweep, density clusters, two-peak density, final placement.

A cell-bead table has one row per cell and bead, so what a cell may bring to a task is bounded by the beads of its
pucks. Cells of a task are worked on side by side without a frame of their own; the kernels hold pairs of near beads, never a
full distance matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beadloom.operators import kernels
from beadloom.runtime import cut, parts

#: The reference search grid, density width, radius and accepted ratio of both peaks.
EPS, FIRST_MIN_PTS, LAST_MIN_PTS = (50.0, 100.0), 3, 42
WIDTH, RADIUS = 800.0, 200.0


Kernel = Callable[[np.ndarray, np.ndarray, np.ndarray], list[tuple]]
_BATCH = 100_000


def per_cell(beads: DataFrame, kernel: Kernel, schema: str) -> DataFrame:
    """Rows ``(cb_index, *made)`` of ``kernel(x, y, umi)`` for each cell, its beads in order of place; a null cell or place is left out."""
    names = [c.split()[0] for c in schema.split(", ")]
    rows = beads.filter("cb_index IS NOT NULL AND x_um IS NOT NULL AND y_um IS NOT NULL").select("cb_index", "x_um", "y_um", F.col("umi").cast("double").alias("umi"))
    placed = rows.repartition(parts(beads.sparkSession), "cb_index").sortWithinPartitions("cb_index", "x_um", "y_um", "umi")

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def work(last: bool) -> Iterator[pd.DataFrame]:
            pdf = pd.concat(held, ignore_index=True)
            held.clear()
            cb, x, y, w = (pdf[c].to_numpy() for c in ("cb_index", "x_um", "y_um", "umi"))
            edges = np.flatnonzero(np.diff(cb)) + 1
            starts, ends = [0, *edges.tolist()], [*edges.tolist(), len(cb)]
            if not last:  # the last cell may go on
                held.append(pdf.iloc[starts[-1] :])
                starts, ends = starts[:-1], ends[:-1]
            out = [(int(cb[i]), *row) for i, j in zip(starts, ends) for row in kernel(x[i:j], y[i:j], w[i:j])]
            if out:
                yield pd.DataFrame(out, columns=names)

        for pdf in pdfs:
            held.append(pdf)
            if sum(map(len, held)) >= _BATCH:
                yield from work(False)
        if held and sum(map(len, held)):
            yield from work(True)

    return placed.mapInPandas(run, schema)


def sweep(beads: DataFrame, eps: tuple[float, ...] = EPS, min_pts: tuple[int, ...] = tuple(range(FIRST_MIN_PTS, LAST_MIN_PTS + 1))) -> DataFrame:
    """``eps, min_pts, n_cells, n_one, n_some``: cells with exactly one cluster and with at least one, for every pair.

    Each cell's distances and core weights are made once per ``eps``; counts for all ``min_pts`` follow from them.
    """
    values = np.array(min_pts)

    def kernel(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[tuple]:
        return [(np.concatenate([kernels.cluster_counts(x, y, w, e, values) for e in eps]).tolist(),)]

    made = per_cell(beads, kernel, "cb_index long, clusters array<long>")
    # cells of equal counts are added up before the counts are taken apart
    n, m = len(values), F.col("at")
    flat = made.groupBy("clusters").agg(F.count("*").alias("n")).select("n", F.posexplode("clusters").alias("at", "clusters"))
    each = flat.select(F.element_at(F.array(*map(F.lit, eps)), (F.floor(m / n) + 1).cast("int")).alias("eps"), F.element_at(F.array(*map(F.lit, min_pts)), (m % n + 1).cast("int")).alias("min_pts"), "clusters", "n")
    return each.groupBy("eps", "min_pts").agg(
        F.sum("n").alias("n_cells"), F.sum(F.when(F.col("clusters") == 1, F.col("n")).otherwise(0)).alias("n_one"), F.sum(F.when(F.col("clusters") >= 1, F.col("n")).otherwise(0)).alias("n_some")
    )


def best_parameters(beads: DataFrame, eps: tuple[float, ...] = EPS, rounds: int = 27) -> tuple[float, int, list[dict]]:
    """The pair with the largest share of single-cluster cells; the range of ``min_pts`` grows while the best lies in its last tenth.

    Ties go to the smaller ``min_pts``, then to the first ``eps``. Only one row per pair comes to the driver.
    """
    block, rows = LAST_MIN_PTS - FIRST_MIN_PTS + 1, []
    for k in range(rounds):
        values = tuple(range(FIRST_MIN_PTS + k * block, LAST_MIN_PTS + 1 + k * block))
        rows += [r.asDict() for r in sweep(beads, eps, values).collect()]
        share: dict[int, float] = {}
        for r in rows:
            share[r["min_pts"]] = max(share.get(r["min_pts"], 0.0), r["n_one"] / r["n_cells"])
        order = sorted(share)
        best = max(order, key=lambda m: (share[m], -m)) if order else FIRST_MIN_PTS
        if not order or (order.index(best) + 1) / len(order) < 0.9:
            break
    if not rows:
        return eps[0], FIRST_MIN_PTS, []
    top = min(rows, key=lambda r: (-r["n_one"] / r["n_cells"], r["min_pts"], eps.index(r["eps"])))
    return top["eps"], top["min_pts"], rows


CLUSTERED = "cb_index long, x_um double, y_um double, umi long, cluster int"


def clusters(beads: DataFrame, eps: float, min_pts: int, border: bool = False) -> DataFrame:
    """Every bead with its cluster, 0 for noise; clusters are numbered by their first bead in order of place."""

    def kernel(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[tuple]:
        return list(zip(x.tolist(), y.tolist(), w.astype(int).tolist(), kernels.dbscan(x, y, w, eps, min_pts, border).tolist()))

    return per_cell(beads, kernel, CLUSTERED)


def cluster_places(clustered: DataFrame) -> DataFrame:
    """One row per cell: clusters, UMIs, beads, and centre and signal share if there is exactly one cluster."""
    one = F.col("cluster") == 1
    w = F.when(one, F.col("umi"))
    agg = clustered.groupBy("cb_index").agg(
        F.max("cluster").alias("clusters"), F.sum("umi").alias("umi"), F.count("*").alias("beads"), F.sum(w).alias("own"),
        F.sum(w * F.col("x_um")).alias("sx"), F.sum(w * F.col("y_um")).alias("sy"),
    )
    if_one = lambda v: F.when(F.col("clusters") == 1, v)
    return agg.select(
        "cb_index", if_one(F.col("sx") / F.col("own")).alias("x_um"), if_one(F.col("sy") / F.col("own")).alias("y_um"),
        "clusters", "umi", "beads", if_one(F.col("own") / F.col("umi")).alias("snr"),
    )


PEAKS = "cb_index long, x_um double, y_um double, x2_um double, y2_um double, d1 double, d2 double, sumi double, sbeads long, max double, r double, h long"


def peaks(beads: DataFrame, width: float = WIDTH, radius: float = RADIUS) -> DataFrame:
    """Two-peak density of each cell, with ``ratio`` of both densities."""

    names = [c.split()[0] for c in PEAKS.split(", ")][1:]

    def kernel(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[tuple]:
        got = kernels.two_peaks(x, y, w, width, radius)
        return [tuple(got[c] for c in names)]

    return per_cell(beads, kernel, PEAKS).withColumn("ratio", F.col("d2") / F.col("d1"))


def placement(places: DataFrame, tops: DataFrame) -> DataFrame:
    """Cluster centre where both peaks differ enough (ratio under a third), else null; one row per cell of both."""
    p = places.withColumnsRenamed({"x_um": "x_um_dbscan", "y_um": "y_um_dbscan"})
    k = tops.withColumnsRenamed({"x_um": "x_um_kde", "y_um": "y_um_kde", "x2_um": "x2_um_kde", "y2_um": "y2_um_kde"})
    sure = F.col("ratio") < F.lit(1.0) / 3
    both = p.join(k, "cb_index")
    return both.select("cb_index", F.when(sure, F.col("x_um_dbscan")).alias("x_um"), F.when(sure, F.col("y_um_dbscan")).alias("y_um"), *(c for c in both.columns if c != "cb_index"))


def agreement(placed: DataFrame) -> DataFrame:
    """Contingency of both methods: ``dbscan_pass, kde_pass, n, pct``; a ratio over a third hides the density's view."""
    flags = placed.select((F.col("clusters") == 1).alias("dbscan_pass"), (F.col("ratio") <= F.lit(1.0) / 3).alias("kde_pass"))
    n = flags.groupBy("dbscan_pass", "kde_pass").agg(F.count("*").alias("n"))
    return n.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4))


# --- the profile path: border points, survivors, weighted medians, salvage and rescue ---

PROFILE = (
    "cb_index long, x_um double, y_um double, number_clusters long, sb_total long, sb_umi_total long, sb_noise long, sb_umi_noise long, sb_top_cluster long, "
    "sb_umi_top_cluster long, umimax long, nc_0 long, dist_max double, n_lone long, sx_um double, sy_um double"
)


def profile_cell(x: np.ndarray, y: np.ndarray, w: np.ndarray, eps: float, min_pts: int, umi_floor: int, close: float) -> list[tuple]:
    """One cell: unplaced is 0, not null. ``n_lone`` clusters have one place only; ``sx_um, sy_um`` is the salvage centre of the other one."""
    label = kernels.dbscan(x, y, w, eps, min_pts, True)
    m = int(label.max(initial=0))
    out = {
        "x_um": 0.0, "y_um": 0.0, "number_clusters": m, "sb_total": len(x), "sb_umi_total": int(w.sum()),
        "sb_noise": int((label == 0).sum()), "sb_umi_noise": int(w[label == 0].sum()), "sb_top_cluster": int((label == 1).sum()), "sb_umi_top_cluster": int(w[label == 1].sum()),
        "umimax": int(w.max()), "nc_0": m, "dist_max": 0.0, "n_lone": 0, "sx_um": 0.0, "sy_um": 0.0,
    }
    spots = {k: len(np.unique(np.stack([x[label == k], y[label == k]], 1), axis=0)) for k in range(1, m + 1)}
    centre = lambda k: (kernels.weighted_median(x[k], w[k]), kernels.weighted_median(y[k], w[k]))
    out["n_lone"] = sum(n == 1 for n in spots.values())
    if m > 1 and out["n_lone"] == m - 1:
        out["sx_um"], out["sy_um"] = centre(label == next(k for k, n in spots.items() if n != 1))
    good = [k for k in spots if spots[k] > 1 and w[label == k].max() > umi_floor]
    if m >= 1 and not good:
        out["number_clusters"] = 0
    elif m >= 1:
        keep = np.isin(label, good)
        if m > 1:
            c = np.array([centre(label == k) for k in good])
            out["dist_max"] = float(np.sqrt(((c[:, None] - c[None]) ** 2).sum(-1)).max())
            if out["dist_max"] <= close:
                out["number_clusters"] = 1
            best = int(np.flatnonzero(keep)[np.argmax(w[keep])])
            keep = label == label[best]
        out["x_um"], out["y_um"] = centre(keep)
    return [tuple(out.values())]


def profile(beads: DataFrame, eps: float, min_pts: int, umi_floor: int = 1, close: float = 100.0) -> DataFrame:
    return per_cell(beads, lambda x, y, w: profile_cell(x, y, w, eps, min_pts, umi_floor, close), PROFILE)


def with_shares(p: DataFrame) -> DataFrame:
    """Four shares of beads and UMIs in noise and in the top cluster."""
    s = lambda a, b, c: F.round(F.col(a) / F.col(b), 6).alias(c)
    return p.select(
        "*", s("sb_noise", "sb_total", "prop_sb_noise"), s("sb_umi_noise", "sb_umi_total", "prop_umi_noise"),
        s("sb_top_cluster", "sb_total", "prop_sb_top"), s("sb_umi_top_cluster", "sb_umi_total", "prop_umi_top"),
    )


def salvage(p: DataFrame) -> DataFrame:
    """Cells of several clusters of which all but one have a single place get the centre of that one: ``rep_status`` 1."""
    can = (F.col("number_clusters") > 1) & (F.col("nc_0") > 1) & (F.col("n_lone") == F.col("nc_0") - 1)
    return p.select(
        "cb_index", F.when(can, F.col("sx_um")).otherwise(F.col("x_um")).alias("x_um"), F.when(can, F.col("sy_um")).otherwise(F.col("y_um")).alias("y_um"),
        F.when(can, 1).otherwise(F.col("number_clusters")).alias("number_clusters"), F.col("number_clusters").alias("number_clusters_o"), F.when(can, 1).otherwise(0).alias("rep_status"), "nc_0",
    )


def rescue(salvaged: DataFrame, again: DataFrame) -> DataFrame:
    """Cells without any cluster (``nc_0`` is 0, before survivors are chosen) take their place from a second clustering where it found one: ``rep_status`` 2."""
    new = again.filter("number_clusters > 0").select("cb_index", F.col("x_um").alias("nx"), F.col("y_um").alias("ny"), F.col("number_clusters").alias("nn"))
    met = salvaged.join(new, "cb_index", "left")
    use = (F.col("nc_0") == 0) & F.col("nn").isNotNull()
    return met.select(
        "cb_index", F.when(use, F.col("nx")).otherwise(F.col("x_um")).alias("x_um"), F.when(use, F.col("ny")).otherwise(F.col("y_um")).alias("y_um"),
        F.when(use, F.col("nn")).otherwise(F.col("number_clusters")).alias("number_clusters"), "number_clusters_o", F.when(use, 2).otherwise(F.col("rep_status")).alias("rep_status"),
    )


# --- both paths with the parameters their search finds ---


def placed_at_best(beads: DataFrame) -> DataFrame:
    """``placement`` of all cells with the ``eps`` and ``min_pts`` that ``best_parameters`` finds; ``beads`` is read several times."""
    eps, min_pts, _ = best_parameters(beads)
    return placement(cluster_places(clusters(beads, eps, min_pts)), peaks(beads))


def best_min_pts(beads: DataFrame, eps: float, values: tuple[int, ...]) -> int:
    """The first of ``values`` with the largest share (in hundredths of a percent) of cells with one cluster; the first of all without cells."""
    share = {r["min_pts"]: round(100.0 * r["n_one"] / r["n_cells"], 2) for r in sweep(beads, (eps,), values).collect()}
    return max(values, key=lambda m: share.get(m, 0.0))


def profile_at_best(beads: DataFrame, eps: float, values: tuple[int, ...], umi_floor: int = 1, close: float = 100.0) -> DataFrame:
    """Profile, salvage and rescue; ``min_pts`` is swept over all cells, and over those without any cluster (``nc_0`` 0) once more."""
    first = cut(salvage(profile(beads, eps, best_min_pts(beads, eps, values), umi_floor, close)))
    lost = cut(beads.join(first.filter("nc_0 = 0").select("cb_index"), "cb_index", "left_semi"))
    return rescue(first, profile(lost, eps, best_min_pts(lost, eps, values), umi_floor, close))
