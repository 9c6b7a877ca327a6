"""Cell kernels, sequences, dictionaries and molecule steps on hand-made cases."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from beadloom.functions import formats as N
from beadloom.functions import seq
from beadloom.operators import dictionary as D
from beadloom.operators import kernels as K
from beadloom.operators import metadata as S
from beadloom.operators import molecules as M
from beadloom.operators import positioning as P
from beadloom.operators import profile_reads as R

MOL = "cb_index long, umi_2bit long, sb_index long, reads long"
UP = seq.LINKER


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "s string").select(expr).first()[0]


@pytest.mark.parametrize("s, run, most", [("AACCCCGTTN", 4, 4), ("", 0, 0), ("AAAAAAAACGTACG", 8, 9), ("NNNN", 4, 4)])
def test_runs(spark, s, run, most):
    assert one(spark, s, seq.longest_run("s")) == run and one(spark, s, seq.most_common("s")) == most


@pytest.mark.parametrize(
    "r2, state",
    [
        ("A" * 8 + UP + "CCCCCC", "exact"), ("A" * 8 + "A" + UP[1:] + "CCCCCC", "-1X"), ("A" * 8 + "G" * 15 + "TTT" + "CCCCCC", "GG"), ("A" * 7 + UP + "CCCCCCC", "1D-"),
        ("A" * 7 + "A" + UP[1:] + "CCCCCCC", "1D-1X"), ("A" * 8 + UP[:5] + UP[6:] + "CCCCCCC", "-1D"), ("A" * 8 + "AA" + UP[2:] + "CCCCCC", "-2X"), ("A" * 32, "none"),
    ],
)
def test_linker_classes(spark, r2, state):
    assert seq.with_linker(spark.createDataFrame([(r2,)], "r2 string")).first()["linker"] == state


@pytest.mark.parametrize("umi, state", [("ACGTNACGTACG", "umi_N"), ("AAAAAAAAAACG", "umi_homopolymer"), ("AAAAAAAAACGT", "ok")])
def test_umi_states(spark, umi, state):
    assert one(spark, umi, seq.umi_state("s")) == state


def test_umi_round_trip_and_middle_swap(spark):
    assert one(spark, "GACTTCAGGACT", seq.umi_decode(seq.umi_encode("s"))) == "GACTTCAGGACT"
    assert one(spark, "AAAAAAATCAAAAAAA", seq.swap_middle("s")) == "AAAAAAAAGAAAAAAA"
    assert one(spark, "AAAAAAATTAAAAAAA", seq.swap_middle("s")) == "AAAAAAATTAAAAAAA"


def plain_dictionary(beads):
    """As the definition has it, entry by entry."""
    d = {}

    def put(key, value):
        d[key] = (0, 0) if key in d else value

    for i, b in beads:
        if b.count("N") == 0:
            for p, c in itertools.product(range(14), "ACGTN"):
                if b[p] != c:
                    f = b[:p] + c + b[p + 1 :]
                    put((f[:8], f[8:]), (i, p + 1))
            for p in range(8):
                put((b[:p] + b[p + 1 : 8], b[8:]), (i, -(p + 1)))
        elif b.count("N") == 1:
            for c in "NACGT":
                f = b.replace("N", c)
                put((f[:8], f[8:]), (i, b.index("N") + 1))
    for i, b in beads:
        if "N" not in b:
            d[b[:8], b[8:]] = (i, 0)
    return d


def test_dictionary_against_the_plain_way(spark):
    rng = np.random.default_rng(3)
    beads = [(k + 1, "".join(rng.choice(list("ACGT"), 14))) for k in range(40)]
    beads += [(50, beads[0][1][:13] + "A"), (51, "ACGTNACGTACGTA"), (52, "NCGTNACGTACGTA"), (53, "AACCGGTTAACCGG")]
    beads = [(i, b) for i, b in {b: (i, b) for i, b in reversed(beads)}.values()]
    got = {(r["sb1"], r["sb2"]): (r["sb_index"], r["pos"]) for r in D.bead_dictionary(spark.createDataFrame(beads, "sb_index long, barcode string")).collect()}
    assert got == plain_dictionary(beads)


def test_edit_match_prefers_the_same_last_base_then_the_smaller(spark):
    """The last bead is of low complexity and takes no part, though it is there as it is."""
    beads = spark.createDataFrame([("ACGTACGTACGTAC",), ("ACGTACGTACGTCA",), ("CCGGTTAACCGGTT",), ("GGGGGGGGGGGGGT",)], "bead string")
    obs = spark.createDataFrame([("ACGTACGTACGTAA",), ("CCGGTTAACCGGTT",), ("GGGGGGGGGGGGGT",), ("TTTTCCCCTTTTCC",)], "barcode string")
    got = {r["barcode"]: (r["bead"], r["distance"]) for r in D.blocked_edit_match(obs, beads).collect()}
    assert got == {"ACGTACGTACGTAA": ("ACGTACGTACGTCA", 1), "CCGGTTAACCGGTT": ("CCGGTTAACCGGTT", 0)}


def test_chimeras(spark):
    rows = [(1, 1, 1, 5), (1, 2, 1, 5), (1, 2, 2, 3), (1, 3, 1, 4), (1, 3, 2, 4), (1, 4, 1, 9), (1, 4, 2, 2), (1, 4, 3, 2)]
    kept = M.flag_chimeras(spark.createDataFrame(rows, MOL)).filter("NOT chimeric")
    assert {(r["umi_2bit"], r["sb_index"]) for r in kept.collect()} == {(1, 1), (2, 1), (4, 1)}


def test_saturation_ends(spark):
    m = spark.createDataFrame([(1, k, 1, 1 + k % 4) for k in range(100)], MOL)
    got = {r["fraction"]: r for r in M.expected_saturation(m, [0.0, 0.5, 1.0]).collect()}
    assert got[0.0]["umis"] == 0 and abs(got[1.0]["umis"] - 100) < 1e-6 and 50 < got[0.5]["umis"] < 100


@pytest.mark.parametrize("v, w, want", [([1, 2, 3], [1, 1, 1], 2.0), ([1, 2], [1, 1], 1.5), ([1, 2, 3, 4], [1, 1, 1, 1], 2.5), ([5], [3], 5.0), ([1, 10], [3, 1], 2 / 8 * 9 + 1), ([1, 9, 2], [1, 0, 1], 1.5)])
def test_weighted_median(v, w, want):
    assert abs(K.weighted_median(np.array(v, float), np.array(w)) - want) < 1e-9


def test_h_index():
    assert K.h_index(np.array([5, 4, 4, 1])) == 3 and K.h_index(np.array([1])) == 1 and K.h_index(np.array([])) == 0


def plain_clusters(x, y, w, eps, m):
    near = (x[:, None] - x) ** 2 + (y[:, None] - y) ** 2 <= eps * eps
    core = near @ w >= m
    out, k = np.zeros(len(x), int), 0
    for i in range(len(x)):
        if core[i] and not out[i]:
            k += 1
            todo = [i]
            while todo:
                j = todo.pop()
                if not out[j]:
                    out[j] = k
                    if core[j]:
                        todo += np.flatnonzero(near[j] & (out == 0) & core).tolist()
    for i in np.flatnonzero(~core):
        reach = out[near[i] & core]
        out[i] = reach.min() if len(reach) else 0
    return out


@pytest.mark.parametrize("n", [1, 2, 30, 90, 400])
def test_clusters_against_the_plain_way(n):
    rng = np.random.default_rng(n)
    x, y, w = rng.uniform(0, 300, n), rng.uniform(0, 300, n), rng.integers(1, 6, n).astype(float)
    for eps, m in itertools.product((15.0, 40.0), (1, 4, 12, 40)):
        assert np.array_equal(K.dbscan(x, y, w, eps, m), plain_clusters(x, y, w, eps, m))


def test_two_peaks():
    x, y, u = np.array([0, 1, 2, 500, 501.0]), np.zeros(5), np.array([3, 3, 3, 2, 2.0])
    p = K.two_peaks(x, y, u, 800.0, 200.0)
    assert abs(p["x_um"] - 1) < 1e-9 and abs(p["x2_um"] - 500.5) < 1e-9 and p["d1"] > p["d2"] > 0 and p["h"] == 3
    assert K.two_peaks(x[:1], y[:1], u[:1], 800.0, 200.0)["d2"] == 0.0


def test_cells_over_several_batches_and_null_places(spark):
    rows = [(c, float(k), 0.0, 2) for c in range(6) for k in range(40)] + [(None, 1.0, 1.0, 1), (9, None, 1.0, 1)]
    old, P._BATCH = P._BATCH, 50
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = P.cluster_places(P.clusters(spark.createDataFrame(rows, "cb_index long, x_um double, y_um double, umi long"), 5.0, 4)).collect()
    finally:
        P._BATCH = old
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r["cb_index"], r["clusters"], r["beads"]) for r in got} == {(c, 1, 40) for c in range(6)}


def test_search_grows_while_the_best_lies_at_the_edge(spark):
    rows = [(c, float(k % 5), float(k // 5), 3) for c in range(3) for k in range(25)]
    eps, m, tried = P.best_parameters(spark.createDataFrame(rows, "cb_index long, x_um double, y_um double, umi long"))
    assert (eps, m) == (50.0, 3) and len(tried) == 80
    assert P.best_parameters(spark.createDataFrame([], "cb_index long, x_um double, y_um double, umi long"))[2] == []


def test_rescue_only_takes_lost_cells(spark):
    """Cell 4 has clusters, but none survived: it is not lost."""
    cols = "cb_index long, x_um double, y_um double, number_clusters long, number_clusters_o long, rep_status int, nc_0 long"
    first = spark.createDataFrame([(1, 0.0, 0.0, 0, 0, 0, 0), (2, 5.0, 5.0, 1, 1, 0, 1), (3, 0.0, 0.0, 0, 0, 0, 0), (4, 0.0, 0.0, 0, 0, 0, 2)], cols)
    again = spark.createDataFrame([(1, 7.0, 8.0, 1), (2, 9.0, 9.0, 1), (3, 0.0, 0.0, 0), (4, 6.0, 6.0, 1)], "cb_index long, x_um double, y_um double, number_clusters long")
    assert {(r["cb_index"], r["x_um"], r["rep_status"]) for r in P.rescue(first, again).collect()} == {(1, 7.0, 2), (2, 5.0, 0), (3, 0.0, 0), (4, 0.0, 0)}


def test_metadata_repeats_and_conflicts(spark):
    base = dict.fromkeys(S.CONTENT, None) | {"sample_name": "s", "bcl": "b", "run": "YES", "lane": "1"}
    rows = [base | {"row_id": 1}, base | {"row_id": 2, "lane": " 1 "}, base | {"row_id": 3, "lane": "2", "email": "x"}, base | {"row_id": 4, "sample_name": "t"}]
    df = spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{c} string" for c in S.CONTENT))
    assert {(r["row_id"], r["n_rows"]) for r in S.without_repeats(df).collect()} == {(1, 2), (3, 1), (4, 1)}
    assert [tuple(r) for r in S.conflicts(df).collect()] == [("b", "s", 2, "email,lane")]


def test_formats(spark):
    assert one(spark, "1,234", N.parse_count(F.col("s"))) == 1234 and one(spark, "85.7%", N.parse_percent(F.col("s"))) == 85.7 and one(spark, "x", N.parse_percent(F.col("s"))) is None
    assert one(spark, "Pct_useful_reads", N.metric_label(F.col("s"))) == "% Useful reads" and one(spark, "Total_reads", N.metric_label(F.col("s"))) == "Total reads"
    assert one(spark, "1, 12", N.lane_tokens(F.col("s"))) == ["L001", "L012"] and one(spark, "1,*", N.lane_tokens(F.col("s"))) == [] and one(spark, None, N.lane_tokens(F.col("s"))) == []
    assert one(spark, "a", N.ratio_or_zero(F.lit(5), F.lit(0))) == 0.0


def test_layouts(spark):
    s = "".join("ACGT"[k % 4] for k in range(80))
    for name in (*R.LAYOUTS, *R.SHIFTED):
        cb, umi = R.cell_and_umi("s", name)
        row = spark.createDataFrame([(s,), ("ACGT",)], "s string").select(cb.alias("c"), umi.alias("u")).collect()
        assert row[1]["c"] == row[1]["u"] == ""
    linked = "T" * 3 + "A" * 9 + "GTGA" + "C" * 9 + "GGGG" + "T" * 9 + "ACACACAC" + "T" * 9
    cb, umi = R.cell_and_umi("s", "cell27_linker")
    assert tuple(spark.createDataFrame([(linked,)], "s string").select(cb, umi).first()) == ("A" * 9 + "C" * 9 + "T" * 9, "ACACACAC")
