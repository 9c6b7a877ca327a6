import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from beadloom.operators import packed_fields as P



CELLS = [
    ("1,2", ["1", "2"]), ("*", ["*"]), ('"4|6"', ["4", "6"]), (" '6\n8' ", ["6", "8"]), ('BC001;"BC002 rep 3",BC3', ["BC001", "BC002 rep 3", "BC3"]),
    ("“BC001,lot7”,BC009", ["BC001,lot7", "BC009"]), ('"a","b"', ["a", "b"]), ("[BC_003 BC-005 “BC-014”]", ["BC_003", "BC-005", "BC-014"]), ("", []), ("  ,;| ", []),
    ('"AB004 rep 3"', ["AB004", "rep", "3"]), ('1,"', ["1"]), ("5' a", ["5", "a"]), ('"";x', ["x"]), ("a，b、c", ["a", "b", "c"]), ('"', []), ("é1", ["1"]),
]


def test_values(spark):
    """Each in a field of its own, so that no cell learns from another."""
    names = [f"f{k}" for k in range(len(CELLS))]
    df = spark.createDataFrame([(1, *(c for c, _ in CELLS))], "row_id long, " + ", ".join(f"{n} string" for n in names))
    got = {n: [] for n in names}
    for r in P.unpack(df, "row_id", names).orderBy("pos").collect():
        got[r["field_name"]].append((r["pos"], r["item_text"]))
    assert list(got.values()) == [list(enumerate(want, 1)) for _, want in CELLS]


def test_rows_positions_repeats_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "1,2", None, "x"), (1, "1,2", "", "y"), (2, None, "a" * 30000 + ",b", "z")], "row_id long, lane string, sb_lane string, ident string")
    got = sorted(tuple(r)[:4] for r in P.unpack(df, "row_id", ["lane", "sb_lane"]).collect())
    assert got[:4] == [(1, "lane", 1, "1"), (1, "lane", 1, "1"), (1, "lane", 2, "2"), (1, "lane", 2, "2")]
    assert [g[2:] for g in got[4:]] == [(1, "a" * 30000), (2, "b")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "row_id long, lane string")
    assert P.unpack(df, "row_id", ["lane"]).count() == 0


def glued(share):
    """Lists of two of nine values; a share of them without the separator."""
    return [(k, f"BC{k % 9:03d}" + ("" if k % 100 < share else ",") + f"BC{k // 9 % 9:03d}") for k in range(600)]


def test_glued_values_are_told_apart_by_what_the_column_holds(spark):
    rows = glued(0) + [(900, "BC001BC005"), (901, "BC003BC002BC008"), (902, "'BC001BC005',BC002"), (903, "BC001XX")]
    df = spark.createDataFrame(rows, "row_id long, lane string")
    got = P.unpack(df, "row_id", ["lane"], glue=100.0).filter("row_id >= 900").orderBy("row_id", "pos").collect()
    assert [(r["row_id"], r["pos"], r["item_text"]) for r in got] == [(900, 1, "BC001"), (900, 2, "BC005"), (901, 1, "BC003"), (901, 2, "BC002"), (901, 3, "BC008"), (902, 1, "BC001BC005"), (902, 2, "BC002"), (903, 1, "BC001XX")]


def test_how_often_values_are_glued_is_learned(spark):
    """Nothing is glued: the chance of it is learned to be none, and rare values made of frequent ones stay whole."""
    lanes = [(k, str(k % 8 + 1)) for k in range(3000)] + [(5000, "12"), (5001, "7,12"), (5002, "34"), (5003, "123")]
    m = P.model_of(spark.createDataFrame(lanes, "row_id long, lane string"), ["lane"])
    assert m.splits.count() == 0 and m.glue["lane"] < 1e-6
    assert {r["value"]: round(r["uses"], 3) for r in m.values.collect() if len(r["value"]) > 1} == {"12": 2.0, "34": 1.0, "123": 1.0}


def test_the_answer_rests_on_learning_and_on_the_best_path(spark, monkeypatch):
    df = spark.createDataFrame(glued(20), "row_id long, lane string")
    rows = lambda: sorted(map(tuple, P.unpack(df, "row_id", ["lane"], glue=100.0).collect()))
    right = rows()
    monkeypatch.setattr(P, "viterbi", lambda n, starts, ends, weights: [(0, n)])
    assert rows() != right
    monkeypatch.undo()
    monkeypatch.setattr(P, "_log_p", lambda uses: uses.withColumn("log_p", -F.abs(F.hash("value")).cast("double")))
    assert rows() != right


def test_expected_uses_against_all_paths():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = int(rng.integers(1, 7))
        edges = [(i, j) for i in range(n) for j in range(i + 1, n + 1)]
        w = dict(zip(edges, np.log(rng.uniform(0.01, 1, len(edges)))))
        paths = [[(a, b) for a, b in zip([0, *cut], [*cut, n])] for r in range(n) for cut in itertools.combinations(range(1, n), r)]
        p = np.array([math.exp(sum(w[e] for e in path)) for path in paths])
        want = [sum(q for q, path in zip(p, paths) if e in path) / p.sum() for e in edges]
        s, t, x = np.array([e[0] for e in edges]), np.array([e[1] for e in edges]), np.array([w[e] for e in edges])
        assert np.allclose(P.forward_backward(n, s, t, x), want)
        assert P.viterbi(n, s, t, x) == paths[int(p.argmax())]
