import math
import random

import numpy as np
import pytest

from beadloom.llm import markov as K
from beadloom.operators.components import linked_table

MOL, LIST, PUCK = "cb_index long, sb_index long, reads long", "sb_index long, barcode string", "bead_id long, sb string, x double, y double, puck_index int"


def tables(spark, beads, seen):
    puck = spark.createDataFrame([(b, sb, x, y, p) for b, sb, x, y, p in beads], PUCK)
    names = sorted({sb.strip().upper() for _, sb, *_ in beads if sb})
    index = {n: k for k, n in enumerate(names, 1)}
    lst = spark.createDataFrame([(k, n) for n, k in index.items()], LIST)
    mol = spark.createDataFrame([(c, index.get(s), 1) for c, s in seen], MOL)
    return mol, lst, puck


def brute(beads, seen, reach=20.0):
    count = {}
    for _, sb, *_ in beads:
        if sb:
            count[sb.strip().upper()] = count.get(sb.strip().upper(), 0) + 1
    place = {sb.strip().upper(): (b, x, y, p) for b, sb, x, y, p in beads if sb and count[sb.strip().upper()] == 1 and x is not None and y is not None and x == x and y == y and p is not None}
    cells = {}
    for c, s in seen:
        if c is not None and c > 0 and s in place:
            cells.setdefault(c, {})[place[s][0]] = place[s][1:]
    out = {}
    for c, own in cells.items():
        left = set(own)
        while left:
            group, edge = set(), [left.pop()]
            while edge:
                b = edge.pop()
                group.add(b)
                near = [o for o in left if own[o][2] == own[b][2] and (own[o][0] - own[b][0]) ** 2 + (own[o][1] - own[b][1]) ** 2 < reach * reach]
                left -= set(near)
                edge += near
            out |= {(c, b): (min(group), len(group)) for b in group}
    return out


def random_case(n_beads, n_cells, seed):
    rng = random.Random(seed)
    beads = [(k + 1, f"B{k}", rng.randrange(0, 4800) / 16, rng.randrange(0, 4800) / 16, rng.choice([1, 2])) for k in range(n_beads)]
    beads += [(9001, "B3", 1.0, 1.0, 1), (9002, None, 1.0, 1.0, 1), (9003, "X1", None, 2.0, 1), (9004, "X2", float("nan"), 2.0, 1), (9005, "X3", 1.0, 2.0, None), (9006, " b5 ", 3.0, 3.0, 1)]
    seen = [(c, f"B{rng.randrange(n_beads)}") for c in range(1, n_cells + 1) for _ in range(rng.randrange(1, 120))]
    seen += seen[:50] + [(None, "B1"), (-3, "B1"), (2, "nowhere"), (2, "X1"), (2, "X3")]
    return beads, seen


def test_patches_against_brute_force(spark):
    beads, seen = random_case(250, 60, 5)
    got = K.bead_patches(*tables(spark, beads, seen)).collect()
    assert {(r["cb_index"], r["bead_id"]): (r["head_bead_id"], r["patch_size"]) for r in got} == brute(beads, seen)
    assert len(got) == len({(r["cb_index"], r["bead_id"]) for r in got}) and all(r["settled"] for r in got)


def test_blocks_in_tasks_equal_blocks_over_the_cluster(spark):
    """With a limit of 8 beads nearly all blocks are tables of entries; every column is the same."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    beads, seen = random_case(90, 3, 5)
    made = lambda limit: {(r["cb_index"], r["bead_id"]): (r["puck_index"], r["attractor_id"], round(r["drawn"], 6), r["settled"], r["head_bead_id"], r["patch_size"]) for r in K.bead_patches(*tables(spark, beads, seen), limit=limit).collect()}
    try:
        far, near = made(8), made(8_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert far == near and {k: v[-2:] for k, v in far.items()} == brute(beads, seen)


def test_without_markov_clustering_there_are_no_patches(monkeypatch):
    monkeypatch.setattr(K, "flow_clusters", lambda a, b, w, loops, base, span, power: (np.arange(len(base)), np.ones(len(base)), np.ones(len(base), dtype=bool)))
    with pytest.raises(RuntimeError):
        K.all_levels(np.array([0]), np.array([1]), np.array([0.9]), np.zeros(2, dtype=int))


def test_a_block_is_the_same_whatever_lies_beside_it():
    rng = np.random.default_rng(4)
    xy = [rng.uniform(0, 60, (n, 2)) for n in (40, 25, 60)]
    one = [K._cluster_blocks(frame(p, k), 20.0) for k, p in enumerate(xy)]
    import pandas as pd

    every = K._cluster_blocks(pd.concat([frame(p, k) for k, p in enumerate(xy)], ignore_index=True), 20.0)
    assert every.equals(pd.concat(one, ignore_index=True))


def frame(xy, cell=1):
    import pandas as pd

    return pd.DataFrame({"cb_index": cell, "puck_index": 1, "bead_id": range(len(xy)), "x": xy[:, 0], "y": xy[:, 1]})


def test_flow_clusters_never_cross_patches_and_split_at_a_thin_bridge():
    left = [(x, y) for x in (0, 8, 16) for y in (0, 8, 16)]
    right = [(x + 80, y) for x, y in left]
    bridge = [(33, 8), (48, 8), (64, 8)]
    xy = np.array(left + bridge + right, dtype=float)
    out = K._cluster_blocks(frame(xy), 20.0)
    assert out["head_bead_id"].unique().tolist() == [0] and (out["patch_size"] == len(xy)).all()
    a, b = set(out["attractor_id"][:9]), set(out["attractor_id"][-9:])
    assert not a & b


def test_matrix_in_tasks_equals_the_table_over_the_cluster(spark):
    rng = np.random.default_rng(2)
    x, y = rng.uniform(0, 90, 60), rng.uniform(0, 90, 60)
    a, b, gap = K.neighbours(np.zeros(60, dtype=int), x, y, 20.0)
    w = 1 - gap / 40
    nodes = np.unique(np.concatenate([a, b]))
    to = {n: k for k, n in enumerate(nodes)}
    n = len(nodes)
    head, flow, still = K.flow_clusters(np.array([to[i] for i in a]), np.array([to[i] for i in b]), w, np.ones(n), np.zeros(n, dtype=int), np.full(n, n))
    edges = spark.createDataFrame([(1, int(i), int(j), float(v)) for i, j, v in zip(a, b, w)], "blk int, a long, b long, weight double")
    got = {r["node"]: (r["attractor"], round(r["drawn"], 6), r["settled"]) for r in K.markov_table(edges).collect()}
    assert got == {int(m): (int(nodes[head[k]]), round(float(flow[k]), 6), bool(still[k])) for k, m in enumerate(nodes)}


def test_blocks_that_lie_over_several_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    old, K.BATCH_ROWS = K.BATCH_ROWS, 20
    try:
        beads, seen = random_case(120, 20, 8)
        got = K.bead_patches(*tables(spark, beads, seen)).collect()
        assert {(r["cb_index"], r["bead_id"]): (r["head_bead_id"], r["patch_size"]) for r in got} == brute(beads, seen)
    finally:
        K.BATCH_ROWS = old
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_tables_equal_places_and_clashing_columns(spark):
    mol, lst, puck = tables(spark, [(k, f"B{k}", 1.0, 1.0, 1) for k in range(1, 8)], [(1, f"B{k}") for k in range(1, 8)])
    got = K.bead_patches(mol.selectExpr("*", "1 AS x", "'z' AS barcode", "2 AS bead_id"), lst.selectExpr("*", "5 AS y"), puck.selectExpr("*", "3 AS sb_index", "4 AS n")).collect()
    assert {(r["bead_id"], r["head_bead_id"], r["patch_size"]) for r in got} == {(k, 1, 7) for k in range(1, 8)}
    for e in ((mol.limit(0), lst, puck), (mol, lst.limit(0), puck), (mol, lst, puck.limit(0))):
        assert K.bead_patches(*e).count() == 0


def test_typical_beads(spark):
    beads, seen = random_case(250, 20, 3)
    members = K.bead_patches(*tables(spark, beads, seen))
    rows = members.collect()
    for p in K.patches(members).collect():
        own = sorted((r for r in rows if (r["cb_index"], r["head_bead_id"]) == (p["cb_index"], p["head_bead_id"])), key=lambda r: (-math.floor(r["drawn"] * 1e6 + 0.5), r["bead_id"]))
        assert p["typical_beads"] == [r["bead_id"] for r in own[:3]] and p["patch_size"] == len(own) >= 5


def test_components_of_a_long_chain(spark):
    e = spark.createDataFrame([(1, k, k + 1) for k in range(200)] + [(1, 900, 901), (2, 5, 3)], "blk int, a long, b long")
    got = {(r["blk"], r["node"]): r["low"] for r in linked_table(e).collect()}
    assert got == {**{(1, k): 0 for k in range(1, 201)}, (1, 901): 900, (2, 5): 3}


def test_a_dense_crowd_stays_in_memory(spark):
    out = K._cluster_blocks(frame(np.random.default_rng(0).uniform(0, 12, (500, 2))), 20.0)
    assert (out["patch_size"] == 500).all()
