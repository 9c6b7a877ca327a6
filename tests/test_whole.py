"""Queries that must take in the whole of their tables, on small tables written for them."""

import random

from pyspark.sql import functions as F

from beadloom.operators import molecules
from beadloom.operators import positioning as P
from beadloom.plans import general, molecule_queries, position_queries

from same import check


def save(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_every_placed_bead_of_every_puck_is_in_a_tile(spark, tmp_path):
    rng = random.Random(3)
    rows = [(k, "A", rng.randrange(-800, 1600) / 16, rng.randrange(-800, 1600) / 16, k % 7 + 1) for k in range(700)]
    rows += [(800, "A", 3.0, 4.0, 9), (801, "A", None, 1.0, 1), (802, "A", float("nan"), 1.0, 1), (803, "A", 1.0, 1.0, None)]
    got = general.QUERIES["p2_in_tiles"](spark, save(spark, tmp_path, puck=(rows, "bead_id long, sb string, x double, y double, puck_index int")))
    assert {r["bead_id"] for r in got.select("bead_id").distinct().collect()} == {*range(700), 800}
    assert got.filter((F.col("bead_id") < 700) & (F.floor(F.col("box") / 16) != F.col("bead_id") % 7 + 1)).count() == 0


def test_beads_leave_at_the_cap_of_the_reference(spark):
    rows = spark.createDataFrame([(1, 1, 8), (1, 2, 200), (2, 2, 55), (1, 3, 200), (2, 3, 56)], "cb_index long, sb_index long, umi long")
    got = molecules.under_cap(rows, molecule_queries.UMI_CAP).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 8), (1, 2, 200), (2, 2, 55)]


def test_cells_are_placed_with_the_parameters_of_the_search(spark):
    """Deep cells: one spot of 60 UMIs, and noise of 5 that a fixed minPts of 4 takes for clusters."""
    rows = [(c, x, 0.0, u) for c in range(1, 7) for x, u in ((0.0, 30), (10.0, 30), (1000.0, 5), (2000.0, 5))]
    beads = spark.createDataFrame(rows, "cb_index long, x_um double, y_um double, umi long").cache()
    assert P.cluster_places(P.clusters(beads, 50.0, 4)).filter("clusters = 3").count() == 6
    got = P.placed_at_best(beads).collect()
    assert len(got) == 6 and all(r["clusters"] == 1 and r["x_um_dbscan"] == 5.0 for r in got)


def test_lost_cells_get_a_sweep_of_their_own(spark):
    """Five deep cells set minPts to 6; two shallow ones of 5 UMIs are lost there and found by the second sweep."""
    deep = [(c, x, 0.0, u) for c in range(1, 6) for x, u in ((0.0, 30), (10.0, 30), (1000.0, 5), (2000.0, 5))]
    rows = deep + [(c, x, 0.0, u) for c in (8, 9) for x, u in ((0.0, 2), (10.0, 3))]
    beads = spark.createDataFrame(rows, "cb_index long, x_um double, y_um double, umi long").cache()
    assert P.best_min_pts(beads, 50.0, tuple(range(4, 81))) == 6
    got = {r["cb_index"]: (r["number_clusters"], r["rep_status"]) for r in P.profile_at_best(beads, 50.0, tuple(range(4, 81))).collect()}
    assert got == {**{c: (1, 0) for c in range(1, 6)}, 8: (1, 2), 9: (1, 2)}


def test_sweeps_hold_every_pair(spark, small):
    got = {(r["eps"], r["min_pts"]) for r in position_queries.QUERIES["dbscan_sweep_full"](spark, small).collect()}
    assert got == {(e, m) for e in (50.0, 100.0) for m in range(3, 43)}
    assert {r["min_pts"] for r in position_queries.QUERIES["profile_sweep_full"](spark, small).collect()} == set(range(4, 81))


def test_remap_choice_counts_the_reads_of_every_fifth_cell(spark, small):
    old, new = (molecule_queries.QUERIES[q](spark, small).first() for q in ("cb_remap_choice", "cb_remap_choice_all"))
    print("REMAP", old, new)
    assert new["reads_plain"] > old["reads_plain"] and new["reads_swapped"] >= old["reads_swapped"]


def broadcasts(df):
    """Joins by barcode that send one side whole to the driver; one row a cell of so few cells may be sent."""
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin [barcode#")


def cells(spark, folder):
    """300 cells; 1 and 2 are one base apart, so forms of theirs are ambiguous."""
    rng = random.Random(5)
    made = ["ACGTACGTACGTACGT", "CCGTACGTACGTACGT", *("".join(rng.choice("ACGT") for _ in range(16)) for _ in range(298))]
    molecules = [(c, u, u % 9, (c or 0) % 4) for c in (*range(-5, 303), None) for u in range(3)]
    tables = dict(cb_list=(list(enumerate(made, 1)), "cb_index long, barcode string"), molecules=(molecules, "cb_index long, umi_2bit long, sb_index long, reads long"))
    return save(spark, folder, **tables)


def same_without_broadcast(spark, folder, name):
    import duckdb

    sf = cells(spark, folder)
    got = molecule_queries.QUERIES[name](spark, sf)
    assert broadcasts(got) == 0
    con = duckdb.connect()
    for t in ("cb_list", "molecules"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet/*.parquet'")
    check(got, con.sql(molecule_queries.ORACLE[name]))


def test_forms_of_cells_are_not_sent_to_the_driver(spark, tmp_path):
    same_without_broadcast(spark, tmp_path, "cb_fuzzy_match")


def test_reads_by_match_of_cells_are_counted_without_sending_forms_to_the_driver(spark, tmp_path):
    same_without_broadcast(spark, tmp_path, "cb_match_counts")


def test_molecules_are_reindexed_without_sending_forms_to_the_driver(spark, tmp_path):
    same_without_broadcast(spark, tmp_path, "cb_reindex")


def sent_whole(spark, folder, name):
    """Tables that the plan as run sends whole to the driver: joins changed while it runs count too, and no cell may be sent."""
    got = molecule_queries.QUERIES[name](spark, cells(spark, folder))
    got.collect()
    ran = got._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in ran
    return ran.split("+- == Initial Plan ==")[0].count("BroadcastExchange")


def test_reads_by_match_are_counted_without_sending_any_cell_to_the_driver(spark, tmp_path):
    assert sent_whole(spark, tmp_path, "cb_match_counts") == 0


def test_molecules_are_reindexed_without_sending_any_cell_to_the_driver(spark, tmp_path):
    assert sent_whole(spark, tmp_path, "cb_reindex") == 0
