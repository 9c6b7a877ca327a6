from collections import Counter

import pytest

from beadloom.operators import heavy_keys
from beadloom.operators.heavy_keys import balanced_totals, dominant_keys, key_totals

MOL = "cb_index long, sb_index long, reads long"


def test_one_key_holds_most_rows_and_runs_over_partitions(spark):
    rows = [(1, 7, 1)] * 5000 + [(2 + k % 50, 7 + k % 3, k % 4) for k in range(2500)]
    df = spark.createDataFrame(rows, MOL).repartition(16)
    want = Counter()
    for c, _, r in rows:
        want[c] += r
    got = {r["cb_index"]: (r["n_rows"], r["reads"]) for r in balanced_totals(df, ["cb_index"], ["reads"], 6).collect()}
    assert {k: v[1] for k, v in got.items()} == dict(want)
    assert sum(v[0] for v in got.values()) == len(rows) and len(got) == len(set(r[0] for r in rows))


def test_no_key_twice_at_any_number_of_partitions(spark):
    df = spark.range(0, 3000).selectExpr("id % 37 AS cb_index", "id % 5 AS sb_index", "1L AS reads").repartition(20)
    for n in (1, 2, 9, 40):
        got = balanced_totals(df, ["cb_index"], ["reads"], n).collect()
        assert len(got) == 37 and sum(r["reads"] for r in got) == 3000


def test_null_keys_null_reads_and_repeats(spark):
    df = spark.createDataFrame([(None, 1, 5), (1, None, None), (1, None, None), (1, 1, 3)], MOL)
    got = {(r["key_field"], r["key_id"]): (r["n_rows"], r["reads"]) for r in key_totals(df).collect()}
    assert got == {("cb_index", 1): (3, 3), ("sb_index", 1): (2, 8)}


def test_share_counts_rows_without_key_and_ties_all_come(spark):
    df = spark.createDataFrame([(None, None, 92), (1, 5, 4), (2, 6, 4)], MOL)
    assert {tuple(r) for r in dominant_keys(df).collect()} == {("cb_index", 1), ("cb_index", 2), ("sb_index", 5), ("sb_index", 6)}


def test_empty_and_zero_reads(spark):
    assert dominant_keys(spark.createDataFrame([], MOL)).count() == 0
    assert dominant_keys(spark.createDataFrame([(1, 1, 0), (2, 2, None)], MOL)).count() == 0


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, 2, 3, "a", 9)], MOL + ", k0 string, n_rows int")
    assert {(r["key_field"], r["n_rows"]) for r in key_totals(df).collect()} == {("cb_index", 1), ("sb_index", 1)}


def test_string_keys_with_nulls(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), (None, 4), ("b", 5)], "k string, v long").repartition(5)
    assert {(r["k"], r["n_rows"], r["v"]) for r in balanced_totals(df, ["k"], ["v"], 3).collect()} == {("a", 1, 3), ("b", 2, 6), (None, 2, 6)}


@pytest.mark.parametrize("n", [1, 3])
def test_empty_total(spark, n):
    assert balanced_totals(spark.createDataFrame([], "k long, v long"), ["k"], ["v"], n).count() == 0


@pytest.mark.parametrize("rows", [1, 7, 100])
def test_tasks_that_fold_many_times(spark, monkeypatch, rows):
    monkeypatch.setattr(heavy_keys, "_FOLD_ROWS", rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        df = spark.range(0, 900).selectExpr("id * id % 41 AS cb_index", "id % 700 AS sb_index", "id % 3 AS reads").repartition(3)
        got = {tuple(r) for r in key_totals(df, 4).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = Counter(), Counter()
    for k in range(900):
        for key in (("cb_index", k * k % 41), ("sb_index", k % 700)):
            want[0][key] += 1
            want[1][key] += k % 3
    assert got == {(*key, n, want[1][key]) for key, n in want[0].items()}
