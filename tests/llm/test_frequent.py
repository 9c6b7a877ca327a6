import random
from collections import Counter

import pytest

from beadloom.llm.frequent import frequent_barcodes, frequent_items, lossy_summary


def frame(spark, items, n=6):
    return spark.createDataFrame([(i,) for i in items], "item string").repartition(n)


@pytest.mark.parametrize("epsilon", [0.2, 0.01, 0.001])
def test_intervals_hold_the_truth(spark, epsilon):
    rng = random.Random(1)
    items = [f"i{int(rng.paretovariate(0.7))}" for _ in range(20_000)]
    true, n = Counter(items), len(items)
    df = frame(spark, items)
    rows = lossy_summary(df, epsilon).collect()
    for r in rows:
        assert r["count_low"] <= true[r["item"]] <= r["count_high"]
    held, unseen = {r["item"] for r in rows}, max((r["unseen"] for r in rows), default=n)
    assert all(c <= unseen for i, c in true.items() if i not in held)
    assert unseen <= epsilon * n + 6


@pytest.mark.parametrize("epsilon", [0.5, 0.05, 0.0001])
def test_exact_whatever_the_first_epsilon(spark, epsilon):
    """With ever wider buckets the pass is repeated until the answer is certain."""
    rng = random.Random(2)
    items = [f"i{int(rng.paretovariate(0.6))}" for _ in range(6000)]
    want = sorted(Counter(items).items(), key=lambda kv: (-kv[1], kv[0]))[:8]
    assert [(r["item"], r["n"]) for r in frequent_items(frame(spark, items), 8, epsilon).orderBy("place").collect()] == want


def test_all_items_alike(spark):
    got = frequent_items(frame(spark, [f"k{k}" for k in range(500)]), 3, 0.1).orderBy("place").collect()
    assert [r["item"] for r in got] == ["k0", "k1", "k10"]  # ties by text


def test_a_flat_column_stops_at_the_floor_with_intervals(spark):
    items = [f"k{k % 900}" for k in range(3000)]
    got = frequent_items(frame(spark, items, 2), 3, 0.1, 0.05).collect()
    true = Counter(items)
    assert not any(r["sure"] for r in got) and all(r["count_low"] <= true[r["item"]] == r["n"] <= r["count_high"] for r in got)
    assert all(r["sure"] for r in frequent_items(frame(spark, items, 2), 3, 0.1).collect())


def test_few_items_nulls_empty_and_long_texts(spark):
    long = "x" * 100_000
    got = frequent_items(frame(spark, [None, "a", "a", None, long, ""]), 10).orderBy("place").collect()
    assert [(r["item"], r["n"]) for r in got] == [("a", 2), ("", 1), (long, 1)]
    assert frequent_items(frame(spark, []), 5).count() == 0
    assert frequent_items(frame(spark, [None]), 5).count() == 0


def test_one_item_holds_a_third(spark):
    items = ["hot"] * 10_000 + [f"r{k}" for k in range(20_000)]
    got = frequent_items(frame(spark, items), 1, 0.01).first()
    assert (got["item"], got["n"]) == ("hot", 10_000)


def test_barcodes_are_compared_trimmed_and_upper(spark):
    puck = spark.createDataFrame([(" ac ", 1), ("AC", 1), ("ag", 1), (None, 1)], "sb string, item int")
    mol = spark.createDataFrame([(5, "x"), (5, "x"), (None, "x"), (7, "x")], "sb_index long, item string")
    got = {(r["item_field"], r["item"], r["n"]) for r in frequent_barcodes(puck, mol).collect()}
    assert got == {("puck.sb", "AC", 2), ("puck.sb", "AG", 1), ("molecules.sb_index", "5", 2), ("molecules.sb_index", "7", 1)}
