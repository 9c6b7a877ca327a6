import random

import numpy as np

from beadloom.llm import leakage as L

DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def test_a_changed_part_of_an_item_inside_a_longer_document(spark):
    item = [f"q{k}" for k in range(60)]
    part = [("sub" if k in (10, 20) else w) for k, w in enumerate(item[15:45])]
    doc = [f"x{k}" for k in range(50)] + part + [f"y{k}" for k in range(50)]
    d, i = spark.createDataFrame([(1, " ".join(doc))], DOC), spark.createDataFrame([(7, " ".join(item))], ITEM)
    assert L.leaks(d, i).count() == 0
    assert [tuple(r) for r in L.near_leaks(d, i).collect()] == [(1, 7, 30, 28, 10)]


def test_exact_parts_are_near_passages_too(spark):
    rng = random.Random(8)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(rng.randrange(37, 88)))) for k in range(20)]
    docs = []
    for d in range(60):
        w = items[d % 20][1].split()
        n = rng.choice([12, 13, 14, 19, 20, 30])
        at = rng.randrange(len(w) - n + 1)
        docs.append((d, " ".join([f"a{j}" for j in range(40)] + w[at : at + n] + [f"b{j}" for j in range(40)])))
    d, i = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)
    exact = {tuple(r) for r in L.leaks(d, i).collect()}
    near = {(r["doc_id"], r["item_id"]) for r in L.near_leaks(d, i).collect()}
    assert exact and exact <= near


def test_best_stretch_against_all_stretches():
    rng = random.Random(9)
    for _ in range(300):
        f = [rng.random() < rng.choice([0.5, 0.8, 0.95]) for _ in range(rng.randrange(1, 60))]
        every = [(sum(f[a:b]) * 10 - 8 * (b - a), b - a, -a) for a in range(len(f)) for b in range(a + 20, len(f) + 1)]
        score, at, to = L.best_stretch(np.array(f), 20, 0.8)
        assert (score, to - at, -at) == ((lambda w: (w[0] * 100_000, w[1], w[2]))(max(every)) if every else (-1, 0, 0))


def test_recall_at_the_thresholds_against_brute_force(spark):
    """Parts of 20 words with 4 changed at random; brute force tries every alignment of every document with its item."""
    rng = random.Random(12)
    items, docs, want = [], [], set()
    for k in range(400):
        w = [f"i{k}w{j}" for j in range(40)]
        part = [("sub" if j in set_ else x) for set_ in [set(rng.sample(range(20), 4))] for j, x in enumerate(w[10:30])]
        items.append((k, " ".join(w)))
        d = [f"a{k}x{j}" for j in range(30)] + part + [f"b{k}x{j}" for j in range(30)]
        docs.append((k, " ".join(d)))
        for shift in range(-len(w), len(d)):
            same = np.array([0 <= j + shift < len(d) and d[j + shift] == x for j, x in enumerate(w)])
            if L.best_stretch(same, 20, 0.8)[0] >= 0:
                want.add((k, k))
    got = {(r["doc_id"], r["item_id"]) for r in L.near_leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()}
    assert len(want) == 400 and got <= want
    assert len(got) / len(want) >= 0.95
