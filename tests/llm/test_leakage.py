import random
import re

import pytest

from beadloom.llm import leakage as L

DOC, ITEM = "doc_id long, text string", "item_id long, text string"
rng = random.Random(6)
WORDS = [f"w{k}" for k in range(400)]


def brute(docs, items, run=13):
    out = set()
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    index = {}
    for i, t in items:
        w = cut(t)
        for k in range(len(w) - run + 1):
            index.setdefault(tuple(w[k : k + run]), set()).add(i)
    for d, t in docs:
        w = cut(t)
        for k in range(len(w) - run + 1):
            out |= {(d, i) for i in index.get(tuple(w[k : k + run]), ())}
    return out


def case():
    items = [(k, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(10, 60)))) for k in range(30)]
    items += [(100, items[0][1]), (101, "short one"), (102, "a " * 40)]
    docs = []
    for d in range(150):
        w = [rng.choice(WORDS) for _ in range(rng.randrange(0, 90))]
        src = rng.choice(items)[1].split()
        n = rng.choice([0, 11, 12, 13, 14, 30])
        part = src[:n] if rng.random() < 0.5 else src[-n:] if n else []
        if part and rng.random() < 0.3:
            part[len(part) // 2] = "changed"
        at = rng.randrange(len(w) + 1)
        text = rng.choice([" ", "\n", ", ", "  -- ", "_"]).join(w[:at] + [p.upper() if rng.random() < 0.3 else p for p in part] + w[at:])
        docs.append((d, text))
    return docs + [(900, None), (901, ""), (902, "a " * 5000), (903, docs[3][1]), (903, docs[3][1])], items


def test_exact_runs_against_brute_force(spark):
    docs, items = case()
    got = [tuple(r) for r in L.leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()]
    want = brute(docs, items)
    assert len(got) == len(set(got)) and set(got) == want and want


def test_same_when_the_items_are_too_many_to_send(spark, monkeypatch):
    docs, items = case()
    monkeypatch.setattr(L, "BROADCAST_HASHES", 10)
    got = {tuple(r) for r in L.leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()}
    assert got == brute(docs, items)


def test_substitutions_are_tolerated(spark):
    item = [f"q{k}" for k in range(40)]
    doc = ["x"] * 20 + [("sub" if k % 9 == 4 else w) for k, w in enumerate(item)] + ["y"] * 20
    d, i = spark.createDataFrame([(1, " ".join(doc))], DOC), spark.createDataFrame([(7, " ".join(item))], ITEM)
    assert L.leaks(d, i).count() == 0
    r = L.near_leaks(d, i).first()
    assert (r["item_id"], r["overlap_words"], r["equal_words"], r["exact_run"]) == (7, 40, 36, 8)


def test_overlap_is_the_longest_common_run(spark):
    d = spark.createDataFrame([(1, " ".join(f"q{k}" for k in range(15)) + " z " + " ".join(f"q{k}" for k in range(16, 40)))], DOC)
    i = spark.createDataFrame([(7, " ".join(f"q{k}" for k in range(40)))], ITEM)
    r = L.overlaps(d, i).first()
    assert (r["shift"], r["overlap_words"], r["equal_words"], r["exact_run"]) == (0, 40, 39, 24)


def test_empty_clashing_columns_and_short_runs(spark):
    d, i = spark.createDataFrame([], DOC), spark.createDataFrame([], ITEM)
    some = spark.createDataFrame([(1, " ".join(f"q{k}" for k in range(20)), 5, "s")], DOC + ", item_id int, seed string")
    item = spark.createDataFrame([(2, " ".join(f"q{k}" for k in range(20)), 4, 1)], ITEM + ", doc_id int, w int")
    assert L.leaks(d, i).count() == L.leaks(some, i).count() == L.leaks(d, item).count() == 0
    assert [tuple(r) for r in L.leaks(some, item).collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        L.leaks(some, item, 12)
