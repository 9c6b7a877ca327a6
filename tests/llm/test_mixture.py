import numpy as np
import pytest

from beadloom.llm import mixture as M

DOC, TARGET = "doc_id long, text string, source string", "source string, target_share double, max_repeats int"
pytestmark = pytest.mark.skipif(not __import__("os").path.exists(M.TOKENIZERS), reason="no tokenizers")


def docs(n, seed=1):
    rng = np.random.default_rng(seed)
    kinds = {"a": "bead puck location sample", "b": "reads lane index flow cell", "c": "nuclei tissue section stain"}
    out = []
    for k in range(n):
        s = rng.choice(list(kinds), p=[0.7, 0.25, 0.05])
        w = kinds[s].split()
        out.append((k, " ".join(rng.choice(w, rng.integers(5, 80))), str(s)))
    return out


def test_targets_are_met_and_repeats_are_kept(spark):
    rows = docs(3000)
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3)], TARGET)
    m = M.mix(spark.createDataFrame(rows, DOC), t)
    shares = {r["source"]: r for r in m.shares.collect()}
    for s, w, most in (("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3)):
        assert abs(shares[s]["reached_share"] - w) < 0.01 and shares[s]["most_copies"] <= most
    per = m.documents.collect()
    assert len(per) == len(rows)
    assert sum(r["n_tokens"] * r["copies"] for r in per) == sum(r["tokens_used"] for r in shares.values())


def test_unlabelled_documents_get_a_soft_place(spark):
    rows = docs(1500)
    hidden = [(i, t, None if i % 10 == 0 else s) for i, t, s in rows]
    t = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 1), ("c", 0.1, 2)], TARGET)
    got = {r["doc_id"]: r["domain"] for r in M.mix(spark.createDataFrame(hidden, DOC), t).documents.filter("source IS NULL").collect()}
    assert np.mean([got[i] == s for i, _, s in rows if i % 10 == 0]) > 0.9


def test_a_target_out_of_reach_is_reported_as_it_came_out(spark):
    rows = [(1, "one two three", "a"), (2, "one two three", "b")]
    t = spark.createDataFrame([("a", 0.9, 2), ("b", 0.1, 1)], TARGET)
    s = {r["source"]: r for r in M.mix(spark.createDataFrame(rows, DOC), t, total_tokens=100).shares.collect()}
    assert s["a"]["most_copies"] == 2 and s["a"]["tokens_used"] == 2 * s["a"]["tokens_there"]


def test_nulls_empty_other_sources_and_clashing_columns(spark):
    rows = [(1, None, "a", 3, 1), (2, "", "a", 3, 1), (3, "x y", " A ", 3, 1), (4, "x y", "other", 3, 1), (5, "x y", None, 3, 1), (6, "x y", "", 3, 1)]
    t = spark.createDataFrame([("a", 1.0, 1), ("missing", 0.0, 1)], TARGET)
    m = M.mix(spark.createDataFrame(rows, DOC + ", p0 int, label int"), t)
    assert sorted(r["doc_id"] for r in m.documents.collect()) == [1, 2, 3, 5, 6]
    assert {r["source"]: r["tokens_there"] > 0 for r in m.shares.collect()} == {"a": True, "missing": False}
    e = M.mix(spark.createDataFrame([], DOC), t)
    assert e.documents.count() == 0 and all(r["tokens_used"] == 0 for r in e.shares.collect())


def test_copies_are_the_same_on_every_run(spark):
    rows, t = docs(400), spark.createDataFrame([("a", 0.4, 1), ("b", 0.4, 2), ("c", 0.2, 2)], TARGET)
    one = {r["doc_id"]: r["copies"] for r in M.mix(spark.createDataFrame(rows, DOC).repartition(3), t).documents.collect()}
    two = {r["doc_id"]: r["copies"] for r in M.mix(spark.createDataFrame(rows[::-1], DOC).repartition(7), t).documents.collect()}
    assert one == two


def test_long_texts_are_counted_whole(spark):
    enc = M.encoder(M.TOKENIZERS)
    texts = ["word " * 60_000, "z" * 200_000, "样品" * 50_000, " " * 100_000 + "x"]
    got = M.memberships(spark.createDataFrame([(k, "a", t) for k, t in enumerate(texts)], "doc_id long, label string, text string"), ["a"], np.zeros((M.PLACES + 1, 1)))
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == {k: len(enc.encode_ordinary(t)) for k, t in enumerate(texts)}


def test_rates_after_steps(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet(np.ones(3), 20)
    steps = [rng.normal(0, 0.6, 3) for _ in range(6)]
    want = np.zeros(20)
    for s in steps:
        want = np.clip(want + p @ s, 0, 1.5)
    df = spark.createDataFrame([(k, 1.5, *map(float, r)) for k, r in enumerate(p)], "k int, cap double, p0 double, p1 double, p2 double")
    got = df.select("k", M.rate_after(steps, ["p0", "p1", "p2"]).alias("r")).orderBy("k").collect()
    assert np.allclose([r["r"] for r in got], want)


def test_steps_that_run_out_are_told(spark, monkeypatch):
    monkeypatch.setattr(M, "STEPS", 1)
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2)], TARGET)
    rows = [(k, "one two three four", "a" if k % 3 else "b" if k % 2 else None) for k in range(60)]
    assert not any(r["settled"] for r in M.mix(spark.createDataFrame(rows, DOC), t, total_tokens=900).shares.collect())
