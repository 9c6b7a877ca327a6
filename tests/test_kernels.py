import numpy as np
import pytest

from beadloom.operators import kernels as K


def plain_clusters(x, y, w, eps, min_pts):
    d = (x[:, None] - x) ** 2 + (y[:, None] - y) ** 2 <= eps * eps
    core, label, c = d @ w >= min_pts, np.zeros(len(x), dtype=int), 0
    for i in range(len(x)):
        if core[i] and not label[i]:
            c += 1
            todo = [i]
            while todo:
                k = todo.pop()
                if not label[k]:
                    label[k] = c
                    todo += np.flatnonzero(d[k] & core & (label == 0)).tolist()
    for i in np.flatnonzero(~core):
        near = label[d[i] & core]
        label[i] = near.min() if len(near) else 0
    return label


@pytest.mark.parametrize("portion", [50, 4_000_000])
def test_clusters_in_portions_of_pairs(monkeypatch, portion):
    monkeypatch.setattr(K, "PAIRS", portion)
    rng = np.random.default_rng(3)
    for _ in range(6):
        n = int(rng.integers(65, 250))
        x, y, w = np.round(rng.uniform(0, 900, n) * 4) / 4, np.round(rng.uniform(0, 300, n) * 4) / 4, rng.integers(1, 4, n)
        values = np.arange(2, 12)
        want = [plain_clusters(x, y, w, 50.0, m) for m in values]
        assert all(K.dbscan(x, y, w, 50.0, m).tolist() == v.tolist() for m, v in zip(values, want))
        assert K.cluster_counts(x, y, w, 50.0, values).tolist() == [v.max() for v in want]
        if portion == 50:
            assert K.Pairs(x, y, 50.0).kept is None


def test_densities_by_squares_equal_all_pairs():
    rng = np.random.default_rng(4)
    x, y, u = np.append(rng.uniform(-2000, 2000, 900), rng.normal(0, 30, 300)), np.append(rng.uniform(-2000, 2000, 900), rng.normal(0, 30, 300)), rng.integers(1, 9, 1200)
    want = np.exp(-((x[:, None] - x) ** 2 + (y[:, None] - y) ** 2) / 800) @ u
    assert np.allclose(K.densities(x, y, u, 800.0, rows=64, columns=100), want, rtol=1e-12)


def test_a_cell_of_very_many_beads_stays_small():
    """50,000 beads with 600 neighbours each: 15 million pairs, of which a portion at a time is held."""
    import tracemalloc

    rng = np.random.default_rng(5)
    x, y, w = rng.uniform(0, 800, 50_000), rng.uniform(0, 800, 50_000), np.ones(50_000, dtype=int)
    tracemalloc.start()
    label = K.dbscan(x, y, w, 50.0, 100)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert label.max() == 1 and (label == 1).all() and most < 1 << 29
