"""Numpy kernels over the beads of one cell: weighted density clustering, two-peak density, medians."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def neighbours(block: np.ndarray, x: np.ndarray, y: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs i < j of one block less than ``reach`` apart, and their distances, by a grid of cells of that side.

    Memory and time follow the number of pairs in neighbouring cells, not the square of the points.
    """
    gx, gy = np.floor(x / reach).astype(np.int64), np.floor(y / reach).astype(np.int64)
    gx, gy = gx - gx.min() + 1, gy - gy.min() + 1
    wide, high = int(gx.max()) + 2, int(gy.max()) + 2
    code = (block.astype(np.int64) * wide + gx) * high + gy
    order = np.argsort(code, kind="stable")
    at = code[order]
    left, right = [], []
    # own cell and four of the eight around it, so that each pair of cells is met once
    for shift in (0, 1, high - 1, high, high + 1):
        lo, hi = np.searchsorted(at, at + shift, "left"), np.searchsorted(at, at + shift, "right")
        if shift == 0:
            lo = np.arange(len(at)) + 1
        n = hi - lo
        n[n < 0] = 0
        i = np.repeat(np.arange(len(at)), n)
        j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        a, b = order[i], order[j]
        gap = (x[a] - x[b]) ** 2 + (y[a] - y[b]) ** 2
        keep = gap < reach * reach
        left.append(a[keep]), right.append(b[keep])
    a, b = np.concatenate(left), np.concatenate(right)
    return np.minimum(a, b), np.maximum(a, b), np.sqrt((x[a] - x[b]) ** 2 + (y[a] - y[b]) ** 2)


#: Pairs of places held at once.
PAIRS = 4_000_000


class Pairs:
    """Pairs i < j at most ``eps`` apart, given in portions of about ``PAIRS`` candidates and made anew for each pass, so that a cell with
    very many near beads never has all of its pairs in memory. Cells of one portion keep it."""

    def __init__(self, x: np.ndarray, y: np.ndarray, eps: float):
        self.x, self.y, self.eps = x, y, eps
        self.kept: list[tuple[np.ndarray, np.ndarray]] | None = None
        if len(x) <= 64:
            a, b = np.triu_indices(len(x), 1)
            self.kept = [self._near(a, b)]
            return
        side = eps * (1 + 1e-9) if eps > 0 else 1.0
        gx, gy = np.floor(x / side).astype(np.int64), np.floor(y / side).astype(np.int64)
        gx, gy = gx - gx.min() + 1, gy - gy.min() + 1
        high = int(gy.max()) + 2
        code = gx * high + gy
        self.order = np.argsort(code, kind="stable")
        self.at = code[self.order]
        self.shifts = (0, 1, high - 1, high, high + 1)
        if sum(int(self._ends(s)[1].sum()) for s in self.shifts) <= PAIRS:
            self.kept = [self._joined(list(self._made()))]

    def _near(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = (self.x[a] - self.x[b]) ** 2 + (self.y[a] - self.y[b]) ** 2 <= self.eps * self.eps
        return a[keep], b[keep]

    def _joined(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _ends(self, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """First candidate of each place in the cell ``shift`` on, and their number."""
        lo, hi = np.searchsorted(self.at, self.at + shift, "left"), np.searchsorted(self.at, self.at + shift, "right")
        lo = np.arange(len(self.at)) + 1 if shift == 0 else lo
        return lo, np.maximum(hi - lo, 0)

    def _made(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for shift in self.shifts:
            lo, n = self._ends(shift)
            upto, begin = np.cumsum(n), 0
            while begin < len(n):
                end = max(int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + PAIRS, "right")), begin + 1)
                m = n[begin:end]
                i = np.repeat(np.arange(begin, end), m)
                j = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(lo[begin:end], m)
                a, b = self.order[i], self.order[j]
                yield self._near(np.minimum(a, b), np.maximum(a, b))
                begin = end

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return iter(self.kept) if self.kept is not None else self._made()


def smallest_linked(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node that a chain of edges links to each node."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def core_weights(pairs: Pairs, weight: np.ndarray) -> np.ndarray:
    """Weight within reach of each point, itself included."""
    out = weight.astype(float)
    for a, b in pairs:
        out += np.bincount(a, weight[b], len(weight)) + np.bincount(b, weight[a], len(weight))
    return out


def dbscan(x: np.ndarray, y: np.ndarray, weight: np.ndarray, eps: float, min_pts: float, border: bool = True) -> np.ndarray:
    """Cluster of each point, 0 for noise; clusters are numbered by their first core point. A border point goes to the first cluster that reaches it."""
    n = len(x)
    pairs = Pairs(x, y, eps)
    core = core_weights(pairs, weight) >= min_pts
    out = np.zeros(n, dtype=np.int64)
    if not core.any():
        return out
    label = np.arange(n)
    for a, b in pairs:
        inner = core[a] & core[b]
        label = smallest_linked(label[a[inner]], label[b[inner]], n)[label]
    firsts = np.unique(label[core])
    out[core] = np.searchsorted(firsts, label[core]) + 1
    if border:
        first = np.full(n, n + 1)
        for a, b in pairs:
            for edge, mid in ((a, b), (b, a)):
                reach = core[mid] & ~core[edge]
                np.minimum.at(first, edge[reach], out[mid[reach]])
        out = np.where(~core & (first <= n), first, out)
    return out


def _forest(n: int, a: np.ndarray, b: np.ndarray, strength: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges that join something when taken in falling order of strength."""
    order = np.argsort(-strength, kind="stable")
    parent, kept = list(range(n)), []
    for k, i, j in zip(order.tolist(), a[order].tolist(), b[order].tolist()):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        while parent[j] != j:
            parent[j] = parent[parent[j]]
            j = parent[j]
        if i != j:
            parent[i] = j
            kept.append(k)
    return a[kept], b[kept], strength[kept]


def cluster_counts(x: np.ndarray, y: np.ndarray, weight: np.ndarray, eps: float, min_pts: np.ndarray) -> np.ndarray:
    """Number of clusters for each of ``min_pts``, pairs and core weights made once.

    At a threshold the clusters are the core points less the joins between them. A pair joins from the smaller core weight of
    both downwards, so the pairs are taken in falling order of it and each real join is kept with its threshold. Of every portion of
    pairs only the joins go on to the next, at most one fewer than points.
    """
    pairs = Pairs(x, y, eps)
    own = core_weights(pairs, weight)
    a, b, strength = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    for i, j in pairs:
        # a pair that joins at no threshold asked for is left out
        both = np.minimum(own[i], own[j])
        some = both >= (min_pts.min() if len(min_pts) else np.inf)
        a, b, strength = _forest(len(x), np.concatenate([a, i[some]]), np.concatenate([b, j[some]]), np.concatenate([strength, both[some]]))
    return (own[None, :] >= min_pts[:, None]).sum(1) - (strength[None, :] >= min_pts[:, None]).sum(1)


def weighted_median(v: np.ndarray, w: np.ndarray) -> float:
    """Interpolated weighted median: the value at half the weight, midpoints of the cumulated weights as nodes."""
    keep = w > 0
    v, w = v[keep], w[keep].astype(float)
    if not len(v):
        return float("nan")
    order = np.argsort(v, kind="stable")
    v, w = v[order], w[order]
    middle = (np.cumsum(w) - w / 2) / w.sum()
    return float(np.interp(0.5, middle, v))


def h_index(w: np.ndarray) -> int:
    values = np.sort(w)[::-1]
    return int(np.minimum(values, np.arange(1, len(values) + 1)).max(initial=0)) if len(values) else 0


def densities(x: np.ndarray, y: np.ndarray, umi: np.ndarray, width: float, rows: int = 512, columns: int = 1 << 14) -> np.ndarray:
    """Sum of ``umi * exp(-d² / width)`` over all beads at each bead.

    Beads meet those of their own and the neighbouring squares, whose side is where the kernel has fallen under 1e-20, less than
    the last bit of a sum can hold.
    """
    side = np.sqrt(46.1 * width)
    gx, gy = np.floor(x / side).astype(np.int64), np.floor(y / side).astype(np.int64)
    gx, gy = gx - gx.min() + 1, gy - gy.min() + 1
    high = int(gy.max()) + 2
    code = gx * high + gy
    order = np.argsort(code, kind="stable")
    at, sx, sy, su = code[order], x[order], y[order], umi[order].astype(float)
    out = np.zeros(len(x))
    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    for begin, end in zip(starts, np.append(starts[1:], len(at))):
        for shift in (-high, 0, high):
            lo, hi = np.searchsorted(at, at[begin] + shift - 1, "left"), np.searchsorted(at, at[begin] + shift + 1, "right")
            for j in range(lo, hi, columns):
                k = slice(j, min(j + columns, hi))
                for i in range(begin, end, rows):
                    r = slice(i, min(i + rows, end))
                    out[r] += np.exp(-((sx[r, None] - sx[k]) ** 2 + (sy[r, None] - sy[k]) ** 2) / width) @ su[k]
    back = np.empty(len(x))
    back[order] = out
    return back


def two_peaks(x: np.ndarray, y: np.ndarray, umi: np.ndarray, width: float, radius: float) -> dict[str, float | None]:
    """Densest bead and the densest outside its radius; weighted centres of both and measures of the first."""
    top = float(umi.max())
    if len(x) == 1:
        return {"x_um": x[0], "y_um": y[0], "x2_um": None, "y2_um": None, "d1": float(umi[0]), "d2": 0.0, "sumi": float(umi[0]), "sbeads": 1, "max": top, "r": 1.0, "h": 1}
    if top >= 3:
        keep = umi > 1
        x, y, umi = x[keep], y[keep], umi[keep]
    if len(x) <= 512:
        density = np.exp(-((x[:, None] - x) ** 2 + (y[:, None] - y) ** 2) / width) @ umi
    else:
        density = densities(x, y, umi, width)
    # ties by place, so that the order of rows does not matter
    rank = np.lexsort((y, x, -np.round(density, 9)))
    first = rank[0]
    near = (x - x[first]) ** 2 + (y - y[first]) ** 2 < radius * radius
    rest = rank[~near[rank]]
    out = {"x_um": float(np.average(x[near], weights=umi[near])), "y_um": float(np.average(y[near], weights=umi[near])), "x2_um": None, "y2_um": None, "d2": 0.0}
    if len(rest):
        near2 = (x - x[rest[0]]) ** 2 + (y - y[rest[0]]) ** 2 < radius * radius
        out |= {"x2_um": float(np.average(x[near2], weights=umi[near2])), "y2_um": float(np.average(y[near2], weights=umi[near2])), "d2": float(density[rest[0]])}
    own = umi[near]
    return out | {"d1": float(density[first]), "sumi": float(own.sum()), "sbeads": int(near.sum()), "max": top, "r": float(own.sum() / own.max()), "h": h_index(own)}
