"""Markov clustering of a distributed similarity graph, level by level.

The column-stochastic flow matrix is squared (expansion), its entries are raised to a power and columns are
scaled to 1 again (inflation), and small entries are dropped (pruning), over and over, until nothing
moves. A column's largest entry then names its attractor; columns of one attractor are one flow cluster, and
the bead that draws the strongest flow represents it.

Flow clusters are finer than all that a chain of neighbours joins. So each is contracted to one node, edges between
clusters are added up, and the smaller graph is clustered again, with an inflation closer to 1 from level to level, until no
edge is left. The clusters of the last level are the patches.

The matrix is block-diagonal: cells never share an edge. Blocks of up to ``BLOCK_BEADS`` lie whole in one task, many side by
side, and are squared there without moving an entry (``flow_clusters``). Larger ones are tables of entries, squared by
joins with the lineage cut in every round (``markov_table``). Both ways take the same steps, stop each block by
itself and round flows to the same grid, so it does not matter which way a block goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beadloom.operators.components import linked_table
from beadloom.operators.kernels import neighbours, smallest_linked
from beadloom.operators.proximity import near_pairs
from beadloom.runtime import cut, parts

#: Inflation power of the first level, smallest kept entry, and the change under which a block counts as still.
INFLATION, SMALL, STILL = 2.0, 0.01, 1e-3
#: Most rounds of a level; a block that still moves then says so in ``settled``.
ROUNDS = 40
#: Flows are rounded to this many steps of 1, so that sums in another order give the same flows.
GRID = 1e9
#: Beads of one cell on one puck up to which its block stays in a task; rows worked on at once; products and slots held at once.
BLOCK_BEADS, BATCH_ROWS, PRODUCTS, SLOTS = 8_000, 40_000, 1 << 20, 1 << 23
#: By then the inflation is 1 to the last bit and every part of a graph is one cluster.
MOST_LEVELS = 60


def power_of(level: int) -> float:
    """Inflation of a level: half as far from 1 as the level before."""
    return 1 + (INFLATION - 1) / 2**level


# --- inside a task: entries (row, col, flow) sorted by column, as numpy arrays over many blocks ---


def scaled(col: np.ndarray, flow: np.ndarray, n: int) -> np.ndarray:
    return flow / np.bincount(col, flow, n)[col]


def square(row: np.ndarray, col: np.ndarray, flow: np.ndarray, first: np.ndarray, many: np.ndarray, shift: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and sums of the squared matrix; column j of it is the sum over entries (k, j) of flow times column k.

    Slots rise with the column, so the products are made and summed for a run of columns at a time, ``PRODUCTS`` or one
    column's at most.
    """
    times = many[row]
    made = np.cumsum(times)
    base_slot = shift + np.arange(len(span)) * span  # rises from column to column
    slots, sums, at = [], [], 0
    while at < len(row):
        to = int(np.searchsorted(made, (made[at - 1] if at else 0) + PRODUCTS, "right"))
        end = int(np.searchsorted(base_slot, base_slot[col[at]] + SLOTS, "right")) - 1  # columns whose slots fit
        to = min(to, int(first[end]) if end < len(first) - 1 else len(row))
        to = len(row) if to >= len(row) else int(first[col[max(to, at)]])
        if to <= at:
            to = int(first[col[at]] + many[col[at]])
        n = times[at:to]
        k = np.repeat(np.arange(at, to), n)
        e = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[row[at:to]], n)
        j = col[k]
        slot = shift[j] + j * span[j] + row[e]
        part = flow[k] * flow[e]
        low, high = int(slot.min()), int(slot.max()) + 1
        if high - low <= SLOTS:
            acc = np.bincount(slot - low, part)
            some = np.flatnonzero(acc)
            slots.append(some + low), sums.append(acc[some])
        else:
            some, back = np.unique(slot, return_inverse=True)
            slots.append(some), sums.append(np.bincount(back, part))
        at = to
    return np.concatenate(slots), np.concatenate(sums)


def _on_grid(flow: np.ndarray) -> np.ndarray:
    return np.floor(flow * GRID + 0.5) / GRID


def flow_clusters(a: np.ndarray, b: np.ndarray, weight: np.ndarray, loops: np.ndarray, base: np.ndarray, span: np.ndarray, power: float = INFLATION) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Attractor of each node, the flow each node draws, and whether its block came to rest.

    Nodes are numbered through, block after block; node i's block starts at ``base[i]`` and has ``span[i]`` nodes. Every
    block stops in the round in which it is still, whatever the blocks beside it do.
    """
    n = len(base)
    loop = np.arange(n)
    row, col = np.concatenate([a, b, loop]), np.concatenate([b, a, loop])
    flow = np.concatenate([weight, weight, loops])
    order = np.lexsort((row, col))
    row, col, flow = row[order], col[order], _on_grid(scaled(col, flow, n)[order])
    # slot of (row, col) in an accumulator of span x span per block
    size = np.zeros(n, dtype=np.int64)
    starts = np.flatnonzero(base == loop)
    size[starts] = span[starts].astype(np.int64) ** 2
    offset = (np.cumsum(size) - size)[base] if n else size
    shift = offset - base * span - base
    attractor, drawn, settled = loop.copy(), np.zeros(n), np.zeros(n, dtype=bool)

    def rest(row: np.ndarray, col: np.ndarray, flow: np.ndarray, still: bool) -> None:
        nodes = np.unique(col)
        drawn[nodes] = np.bincount(row, flow, n)[nodes]
        # the strongest entry of each column; ties go to the smaller row
        order = np.lexsort((row, -_to_six(flow), col))
        attractor[nodes] = row[order[np.searchsorted(col[order], nodes)]]
        settled[nodes] = still

    for _ in range(ROUNDS):
        first = np.searchsorted(col, loop)
        many = np.diff(np.append(first, len(col)))
        kept, new = square(row, col, flow, first, many, shift, span)
        block = np.searchsorted(offset[starts], kept, "right") - 1
        left = kept - offset[starts][block]
        width = span[starts][block]
        new_col, new_row = starts[block] + left // width, starts[block] + left % width
        new = new**power
        total, most = np.bincount(new_col, new, n), np.zeros(n)
        np.maximum.at(most, new_col, new)
        # the largest entry of a column is never pruned
        keep = (new >= total[new_col] * SMALL) | (new == most[new_col])
        new_row, new_col, new, kept, block = new_row[keep], new_col[keep], new[keep], kept[keep], block[keep]
        new = _on_grid(scaled(new_col, new, n))
        # entries that came, went or changed make their block move
        old_block = np.searchsorted(starts, base[col])
        slot = shift[col] + col * span[col] + row
        at = np.minimum(np.searchsorted(slot, kept), len(slot) - 1)
        moved = (slot[at] != kept) | (np.abs(new - flow[at]) >= STILL)
        moving = (np.bincount(block, moved, len(starts)) > 0) | (np.bincount(block, minlength=len(starts)) != np.bincount(old_block, minlength=len(starts)))
        on = moving[block]
        if not on.all():
            rest(new_row[~on], new_col[~on], new[~on], True)
        row, col, flow = new_row[on], new_col[on], new[on]
        if not len(col):
            break
    if len(col):
        rest(row, col, flow, False)
    return attractor, drawn, settled


def _to_six(flow: np.ndarray) -> np.ndarray:
    return np.floor(flow * 1e6 + 0.5)


def all_levels(a: np.ndarray, b: np.ndarray, weight: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Attractor, flow drawn and rest of the first level, and the smallest node of each node's patch; blocks start at ``base``."""
    n = len(base)
    attractor, drawn, settled, patch = np.arange(n), np.ones(n), np.ones(n, dtype=bool), np.arange(n)
    for level in range(MOST_LEVELS):
        if not len(a):
            return attractor, drawn, settled, patch
        # only nodes with an edge take part; the others are done
        nodes, to = np.unique(np.concatenate([a, b]), return_inverse=True)
        i, j, k = to[: len(a)], to[len(a) :], len(nodes)
        own = base[nodes]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        inner = np.cumsum(np.append(True, own[1:] != own[:-1])) - 1
        loops = np.ones(k)
        if level:  # as strong as the strongest edge
            loops = np.zeros(k)
            np.maximum.at(loops, i, weight)
            np.maximum.at(loops, j, weight)
        got, flow, still = flow_clusters(i, j, weight, loops, first[inner], np.diff(np.append(first, k))[inner], power_of(level))
        if not level:
            attractor[nodes], drawn[nodes], settled[nodes] = nodes[got], flow, still
        # attractors of attractors are one cluster, named by its smallest node
        low = smallest_linked(np.arange(k), got, k)
        patch_of = np.arange(n)
        patch_of[nodes] = nodes[low]
        patch = patch_of[patch]
        u, v = low[i], low[j]
        out = u != v
        pair, back = np.unique(np.minimum(u, v)[out] * k + np.maximum(u, v)[out], return_inverse=True)
        a, b, weight = nodes[pair // k], nodes[pair % k], np.bincount(back, weight[out], len(pair))
    raise RuntimeError("Markov clustering left edges after its last level")


_BLOCK = ["cb_index", "puck_index"]
NODE = "cb_index long, puck_index int, bead_id long, attractor_id long, drawn double, settled boolean, head_bead_id long, patch_size long"


def _cluster_blocks(pdf: pd.DataFrame, reach: float) -> pd.DataFrame:
    """All whole blocks of ``pdf`` (sorted by cell, puck and bead, each bead once in a block)."""
    cb, puck, bead = pdf["cb_index"].to_numpy(), pdf["puck_index"].to_numpy(), pdf["bead_id"].to_numpy()
    n = len(pdf)
    new = np.ones(n, dtype=bool)
    new[1:] = (cb[1:] != cb[:-1]) | (puck[1:] != puck[:-1])
    block = np.cumsum(new) - 1
    a, b, gap = neighbours(block, pdf["x"].to_numpy(), pdf["y"].to_numpy(), reach)
    attractor, drawn, settled, patch = all_levels(a, b, 1.0 - gap / reach / 2, np.flatnonzero(new)[block])
    # beads are sorted, so the smallest node of a patch has the smallest bead
    return pd.DataFrame({
        "cb_index": cb, "puck_index": puck, "bead_id": bead, "attractor_id": bead[attractor], "drawn": drawn, "settled": settled,
        "head_bead_id": bead[patch], "patch_size": np.bincount(patch, minlength=n)[patch],
    })


def _in_task(reach: float):
    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by block; a block is held back until all of it is there."""
        held: list[pd.DataFrame] = []

        def work(rows: pd.DataFrame) -> pd.DataFrame:
            return _cluster_blocks(rows.drop_duplicates(["cb_index", "puck_index", "bead_id"], ignore_index=True), reach)

        for pdf in pdfs:
            held.append(pdf)
            if sum(map(len, held)) < BATCH_ROWS:
                continue
            rows = pd.concat(held, ignore_index=True)
            other = (rows[_BLOCK] != rows[_BLOCK].iloc[-1]).any(axis=1).to_numpy()
            whole = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if whole:
                yield work(rows.iloc[:whole])
            held = [rows.iloc[whole:]]
        if held and sum(map(len, held)):
            yield work(pd.concat(held, ignore_index=True))

    return run


# --- over the cluster: entries (blk, i, j, flow) as a table, column j sending to row i ---


def _grid(c: Column) -> Column:
    return F.floor(c * GRID + 0.5) / GRID


def expand_entries(m: DataFrame, power: float = INFLATION, small: float = SMALL) -> DataFrame:
    """One round over a table of entries ``blk, i, j, flow``: square, inflate, prune, scale.

    The sums of a column and its pruning share the shuffle of the squared entries, as all are by column.
    """
    left = m.select("blk", F.col("i").alias("k"), "j", F.col("flow").alias("f"))
    right = m.select("blk", F.col("j").alias("k"), "i", F.col("flow").alias("g"))
    products = left.join(right, ["blk", "k"]).select("blk", "j", "i", (F.col("f") * F.col("g")).alias("flow"))
    column = Window.partitionBy("blk", "j")
    square = products.repartition("blk", "j").groupBy("blk", "j", "i").agg(F.pow(F.sum("flow"), F.lit(power)).alias("flow"))
    told = square.withColumn("total", F.sum("flow").over(column)).withColumn("most", F.max("flow").over(column))
    kept = told.filter((F.col("flow") >= F.col("total") * small) | (F.col("flow") == F.col("most")))
    return kept.select("blk", "i", "j", _grid(F.col("flow") / F.sum("flow").over(column)).alias("flow"))


def markov_table(edges: DataFrame, level: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """``blk, node, attractor, drawn, settled`` from edges ``blk, a, b, weight`` given once each; blocks never mix."""
    both = edges.select("blk", F.col("a").alias("i"), F.col("b").alias("j"), F.col("weight").alias("flow"))
    both = both.unionByName(both.select("blk", F.col("j").alias("i"), F.col("i").alias("j"), "flow"))
    loops = both.groupBy("blk", "i").agg((F.max("flow") if level else F.lit(1.0)).alias("flow")).select("blk", "i", F.col("i").alias("j"), "flow")
    column = Window.partitionBy("blk", "j")
    m = cut(both.unionByName(loops).select("blk", "i", "j", _grid(F.col("flow") / F.sum("flow").over(column)).alias("flow")))
    done: DataFrame | None = None
    for _ in range(rounds):
        new, none = expand_entries(m, power_of(level)), F.lit(None).cast("double")
        two = new.withColumn("was", none).unionByName(m.select("blk", "i", "j", none.alias("flow"), F.col("flow").alias("was")))
        met = cut(two.groupBy("blk", "j", "i").agg(F.max("flow").alias("flow"), F.max("was").alias("was")))
        moved = F.col("flow").isNull() | F.col("was").isNull() | (F.abs(F.col("flow") - F.col("was")) >= STILL)
        moving = met.filter(moved).select("blk").distinct()
        now = met.filter("flow IS NOT NULL").select("blk", "i", "j", "flow")
        rest = now.join(moving, "blk", "left_anti").withColumn("settled", F.lit(True))
        done = rest if done is None else done.unionByName(rest)
        m = now.join(moving, "blk", "left_semi")
        if moving.isEmpty():
            break
    done = done.unionByName(m.withColumn("settled", F.lit(False)))
    drawn = done.groupBy("blk", F.col("i").alias("node")).agg(F.sum("flow").alias("drawn"))
    best = done.groupBy("blk", F.col("j").alias("node")).agg(F.max(F.struct(F.floor(F.col("flow") * 1e6 + 0.5).alias("f"), (-F.col("i")).alias("i"))).alias("top"), F.first("settled").alias("settled"))
    return best.join(drawn, ["blk", "node"], "left").select("blk", "node", (-F.col("top.i")).alias("attractor"), F.coalesce("drawn", F.lit(0.0)).alias("drawn"), "settled")


def table_levels(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first level's ``markov_table`` and ``blk, node, low``, the smallest node of the patch of every node with an edge."""
    first: DataFrame | None = None
    patch: DataFrame | None = None
    edges = cut(edges)
    for level in range(MOST_LEVELS):
        if edges.isEmpty():
            return first, patch
        got = cut(markov_table(edges, level))
        first = got if first is None else first
        led = linked_table(got.select("blk", F.col("node").alias("a"), F.col("attractor").alias("b")))
        step = got.select("blk", "node").join(led, ["blk", "node"], "left").select("blk", "node", F.coalesce("low", "node").alias("low"))
        if patch is None:
            patch = cut(step)
        else:
            on = step.select("blk", F.col("node").alias("low"), F.col("low").alias("next"))
            patch = cut(patch.join(on, ["blk", "low"], "left").select("blk", "node", F.coalesce("next", "low").alias("low")))
        end = lambda c: step.select("blk", F.col("node").alias(c), F.col("low").alias(f"low_{c}"))
        met = edges.join(end("a"), ["blk", "a"]).join(end("b"), ["blk", "b"]).filter("low_a <> low_b")
        edges = cut(met.groupBy("blk", F.least("low_a", "low_b").alias("a"), F.greatest("low_a", "low_b").alias("b")).agg(F.sum("weight").alias("weight")))
    raise RuntimeError("Markov clustering left edges after its last level")


def _over_the_cluster(nodes: DataFrame, reach: float) -> DataFrame:
    """Blocks too large for a task, from ``cb_index, puck_index, bead_id, x, y``, each bead once in a block."""
    here = cut(nodes.withColumn("blk", F.struct("cb_index", "puck_index")))
    pairs = near_pairs(here, reach, "blk", "bead_id").filter(F.col("gap2") < reach * reach)
    first, patch = table_levels(pairs.select("blk", "a", "b", (1.0 - F.sqrt("gap2") / reach / 2).alias("weight")))
    out = here.select("blk", F.col("bead_id").alias("node"))
    if first is None:
        out = out.select("*", *(F.lit(None).cast(t).alias(c) for c, t in (("attractor", "long"), ("drawn", "double"), ("settled", "boolean"), ("low", "long"))))
    else:
        out = out.join(first, ["blk", "node"], "left").join(patch, ["blk", "node"], "left")
    head = F.coalesce("low", "node")
    told = out.select("blk", "node", F.coalesce("attractor", "node").alias("attractor_id"), F.coalesce("drawn", F.lit(1.0)).alias("drawn"), F.coalesce("settled", F.lit(True)).alias("settled"), head.alias("head_bead_id"))
    size = told.groupBy("blk", "head_bead_id").agg(F.count("*").alias("patch_size"))
    met = told.join(size, ["blk", "head_bead_id"])
    return met.select("blk.cb_index", "blk.puck_index", F.col("node").alias("bead_id"), "attractor_id", "drawn", "settled", "head_bead_id", "patch_size")


# --- the problem: beads seen with each called cell ---


def lone_beads(puck: DataFrame) -> DataFrame:
    """Puck rows whose barcode (trimmed, upper case) is in no other row and which have a position."""
    sb = F.upper(F.trim("sb"))
    one = puck.filter("sb IS NOT NULL").select(sb.alias("barcode"), "bead_id", "x", "y", "puck_index").groupBy("barcode").agg(
        F.count("*").alias("n"), *(F.min(c).alias(c) for c in ("bead_id", "x", "y", "puck_index"))
    )
    return one.filter("n = 1 AND x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y) AND puck_index IS NOT NULL").drop("n")


def bead_patches(molecules: DataFrame, sb_list: DataFrame, puck: DataFrame, reach: float = 20.0, limit: int = BLOCK_BEADS) -> DataFrame:
    """Every bead seen with a called cell: ``cb_index, puck_index, bead_id, attractor_id, drawn, settled, head_bead_id, patch_size``.

    ``attractor_id`` is the bead's flow cluster of the first level, ``drawn`` the flow it draws there, ``settled`` whether its block came to
    rest, ``head_bead_id`` the smallest bead of its patch (its cluster of the last level), ``patch_size`` the beads of the patch. Rows with a
    null or negative ``cb_index`` or a null ``sb_index``, and beads without a barcode, a puck or a finite position, take no part; repeated
    molecules count once; a bead without neighbours is a patch of its own; empty tables give no rows. ``limit`` only says where a block
    is worked on, not what comes out.
    """
    finite = "abs(x) < double('inf') AND abs(y) < double('inf')"
    beads = sb_list.select("sb_index", "barcode").join(lone_beads(puck).filter(finite), "barcode").drop("barcode")
    called = molecules.filter("cb_index > 0 AND sb_index IS NOT NULL").select("cb_index", "sb_index")
    nodes = called.join(beads, "sb_index").select("cb_index", "puck_index", "bead_id", "x", "y")
    # a cell's beads are at most its rows: only cells of more rows than the limit can have a block beyond it
    crowded = cut(called.groupBy("cb_index").agg(F.count("*").alias("n")).filter(F.col("n") > limit).select("cb_index"))
    n = parts(molecules.sparkSession)
    if crowded.isEmpty():
        return _run(nodes, n, reach)
    own = cut(nodes.join(crowded, "cb_index", "left_semi").distinct())
    large = own.groupBy(*_BLOCK).agg(F.count("*").alias("n")).filter(F.col("n") > limit).select(*_BLOCK)
    light = nodes.join(crowded, "cb_index", "left_anti").unionByName(own.join(large, _BLOCK, "left_anti"))
    out, heavy = _run(light, n, reach), own.join(large, _BLOCK, "left_semi")
    return out if large.isEmpty() else out.unionByName(_over_the_cluster(heavy, reach))


def _run(nodes: DataFrame, n: int, reach: float) -> DataFrame:
    return nodes.repartition(n, *_BLOCK).sortWithinPartitions(*_BLOCK, "bead_id").mapInPandas(_in_task(reach), NODE)


def patches(members: DataFrame, least: int = 5, typical: int = 3) -> DataFrame:
    """Each patch's size and most typical beads: those that draw the most flow (in millionths), ties to the smaller bead.

    ``settled`` is false where the patch's block had not come to rest after ``ROUNDS`` rounds. A patch's members are sorted together
    only up to ``typical`` of them: each task hands on its own best.
    """
    strength = F.floor(F.col("drawn") * 1e6 + 0.5)
    by_flow = F.row_number().over(Window.partitionBy("cb_index", "puck_index", "head_bead_id").orderBy("by", "bead_id"))
    top = members.filter(F.col("patch_size") >= least).withColumn("by", -strength).withColumn("place", by_flow).filter(F.col("place") <= typical)
    return top.groupBy("cb_index", "puck_index", "head_bead_id", "patch_size").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "bead_id"))), lambda s: s["bead_id"]).alias("typical_beads"), F.bool_and("settled").alias("settled")
    )
