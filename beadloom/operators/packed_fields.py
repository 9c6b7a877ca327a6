"""Several values packed in one field: one row per value, with its position.

A cell is a lattice. What is certain about it is read by one pattern: blanks and quotes that only wrap the cell are taken off, a quoted
span inside is one atomic value, all that is no value character separates, and a run of value characters is one value or several
that stand side by side without a separator. So cells fall apart into runs, and only runs are uncertain: a run's lattice has an edge
for the run as a whole and for every piece of it that is a value elsewhere in the column.

Value frequencies, and how often two values stand side by side unseparated, are learned from the whole column by
expectation-maximisation: the start takes every run as one value, forward and backward sums over each distinct run's lattice give
the expected uses of its edges, and Spark adds them up over all runs and atomic spans. A run that is seen as often as its parts would meet
by chance is as likely one value as several, so learned odds of unseparated values stay near none; where it is known that values
are run together, odds are given. Viterbi then takes the likeliest path through each
distinct run, and cells are put together from the paths of their runs. The model and the lattices are tables; neither comes to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beadloom.runtime import cut

#: Quote characters, each with the one that closes it.
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’"}
#: Fixed value: characters of a value.
VALUE_CHARS = "A-Za-z0-9*_-"
_SPANS = "|".join(f"{a}[^{b}]*{b}" for a, b in QUOTES.items())
#: Odds of the next value following without a separator, at the start of learning.
GLUE = 1e-3
#: Expected uses under which a value leaves the model.
LEAST_USES = 1e-9


def parts(cell: str) -> Column:
    """The cell's atomic spans and runs in order: an array of ``text, atomic``; spans without a value character are left out."""
    bare = F.regexp_replace(cell, r"(?U)^\s+|\s+$", "")
    inner = F.when(bare.rlike(f"(?s)^(?:{_SPANS})$"), F.substr(bare, F.lit(2), F.length(bare) - 2)).otherwise(bare)
    found = F.regexp_extract_all(inner, F.lit(f"{_SPANS}|[{VALUE_CHARS}]+"), F.lit(0))
    atomic = lambda x: F.substr(x, F.lit(1), F.lit(1)).isin(*QUOTES)
    told = F.transform(found, lambda x: F.struct(F.when(atomic(x), F.substr(x, F.lit(2), F.length(x) - 2)).otherwise(x).alias("text"), atomic(x).alias("atomic")))
    return F.filter(told, lambda p: p["text"].rlike(f"[{VALUE_CHARS}]"))


def forward_backward(n: int, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Expected uses of each edge over all paths from 0 to ``n``; edges are sorted by start, ``weights`` are log probabilities."""
    ahead, back = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    ahead[0] = back[n] = 0.0
    for k in range(len(starts)):
        ahead[ends[k]] = np.logaddexp(ahead[ends[k]], ahead[starts[k]] + weights[k])
    for k in reversed(range(len(starts))):
        back[starts[k]] = np.logaddexp(back[starts[k]], back[ends[k]] + weights[k])
    return np.exp(ahead[starts] + weights + back[ends] - ahead[n])


def viterbi(n: int, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> list[tuple[int, int]]:
    """Spans of the likeliest path; ties go to fewer values, then to a longer first one."""
    best: list[tuple[float, int, int]] = [(-math.inf, 0, -1)] * (n + 1)
    best[0] = (0.0, 0, -1)
    for k in sorted(range(len(starts)), key=lambda k: (starts[k], -ends[k])):
        if best[starts[k]][0] == -math.inf:
            continue
        score, used = best[starts[k]][0] + weights[k], best[starts[k]][1] + 1
        old = best[ends[k]]
        if score > old[0] + 1e-12 or (abs(score - old[0]) <= 1e-12 and used < old[1]):
            best[ends[k]] = (score, used, k)
    out, at = [], n
    while at:
        k = best[at][2]
        out.append((int(starts[k]), int(ends[k])))
        at = int(starts[k])
    return out[::-1]


def edges_of(runs: DataFrame, values: DataFrame) -> DataFrame:
    """``field_name, run, n, at, to, value``: the edges of every run that has some way through it besides the whole run.

    ``runs``: ``field_name, run, n``; ``values``: ``field_name, value``. Pieces are looked up by equality, at all lengths
    that values of the field have. Runs of which no values make up the whole drop out.
    """
    lengths = values.groupBy("field_name").agg(F.sort_array(F.collect_set(F.length("value"))).alias("lengths"))
    open_ = runs.filter(F.length("run") > 1).join(F.broadcast(lengths), "field_name")
    sized = open_.select("field_name", "run", "n", F.explode("lengths").alias("size")).filter(F.col("size") < F.length("run"))
    spans = sized.select("field_name", "run", "n", "size", F.explode(F.sequence(F.lit(0), F.length("run") - F.col("size"))).alias("at"))
    pieces = spans.select("field_name", "run", "n", "at", (F.col("at") + F.col("size")).alias("to"), F.expr("substr(run, at + 1, size)").alias("value"))
    known = pieces.join(values, ["field_name", "value"], "left_semi").select("field_name", "run", "n", "at", "to", "value")
    # a way needs an edge at the run's beginning and one at its end
    ends = known.groupBy("field_name", "run").agg(F.bool_or(F.col("at") == 0).alias("a"), F.bool_or(F.col("to") == F.length("run")).alias("b"))
    both = known.join(ends.filter("a AND b").select("field_name", "run"), ["field_name", "run"], "left_semi")
    whole = both.select("field_name", "run", "n").distinct().select("field_name", "run", "n", F.lit(0).alias("at"), F.length("run").alias("to"), F.col("run").alias("value"))
    return both.unionByName(whole)


class Model:
    """What is learned: ``values`` (``field_name, value, uses, log_p``), ``glue`` by field, and the likeliest pieces of runs that are several values."""

    def __init__(self, values: DataFrame, glue: dict[str, float], splits: DataFrame):
        self.values, self.glue, self.splits = values, glue, splits


def _log_p(uses: DataFrame) -> DataFrame:
    whole = uses.groupBy("field_name").agg(F.sum("uses").alias("whole"))
    return uses.join(F.broadcast(whole), "field_name").select("field_name", "value", "uses", F.log(F.col("uses") / F.col("whole")).alias("log_p"))


def _lattices(edges: DataFrame, values: DataFrame) -> DataFrame:
    """One row per open run, its edges sorted by their start; a value that left the model has no edge, the whole run always has one."""
    met = edges.join(values.select("field_name", "value", "log_p"), ["field_name", "value"], "left")
    met = met.filter(F.col("log_p").isNotNull() | (F.col("value") == F.col("run"))).withColumn("log_p", F.coalesce("log_p", F.lit(-1e6)))
    return met.groupBy("field_name", "run", "n").agg(F.sort_array(F.collect_list(F.struct("at", "to", "log_p"))).alias("edges"))


def _arrays(run: str, edges, log_glue: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = np.array([e["at"] for e in edges]), np.array([e["to"] for e in edges])
    weights = np.array([e["log_p"] for e in edges])
    # each value but the last of a run is followed by another without a separator
    return starts, ends, weights + np.where(ends == len(run), 0.0, log_glue)


def _expected(glue: dict[str, float]):
    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            out = []
            for f, text, n, edges in zip(pdf["field_name"], pdf["run"], pdf["n"], pdf["edges"]):
                starts, ends, weights = _arrays(text, edges, math.log(glue[f]))
                e = forward_backward(len(text), starts, ends, weights) * n
                out.extend((f, text[a:b], u, u if b < len(text) else 0.0) for a, b, u in zip(starts, ends, e))
            yield pd.DataFrame(out, columns=["field_name", "value", "uses", "glued"])

    return run


def _likeliest(glue: dict[str, float]):
    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            out = []
            for f, text, edges in zip(pdf["field_name"], pdf["run"], pdf["edges"]):
                path = viterbi(len(text), *_arrays(text, edges, math.log(glue[f])))
                if len(path) > 1:
                    out.append((f, text, [text[a:b] for a, b in path]))
            yield pd.DataFrame(out, columns=["field_name", "run", "pieces"])

    return run


def learn(found: DataFrame, glue: float | None, rounds: int) -> Model:
    """The model of ``field_name, text, atomic, n``, the distinct parts of all cells.

    ``glue`` is the odds of two values standing unseparated, or None where they are learned too; odds over 1 say that a run which can be
    read as several values is so more often than frequencies alone would have it. Values that no path uses any more leave the model; none
    is left out for their number. Only one row per field comes to the driver.
    """
    found = cut(found)
    strict = found.groupBy("field_name", F.col("text").alias("value")).agg(F.sum("n").cast("double").alias("uses"))
    runs = found.filter("NOT atomic").select("field_name", F.col("text").alias("run"), "n")
    edges = cut(edges_of(runs, strict.select("field_name", "value")))
    whole = {r["field_name"]: float(r["n"]) for r in found.groupBy("field_name").agg(F.sum("n").alias("n")).collect()}
    chance = {f: glue if glue is not None else GLUE for f in whole}
    values = cut(_log_p(strict))
    # runs with a single way through and atomic spans are used as often in every round
    sure = found.join(edges.select("field_name", F.col("run").alias("text")).distinct().withColumn("atomic", F.lit(False)), ["field_name", "text", "atomic"], "left_anti")
    sure = cut(sure.select("field_name", F.col("text").alias("value"), F.col("n").cast("double").alias("uses")))
    if edges.isEmpty():
        return Model(values, chance, found.sparkSession.createDataFrame([], "field_name string, run string, pieces array<string>"))
    before: dict[str, float] = {}
    for _ in range(rounds):
        made = cut(_lattices(edges, values).mapInPandas(_expected(chance), "field_name string, value string, uses double, glued double"))
        side = {r["field_name"]: r["g"] for r in made.groupBy("field_name").agg(F.sum("glued").alias("g")).collect()}
        if glue is None:
            chance = {f: max(side.get(f, 0.0) / n, 1e-300) for f, n in whole.items()}
        uses = sure.unionByName(made.select("field_name", "value", "uses")).groupBy("field_name", "value").agg(F.sum("uses").alias("uses")).filter(F.col("uses") > LEAST_USES)
        values = cut(_log_p(uses))
        if all(abs(g - before.get(f, -1.0)) <= 1e-6 * max(1.0, g) for f, g in side.items()):
            break
        before = side
    splits = cut(_lattices(edges, values).mapInPandas(_likeliest(chance), "field_name string, run string, pieces array<string>"))
    return Model(values, chance, splits)


def _flat(cells: DataFrame, ident: str, fields: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{f}', `{f}`" for f in fields)
    return cells.select(ident, F.expr(f"stack({len(fields)}, {pairs}) AS (field_name, cell)")).filter("cell IS NOT NULL")


def model_of(cells: DataFrame, fields: list[str], glue: float | None = None, rounds: int = 12) -> Model:
    """The model of all cells of the fields."""
    each = _flat(cells.withColumn("ident", F.lit(0)), "ident", fields).groupBy("field_name", "cell").agg(F.count("*").alias("n"))
    one = each.select("field_name", "n", F.explode(parts("cell")).alias("p"))
    return learn(one.groupBy("field_name", "p.text", "p.atomic").agg(F.sum("n").alias("n")), glue, rounds)


def unpack(cells: DataFrame, ident: str, fields: list[str], glue: float | None = None, rounds: int = 12) -> DataFrame:
    """One row per value: ``ident, field_name, pos, item_text``.

    A null, empty or blank cell and one of separators only give no row. A quoted span with no value
    character inside gives none either. A quote that nothing closes separates. Repeated rows are
    split each on their own. ``pos`` counts from 1. A run is split only into values that stand alone elsewhere in its field, and only where
    what the column holds makes that likelier than one value. ``glue`` as in ``learn``.
    """
    model = model_of(cells, fields, glue, rounds)
    flat = _flat(cells, ident, fields)
    if model.splits.isEmpty():
        own = flat.select(ident, "field_name", F.posexplode(parts("cell")).alias("pos", "p"))
        return own.select(ident, "field_name", (F.col("pos") + 1).cast("int").alias("pos"), F.col("p.text").alias("item_text"))
    # distinct cells take the paths of their runs, and rows the values of their cells
    each = flat.select("field_name", "cell").distinct().select("field_name", "cell", F.posexplode(parts("cell")).alias("nth", "p"))
    run = F.when(~F.col("p.atomic"), F.col("p.text"))
    met = each.withColumn("run", run).join(model.splits, ["field_name", "run"], "left")
    values = met.groupBy("field_name", "cell").agg(F.sort_array(F.collect_list(F.struct("nth", F.coalesce("pieces", F.array("p.text")).alias("v")))).alias("all"))
    told = values.select("field_name", "cell", F.flatten(F.transform("all", lambda x: x["v"])).alias("values"))
    out = flat.join(told, ["field_name", "cell"]).select(ident, "field_name", F.posexplode("values").alias("pos", "item_text"))
    return out.select(ident, "field_name", (F.col("pos") + 1).cast("int").alias("pos"), "item_text")
