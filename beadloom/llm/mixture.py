"""Mixing documents of several sources to target shares of the tokens.

Every document has a membership in each source: its label, or, where the label is missing, the posterior of a classifier
fitted on a bounded sample of labelled documents. Rates (how often a document is used) between 0 and the source's most repeats are
fitted by projected gradient steps on the least squares of expected tokens per source against the targets. A step
needs ten sums over all documents; rates are never collected. Rates become whole copies by a hash of the document's id, with one
threshold per source that makes the tokens come out.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beadloom.runtime import cut

#: Folder of the public tokenizers' vocabularies, and the vocabulary.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
#: Fixed value: how that vocabulary parts words before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Labelled documents the classifier is fitted on, places its features are hashed to, passes over them.
FIT_DOCUMENTS, PLACES, PASSES = 5_000, 1 << 14, 12
#: Most gradient steps, and the largest relative miss of a target that ends them; ``settled`` tells whether they came to an end before.
STEPS, CLOSE = 40, 1e-6
BINS = 8192

_WORD = re.compile(r"\w+|\n\n|\n|\t|[^\w\s]")


def encoder(folder: str):
    import tiktoken

    with open(f"{folder}/{VOCABULARY}", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def features(text: str) -> np.ndarray:
    """Distinct places of the hashed words, numbers alike, and of pairs of neighbouring ones."""
    import xxhash

    w = ["#" if x[0].isdigit() else x.lower() for x in _WORD.findall(text)]
    both = {xxhash.xxh3_64_intdigest(x) % PLACES for x in {*w, *map(" ".join, zip(w, w[1:]))}}
    return np.fromiter(both, dtype=np.int64, count=len(both))


def _feature_rows(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in pdfs:
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "places": [np.sort(features(t)).astype(np.int32) for t in pdf["text"]]})


def train(documents: DataFrame, sources: list[str], bound: int = FIT_DOCUMENTS) -> np.ndarray:
    """Weights (places + 1, sources) of a softmax regression; the last row is the bias. Without labelled documents all are 0.

    ``bound`` labelled documents at most, chosen by a hash of their ids; their whole texts become places in the tasks.
    """
    labelled = documents.filter(F.col("label").isin(*sources) & F.col("text").isNotNull()).select("doc_id", "label", "text")
    chosen = labelled.select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(bound)
    some = labelled.join(F.broadcast(chosen.distinct()), "doc_id", "left_semi")
    rows = some.mapInPandas(_feature_rows, "doc_id long, label string, places array<int>").toPandas()
    rows = rows.sort_values(["doc_id", "label"], ignore_index=True, kind="stable")
    weights = np.zeros((PLACES + 1, len(sources)))
    if rows.empty:
        return weights
    xs, ys = [np.asarray(p, dtype=np.int64) for p in rows["places"]], [sources.index(s) for s in rows["label"]]
    seen, rng = np.full_like(weights, 1e-6), np.random.default_rng(5)
    for _ in range(PASSES):
        for i in rng.permutation(len(xs)):
            x = np.append(xs[i], PLACES)
            scale = 1 / np.sqrt(len(x))
            z = weights[x].sum(0) * scale
            p = np.exp(z - z.max())
            p /= p.sum()
            p[ys[i]] -= 1
            g = p * scale + 1e-5 * weights[x]
            seen[x] += g * g
            weights[x] -= 0.3 * g / np.sqrt(seen[x])
    return weights


def posteriors(text: str, weights: np.ndarray) -> np.ndarray:
    x = np.append(features(text), PLACES)
    z = weights[x].sum(0) / np.sqrt(len(x))
    p = np.exp(z - z.max())
    return p / p.sum()


def memberships(documents: DataFrame, sources: list[str], weights: np.ndarray, folder: str = TOKENIZERS) -> DataFrame:
    """``doc_id, label, n_tokens`` and ``p0, p1, ...``, the membership in each source; a null text has no tokens."""
    sent = documents.sparkSession.sparkContext.broadcast(weights)
    n = len(sources)
    names = [f"p{k}" for k in range(n)]

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(folder)
        for pdf in pdfs:
            counts, p = np.zeros(len(pdf), dtype=np.int64), np.zeros((len(pdf), n))
            for i, (label, text) in enumerate(zip(pdf["label"], pdf["text"])):
                text = text or ""
                counts[i] = len(enc.encode_ordinary(text))  # whole, however long
                if label in sources:
                    p[i, sources.index(label)] = 1
                else:
                    p[i] = posteriors(text, sent.value)
            out = pd.DataFrame(p, columns=names)
            out.insert(0, "n_tokens", counts)
            out.insert(0, "label", pdf["label"].to_numpy())
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    return documents.select("doc_id", "label", "text").mapInPandas(run, "doc_id long, label string, n_tokens long, " + ", ".join(f"{p} double" for p in names))


def rate_after(steps: list[np.ndarray], names: list[str], cap: str = "cap") -> Column:
    """The rate that the steps lead to from 0, each clipped to what is allowed; steps are data in one expression, which does not grow with them."""
    p = F.array(*map(F.col, names))
    table = F.array(*(F.array(*(F.lit(float(w)) for w in s)) for s in steps)) if steps else F.array().cast("array<array<double>>")

    def step(rate: Column, s: Column) -> Column:
        dot = F.aggregate(F.zip_with(p, s, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y)
        return F.least(F.col(cap), F.greatest(F.lit(0.0), rate + dot))

    return F.aggregate(table, F.lit(0.0), step)


class Mix:
    """The fitted mix: ``documents`` (one row each) and ``shares`` (one row per source)."""

    def __init__(self, documents: DataFrame, shares: DataFrame):
        self.documents, self.shares = documents, shares


def mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, folder: str = TOKENIZERS) -> Mix:
    """Fit rates and copies.

    ``documents``: ``doc_id, text, source``; ``targets``: ``source, target_share, max_repeats``, a table as small as the number of
    sources. ``total_tokens`` is the size of the mix; by default the largest at which every target can be met. A
    source label is compared trimmed and in lower case. A null or blank label makes a document soft: it may be used once at most, for
    its posterior sources. A label outside of ``targets`` has no share and its documents are not used. A target without documents stays at 0.
    Copies of a document are mixed each on their own. ``shares.settled`` is false where the last step still moved rates.
    """
    want = sorted((r["source"].strip().lower(), float(r["target_share"]), int(r["max_repeats"])) for r in targets.collect())
    sources, share, most = [w[0] for w in want], np.array([w[1] for w in want]), np.array([w[2] for w in want])
    n, names = len(sources), [f"p{k}" for k in range(len(want))]
    label = F.lower(F.trim("source"))
    labelled = documents.select("doc_id", "text", F.when(label != "", label).alias("label"))
    labelled = labelled.filter(F.col("label").isNull() | F.col("label").isin(*sources))
    member = memberships(labelled, sources, train(labelled, sources), folder)
    cap = F.coalesce(*(F.when(F.col("label") == s, F.lit(float(m))) for s, m in zip(sources, most)), F.lit(1.0))
    rows = cut(member.withColumn("cap", cap))

    # documents of one label have one membership and one rate: a step works on their sum and on the soft ones
    like = cut(rows.groupBy("cap", *names).agg(F.sum("n_tokens").alias("n_tokens")))
    tokens = lambda rate: like.agg(*(F.sum(rate * F.col("n_tokens") * F.col(p)).alias(f"sum_{p}") for p in names)).first()
    got = lambda row: np.array([row[f"sum_{p}"] or 0.0 for p in names])
    there, reach = got(tokens(F.lit(1.0))), got(tokens(F.col("cap")))
    able = there > 0
    asked = able & (share > 0)
    total = float(total_tokens) if total_tokens is not None else float((reach[asked] / share[asked]).min()) if asked.any() else 0.0
    target = share * total
    # rates are never stored or collected: the steps tell the rate of each membership
    steps: list[np.ndarray] = []
    mixed, settled = np.zeros(n), False
    for _ in range(STEPS):
        steps.append(np.where(able, (target - mixed) / np.maximum(there, 1e-9), 0.0))
        before, mixed = mixed, got(tokens(rate_after(steps, names)))
        miss = np.abs(mixed - target)[able] / np.maximum(target[able], 1)
        if miss.max(initial=0) < CLOSE or np.abs(mixed - before).max(initial=0) < CLOSE * max(total, 1):
            settled = True
            break
    rate = rate_after(steps, names)
    domain = F.coalesce("label", F.element_at(F.array(*map(F.lit, sources)), F.array_position(F.array(*map(F.col, names)), F.greatest(*map(F.col, names)) if n > 1 else F.col(names[0])).cast("int")))
    fitted = rows.select("doc_id", "label", "n_tokens", "cap", *names, rate.alias("rate")).withColumn("domain", domain)
    # whole copies: the floor, and one more where hash / fraction is under the domain's threshold
    whole = F.floor("rate")
    part = F.col("rate") - whole
    chance = (F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) + 1) / float(1 << 30)
    fitted = fitted.withColumn("whole", whole).withColumn("draw", F.when(part > 1e-9, chance / part))
    bins = fitted.groupBy("domain", F.least(F.floor(F.coalesce("draw", F.lit(9.0)) * (BINS / 2)), F.lit(BINS)).alias("bin")).agg(
        F.sum(F.col("n_tokens") * (F.col("rate") - F.col("whole"))).alias("due"), F.sum("n_tokens").alias("tokens")
    ).toPandas()
    limits = {}
    for d, own in bins.groupby("domain"):
        due = own["due"].sum()
        own = own[own["bin"] < BINS].sort_values("bin")
        reached = np.cumsum(own["tokens"].to_numpy())
        k = int(np.searchsorted(reached, due))
        nearer = k < len(reached) and abs(reached[k] - due) < abs((reached[k - 1] if k else 0) - due)
        k += nearer
        limits[d] = (int(own["bin"].iloc[k - 1]) + 1) / (BINS / 2) if k else 0.0
    limit = F.coalesce(*(F.when(F.col("domain") == d, F.lit(v)) for d, v in limits.items()), F.lit(0.0))
    copies = (F.col("whole") + F.when(F.col("draw") < limit, 1).otherwise(0)).cast("long")
    out = fitted.select("doc_id", F.col("label").alias("source"), "domain", "n_tokens", F.round("rate", 6).alias("rate"), copies.alias("copies"), *names)
    per = out.groupBy("domain").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens_used"), F.sum(F.when(F.col("copies") > 0, 1).otherwise(0)).alias("documents_used"),
        F.max("copies").alias("most_copies"), F.sum("n_tokens").alias("tokens_there"),
    )
    reached = documents.sparkSession.createDataFrame(
        [(s, float(w), int(m), float(e), settled) for s, w, m, e in zip(sources, share, most, mixed)], "source string, target_share double, max_repeats int, expected_tokens double, settled boolean"
    )
    zero = F.lit(0).cast("long")
    told = reached.join(per.withColumnRenamed("domain", "source"), "source", "left").select(
        "source", "target_share", "max_repeats", F.coalesce("tokens_there", zero).alias("tokens_there"), F.round("expected_tokens", 3).alias("expected_tokens"),
        F.coalesce("tokens_used", zero).alias("tokens_used"), F.coalesce("documents_used", zero).alias("documents_used"), F.coalesce("most_copies", zero).alias("most_copies"), "settled",
    )
    used = told.agg(F.sum("tokens_used").alias("u")).scalar()
    shares = told.withColumn("reached_share", F.coalesce(F.round(F.col("tokens_used") / F.when(used > 0, used), 6), F.lit(0.0)))
    return Mix(out.drop(*names), shares)
