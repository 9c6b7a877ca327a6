"""Evaluation texts inside training texts, by spaced-seed hashing.

A mask of ``span`` places, some of them ignored, is laid on every run of ``span`` words of items and documents; the
words at its kept places are hashed. Equal hashes of one mask are a hit: the words agree wherever the mask looks, and
may differ elsewhere. Around each hit the texts are aligned and compared word by word, which gives the overlap with its
substitutions and the longest run of equal words. Every exact run of at least ``span`` words is hit by every mask.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Masks of 13 places with 7 or 8 kept ones: 1 is looked at, 0 is ignored. Of overlaps of 20 words with 4 changed at random, together they
#: hit 97 %, of 25 with 5 changed 99 %; the first three alone hit 91 and 96 %.
MASKS = ("1101100101011", "1011010011101", "1110010110011", "1110001000111")
WORDS = r"[\p{L}\p{N}]+"
#: Most hashes of items that are sent to every task; beyond it the join shuffles.
BROADCAST_HASHES = 500_000


def words(text: str | Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(WORDS), F.lit(0))


def seeds(df: DataFrame, keep: list[str], masks: tuple[str, ...]) -> DataFrame:
    """``keep``, ``at`` (word place from 0) and ``seed`` for every mask and place; ``df`` has an array ``w``."""
    span = len(masks[0])

    def hashed(mask: str, number: int) -> Column:
        looked = [k for k, c in enumerate(mask) if c == "1"]
        places = F.when(F.size("w") >= span, F.sequence(F.lit(0), F.size("w") - span))
        return F.transform(places, lambda i: F.xxhash64(F.lit(number), *(F.element_at("w", i + k + 1) for k in looked)))

    both = F.arrays_zip(*(hashed(m, n).alias(f"m{n}") for n, m in enumerate(masks)))
    if len(masks) == 1:
        return df.select(*keep, F.posexplode(hashed(masks[0], 0)).alias("at", "seed"))
    each = df.select(*keep, F.posexplode(both).alias("at", "m"))
    return each.select(*keep, "at", F.explode(F.array(*(F.col(f"m.m{n}") for n in range(len(masks))))).alias("seed"))


def longest_run(flags: Column) -> Column:
    """Longest run of true in an array of booleans."""
    step = F.aggregate(
        flags,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")),
        lambda s, f: F.struct(
            F.when(f, s["now"] + 1).otherwise(0).alias("now"),
            F.greatest(s["best"], F.when(f, s["now"] + 1).otherwise(0)).alias("best"),
        ),
    )
    return step["best"]


def _aligned(documents: DataFrame, items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """``doc_id, item_id, shift, same``: for each alignment that some seed hits, whether the words side by side are equal."""
    span = len(masks[0])
    iw = items.select("item_id", words("text").alias("w")).filter(F.size("w") >= span)
    hashes = seeds(iw, ["item_id"], masks).select("item_id", F.col("at").alias("item_at"), "seed")
    small = hashes.limit(BROADCAST_HASHES + 1).count() <= BROADCAST_HASHES
    dw = documents.select("doc_id", words("text").alias("w"))
    hits = seeds(dw, ["doc_id"], masks).join(F.broadcast(hashes) if small else hashes, "seed")
    # each document's alignments go to it in one row, and its words are split again only if it has any
    lines = hits.groupBy("doc_id").agg(F.collect_set(F.struct("item_id", (F.col("at") - F.col("item_at")).alias("shift"))).alias("lines"))
    held = documents.select("doc_id", "text").join(lines, "doc_id").select("doc_id", words("text").alias("dw"), "lines")
    iw2 = iw.withColumnRenamed("w", "iw")
    met = held.select("doc_id", "dw", F.inline("lines")).join(F.broadcast(iw2) if small else iw2, "item_id")
    first, last = F.greatest(F.lit(0), -F.col("shift")), F.least(F.size("iw"), F.size("dw") - F.col("shift")) - 1
    # the stretch of the item that lies on the document under this shift
    flags = F.transform(F.sequence(first, last), lambda i: F.element_at("iw", i + 1) == F.element_at("dw", i + F.col("shift") + 1))
    return met.select("doc_id", "item_id", "shift", flags.alias("same"))


def _told(aligned: DataFrame) -> DataFrame:
    return aligned.select(
        "doc_id", "item_id", "shift", F.size("same").alias("overlap_words"),
        F.size(F.filter("same", lambda x: x)).alias("equal_words"), longest_run(F.col("same")).alias("exact_run"),
    )


def overlaps(documents: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS[:1]) -> DataFrame:
    """Aligned overlaps of documents and items: ``doc_id, item_id, shift, overlap_words, equal_words, exact_run``.

    ``documents`` has ``doc_id, text``, ``items`` has ``item_id, text``. One row per document, item and alignment that some
    seed hits; ``overlap_words`` is what both texts have side by side under it. A null text and one of fewer words than a
    mask has places hit nothing; copies of a document are each reported; empty inputs give no rows.
    """
    return _told(_aligned(documents, items, masks))


def leaks(documents: DataFrame, items: DataFrame, least_run: int = 13) -> DataFrame:
    """``doc_id, item_id`` of documents and items with a common run of at least ``least_run`` words.

    ``least_run`` must be no smaller than the masks are long, so that no run escapes them.
    """
    if least_run < len(MASKS[0]):
        raise ValueError(f"runs under {len(MASKS[0])} words may escape the masks")
    return overlaps(documents, items).filter(F.col("exact_run") >= least_run).select("doc_id", "item_id").distinct()


def best_stretch(same: np.ndarray, least_words: int, least_equal: float) -> tuple[int, int, int]:
    """``score, at, to`` of the best stretch of ``least_words`` flags or more, its first place and the place after its last.

    The score is ``equal - least_equal * words`` in millionths, so it is 0 or more just where the share is reached; some stretch
    reaches it if and only if the best one does. Ties go to the longer stretch, then to the earlier. Of too few flags the score is -1.
    """
    n = len(same) - least_words + 1
    if n < 1:
        return -1, 0, 0
    sums = np.append(0, np.cumsum(np.where(same, 1_000_000, 0) - round(least_equal * 1_000_000)))
    # the lowest sum at least ``least_words`` before an end begins the best stretch up to it
    low = np.minimum.accumulate(sums[:n])
    new = np.append(True, low[1:] < low[:-1])
    low_at = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    score, size = sums[least_words:] - low, np.arange(n) + least_words - low_at
    k = int(np.lexsort((-size, -score))[0])
    return int(score[k]), int(low_at[k]), k + least_words


def _run_of(same: np.ndarray) -> int:
    gaps = np.flatnonzero(~np.concatenate([[False], same, [False]]))
    return int(np.diff(gaps).max() - 1)


def near_leaks(documents: DataFrame, items: DataFrame, least_equal: float = 0.8, least_words: int = 20) -> DataFrame:
    """Passages with substitutions, of whole items or parts, from all masks; the best alignment of each document and item.

    Of each alignment the best stretch of at least ``least_words`` side by side counts if ``least_equal`` of it are equal,
    whatever stands beside it. An exact run as long as the masks counts as well, so nothing that ``leaks`` finds is missing.
    """
    span = len(MASKS[0])
    # a stretch that counts has at least so many equal words
    few = min(span, least_words * least_equal)
    some = _aligned(documents, items, MASKS).filter(F.size(F.filter("same", lambda x: x)) >= few)

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            out = []
            for d, i, shift, flags in zip(pdf["doc_id"], pdf["item_id"], pdf["shift"], pdf["same"]):
                same = np.asarray(flags, dtype=bool)
                score, at, to = best_stretch(same, least_words, least_equal)
                if score >= 0:
                    part = same[at:to]
                    out.append((d, i, shift, len(part), int(part.sum()), _run_of(part)))
                elif (n := _run_of(same)) >= span:
                    out.append((d, i, shift, n, n, n))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "shift", "overlap_words", "equal_words", "exact_run"])

    kinds = dict(some.dtypes)
    found = some.mapInPandas(run, f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, shift int, overlap_words int, equal_words int, exact_run int")
    best = F.expr("row_number() OVER (PARTITION BY doc_id, item_id ORDER BY equal_words DESC, overlap_words, shift)")
    return found.withColumn("place", best).filter("place = 1").select("doc_id", "item_id", "overlap_words", "equal_words", "exact_run")
