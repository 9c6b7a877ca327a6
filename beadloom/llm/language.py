"""Languages of documents and of their lines, by a string kernel.

The kernel of two lines is the number of character n-grams (n = 1 to 4, the blended spectrum) that occur in both, over
the root of the product of their numbers of n-grams: presence, not frequency. N-grams are hashed to a fixed number of
places. Landmark lines span a Nyström approximation of the kernel, on which ridge regression fits one target per
language against the rest. As the kernel is a dot product of presence vectors, the fitted weights fold into one row of
weights per n-gram, and a batch of lines is scored by one product of its presence matrix with that table.

The classifier is fitted on a bounded sample of labelled documents; its bounds are the parameters ``Bounds``. Labels may be wrong: after
a first fit, lines that it assigns elsewhere are left out of a second one. All lines of all documents are scored, each as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The languages, by code.
CODES = ("de", "en", "es", "fr", "it", "nl", "pt", "ru", "zh")
#: Orders of n-grams, and places they are hashed to.
ORDERS, PLACE_BITS = (1, 2, 3, 4), 18
PLACES = 1 << PLACE_BITS
#: Lines scored in one product: their number and an n-gram's place share 32 bits.
MOST_LINES = 1 << (32 - PLACE_BITS)
RIDGE = 1e-2
#: A score difference of 1 / SHARP is an e-fold in confidence.
SHARP = 8.0
#: Characters scored at once; a longer line is scored by itself.
BATCH_CHARS = 400_000


@dataclass(frozen=True)
class Bounds:
    """Bounds of the fit, and of nothing else.

    ``documents``: labelled documents sampled. ``lines_of_document``: lines taken of each, evenly over its whole text.
    ``longest_line``: a line of more characters is not used for the fit, as it would count once like a short one.
    ``lines_of_language``: lines used of each language. ``landmarks``: landmark lines of each language in the first and the second fit.
    """

    documents: int = 6_000
    lines_of_document: int = 20
    longest_line: int = 20_000
    lines_of_language: int = 1_200
    landmarks: tuple[int, int] = (30, 90)


# classes of characters: marks and digits of other scripts, blanks, line feeds, other letters and numbers, and ASCII letters, digits, underscore
MARK, BLANK, FEED, OTHER, LETTER, DIGIT, LOW = range(7)
_BASES = np.zeros(128, dtype=bool)
_BASES[[ord(c) for c in "ACGTN"]] = True


def _class_of(c: str) -> int:
    if c == "\n":
        return FEED
    if c.isspace():
        return BLANK
    if c.isascii():
        return LETTER if c.isalpha() else DIGIT if c.isdigit() else LOW if c == "_" else MARK
    return OTHER if c.isalnum() and not c.isdecimal() else MARK


def _lower_of(c: str) -> int:
    low = c.lower()
    return ord(low) if len(low) == 1 else ord(c)


#: Made once in each worker.
_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """Class and lower case of every character of the basic plane."""
    if not _TABLES:
        chars = list(map(chr, range(1 << 16)))
        _TABLES.extend([np.array([_class_of(c) for c in chars], dtype=np.uint8), np.array([_lower_of(c) for c in chars], dtype=np.uint32)])
    return _TABLES


def _looked_up(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kinds, lower = _tables()
    far = np.flatnonzero(codes >= 1 << 16)
    near = codes & np.uint32(0xFFFF)
    kind, low = kinds[near], lower[near]
    if len(far):
        some, back = np.unique(codes[far], return_inverse=True)
        kind[far] = np.array([_class_of(chr(c)) for c in some], dtype=np.uint8)[back]
        low[far] = np.array([_lower_of(chr(c)) for c in some], dtype=np.uint32)[back]
    return kind, low


def _runs_of(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each run of true, and the place after its last."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    return edge[::2], edge[1::2]


@dataclass
class Lines:
    """Lines of texts that are not blank: the text each is in, its number there from 1, and its plain characters as codes.

    Plain is lower case without words that hold a digit or are followed by a hyphen and digits, bare runs of bases and marks; blanks
    are one each, with one before and one after. ``line`` names the line of each code; a line without any speaks no language.
    """

    text: np.ndarray
    number: np.ndarray
    codes: np.ndarray
    line: np.ndarray

    def sizes(self) -> np.ndarray:
        """Plain characters of each line, without the blanks around them."""
        return np.maximum(np.bincount(self.line, minlength=len(self.text)) - 2, 0)

    def strings(self) -> list[str]:
        ends = np.cumsum(np.bincount(self.line, minlength=len(self.text)))
        whole = self.codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        return [whole[a:b].strip() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def lines_of(texts: list[str]) -> Lines:
    """All lines of all texts, character classes and rules applied to all at once."""
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(f"{t}\n" for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind, low = _looked_up(codes)
    noise = (kind == MARK) | (kind == DIGIT) | (kind == LOW)
    # a word of ASCII letters, digits and underscores with a digit in it
    word = (kind == LETTER) | (kind == DIGIT) | (kind == LOW)
    a, b = _runs_of(word)
    digits = np.concatenate([[0], np.cumsum(kind == DIGIT)])
    bad = digits[b] > digits[a]
    change = np.zeros(len(codes) + 1, dtype=np.int32)
    np.add.at(change, a[bad], 1)
    np.add.at(change, b[bad], -1)
    # letters followed by a hyphen and a digit, or six bases or more by themselves
    a, b = _runs_of(kind == LETTER)
    bases = np.concatenate([[0], np.cumsum(_BASES[np.minimum(codes, 127)])])
    bad = (b - a >= 6) & (bases[b] - bases[a] == b - a)
    after = np.minimum(b + 1, len(codes) - 1)
    bad |= (codes[np.minimum(b, len(codes) - 1)] == ord("-")) & (kind[after] == DIGIT)
    np.add.at(change, a[bad], 1)
    np.add.at(change, b[bad], -1)
    noise |= np.cumsum(change[:-1]) > 0
    # lines: every line feed ends one; blank ones are not counted
    ends = np.flatnonzero(kind == FEED)
    line = np.cumsum(np.concatenate([[0], kind[:-1] == FEED])) if len(codes) else np.zeros(0, dtype=np.int64)
    full = np.bincount(line[(kind != BLANK) & (kind != FEED)], minlength=len(ends)) > 0
    text = np.searchsorted(np.cumsum(sizes), ends, "right")
    counted = np.cumsum(full)
    before = np.concatenate([[0], counted])[np.searchsorted(ends, np.cumsum(sizes) - sizes)]
    number = counted - before[text] if len(text) else counted
    # blanks are one each; a line's own feed is the blank behind it
    blank = noise | (kind == BLANK) | (kind == FEED)
    follows = np.ones(len(codes), dtype=bool)
    follows[1:] = blank[:-1]
    kept = ~(blank & follows)
    out, of = np.where(blank, np.uint32(32), low)[kept], line[kept]
    first = np.flatnonzero(np.diff(of, prepend=-1))
    out, of = np.insert(out, first, 32), np.insert(of, first, of[first])
    to = np.cumsum(full) - 1
    return Lines(text[full], number[full], out.astype(np.uint32), to[of])


def plain(line: str) -> str:
    """One line as ``Lines`` has it, without blanks around it."""
    return " ".join(lines_of([line]).strings())


def presence(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``present`` of plain lines given as strings; ``MOST_LINES`` at most."""
    sizes = np.array([len(x) + 2 for x in lines], dtype=np.int64)
    codes = np.frombuffer("".join(f" {x} " for x in lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return present(codes, np.repeat(np.arange(len(lines)), sizes), len(lines))


def present(codes: np.ndarray, line: np.ndarray, n_lines: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of every n-gram present, the line it is in (sorted by line), and the n-grams per line."""
    high = line.astype(np.uint32) << np.uint32(PLACE_BITS)
    h = np.zeros(len(codes), dtype=np.uint32)
    keys = []
    for n in range(1, max(ORDERS) + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        h = (h[:m] + np.uint32(n)) * np.uint32(0x9E3779B1) + codes[n - 1 :]
        if n in ORDERS:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)
            key = high[:m] | (mixed >> np.uint32(32 - PLACE_BITS))
            keys.append(key[high[:m] == high[n - 1 :]] if n > 1 else key)
    keys = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint32)
    keys.sort()
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    keys = keys[first]
    at = keys >> np.uint32(PLACE_BITS)
    return keys & np.uint32(PLACES - 1), at, np.bincount(at, minlength=n_lines)


@dataclass
class Kernel:
    """Fitted weights: one row per language, one column per n-gram place."""

    weights: np.ndarray

    def scores(self, codes: np.ndarray, line: np.ndarray, n_lines: int) -> np.ndarray:
        """One row per line, whatever its length; lines are taken together up to ``BATCH_CHARS``. A line without codes scores 0."""
        ends = np.searchsorted(line, np.arange(n_lines), "right")
        out, at = np.zeros((n_lines, len(CODES))), 0
        while at < n_lines:
            begin = int(ends[at - 1]) if at else 0
            to = min(max(int(np.searchsorted(ends, begin + BATCH_CHARS, "right")), at + 1), at + MOST_LINES, n_lines)
            end = int(ends[to - 1])
            place, of, n = present(codes[begin:end], line[begin:end] - at, to - at)
            some = np.flatnonzero(n)
            if len(some):
                starts = np.searchsorted(of, some.astype(of.dtype))
                # language by language, so that each gather stays in a small table
                for k, own in enumerate(self.weights):
                    out[at + some, k] = np.add.reduceat(own[place], starts) / np.sqrt(n[some])
            at = to
        return out


def against(marks: list[str], lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kernel of lines and landmarks, the n-gram places of the landmarks, and the landmarks' scaled presence there."""
    place, at, n = presence(marks)
    used, to = np.unique(place, return_inverse=True)
    z = np.zeros((len(used) + 1, len(marks)), dtype=np.float32)  # the last row is for n-grams of no landmark
    z[to, at] = 1 / np.sqrt(n)[at]
    where = np.full(PLACES, len(used), dtype=np.int32)
    where[used] = np.arange(len(used))
    out = np.empty((len(lines), len(marks)), dtype=np.float32)
    for k, line in enumerate(lines):  # a few thousand; each is one sum of rows
        p, _, m = presence([line])
        out[k] = z[where[p]].sum(0) / np.sqrt(m[0])
    return out, used, z[:-1]


def ridge(phi: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """One-versus-rest weights; languages weigh alike, however many lines each has."""
    weight = 1 / np.bincount(labels, minlength=len(CODES)).clip(1)[labels]
    target = np.where(labels[:, None] == np.arange(len(CODES)), 1.0, -1.0)
    gram = (phi * weight[:, None]).T @ phi
    return np.linalg.solve(gram + RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram)), (phi * weight[:, None]).T @ target)


def fit(lines: list[str], labels: np.ndarray, landmarks: tuple[int, int] = Bounds.landmarks, seed: int = 7) -> Kernel:
    """Nyström ridge regression on plain lines with labels 0 to 8; at least one line.

    The first fit has random landmarks; lines that contradict their label are then left out. Landmarks of the second are,
    for each language, half random and half the lines the first was least sure of, so that rare kinds of lines are spanned too.
    """
    rng = np.random.default_rng(seed)
    good, marks = np.arange(len(lines)), np.concatenate([rng.permutation(np.flatnonzero(labels == k))[: landmarks[0]] for k in range(len(CODES))])
    for last in (False, True):
        kernel, used, z = against([lines[i] for i in marks], lines)
        kmm = kernel[marks].astype(np.float64)
        value, vector = np.linalg.eigh((kmm + kmm.T) / 2)
        keep = value > 1e-5 * value.max()
        root = vector[:, keep] / np.sqrt(value[keep])
        phi = kernel @ root
        for _ in range(2):
            w = ridge(phi[good], labels[good])
            score = phi @ w
            good = np.flatnonzero(score.argmax(1) == labels)
        if last:
            break
        two = np.sort(score[good], axis=1)[:, -2:]
        unsure = good[np.argsort(two[:, 1] - two[:, 0], kind="stable")]
        half = landmarks[1] // 2
        picked = [np.union1d(unsure[labels[unsure] == k][:half], rng.permutation(good[labels[good] == k])[:half]) for k in range(len(CODES))]
        marks = np.concatenate(picked).astype(np.int64)
        if not len(marks):
            break
    folded = np.zeros((len(CODES), PLACES), dtype=np.float32)
    folded[:, used] = (z @ (root @ w).astype(np.float32)).T
    return Kernel(folded)


def named(lang: Column) -> Column:
    """The language a label names, or null: trimmed, lower-cased, up to any ``-`` or ``_``."""
    code = F.regexp_extract(F.lower(F.regexp_replace(lang, r"^\s+|\s+$", "")), "^[^-_]*", 0)
    return F.when(code.isin(*CODES), code)


def train(documents: DataFrame, bounds: Bounds = Bounds()) -> Kernel | None:
    """A kernel fitted on lines of labelled documents, chosen by a hash of their ids; None without any.

    Only the chosen ids are sorted out on the driver; texts become lines in the tasks, so what comes back is bounded too.
    """
    labelled = documents.select("doc_id", named(F.col("lang")).alias("code"), "text").filter("code IS NOT NULL AND text IS NOT NULL")
    chosen = labelled.select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(bounds.documents)
    some = labelled.join(F.broadcast(chosen.distinct()), "doc_id", "left_semi").select("code", "text")

    def sampled(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            codes, lines = [], []
            for code, text in zip(pdf["code"], pdf["text"]):
                own = [p for p in lines_of([text]).strings() if (6 if code == "zh" else 20) <= len(p) <= bounds.longest_line]
                for p in own[:: -(-len(own) // bounds.lines_of_document) or 1]:
                    codes.append(code), lines.append(p)
            yield pd.DataFrame({"code": codes, "line": lines})

    pairs = some.mapInPandas(sampled, "code string, line string").distinct().toPandas().sort_values(["code", "line"], ignore_index=True)
    if pairs.empty:
        return None
    lines, kinds = pairs["line"].tolist(), pairs["code"].map(CODES.index).to_numpy()
    rng = np.random.default_rng(3)
    pick = np.sort(np.concatenate([rng.permutation(np.flatnonzero(kinds == k))[: bounds.lines_of_language] for k in range(len(CODES))]))
    return fit([lines[i] for i in pick], kinds[pick], bounds.landmarks)


LINE = "doc_id long, lang string, line_no int, line_lang string, confidence double, n_letters long"


def _assign(weights, documents: DataFrame) -> DataFrame:
    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, codes = Kernel(weights.value), np.array([*CODES, None], dtype=object)
        for pdf in pdfs:
            # texts are taken together up to a few batches' worth of characters
            ends = pdf["text"].str.len().cumsum().to_numpy(dtype=np.int64)
            at = 0
            while at < len(pdf):
                to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4 * BATCH_CHARS, "right")), at + 1)
                part = pdf.iloc[at:to]
                lines = lines_of(part["text"].tolist())
                size = lines.sizes()
                score = own.scores(lines.codes, lines.line, len(size))
                best = np.where(size > 0, score.argmax(1), -1) if len(size) else size
                soft = np.exp(SHARP * (score - score.max(1, keepdims=True, initial=-np.inf)))
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy()[lines.text], "lang": part["lang"].to_numpy()[lines.text], "line_no": lines.number.astype(np.int32),
                    "line_lang": codes[best], "confidence": np.where(size > 0, 1 / np.maximum(soft.sum(1), 1), np.nan), "n_letters": size,
                })
                at = to

    return documents.select("doc_id", "lang", "text").filter("text IS NOT NULL").mapInPandas(run, LINE)


def line_languages(documents: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Every line that is not blank: ``doc_id, lang, line_no, line_lang, confidence, n_letters``.

    ``line_lang`` and ``confidence`` are null where a line has no language: only numbers, barcodes, names with digits or marks.
    A null or empty text has no lines. ``doc_id`` need not be unique. Without a single labelled document nothing can
    be fitted, and no line has a language. Of equal scores the first code in alphabetical order is taken.
    """
    kernel = train(documents, bounds)
    if kernel is None:
        kernel = Kernel(np.zeros((len(CODES), PLACES), dtype=np.float32))
        blank = _assign(documents.sparkSession.sparkContext.broadcast(kernel.weights), documents)
        return blank.withColumn("line_lang", F.lit(None).cast("string")).withColumn("confidence", F.lit(None).cast("double"))
    return _assign(documents.sparkSession.sparkContext.broadcast(kernel.weights), documents)


def mislabelled_lines(documents: DataFrame) -> DataFrame:
    """``doc_id, line_no, line_lang`` of lines in another language than the label names, and of all lines where it names none."""
    lines = line_languages(documents)
    code = named(F.col("lang"))
    return lines.filter(F.col("line_lang").isNotNull() & (code.isNull() | (code != F.col("line_lang")))).select("doc_id", "line_no", "line_lang")


def segments(lines: DataFrame) -> DataFrame:
    """Runs of neighbouring lines of one language: ``doc_id, first_line, last_line, line_lang, confidence``; lines without one belong to no run."""
    spoken = lines.filter("line_lang IS NOT NULL")
    order = "OVER (PARTITION BY doc_id ORDER BY line_no)"
    turn = spoken.withColumn("new", F.expr(f"CASE WHEN lag(line_lang) {order} = line_lang THEN 0 ELSE 1 END"))
    runs = turn.withColumn("run", F.expr(f"sum(new) {order}"))
    sure = F.sum(F.col("confidence") * F.col("n_letters")) / F.sum("n_letters")
    return runs.groupBy("doc_id", "run", "line_lang").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), sure.alias("confidence")).drop("run")


def document_languages(lines: DataFrame) -> DataFrame:
    """``doc_id, doc_lang, confidence, share, n_languages``: the language of most letters, its mean confidence times its share."""
    spoken = lines.filter("line_lang IS NOT NULL")
    by = spoken.groupBy("doc_id", "line_lang").agg(F.sum("n_letters").alias("n"), F.sum(F.col("confidence") * F.col("n_letters")).alias("s"))
    best = by.groupBy("doc_id").agg(F.max_by(F.struct("line_lang", "n", "s"), F.struct("n", "line_lang")).alias("b"), F.sum("n").alias("whole"), F.count("*").alias("n_languages"))
    return best.select("doc_id", F.col("b.line_lang").alias("doc_lang"), (F.col("b.s") / F.col("whole")).alias("confidence"), (F.col("b.n") / F.col("whole")).alias("share"), "n_languages")
