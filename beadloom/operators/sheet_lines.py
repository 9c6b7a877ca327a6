"""Sheet lines to typed rows, with the bad lines and their reasons kept apart.

The tokenizer is a finite-state machine over bytes, run for a whole Arrow batch at once. The bytes of
all lines lie in one array that is cut into chunks of equal length. Each chunk gives the state it would
end in for every state it might start in; these transition vectors are composed over all chunks by a
parallel prefix scan, which tells each chunk its real start state, and a second pass records the
state at every byte. Long lines and many short ones cost the same per byte.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: The sheet's columns in order.
SHEET_COLUMNS = (
    "Run", "Email", "Sample Name", "BCL", "Species", "Chemistry", "RNA Index", "Lane", "SB Index", "SB Lane", "Puck ID",
    "Merge RNA From BCL", "Merge Spatial From BCL", "Add RNA Index", "Add SB Index", "Add Puck ID", "Cellranger", "Flex Probe Barcode IDs",
)
FIELD_NAMES = [c.lower().replace(" ", "_") for c in SHEET_COLUMNS]
RNA, PUCK, MERGE = SHEET_COLUMNS.index("RNA Index"), SHEET_COLUMNS.index("Puck ID"), SHEET_COLUMNS.index("Merge RNA From BCL")

# states: at a field's start, in a bare field, in a quoted field, after a quote in one, broken
START, BARE, QUOTED, AFTER, BROKEN = range(5)
# byte classes: other, separator, quote, end of a line, padding
OTHER, SEP, QUOTE, END, PAD = range(5)
#: NEXT[class, state]
NEXT = np.array(
    [
        [BARE, BARE, QUOTED, BROKEN, BROKEN],
        [START, START, QUOTED, START, BROKEN],
        [QUOTED, BROKEN, AFTER, QUOTED, BROKEN],
        [START, START, START, START, START],
        [START, BARE, QUOTED, AFTER, BROKEN],
    ],
    dtype=np.uint8,
)
CHUNK = 256

_RNA = re.compile(r"SI-[A-Z]{2}-[A-H](?:[1-9]|1[0-2])")
_PUCK = re.compile(r"P[0-9]{5}")
_BCL = re.compile(r"([0-9]{4})([0-9]{2})([0-9]{2})_[A-Z0-9]+")


def chunk_vectors(classes: np.ndarray) -> np.ndarray:
    """``classes`` (chunks, length) → end state of each chunk for each start state, (chunks, 5)."""
    state = np.tile(np.arange(5, dtype=np.uint8), (len(classes), 1))
    for k in range(classes.shape[1]):
        state = NEXT[classes[:, k, None], state]
    return state


def compose(vectors: np.ndarray) -> np.ndarray:
    """Running composition of transition vectors: row i maps a start state before chunk 0 to the state after chunk i."""
    out, step = vectors.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], axis=1)
        step *= 2
    return out


def states_before(classes: np.ndarray, start: int = START) -> tuple[np.ndarray, np.ndarray]:
    """State before each byte and the transition vector of the whole run of bytes."""
    n = len(classes)
    wide = np.full(-(-max(n, 1) // CHUNK) * CHUNK, PAD, dtype=np.uint8)
    wide[:n] = classes
    wide = wide.reshape(-1, CHUNK)
    ends = compose(chunk_vectors(wide))
    state = np.concatenate([[start], ends[:-1, start]]).astype(np.uint8)
    before = np.empty_like(wide)
    for k in range(CHUNK):
        before[:, k] = state
        state = NEXT[wide[:, k], state]
    return before.reshape(-1)[:n], ends[-1]


def _unquote(raw: bytes) -> str:
    if raw[:1] == b'"':
        raw = raw[1:-1].replace(b'""', b'"')
    return raw.decode("utf-8", "replace")


def real_bcl(v: str) -> bool:
    m = _BCL.fullmatch(v)
    if not m:
        return False
    try:
        dt.date(*map(int, m.groups()))
    except ValueError:
        return False
    return True


def value_fault(fields: list[str]) -> str | None:
    """First of the value rules that a row of the right width breaks."""
    rna, puck, merge = fields[RNA].strip(), fields[PUCK].strip(), fields[MERGE].strip()
    if rna and not _RNA.fullmatch(rna):
        return "rna_index"
    if not _PUCK.fullmatch(puck):
        return "puck_id"
    if merge and not real_bcl(merge):
        return "merge_bcl"
    return None


def tokenize(lines: list[bytes], separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all lines, offset of each line, broken flag, position of the first fault, and positions of field ends.

    ``separators`` is the separator byte of each line. Line i ends at ``offsets[i + 1] - 1``, where a mark stands.
    """
    sizes = np.array([len(x) + 1 for x in lines], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"\n".join(lines) + b"\n", dtype=np.uint8)
    sep = np.repeat(separators, sizes)
    classes = np.where(data == 0x22, QUOTE, np.where(data == sep, SEP, OTHER)).astype(np.uint8)
    classes[offsets[1:] - 1] = END
    before, _ = states_before(classes)
    last = before[offsets[1:] - 1]
    broken = (last == BROKEN) | (last == QUOTED)
    turned = (before != BROKEN) & (NEXT[classes, before] == BROKEN)
    fault = np.full(len(lines), -1, dtype=np.int64)
    where = np.flatnonzero(turned)
    line_of = np.searchsorted(offsets, where, side="right") - 1
    fault[line_of[::-1]] = (where - offsets[line_of])[::-1]
    open_end = (last == QUOTED)
    fault[open_end] = sizes[open_end] - 1
    ends = np.flatnonzero(((classes == SEP) & (before != QUOTED) & (before != BROKEN)) | (classes == END))
    return data, offsets, broken, fault, ends


def _schema() -> str:
    return "raw_id long, reason string, fault_at long, " + ", ".join(f"{f} string" for f in FIELD_NAMES)


def parse_lines(raw: DataFrame, merge_width: int = len(SHEET_COLUMNS)) -> DataFrame:
    """Every line that is neither blank, comment nor header: ``raw_id, reason, fault_at`` and the 18 fields.

    ``reason`` is null for a good row, else the first of ``broken_quote``, ``column_count``, ``rna_index``,
    ``puck_id`` and ``merge_bcl``; then all fields are null. ``fault_at`` is the byte, from 0, where quoting breaks,
    and null for other reasons. The separator follows the file name: a tab for ``.tsv``, else a comma; a null
    file name counts as ``.csv``. A null line counts as blank. Other columns of ``raw`` are ignored.
    """
    names = FIELD_NAMES

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            ids, texts, seps = [], [], []
            for i, f, line in zip(pdf["raw_id"], pdf["file_name"], pdf["line"]):
                if line is None:
                    continue
                if line.endswith("\r"):
                    line = line[:-1]
                bare = line[1:] if line.startswith("﻿") else line
                sep = "\t" if (f or "").lower().endswith(".tsv") else ","
                if not bare.strip(" \r\n") or line.startswith("#"):
                    continue
                if bare.split(sep, 2)[:2] in (["Run", "Email"], ['"Run"', '"Email"']):
                    continue
                ids.append(i), texts.append(line.encode()), seps.append(ord(sep))
            if not ids:
                continue
            data, offsets, broken, fault, ends = tokenize(texts, np.array(seps, dtype=np.uint8))
            buf = data.tobytes()
            firsts = np.searchsorted(ends, offsets[:-1])
            counts = np.diff(np.append(firsts, len(ends)))
            reasons, rows = [], []
            for k in range(len(ids)):
                row: list[str] | None = None
                if broken[k]:
                    why = "broken_quote"
                elif counts[k] != merge_width:
                    why = "column_count"
                else:
                    stops = ends[firsts[k] : firsts[k] + merge_width].tolist()
                    starts = [int(offsets[k]), *(e + 1 for e in stops[:-1])]
                    row = [_unquote(buf[a:b]) for a, b in zip(starts, stops)]
                    why = value_fault(row)
                reasons.append(why)
                rows.append(row if why is None else [None] * merge_width)
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "fault_at", pd.array([f if b else None for f, b in zip(fault.tolist(), broken)], dtype="Int64"))
            out.insert(0, "reason", reasons)
            out.insert(0, "raw_id", ids)
            yield out

    return raw.select("raw_id", "file_name", "line").mapInPandas(run, _schema())


def bad_lines(raw: DataFrame) -> DataFrame:
    """``raw_id, reason`` of every bad line."""
    return parse_lines(raw).filter("reason IS NOT NULL").select("raw_id", "reason")


def good_rows(raw: DataFrame) -> DataFrame:
    """``raw_id`` and the 18 fields of every good line."""
    return parse_lines(raw).filter("reason IS NULL").drop("reason", "fault_at")
