import csv
import random

import numpy as np

from beadloom.operators import sheet_lines as L

RAW = "raw_id long, file_name string, line_no int, line string"


def good(sep=",", **change):
    f = ["YES", "a@b.c", "s1", "20230101_RUNA", "Human", "Flex", "SI-TT-A1", "1", "SI-TT-B2", "*", "P00001", "", "", "", "", "", "", ""]
    for k, v in change.items():
        f[int(k[1:])] = v
    return sep.join(f)


def reasons(spark, lines, name="a.csv"):
    df = spark.createDataFrame([(k, name, k, x) for k, x in enumerate(lines)], RAW)
    return {r["raw_id"]: r["reason"] for r in L.bad_lines(df).collect()}


def test_reasons_in_their_order(spark):
    lines = [good(), good() + "\r", good() + ",x", good(_0='Y"S'), good(_0='"YES'), good(_6="SI-TT-A13"), good(_6="SI-TT-A01"), good(_6=" "), good(_10="P0001"), good(_10=" P00001 "),
             good(_11="20230229_RUNA"), good(_11="20240229_RUNA"), good(_11="20230101_"), good(_6="x", _10="y"), '"' + good(), good(_2='"a ""q"" b"'), good(_2='"a"b'), good(_2='"two\nlines, and more"')]
    assert reasons(spark, lines) == {2: "column_count", 3: "broken_quote", 4: "broken_quote", 5: "rna_index", 6: "rna_index", 8: "puck_id", 10: "merge_bcl", 12: "merge_bcl", 13: "rna_index", 14: "broken_quote", 16: "broken_quote"}


def test_lines_that_are_neither(spark):
    lines = ["", "  ", "\r", "# note", "﻿" + ",".join(L.SHEET_COLUMNS), ",".join(L.SHEET_COLUMNS), None]
    df = spark.createDataFrame([(k, "a.csv", k, x) for k, x in enumerate(lines)], RAW)
    assert L.parse_lines(df).count() == 0


def test_tabs_null_file_names_repeats_empty_and_clashing_columns(spark):
    assert reasons(spark, [good("\t"), good("\t", _2="a,b"), good()], "x.TSV") == {2: "column_count"}
    df = spark.createDataFrame([(1, None, 1, good(), "r", "z"), (1, None, 1, good(), "r", "z")], RAW + ", reason string, run string")
    assert [r["run"] for r in L.good_rows(df).collect()] == ["YES", "YES"]
    assert L.bad_lines(spark.createDataFrame([], RAW)).count() == 0


def test_fields_against_the_csv_module(spark):
    rng = random.Random(2)
    rows = []
    for k in range(300):
        f = good().split(",")
        f[2] = "".join(rng.choice('ab",\n é') for _ in range(rng.randrange(0, 900)))
        rows.append(f)
    lines = [",".join('"' + v.replace('"', '""') + '"' for v in f) for f in rows]
    df = spark.createDataFrame([(k, "a.csv", k, x) for k, x in enumerate(lines)], RAW)
    got = {r["raw_id"]: r["sample_name"] for r in L.good_rows(df).collect()}
    assert got == {k: f[2] for k, f in enumerate(rows)}
    assert [next(csv.reader([x.replace("\n", "\\n")])) [2].replace("\\n", "\n") for x in lines] == [f[2] for f in rows]


def test_composition_equals_one_long_run():
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 5000):
        classes = rng.integers(0, 4, n).astype(np.uint8)
        state, want = L.START, []
        for c in classes:
            want.append(state)
            state = L.NEXT[c, state]
        before, whole = L.states_before(classes)
        assert before.tolist() == want and whole[L.START] == state


def test_long_line_and_fault_offset(spark):
    line = good(_2="x" * 200_000 + '"')
    r = L.parse_lines(spark.createDataFrame([(1, "a.csv", 1, line)], RAW)).first()
    assert r["reason"] == "broken_quote" and r["fault_at"] == line.index('"')
