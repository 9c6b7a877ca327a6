"""Rows of Spark against rows of DuckDB, whatever their order."""

import math


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v


def rows_of(df):
    cols = sorted(df.columns)
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr), cols


def check(df, relation):
    got, cols = rows_of(df)
    names = relation.columns
    assert cols == sorted(names)
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(norm(r[i]) for i in at) for r in relation.fetchall()), key=repr)
