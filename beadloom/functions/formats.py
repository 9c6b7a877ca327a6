"""Text forms of numbers, labels and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(v: str | Column) -> Column:
    return F.format_number(F.col(v) if isinstance(v, str) else v, 0)


def percent_text(share: Column, places: int = 2) -> Column:
    return F.format_string(f"%.{places}f%%", share * 100)


def parse_percent(text: Column) -> Column:
    """``"85.7%"`` to 85.7; null if it is no number."""
    return F.regexp_replace(F.trim(text), "%$", "").try_cast("double")


def parse_count(text: Column) -> Column:
    """``"1,234"`` to 1234."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("long")


def ratio_or_zero(a: Column, b: Column, scale: float = 100.0) -> Column:
    """``scale * a / b``, and 0 where there is nothing to divide by."""
    return F.when(F.coalesce(b, F.lit(0)) == 0, 0.0).otherwise(a.cast("double") * scale / b)


def metric_label(name: Column) -> Column:
    """Underscores to blanks, ``Pct`` to a percent sign and the word after it with a capital."""
    spaced = F.regexp_replace(name, "_", " ")
    marked = F.regexp_replace(spaced, "^Pct", "%")
    return F.when(marked.startswith("% "), F.concat(F.lit("% "), F.upper(F.substring(marked, 3, 1)), F.substring(marked, 4, 1000))).otherwise(marked)


def stripped(text: Column) -> Column:
    """Without white space at both ends, tabs and line breaks included."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def lane_tokens(cell: Column) -> Column:
    """``1,2`` to ``[L001, L002]``; blank, ``*`` or anything else but numbers means all lanes, an empty array."""
    each = F.transform(F.split(cell, ","), lambda x: stripped(x))
    fine = F.forall(each, lambda x: x.rlike("^[+-]?[0-9]+$"))
    made = F.transform(each, lambda x: F.concat(F.lit("L"), F.lpad(x.cast("int").cast("string"), 3, "0")))
    return F.when(cell.isNotNull() & fine, made).otherwise(F.array().cast("array<string>"))


def probe_ids(cell: Column) -> Column:
    """Parts between commas and pipes, trimmed, empty ones left out."""
    return F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), "[,|]"), lambda x: stripped(x)), lambda x: x != "")


def run_date(run: Column) -> Column:
    """The date a run's name starts with, else null."""
    return F.try_to_timestamp(F.regexp_extract(run, "^([0-9]{8})_", 1), F.lit("yyyyMMdd")).cast("date")


def cleaned(cell: Column) -> Column:
    """Trimmed; null and blank alike are the empty string."""
    return F.coalesce(stripped(cell), F.lit(""))
