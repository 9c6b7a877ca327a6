import hashlib

import pytest
from pyspark.sql import functions as F

from beadloom.operators import profile_inputs as I


@pytest.mark.parametrize("n", [0, 1, 7, 500, 1999, 2000, 9999])
def test_samples_have_the_size_asked_for(spark, n):
    rows = spark.createDataFrame([(k,) for k in range(2000)], "k long").repartition(5)
    got = [r["k"] for r in I.smallest_by_hash(rows, F.col("k").cast("string"), F.lit(n)).collect()]
    assert sorted(got) == sorted(sorted(range(2000), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())[:n])


def test_sorted_numbers_have_no_gaps(spark):
    rows = spark.createDataFrame([(f"b{k * 37 % 500:03d}",) for k in range(1500)], "b string").repartition(7)
    assert sorted((r["b"], r["nth"]) for r in I.sorted_index(rows, "b").collect()) == [(f"b{k:03d}", k + 1) for k in range(500)]
    assert I.sorted_index(rows.limit(0), "b").count() == 0


def test_lists_and_clean_up(spark):
    lines = ["ACGT-1", "ACGT 1", " ACGT\tx", "ACGT", None, ""]
    got = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, line string").select("k", I.listed_barcode("line").alias("b")).orderBy("k").collect()
    assert [r["b"] for r in got] == ["ACGT", "ACGT", "ACGT", None, None, None]
    barcode, fault = I.clean_barcode("line")
    rows = spark.createDataFrame([("A" * 16 + "-1",), ("A" * 15,), ("A" * 15 + "-1",), ("A" * 15 + "1-",)], "line string").select(barcode.alias("b"), fault.alias("f")).collect()
    assert [tuple(r) for r in rows] == [("A" * 16 + "-1", None), (None, "short"), (None, "hyphen"), (None, "digit")]


def test_translation_leaves_out_lines_of_other_width(spark):
    lines = spark.createDataFrame([("A\tT",), ("C",), ("G\tC\tA",), ("A\tU",)], "line string")
    cells = spark.createDataFrame([("A",), ("C",), ("A",)], "barcode string")
    assert sorted(r["translated"] for r in I.translated(cells, I.translation(lines)).collect()) == ["C_UNMAPPED", "U", "U"]


def test_summary_names_and_percents(spark):
    row = {c: 0.5 for c in I.SUMMARY_NAMES} | {"GEX.Sequenced.read.pairs": 1000.0, "GEX.Percent.duplicates": 0.25}
    got = I.standard_summary(spark.createDataFrame([tuple(row.values())], ", ".join(f"`{c}` double" for c in row))).first()
    assert list(got.asDict()) == list(I.SUMMARY_NAMES.values()) and len(got) == 19
    assert (got["Sequencing Saturation"], got["Valid Barcodes"], got["Number of Reads"]) == ("25.0%", "50.0%", 1000.0)
    assert sum(isinstance(v, str) for v in got) == 13


def test_sheets_are_written_in_order(spark, tmp_path):
    rows = spark.createDataFrame([("r1", "1", "b"), ("r1", "2", "a"), ("r2", None, "c")], "run string, lane string, sample string")
    I.write_sheets(I.sheet_sections(rows, {"V": "2"}, "run", ["lane", "sample"]), "run", str(tmp_path / "s"))
    text = lambda r: "".join(p.read_text() for p in sorted((tmp_path / "s" / f"run={r}").glob("part*")))
    assert text("r1") == "[Header]\nV,2\n[Data]\nlane,sample\n1,b\n2,a\n" and text("r2").endswith("sample\n,c\n")


def test_folders_collide_and_miss(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "library string")
    libs = spark.createDataFrame([("a", "f1"), ("a", "f2"), ("b", "f1"), ("b", "f1")], "library string, folder string")
    assert {tuple(r) for r in I.folders(files, libs).collect()} == {("a", "f1", True), ("b", "f1", False), ("c", None, False)}
