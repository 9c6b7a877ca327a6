import gzip

import pytest
from pyspark.sql import functions as F

from beadloom.sources import beads as B
from beadloom.sources import fastq as Q
from beadloom.sources import matrices as X
from beadloom.sources import sinks as S


def fastq(path, seqs, name="r"):
    with gzip.open(path, "wt") as f:
        for k, s in enumerate(seqs):
            f.write(f"@{name}{k} 1:N:0\n{s}\n+\n{'I' * len(s)}\n")


def test_fastq_pairs_in_order(spark, tmp_path):
    fastq(tmp_path / "s1_GEX_S1_L001_R1_001.fastq.gz", ["AC", "GT", "CC"])
    fastq(tmp_path / "s1_GEX_S1_L001_R2_001.fastq.gz", ["TTTT", "GGGG", "AAAA"])
    fastq(tmp_path / "s2_SB_S1_L001_R1_001.fastq.gz", ["NN"])
    fastq(tmp_path / "s2_SB_S1_L001_R2_001.fastq.gz", [])
    reads = Q.read_fastq(spark, str(tmp_path))
    assert {tuple(r) for r in Q.by_order(reads).collect()} == {(0, 0, "AC", "TTTT"), (0, 1, "GT", "GGGG"), (0, 2, "CC", "AAAA")}
    assert [tuple(r) for r in Q.uneven_pairs(reads).collect()] == [(1, 1, 0)]
    one = Q.read_fastq(spark, str(tmp_path), "s1")
    assert one.count() == 6 and one.filter("read_id = 'r2' AND qual = 'IIII' AND plus = '+'").count() == 1


def test_fastq_faults(spark, tmp_path):
    fastq(tmp_path / "a_R1_x.fastq.gz", ["AC"])
    with pytest.raises(FileNotFoundError):
        Q.pair_files(str(tmp_path))
    with gzip.open(tmp_path / "a_R2_x.fastq.gz", "wt") as f:
        f.write("@r0\nAC\n+\n")
    with pytest.raises(Exception, match="cut off"):
        Q.read_fastq(spark, str(tmp_path)).collect()


def test_fastq_round_trip_by_label(spark, tmp_path):
    rows = [(k % 2 and "AB001" or "AB002", f"r{k}", "ACGT", "+", "IIII") for k in range(20)]
    Q.write_fastq(spark.createDataFrame(rows, "label string, read_id string, seq string, plus string, qual string"), str(tmp_path / "o"))
    text = spark.read.text(str(tmp_path / "o"))
    assert text.count() == 80 and text.filter("label = 'AB001' AND value LIKE '@r%'").count() == 10


def test_puck_files(spark, tmp_path):
    p = tmp_path / "puck.csv"
    p.write_text("ACGTACGTACGTAC,1.5,-2\nACGTACGTACGTAC,3,4\nAC,5,6\n")
    puck = B.read_puck(spark, str(p))
    assert tuple(B.puck_faults(puck).first()) == (3, 0, 1, 2)
    p.write_text("ACGTACGTACGTAC,x,4\n")
    with pytest.raises(Exception):
        B.read_puck(spark, str(p)).collect()


def test_bead_pair_and_back(spark, tmp_path):
    (tmp_path / "b").write_text("A,C,G\nT,T,T\n")
    (tmp_path / "l").write_text("1.0,2.5\n3.0,-4.0\n")
    got = B.read_bead_pair(spark, str(tmp_path / "b"), str(tmp_path / "l"))
    assert sorted(tuple(r) for r in got.collect()) == [(0, "ACG", 1.0, 3.0), (1, "TTT", 2.5, -4.0)]
    text = {r["part"]: r["text"] for r in B.split_puck(got).collect()}
    assert text == {"barcodes": "A,C,G\nT,T,T", "locations": "1.0,2.5\n3.0,-4.0"}


def test_whitelist_and_tab_file(spark, tmp_path):
    (tmp_path / "w").write_text("1, ACGT ,1,2\n2,CC,nan?,3\nshort,1\n")
    assert sorted((r["id"], r["sb"], r["x"], r["y"]) for r in B.read_whitelist(spark, str(tmp_path / "w")).collect()) == [("1", "ACGT", 1.0, 2.0), ("2", "CC", None, 3.0)]
    (tmp_path / "t").write_text("bc\tx\ty\nACGTACGTACGTAC\t1\t2\n")
    B.tab_to_puck(spark, str(tmp_path / "t"), str(tmp_path / "o"))
    assert tuple(B.read_puck(spark, str(tmp_path / "o")).first()) == ("ACGTACGTACGTAC", 1.0, 2.0)


def test_market_columns_and_names(spark, tmp_path):
    (tmp_path / "m.mtx").write_text("%%MatrixMarket\n% note\n2 2 3\n1 1 5\n2 1 7\n2 2 3\n")
    (tmp_path / "g").write_text("g1\tx\ng2\ty\n")
    (tmp_path / "c").write_text("c1\nc2\n")
    m = X.read_market(spark, str(tmp_path / "m.mtx"))
    named = X.named_matrix(m, X.read_names(spark, str(tmp_path / "g")), X.read_names(spark, str(tmp_path / "c")))
    assert {tuple(r) for r in named.collect()} == {("g1", "c1", 5), ("g2", "c1", 7), ("g2", "c2", 3)}
    assert {tuple(r) for r in X.transposed(m).collect()} == {(1, 1, 5), (1, 2, 7), (2, 2, 3)}
    ptr = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (3, 3)], "nth long, start long")
    idx = spark.createDataFrame([(0, 0, 5), (1, 1, 7), (2, 1, 3)], "at long, row long, value long")
    assert {tuple(r) for r in X.from_columns(ptr, idx).collect()} == {(0, 0, 5), (1, 0, 7), (1, 2, 3)}
    names = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, "a")], "nth long, name string")
    assert [r["name"] for r in X.unique_names(names).orderBy("nth").collect()] == ["a", "b", "a.1", "a.2"]
    S.write_market(m, str(tmp_path / "out"), 2, 2)
    assert X.read_market(spark, str(tmp_path / "out" / "1_body")).count() == 2  # its first line passes for the sizes
    assert spark.read.text(str(tmp_path / "out" / "0_head")).count() == 2


def test_pages_wide_rows_and_sheets(spark, tmp_path):
    (tmp_path / "p.html").write_text('<script>\nconst data = {"a": {"b": [1, 2]}};\n</script>')
    assert X.page_data(spark, str(tmp_path / "p.html"), "a struct<b array<int>>").first()["data"]["a"]["b"] == [1, 2]
    wide = spark.createDataFrame([("85.7%", 3)], "`Valid Barcodes` string, n int")
    assert {tuple(r) for r in X.wide_to_long(wide).collect()} == {("Valid Barcodes", "85.7%"), ("n", "3")}
    (tmp_path / "s").write_text("﻿a; AB001\n# no\n\nb;AB002,x\n")
    assert [r["f"] for r in X.sniffed_rows(spark, str(tmp_path / "s")).orderBy("nth").collect()] == [["a", "AB001"], ["b", "AB002,x"]]


def test_sinks(spark, tmp_path):
    m = spark.createDataFrame([(1, 2, 3, 4), (1, 1, 3, 5)], "cb_index long, umi_2bit long, sb_index long, reads long")
    S.write_matrix(m, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).agg(F.sum("reads")).first()[0] == 9
    S.write_csv(m, str(tmp_path / "c"), header=False, gzip=True)
    assert spark.read.csv(str(tmp_path / "c")).count() == 2
    j = S.metadata_json(spark.createDataFrame([("UP", "exact", 5), ("UP", "GG", 1), ("SB", "none", 2)], "section string, key string, value long")).first()["json"]
    assert "exact" in j and "SB" in j
