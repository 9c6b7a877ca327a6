"""Paired gzipped FASTQ files as a Spark data source, and files chosen and paired by name."""

from __future__ import annotations

import glob
import gzip
import itertools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_BATCH = 20_000
SCHEMA = "pair_id int, mate int, ord long, read_id string, seq string, plus string, qual string"
_FIELDS = pa.schema([("pair_id", pa.int32()), ("mate", pa.int32()), ("ord", pa.int64()), ("read_id", pa.string()), ("seq", pa.string()), ("plus", pa.string()), ("qual", pa.string())])


class _File(InputPartition):
    def __init__(self, pair_id: int, mate: int, path: str):
        self.pair_id, self.mate, self.path = pair_id, mate, path


def pair_files(folder: str, sample: str = "") -> list[tuple[str, str]]:
    """Files of read 1 and read 2 of a folder whose names hold ``sample``; every read 1 must have its read 2."""
    ones = sorted(p for p in glob.glob(os.path.join(folder, "*")) if "_R1_" in os.path.basename(p) and sample in os.path.basename(p) and re.search(r"\.(fastq|fq)(\.gz)?$", p))
    pairs = [(p, os.path.join(folder, os.path.basename(p).replace("_R1_", "_R2_"))) for p in ones]
    lost = [b for _, b in pairs if not os.path.exists(b)]
    if lost:
        raise FileNotFoundError(f"no read 2 for {len(lost)} files, the first {lost[0]}")
    return pairs


class FastqReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.pairs = pair_files(options["path"], options.get("sample", ""))

    def partitions(self) -> list[InputPartition]:
        """A gzipped file cannot be split, so a task reads one."""
        return [_File(k, m, p) for k, both in enumerate(self.pairs) for m, p in enumerate(both, 1)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        opened = gzip.open if partition.path.endswith(".gz") else open
        with opened(partition.path, "rt") as lines:
            at = 0
            while block := list(itertools.islice(lines, 4 * _BATCH)):
                if len(block) % 4:
                    raise ValueError(f"{partition.path}: the last record is cut off")
                rows = [x.rstrip("\n") for x in block]
                n = len(rows) // 4
                ids = [x[1:].split(" ", 1)[0] for x in rows[0::4]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.pair_id] * n, pa.int32()), pa.array([partition.mate] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), pa.array(ids), pa.array(rows[1::4]), pa.array(rows[2::4]), pa.array(rows[3::4])],
                    schema=_FIELDS,
                )
                at += n


class Fastq(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)


def read_fastq(spark: SparkSession, folder: str, sample: str = "") -> DataFrame:
    """All reads of a folder, both mates: ``pair_id, mate, ord, read_id, seq, plus, qual``; an empty file has no reads."""
    spark.dataSource.register(Fastq)
    return spark.read.format("fastq").option("sample", sample).load(folder)


def by_order(reads: DataFrame) -> DataFrame:
    """``pair_id, ord, r1, r2``: mates put together by their place in the files."""
    one = reads.filter("mate = 1").select("pair_id", "ord", F.col("seq").alias("r1"))
    return one.join(reads.filter("mate = 2").select("pair_id", "ord", F.col("seq").alias("r2")), ["pair_id", "ord"])


def uneven_pairs(reads: DataFrame) -> DataFrame:
    """Pairs of files with different numbers of reads; empty if all is well."""
    return reads.groupBy("pair_id").agg(F.count_if(F.col("mate") == 1).alias("n_1"), F.count_if(F.col("mate") == 2).alias("n_2")).filter("n_1 <> n_2")


def write_fastq(reads: DataFrame, folder: str) -> None:
    """Four-line records, one folder per label, gzipped; ``reads``: ``label, read_id, seq, plus, qual``."""
    reads.select("label", F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", "plus", "qual").alias("value")).write.mode("overwrite").partitionBy("label").option("compression", "gzip").text(folder)
