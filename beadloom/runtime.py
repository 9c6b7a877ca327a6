"""Session settings, table access and lineage cutting shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName("beadloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables, read lazily."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the session names; a folder of this process, removed at its end, only where master and workers are one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="beadloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    return own


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. A cluster that names none is an error, as files of one
    machine would be lost with it; a local session, as in tests, gets a temporary one. Files of frames that are no longer in use are removed
    where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on, as it is in ``local_session``.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(_checkpoint_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all of the session's shuffle partitions if it has fewer, for narrow rows that much is computed from; else as it is."""
    n = parts(df.sparkSession)
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def beside(one: DataFrame, other: DataFrame) -> DataFrame:
    """Columns of ``other``, which has a single row, added to every row of ``one``: a scalar subquery, not a join."""
    told = other.select(F.struct(*other.columns).alias("told")).scalar()
    return one.withColumn("told", told).select(*(F.col(c) for c in one.columns), *(F.col(f"told.{c}").alias(c) for c in other.columns))


def parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
