from beadloom.operators import molecules as M
from beadloom.runtime import table
from beadloom.streaming import counts as C


def test_stream_equals_batch(spark, small, tmp_path):
    m = table(spark, small, "molecules")
    m.repartition(5).write.parquet(str(tmp_path / "in"))
    schema = ", ".join(f"{c} {t}" for c, t in m.dtypes)
    q = C.start(C.running_counts(C.molecule_stream(spark, str(tmp_path / "in"), schema, 1)), "running", str(tmp_path / "cp"))
    q.awaitTermination()
    got = spark.table("running")
    want = M.matrix(m).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_days_with_a_watermark(spark, small, tmp_path):
    m = table(spark, small, "molecules").filter("loaded_at IS NOT NULL")
    m.repartition(3).write.parquet(str(tmp_path / "in"))
    schema = ", ".join(f"{c} {t}" for c, t in m.dtypes)
    q = C.start(C.daily_counts(C.molecule_stream(spark, str(tmp_path / "in"), schema, 10)), "days", str(tmp_path / "cp"))
    q.awaitTermination()
    assert spark.table("days").agg({"n": "sum"}).first()[0] == m.count()
