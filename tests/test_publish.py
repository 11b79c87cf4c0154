import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rivulet.operators import publish as pb


def test_payload_without_source_is_an_error(spark):
    rows = spark.createDataFrame([("k", "tabla", "t", "c", None)], "k string, tipo string, titulo string, conclusion string, fuente string")
    payload = F.struct("tipo", "titulo", "conclusion", "fuente")
    with pytest.raises(PySparkException):
        pb.publish_results(rows, "eda", F.col("k"), payload).collect()
    assert pb.publish_results(rows.withColumn("fuente", F.lit("f")), "eda", F.col("k"), payload).count() == 1
    with pytest.raises(ValueError):
        pb.publish_results(rows, "otro", F.col("k"), payload)


def test_replace_version_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "p")
    schema = "id int, version string"
    pb.replace_version(spark.createDataFrame([(1, "v1"), (2, "v2")], schema), path, "version")
    pb.replace_version(spark.createDataFrame([(9, "v2")], schema), path, "version")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "v1"), (9, "v2")]


def test_upsert_and_ignore(spark):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], "k string, at int, v string")
    new = spark.createDataFrame([("a", 1, "new"), ("c", 1, "new")], "k string, at int, v string")
    assert {r.k: r.v for r in pb.upsert(old, new, ["k"], "at").collect()} == {"a": "new", "b": "old", "c": "new"}
    assert {r.k: r.v for r in pb.insert_ignore(old, new, ["k"]).collect()} == {"a": "old", "b": "old", "c": "new"}


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x,y")], "id int, t string")
    paths = pb.write_tables({"t": df}, str(tmp_path), "csv")
    assert spark.read.schema(df.schema).csv(paths["t"], header=True).collect() == df.collect()


def test_results_by_line_and_as_lists(spark, tmp_path):
    rows = spark.createDataFrame([("eda", "a", "v1", '{"n":[1,2],"titulo":"x"}'), ("eda", "b", "v1", None), ("ml", "c", "v2", '{"titulo":"é"}')], "modulo string, clave string, version string, payload string")
    pb.write_results(rows, str(tmp_path / "lines"))
    assert sorted(map(tuple, pb.read_results(spark, str(tmp_path / "lines")).collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    (tmp_path / "eda.json").write_text('[{"modulo": "eda", "clave": "a", "version": "v1",\n "payload": {"titulo": "x"}}, {"modulo": "eda", "clave": "b", "version": "v1", "payload": {}}]')
    back = pb.read_results(spark, str(tmp_path / "eda.json"), lists=True).orderBy("clave").collect()
    assert [(r["clave"], r["payload"].replace(" ", "")) for r in back] == [("a", '{"titulo":"x"}'), ("b", "{}")]
