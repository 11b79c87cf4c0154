"""Readers of folders with broken input, and the stored table."""

import os
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators import publish as pb
from rivulet.sources import readers, stored

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("amount", T.DecimalType(10, 2)), T.StructField("note", T.StringType())])


def test_broken_lines_are_set_aside_with_file_and_reason(spark, tmp_path):
    folder = tmp_path / "bills.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('id,day,amount,note\n1,2024-01-02,3.50,"x, y"\n2,2024-13-02,1.00,z\n3,2024-01-04,,\n')
    (folder / "b.csv").write_text("id,day,amount,note\nfour,2024-01-02,abc,n\n5,2024-01-02\n6,2024-01-02,7.00,n,more\n7,2024-01-09,8.25,é\n")
    tables, rejected = readers.read_csv_tables(spark, str(tmp_path), {"bills": SCHEMA})
    assert sorted((r["id"], str(r["day"]), None if r["amount"] is None else float(r["amount"]), r["note"]) for r in tables["bills"].collect()) == [
        (1, "2024-01-02", 3.5, "x, y"), (3, "2024-01-04", None, None), (7, "2024-01-09", 8.25, "é")]
    got = sorted((r["table_name"], os.path.basename(r["file"]), r["line"], r["reason"]) for r in rejected.collect())
    assert got == [("bills", "a.csv", "2,2024-13-02,1.00,z", "no value of its type: day"), ("bills", "b.csv", "5,2024-01-02", "wrong number of fields"),
                   ("bills", "b.csv", "6,2024-01-02,7.00,n,more", "wrong number of fields"), ("bills", "b.csv", "four,2024-01-02,abc,n", "no value of its type: id, amount")]


def test_a_header_of_other_columns_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,amount,day,note\n1,2.00,2024-01-02,x\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        readers.read_csv(spark, str(tmp_path / "t.csv"), SCHEMA).rows.collect()


def test_folder_of_documents(spark, tmp_path):
    (tmp_path / "good.md").write_text("titulo: A: b\ntipo: faq\nfuente: me\nurl: http://x\n---\n body\n---\nmore ")
    (tmp_path / "crlf.md").write_bytes("titulo: T\r\ntipo: norma\r\nfuente: f\n---\nñ".encode())
    (tmp_path / "headerless.md").write_text("only text")
    (tmp_path / "kind.md").write_text("titulo: A\ntipo: poem\nfuente: me\n---\nx")
    (tmp_path / "empty.md").write_text("")
    (tmp_path / "other.txt").write_text("titulo: A\ntipo: faq\nfuente: me\n---\nx")
    rows = {r["file"]: r for r in readers.read_document_folder(spark, str(tmp_path)).collect()}
    assert set(rows) == {"good.md", "crlf.md", "headerless.md", "kind.md"}
    good = rows["good.md"]
    assert (good["title"], good["kind"], good["source"], good["url"], good["body"], good["problem"]) == ("A: b", "faq", "me", "http://x", "body\n---\nmore", None)
    assert rows["crlf.md"]["problem"] is None and rows["crlf.md"]["body"] == "ñ"
    assert rows["headerless.md"]["problem"] == "missing fuente, tipo, titulo" and rows["kind.md"]["problem"] == "unknown kind"


def files_of(path):
    return {str(p) for p in Path(path).rglob("*.parquet")}


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(200).select(F.col("id").cast("string").alias("k"), (F.col("id") % 4).alias("v"), F.lit(1).alias("at"), F.lit("old").alias("t"))
    return stored.StoredTable.create(rows, f"{tmp_path}/t", ["k"], buckets=8), f"{tmp_path}/t"


def test_only_touched_buckets_are_written(spark, table):
    t, path = table
    before = files_of(path)
    old = t.read().collect()
    new = spark.createDataFrame([("3", 9, 2, "new"), ("3", 9, 1, "older"), ("x", 9, 1, "new")], "k string, v bigint, at int, t string")
    want = sorted(pb.upsert(t.read(), new, ["k"], "at").collect())
    touched = t.upsert(new, "at")
    added = files_of(path) - before
    assert 1 <= len(touched) <= 2 and {int(f.split("_bucket=")[1].split("/")[0]) for f in added} == set(touched) and before <= files_of(path)
    assert sorted(t.read().collect()) == want and len(want) == 201 and ("3", 9, 2, "new") in map(tuple, want)
    assert sorted(t.read(1).collect()) == sorted(old) and t.versions() == [1, 2]
    assert t.upsert(new.limit(0), "at") == [] and t.versions() == [1, 2]


def test_new_keys_are_added_without_rewriting(spark, table):
    t, path = table
    before = t.manifest()["folders"]
    new = spark.createDataFrame([("3", 9, 2, "new"), ("y", 2, 1, "b"), ("y", 1, 1, "a")], "k string, v bigint, at int, t string")
    touched = t.insert_ignore(new)
    assert len(touched) == 1 and t.read().where("k IN ('3', 'y')").orderBy("k").collect() == [("3", 3, 1, "old"), ("y", 1, 1, "a")]
    after = t.manifest()["folders"]
    assert {b for b in after if after[b] != before.get(b)} == {str(touched[0])} and after[str(touched[0])][:1] == before[str(touched[0])]
    assert t.insert_ignore(new) == [] and t.versions() == [1, 2]


def test_a_version_is_replaced(spark, table):
    t, _ = table
    new = spark.createDataFrame([("3", 3, 5, "new"), ("z", 3, 5, "new")], "k string, v bigint, at int, t string")
    t.replace_version(new, "v")
    assert {r["v"]: r["n"] for r in t.read().groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()} == {0: 50, 1: 50, 2: 50, 3: 2}
    t.replace_version(t.read().where("v = 3").withColumn("t", F.lit("again")), "v")
    assert sorted(r["t"] for r in t.read().where("v = 3").collect()) == ["again", "again"]


def test_a_failed_write_leaves_the_old_version(spark, table):
    t, path = table
    broken = spark.createDataFrame([("3", 9, 2, "new")], "k string, v bigint, at int, t string").withColumn(
        "t", F.when(F.col("v") == 9, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("t")))
    with pytest.raises(PySparkException):
        t.upsert(broken, "at")
    assert stored.StoredTable(spark, path).versions() == [1] and t.read().count() == 200


def test_a_second_change_of_one_version_is_refused(spark, table, monkeypatch):
    t, path = table
    head = t.manifest()
    new = spark.createDataFrame([("3", 9, 2, "new")], "k string, v bigint, at int, t string")
    t.upsert(new, "at")
    monkeypatch.setattr(t, "manifest", lambda version=None: head)  # it began before the other ended
    with pytest.raises(RuntimeError, match="another change"):
        t.upsert(new.withColumn("t", F.lit("late")), "at")
    assert stored.StoredTable(spark, path).read().where("k = '3'").first()["t"] == "new"


def test_refusals(spark, table):
    _, path = table
    with pytest.raises(ValueError):
        stored.StoredTable.create(spark.range(3), path, ["id"])
    with pytest.raises(ValueError):
        stored.StoredTable.create(spark.range(3).withColumn("_bucket", F.lit(1)), f"{path}2", ["id"])
    empty = stored.StoredTable.create(spark.range(0), f"{path}3", ["id"])
    assert empty.read().count() == 0 and empty.insert_ignore(spark.range(5)) != [] and empty.read().count() == 5
