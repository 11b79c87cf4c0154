import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rivulet.operators import aggregates as ag
from rivulet.operators import cleaning as cl
from rivulet.operators import joins as jn
from rivulet.operators import tariff as tf


@pytest.fixture(scope="module")
def table(spark):
    rows = [("2026-T3", t, m, Decimal(str(base)) + m) for t, base in (("domestico_medio", 228.08), ("comercial", 300.0)) for m in range(60)]
    return spark.createDataFrame(rows, "quarter string, tariff string, m3 int, amount decimal(12,2)")


def priced(spark, table, tariff, m3, sewer=False, treatment=False):
    bills = spark.createDataFrame([("2026-07", tariff, float(m3), sewer, treatment)], "period string, tariff string, m3 double, sewer boolean, treatment boolean")
    return tf.recompute_bills(bills, table, period="period", tariff="tariff", m3="m3", sewer="sewer", treatment="treatment").first()


def test_half_up(spark):
    rows = spark.createDataFrame([(5.5,), (5.4,), (2.5,), (None,)], "x double").select(tf.round_half_up_int(F.col("x")).alias("n")).collect()
    assert [r.n for r in rows] == [6, 5, 3, 0]


def test_quarter(spark):
    rows = spark.createDataFrame([("2024-04",), ("2026-07",)], "p string").select(tf.tariff_quarter(F.col("p")).alias("q")).collect()
    assert [r.q for r in rows] == ["2026-T2", "2026-T3"]


def test_domestic_has_no_vat(spark, table):
    r = priced(spark, table, "domestico_medio", 0, True, True)
    assert (r.water, r.vat, r.subtotal, r.total) == (Decimal("228.08"), Decimal("0.00"), Decimal("278.26"), Decimal("278.26"))


def test_business_pays_vat(spark, table):
    r = priced(spark, table, "comercial", 20)
    assert r.subtotal == Decimal("320.00") and r.vat == Decimal("51.20") and r.total == Decimal("371.20")


def test_above_the_table_uses_the_last_row(spark, table):
    assert priced(spark, table, "comercial", 500).water == Decimal("359.00")


@pytest.mark.parametrize("tariff, m3", [("unknown", 1), ("comercial", -1)])
def test_bad_bill_is_an_error(spark, table, tariff, m3):
    with pytest.raises(PySparkException):
        priced(spark, table, tariff, m3)


def test_censoring(spark):
    d = dt.date
    rows = spark.createDataFrame(
        [(1, None, d(2026, 10, 1), False, None), (2, None, d(2026, 8, 1), False, None), (3, False, d(2026, 8, 1), True, None)],
        "id int, late boolean, due date, paid boolean, paid_on date")
    out = {r.id: r for r in cl.censor_labels(rows, "2026-09-01").collect()}
    assert out[1].late is None and not out[1].trainable
    assert out[2].late is True and out[2].overdue_unpaid
    assert out[3].late is False and out[3].paid_without_date


def test_days_late_stays_null_while_unpaid(spark):
    d = dt.date
    rows = spark.createDataFrame([(1, "2026-01", d(2020, 1, 1), d(2026, 2, 1), None), (2, "2026-01", d(2020, 1, 1), d(2026, 2, 1), d(2026, 1, 20))],
                                 "id int, period string, since date, due date, paid_on date")
    assert [r.days_late for r in cl.calendar_features(rows).orderBy("id").collect()] == [None, 0]


def test_unknown_mapping_is_an_error(spark):
    rows = spark.createDataFrame([("domestico",), ("otro",)], "t string")
    with pytest.raises(PySparkException):
        cl.map_values(rows, "t", tf.TARIFF_OF_CUSTOMER, "u").collect()


def test_join_promises_are_checked(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "k int, l string")
    right = spark.createDataFrame([(1, "x")], "k int, r string")
    assert jn.join_many_to_one(left, right, ["k"]).count() == 2
    with pytest.raises(PySparkException):
        jn.join_one_to_one(left, right, ["k"]).collect()
    with pytest.raises(PySparkException):
        jn.join_many_to_one(right, left, ["k"]).collect()


def test_unique_side_keeps_nulls(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    assert sorted(map(tuple, jn.unique_side(rows, ["k"]).collect())) == [(1, None), (2, "x")]


def test_text_with_two_classes_is_an_error(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y")], "t string, c string")
    with pytest.raises(PySparkException):
        ag.unique_texts(rows, "t", "c").collect()


def test_text_with_two_classes_takes_the_first_if_asked(spark):
    rows = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), ("b", None), (None, "z")], "t string, c string")
    got = {tuple(r) for r in ag.unique_texts(rows, "t", "c", one_category=False).collect()}
    assert got == {("a", "x", 3), ("b", None, 1), (None, "z", 1)}


def test_text_without_a_class_is_no_error(spark):
    rows = spark.createDataFrame([("a", None), ("b", "x")], "t string, c string")
    assert {tuple(r) for r in ag.unique_texts(rows, "t", "c").collect()} == {("a", None, 1), ("b", "x", 1)}


def test_unique_texts_query_follows_its_sql(spark, tmp_path):
    from rivulet.plans import QUERIES

    spark.createDataFrame([("a", "y"), ("a", "x")], "text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r)[1:] for r in QUERIES["unique_texts"](spark, str(tmp_path)).collect()] == [("x", 2)]


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="category"):
        cl.load_complaints(spark.createDataFrame([("a",)], "text string"), "text", "category")


def test_hidden_columns_go(spark):
    rows = spark.createDataFrame([(1, 2.0, 3.0)], "id int, consumo_base double, propension_mora double")
    assert cl.drop_hidden(rows).columns == ["id"]


def test_hot_keys_are_split_by_their_rows(spark):
    big = spark.range(1000).selectExpr("CASE WHEN id < 700 THEN 'hot' ELSE concat('k', id % 30) END AS k", "id")
    counts = big.groupBy("k").count()
    hot = jn.hot_keys(counts, "k", "count", rows_per_task=100)
    assert [tuple(r) for r in hot.collect()] == [("hot", 7)]
    lookup = counts.selectExpr("k", "length(k) AS size")
    joined = jn.salted_join(big, lookup, "k", hot, F.col("id"))
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, big.join(lookup, "k").collect()))
