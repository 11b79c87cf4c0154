"""Average precision of many groups at once."""

import pytest
from pyspark.sql import functions as F

from rivulet.operators import metrics as mt


def test_many_groups_have_the_average_precision_of_each_without_a_window(spark, monkeypatch):
    rows = [(i * 37 % 101 % (3 + g * 20) / 10, (i * 7 + g) % 5 % 2, g) for i in range(300) for g in range(4)] + [(None, 1, 0), (0.3, None, 1), (5.0, 0, 6)]
    df = spark.createDataFrame(rows, "p double, y int, g int").repartition(3)
    want = {r.g: r.average_precision for r in mt.ranking_metrics(df.where("g < 6"), "y", "p", ["g"]).collect()}
    for most, edges in ((4_000_000, []), (50, [0.2, 0.9, 3.0]), (50, mt.score_ranges(df, "p", 7))):
        monkeypatch.setattr(mt, "SORTED_ROWS", most)
        out = mt.average_precisions(df, "y", "p", "g", 7, edges)
        assert {r.g: r.average_precision for r in out.collect()} == pytest.approx(want)
        assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_importance_ranks_no_variant_by_shuffled_rows(spark, monkeypatch):
    from rivulet.operators import models as ml

    ranked = []
    plain = mt.ranking_metrics
    monkeypatch.setattr(mt, "ranking_metrics", lambda df, y, p, groups=(): ranked.append(groups) or plain(df, y, p, groups))
    df = spark.range(200).select(F.col("id").alias("bill_id"), (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 3).cast("double").alias("a"), F.lit(1.0).alias("b"))
    out = {r.column: (r.importance, r.spread) for r in ml.permutation_importance(df, lambda rows, p: rows.withColumn(p, 2 - F.col("a")), ["a", "b"], repeats=2).collect()}
    assert ranked == [()] and out["a"][0] > 0.3 and out["b"] == pytest.approx((0, 0))
