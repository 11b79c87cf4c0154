"""Exact ranks and quantiles, also when one key or one value holds a third of all rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.operators import aggregates as ag
from rivulet.operators import metrics as mt
from rivulet.operators import ranks as rk
from rivulet.operators import stats as st
from rivulet.operators.evaluation import latency_percentiles


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    key = np.where(rng.random(6000) < 0.35, "hot", rng.integers(0, 20, 6000).astype(str))
    value = np.where(rng.random(6000) < 0.33, 7.0, np.round(rng.normal(10, 5, 6000), 3))
    return spark.createDataFrame(pd.DataFrame({"k": key, "x": value})), pd.DataFrame({"k": key, "x": value})


def test_quantiles_match_numpy(skewed):
    df, pdf = skewed
    probs = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q995": 0.995}
    got = rk.exact_quantiles(df, "x", probs, ["k"]).toPandas().set_index("k").sort_index()
    for name, p in probs.items():
        want = pdf.groupby("k")["x"].quantile(p).sort_index()
        np.testing.assert_allclose(got[name], want, atol=1e-9)
    assert got["n"].sum() == len(pdf)
    one = rk.exact_quantiles(df, "x", probs).first()
    np.testing.assert_allclose([one[n] for n in probs], [np.quantile(pdf.x, p) for p in probs.values()])


def test_null_groups_stay(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, x double")
    got = {r.k: r.m for r in rk.exact_quantiles(rows, "x", {"m": 0.5}, ["k"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_ranks_match_pandas(skewed):
    df, pdf = skewed
    got = rk.average_ranks(df, "x").toPandas().set_index("x")["rank"]
    want = pdf.assign(r=pdf.x.rank()).groupby("x")["r"].first()
    np.testing.assert_allclose(got.sort_index(), want.sort_index())


def test_box(spark):
    rows = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)], "k string, x double")
    r = ag.box_stats(rows, "x", "k").first()
    assert (r.q1, r["median"], r.q3, r.outliers, r["min"], r["max"]) == (2.0, 3.0, 4.0, [100.0], 1.0, 4.0)


def test_outliers_are_thinned_evenly(spark):
    values = [float(v) for v in range(1000)] + [float(5000 + v) for v in range(120)]
    r = ag.box_stats(spark.createDataFrame([("a", v) for v in values], "k string, x double"), "x", "k").first()
    out = np.sort([v for v in values if v > r.q3 + 1.5 * (r.q3 - r.q1)])
    want = out[np.linspace(0, len(out) - 1, 50).astype(int)]
    assert r.outliers == want.tolist()


def test_histogram_matches_numpy(skewed):
    df, pdf = skewed
    got = [r.n for r in ag.histogram(df, "x", 20).orderBy("bin").collect()]
    assert got == np.histogram(pdf.x, bins=20)[0].tolist()


def brute_ap_auc(y, p):
    order = np.argsort(-p, kind="stable")
    ap, tp, last = 0.0, 0, 0.0
    for v in np.unique(p)[::-1]:
        hit = p >= v
        tp = y[hit].sum()
        recall = tp / y.sum()
        ap += (recall - last) * tp / hit.sum()
        last = recall
    pos, neg = p[y == 1], p[y == 0]
    return ap, ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_metrics_match_brute_force(spark):
    rng = np.random.default_rng(2)
    y = (rng.random(800) < 0.3).astype(int)
    p = np.round(np.clip(0.3 * y + rng.random(800) * 0.7, 0, 1), 2)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    r = mt.classification_metrics(df, "y", "p", 0.5).first()
    ap, auc = brute_ap_auc(y, p)
    hit = p >= 0.5
    f1 = 2 * (hit & (y == 1)).sum() / (hit.sum() + y.sum())
    np.testing.assert_allclose([r.average_precision, r.roc_auc, r.f1, r.brier], [ap, auc, f1, ((p - y) ** 2).mean()])
    scores = [2 * ((p >= u) & (y == 1)).sum() / ((p >= u).sum() + y.sum()) for u in mt.BEST_GRID]
    assert mt.best_threshold(df, "y", "p").first().threshold == mt.BEST_GRID[int(np.argmax(scores))]
    cal = mt.calibration(df, "y", "p").orderBy("bin").toPandas()
    want = pd.DataFrame({"p": p, "y": y}).groupby(pd.qcut(p, 10, labels=False, duplicates="drop")).agg(p=("p", "mean"), y=("y", "mean"), n=("y", "size"))
    np.testing.assert_allclose(cal[["predicted", "actual", "n"]], want[["p", "y", "n"]])


def test_constant_score_has_ap_of_the_rate(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5), (0, 0.5)], "y int, p double")
    r = mt.ranking_metrics(df, "y", "p").first()
    assert (r.average_precision, r.roc_auc) == (0.25, 0.5)


def test_wilson(spark):
    low, high = st.wilson_interval(F.lit(25), F.lit(100))
    r = spark.range(1).select(low.alias("l"), high.alias("h"), st.wilson_interval(F.lit(0), F.lit(0))[0].alias("n")).first()
    assert 0 < r.l < 0.25 < r.h < 1 and np.isnan(r.n)
    np.testing.assert_allclose([r.l, r.h], [0.17545, 0.34305], atol=1e-4)


def test_p_values():
    from rivulet.functions.pvalues import chi2_survival, t_two_sided

    # textbook quantiles
    for x, df, p in ((3.841459, 1, 0.05), (16.918978, 9, 0.05), (9.718, 9, 0.374), (23.209251, 10, 0.01)):
        assert abs(chi2_survival(x, df) - p) < 5e-4
    for t, df, p in ((2.228139, 10, 0.05), (12.706205, 1, 0.05), (1.959964, 1e7, 0.05), (-2.228139, 10, 0.05)):
        assert abs(t_two_sided(t, df) - p) < 1e-6
    assert 0 < chi2_survival(541.033, 1) < 2e-119 and chi2_survival(0, 3) == 1


def test_kruskal_and_spearman_by_hand(spark):
    groups = {"a": [1.0, 2.0, 3.0, 4.0, 5.0], "b": [6.0, 7.0, 8.0, 9.0, 10.0], "c": [1.0, 6.0, 11.0, 12.0, 13.0], "small": [99.0]}
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    r = st.kruskal_wallis(spark.createDataFrame(rows, "g string, x double"), "g", "x").first()
    x = pd.Series([v for k, v in rows if k != "small"])
    g = pd.Series([k for k, v in rows if k != "small"])
    ranks = x.rank()
    h = 12 / (15 * 16) * (ranks.groupby(g).sum() ** 2 / 5).sum() - 3 * 16
    h /= 1 - (x.value_counts() ** 3 - x.value_counts()).sum() / (15**3 - 15)
    assert r.groups == 3 and r.n == 15 and abs(r.h - h) < 1e-9
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": range(200), "a": rng.integers(0, 9, 200).astype(float), "b": rng.normal(size=200)})
    pdf["c"] = pdf.a * 2 + pdf.b
    got = {(q.a, q.b): q.rho for q in st.spearman_matrix(spark.createDataFrame(pdf), "id", ["a", "b", "c"]).collect()}
    want = pdf[["a", "b", "c"]].rank().corr()
    for (a, b), rho in got.items():
        assert abs(rho - want.loc[a, b]) < 1e-9


def test_nearest_rank_latency(spark):
    values = [5, 1, 9, 7, 3, 3, 8, 2]
    df = spark.createDataFrame([(v,) for v in values], "ms int")
    r = latency_percentiles(df, "ms", {"p50": 0.5, "p95": 0.95}).first()
    s = sorted(values)
    assert (r.p50, r.p95) == tuple(s[min(7, round(q * 7))] for q in (0.5, 0.95))


def test_many_buckets_give_the_same(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("id % 3 AS g", "cast(id * 7919 % 1000 as double) AS v")
    few = sorted(map(tuple, rk.value_counts(rows, "v", ["g"]).collect()))
    monkeypatch.setattr(rk, "BUCKET_VALUES", 150)
    assert sorted(map(tuple, rk.value_counts(rows, "v", ["g"]).collect())) == few
