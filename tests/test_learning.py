"""Models, segmentation and trained text models against NumPy or their own rules."""

import math
import os
import time
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.operators import boosting as bo
from rivulet.operators import metrics as mt
from rivulet.operators import models as ml
from rivulet.operators import network as nw
from rivulet.operators import segments as sg
from rivulet.operators import textlearn as tl
from rivulet.operators import textmodel as tm


@pytest.fixture(scope="module")
def bills(spark):
    rng = np.random.default_rng(8)
    n = 1200
    pdf = pd.DataFrame({
        "bill_id": range(n), "conn_id": np.arange(n) // 24, "period": [f"{2024 + i % 24 // 12}-{i % 12 + 1:02d}" for i in range(n)],
        "tariff": np.where(rng.random(n) < 0.9, "a", "b"), "area": rng.integers(0, 4, n).astype(str)})
    for c in ml.BINARY + ml.NUMERIC:
        pdf[c] = rng.normal(size=n) if c in ml.NUMERIC else (rng.random(n) < 0.5).astype(float)
    pdf["y"] = (rng.random(n) < 1 / (1 + np.exp(1.2 - 2.5 * pdf.previous_label))).astype(int)
    pdf.loc[pdf.index % 10 == 0, "m3_vs_avg6"] = np.nan
    pdf["trainable"] = True
    df = spark.createDataFrame(pdf).withColumn("m3_vs_avg6", F.when(~F.isnan("m3_vs_avg6"), F.col("m3_vs_avg6")))
    return df.cache(), pdf


def test_folds_never_see_the_future(spark):
    rows = spark.createDataFrame([(f"2025-{m:02d}",) for m in range(1, 13) for _ in range(3)], "period string")
    pdf = mt.time_series_folds(rows, "period", 5).toPandas()
    assert sorted(pdf.fold.unique()) == [1, 2, 3, 4, 5]
    for _, g in pdf.groupby("fold"):
        assert g[~g.is_validation].period.max() < g[g.is_validation].period.min() and g.is_validation.sum() == 2


def test_leakage_guard():
    with pytest.raises(ValueError, match="days_late"):
        ml.assert_no_leakage(["m3", "days_late"])


def test_preprocessor(bills):
    df, pdf = bills
    prep = ml.Preprocessor.fit(df, True, rare=200)
    assert prep.marked == ["m3_vs_avg6"] and prep.values["tariff"] == (["a"], ["b"])
    from pyspark.ml.functions import vector_to_array
    x = np.array([r.x for r in prep.transform(df).orderBy("bill_id").select(vector_to_array("features").alias("x")).collect()])
    assert x.shape[1] == prep.size()
    filled = pdf.m3_vs_avg6.fillna(pdf.m3_vs_avg6.median())
    j = ml.NUMERIC.index("m3_vs_avg6")
    np.testing.assert_allclose(x[:, j], (filled - filled.mean()) / filled.std(ddof=0), atol=1e-9)
    assert set(x[:, len(ml.NUMERIC + ml.BINARY) + 1]) == {0.0, 1.0}


def test_models_beat_the_rate(bills):
    df, pdf = bills
    marked = mt.temporal_split(df, "period")
    train, test = marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")
    vote = ml.soft_vote([ml.logistic(), ml.random_forest(10, 5), ml.gradient_boosting(5, 4)])
    scores = vote(train)(test, "p")
    rate = test.agg(F.avg("y")).first()[0]
    assert mt.ranking_metrics(scores.select("y", "p"), "y", "p").first().average_precision > rate + 0.15
    importance = {r.column: r.importance for r in ml.permutation_importance(test, ml.logistic()(train), ["previous_label", "total", "tariff"], repeats=3, rows_per_bucket=60).collect()}
    assert max(importance, key=importance.get) == "previous_label" and importance["previous_label"] > 0.1


def test_permutation_keeps_the_values(bills):
    """The scorer sees each column's values once per repeat, only in another order."""
    df, pdf = bills
    seen = {}

    def score(rows, out):
        if "column" in rows.columns:
            seen["rows"] = rows.where("column = 'total' AND repeat = 1").select("total").toPandas().total
        return rows.withColumn(out, F.lit(0.5))

    ml.permutation_importance(df, score, ["total", "m3"], repeats=2, rows_per_bucket=300).collect()
    np.testing.assert_allclose(np.sort(seen["rows"]), np.sort(pdf.total))


def test_choose_by_cv_and_network(bills):
    df, _ = bills
    ranked = ml.choose_by_cv(df, {"logistic": ml.logistic(), "shallow": ml.gradient_boosting(2, 2)}, 3)
    assert ranked[0][1] >= ranked[1][1] and 0.1 <= ranked[0][2] <= 0.9
    last = df.agg(F.max("period")).first()[0]
    score, history = ml.train_network(df.where(F.col("period") < last), df.where(F.col("period") == last), epochs=2, hidden=(8,))
    assert 1 <= len(history) <= 2 and score(df, "p").where("p BETWEEN 0 AND 1").count() == df.count()


# ---------------------------------------------------------------- boosting
def plain_boosting(bins, y, w, rounds, leaves, rate, least, smooth):
    """One leaf per step, every column and bin tried for every leaf; scores of the rows after all rounds."""
    odds = (w * y).sum() / w.sum()
    raw = np.full(len(y), np.log(odds / (1 - odds)))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = w * (p - y), w * p * (1 - p)
        parts = [np.arange(len(y))]
        while len(parts) < leaves:
            found = []
            for number, rows in enumerate(parts):
                for j in range(bins.shape[1]):
                    for cut in range(int(bins[:, j].max())):
                        left = bins[rows, j] <= cut
                        sides = rows[left], rows[~left]
                        if min(map(len, sides)) >= least and min(h[s].sum() for s in sides) >= bo.LEAST_CURVATURE:
                            gain = sum(g[s].sum() ** 2 / (h[s].sum() + smooth) for s in sides) - g[rows].sum() ** 2 / (h[rows].sum() + smooth)
                            found.append((round(gain, 9), -number, -j, -cut, sides))
            top = max(found, key=lambda f: f[:4], default=None)
            if top is None or top[0] <= 1e-9:
                break
            parts[-top[1]:-top[1] + 1] = top[4]
        for rows in parts:
            raw[rows] -= rate * g[rows].sum() / (h[rows].sum() + smooth)
    return 1 / (1 + np.exp(-raw))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(4)
    x = np.stack([rng.normal(size=2_000).round(1), rng.integers(0, 5, 2_000), rng.normal(size=2_000), np.ones(2_000)], axis=1)
    y = (rng.random(2_000) < 1 / (1 + np.exp(-x[:, 0] * (x[:, 1] - 2)))).astype(int)
    w = np.where(y == 1, 1.5, 1.0)
    df = spark.createDataFrame([(i, list(map(float, r)), int(a), float(b)) for i, (r, a, b) in enumerate(zip(x, y, w))], "bill_id int, x array<double>, y int, weight double")
    return df.repartition(5).cache(), x, y, w


@pytest.mark.parametrize("block_rows", [10_000, 600])
def test_boosting_equals_a_plain_loop(labelled, block_rows, monkeypatch):
    df, x, y, w = labelled
    monkeypatch.setattr(bo, "BLOCK_ROWS", block_rows)  # one block, and four that exchange sums
    monkeypatch.setattr(bo, "CUT", 2)
    edges = bo.column_edges(df, F.col("x"), 4)
    bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    model = bo.fit(df, F.col("x"), 4, rounds=5, leaves=7, rate=0.3)
    assert len(model.trees) == 5 and all((t.column >= 0).sum() == 6 for t in model.trees)
    np.testing.assert_allclose(model.probability(x), plain_boosting(bins, y, w, 5, 7, 0.3, 20, 1.0), atol=1e-9)
    scored = bo.score(df, model, F.col("x"), "p").orderBy("bill_id").select("p").toPandas().p
    np.testing.assert_allclose(scored, model.probability(x))


def test_a_block_of_the_network_has_bounded_rows(spark, labelled, monkeypatch):
    df, x, _, _ = labelled
    monkeypatch.setattr(nw, "MOST_ROWS", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 40)
    try:
        blocks, n = nw._blocks(df, F.col("x"), "y", "bill_id", 4)
        found = blocks.collect()
        _, history = nw.train(df, df, F.col("x"), 4, epochs=3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert n == 2_000 and max(len(y) for _, _, y in found) <= 140 and len({number for number, _, _ in found}) == len(found)
    np.testing.assert_array_equal(np.concatenate([b for _, b, _ in found]), x)
    assert len(history) == 3 and history[-1][2] < history[0][2]


def test_pieces_of_the_network_are_small(spark, labelled):
    """A reader's batch holds 4,096 pieces, which were up to 10,000 rows each."""
    df, x, _, _ = labelled
    kept = []
    blocks, n = nw._blocks(df, F.col("x"), "y", "bill_id", 4, kept)
    pieces = kept[0].collect()
    kept[0].unpersist()
    assert max(len(y) for _, y in pieces) <= 64 and sum(len(y) for _, y in pieces) == n == 2_000
    np.testing.assert_array_equal(np.concatenate([b for _, b, _ in blocks.collect()]), x)


def test_a_block_of_the_network_is_held_once():
    """The pieces, their joined bytes and the pickled block were held together, four times the block."""
    width, rows = 20, nw.MOST_ROWS // 16
    pieces = ((np.full(rows * width, float(i)), np.full(rows, float(i))) for i in range(33))
    sizes = []
    tracemalloc.start()
    for number, x, y in nw._joined(3, pieces, width):
        sizes.append((number, len(y)))
        assert (x == y[:, None]).all(axis=1).all()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == [(3, nw.MOST_ROWS), (3 + (1 << 20), nw.MOST_ROWS), (3 + (2 << 20), rows)]
    assert peak < 2.6 * 8 * width * nw.MOST_ROWS  # two while the next one begins, and pieces


def test_steps_sum_only_the_smaller_children(labelled):
    _, x, y, w = labelled
    edges = [np.unique(c)[:-1][:100] for c in x.T] + [np.array([0.0])] * 2
    marks = np.random.default_rng(1).integers(0, 2, (len(y), 2))
    bins = np.hstack([np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1), marks]).astype(np.uint8)
    block, met = [(bins, y.astype(float), w, np.zeros(len(y)))], []

    def total(*asked):
        out = bo.histograms(block[0], *asked)
        met.append(out[2, :, :len(edges[0]) + 1].sum())  # rows met in a step
        plain = np.zeros_like(out)
        tree, slot, slots, widths = asked
        at, begins = slot[tree.leaf(bins, tree.bin)], np.cumsum([0, *widths])
        p = 1 / (1 + np.exp(-block[0][3]))
        for row in np.flatnonzero(at >= 0):
            for j in range(bins.shape[1]):
                plain[:, at[row], begins[j] + bins[row, j]] += w[row] * (p[row] - y[row]), w[row] * p[row] * (1 - p[row]), 1
        np.testing.assert_allclose(out, plain, atol=1e-9)
        return out

    trees = bo.boost(total, lambda t: block.__setitem__(0, bo.added(block[0], t)), edges, 2, 7, 0.3, 20, 1.0)
    roots = [i for i, rows in enumerate(met) if rows == len(y)]
    assert len(trees) == len(roots) == 2 and all(rows <= len(y) / 2 for i, rows in enumerate(met) if i not in roots)


def test_a_hundred_thousand_rows_are_one_block(spark):
    """Steps over blocks are jobs, thousands of them; so a task takes what it does sooner alone."""
    rows = spark.range(130_000).selectExpr("id AS bill_id", "array(CAST(id % 7 AS DOUBLE)) AS x", "CAST(id % 2 AS INT) AS y", "1.0D AS weight")
    blocks, n = bo._stored(rows, F.col("x"), "y", "weight", [np.arange(6.0)], "bill_id")
    assert n == 130_000 and blocks.getNumPartitions() == 1


def test_bins_are_exact_quantiles(labelled):
    df, x, _, _ = labelled
    edges = bo.column_edges(df, F.col("x"), 4, 10)
    assert edges[1].tolist() == [0, 1, 2, 3] and len(edges[3]) == 0
    counts = np.bincount(np.searchsorted(edges[2], x[:, 2], side="left"))
    assert counts.tolist() == [200] * 10


def test_boosting_stops_without_a_split(spark):
    df = spark.createDataFrame([(i, [1.0], i % 2, 1.0) for i in range(100)], "bill_id int, x array<double>, y int, weight double")
    assert bo.fit(df, F.col("x"), 1, rounds=3).trees == ()


# ---------------------------------------------------------------- network
def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    net = nw.Network.random((3, 5, 4, 1), 1)
    x, y = rng.normal(size=(30, 3)), rng.integers(0, 2, 30).astype(float)
    loss, g = net.gradient(x, y, 2.5, 0.2, np.random.default_rng(9))
    for i in range(0, len(g), 7):
        step = np.zeros_like(g)
        step[i] = 1e-6
        ends = [nw.Network(net.sizes, net.weights + s * step).gradient(x, y, 2.5, 0.2, np.random.default_rng(9))[0] for s in (1, -1)]
        assert abs((ends[0] - ends[1]) / 2e-6 - g[i]) < 1e-6
    assert net.gradient(x, y, 2.5, 0.0, rng)[0] == pytest.approx(nw.losses(net.raw(x), y, 2.5).mean())


def test_one_block_is_plain_adam_and_many_learn_too(labelled, monkeypatch):
    df, x, y, _ = labelled
    valid = df.where("bill_id % 5 = 0")
    rows = df.where("bill_id % 5 <> 0")
    chosen = np.arange(2_000) % 5 != 0
    options = nw.Options(batch=100, rate=1e-2)
    found, history = nw.train(rows, valid, F.col("x"), 4, hidden=(8,), epochs=6, options=options)
    xs, ys = x[chosen], y[chosen].astype(float)
    heavy = (1 - ys.mean()) / ys.mean()
    net = nw.Network.random((4, 8, 1), options.seed)
    w, m, v, t, best = net.weights.copy(), 0.0, 0.0, 0, (np.inf, None)
    for epoch in range(1, 7):
        rng = np.random.default_rng((options.seed, epoch, 0))
        order, total = rng.permutation(len(ys)), 0.0
        for a in range(0, len(ys), 100):
            i = order[a:a + 100]
            loss, g = nw.Network(net.sizes, w).gradient(xs[i], ys[i], heavy, 0.2, rng)
            g = g + 1e-4 * w
            t, m, v, total = t + 1, 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, total + loss * len(i)
            w = w - 1e-2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        check = nw.losses(nw.Network(net.sizes, w).raw(x[~chosen]), y[~chosen].astype(float), heavy).mean()
        np.testing.assert_allclose(history[epoch - 1], (epoch, total / len(ys), check), rtol=1e-6)
        if check < best[0] - 1e-4:
            best = check, w.copy()
    np.testing.assert_allclose(found.weights, best[1], rtol=1e-5, atol=1e-7)
    monkeypatch.setattr(nw, "BLOCK_ROWS", 500)
    many, curve = nw.train(rows, valid, F.col("x"), 4, hidden=(8,), epochs=25, options=options)
    odds = np.abs(x[~chosen, 0] * (x[~chosen, 1] - 2))  # of the labels' own rule
    attainable = (1 / (1 + np.exp(-odds))).mean()
    assert curve[-1][2] < curve[0][2] and ((many.probability(x[~chosen]) > 0.5) == y[~chosen]).mean() > attainable - 0.05


# ---------------------------------------------------------------- segmentation
def brute_silhouette(x, label):
    """Squared distances, every row against every other."""
    d = ((x[:, None] - x) ** 2).sum(-1)
    out = []
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, label == c].mean() for c in set(label) if c != label[i])
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_silhouette(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 3))
    label = rng.integers(0, 3, 200)
    label[0] = 3  # alone in its cluster
    df = spark.createDataFrame([(i, v, int(c)) for i, (v, c) in enumerate(zip(x.tolist(), label))], "id int, x array<double>, s int")
    assert abs(sg.silhouette(df, "x", "s").first().silhouette - brute_silhouette(x, label)) < 1e-9


@pytest.mark.parametrize("spread", [0.0, 6.0])
def test_euclidean_silhouette_equals_all_pairs(spark, spread, monkeypatch):
    monkeypatch.setattr(sg, "BLOCK_ROWS", 200)
    rng = np.random.default_rng(19)
    label = rng.integers(0, 4, 3_000)
    label[7] = 9  # alone
    x = rng.normal(size=(3_000, 3)) + spread * np.array([[0, 0, 0], [1, 0, 0], [0, 1, 0], [0, 0, 1]])[label % 4]
    x[100:120] = x[0]
    df = spark.createDataFrame([(i, v, int(c)) for i, (v, c) in enumerate(zip(x.tolist(), label))], "id int, x array<double>, s int")
    d = np.sqrt(((x[:, None] - x) ** 2).sum(-1))
    names = np.unique(label)
    total = np.stack([d[:, label == c].sum(1) for c in names], axis=1)
    size = np.array([(label == c).sum() for c in names])
    own = np.searchsorted(names, label)
    rest = np.where(np.arange(len(names)) == own[:, None], np.inf, total / size).min(1)
    a = total[np.arange(3_000), own] / np.maximum(size[own] - 1, 1)
    want = np.where(size[own] > 1, (rest - a) / np.maximum(a, rest), 0).mean()
    assert abs(sg.euclidean_silhouette(df, "id", "x", "s").first().silhouette - want) < 1e-9


def test_euclidean_silhouette_sends_members_in_chunks_and_leaves_no_tables(spark, monkeypatch):
    """Blocks of rows were shuffled once per pair of blocks, which filled the disk."""
    rng = np.random.default_rng(21)
    x, label = rng.normal(size=(90, 3)), rng.integers(0, 3, 90)
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, label))], "id bigint, x array<double>, s int")
    folder = spark.sparkContext.getCheckpointDir() or sg.materialize(df).sparkSession.sparkContext.getCheckpointDir()
    tables = lambda: set(os.listdir(folder.removeprefix("file:")))
    before, sent, broadcast = tables(), [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(sg, "BLOCK_ROWS", 8)
    monkeypatch.setattr(sg, "CHUNK_NUMBERS", 60)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or broadcast(self, value))
    d = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    sums = np.stack([d[:, label == c].sum(1) for c in range(3)], axis=1)
    n = np.bincount(label)
    a = sums[np.arange(90), label] / (n[label] - 1)
    b = np.where(np.arange(3) == label[:, None], np.inf, sums / n).min(1)
    assert abs(sg.euclidean_silhouette(df, "id", "x", "s").first().silhouette - ((b - a) / np.maximum(a, b)).mean()) < 1e-9
    assert len(sent) == 5 and sum(len(m) for chunk in sent for blocks in chunk.values() for m in blocks) == 90
    assert len(tables() - before) <= 1


@pytest.mark.parametrize("scale, shift", [(1.0, 0.0), (1e-4, 50.0), (0.0, 3.0)])
def test_distance_sums_equal_differences_in_less_time(scale, shift):
    rng = np.random.default_rng(2)
    m = np.vstack([rng.normal(size=(1_500, 7)) * scale + shift, np.full((40, 7), shift)])
    a = np.vstack([m[:700], m[-40:], rng.normal(size=(60, 7)) * scale + shift])

    def plain():
        total = np.zeros((len(a), len(m)))
        for j in range(7):
            total += (a[:, j, None] - m[None, :, j]) ** 2
        return np.sqrt(total).sum(axis=1)

    def seconds(f):
        begun = time.perf_counter()
        f()
        return time.perf_counter() - begun

    np.testing.assert_allclose(sg.distance_sums(a, m), plain(), rtol=1e-9, atol=1e-9)
    if scale == 1:
        assert min(seconds(lambda: sg.distance_sums(a, m)) for _ in range(5)) < 0.6 * min(seconds(plain) for _ in range(5))


def test_kmeans_ends_in_a_fixed_point_and_finds_the_number(spark):
    rng = np.random.default_rng(12)
    corners = np.array([[0, 0], [9, 0], [0, 9]])
    x = np.concatenate([c + rng.normal(size=(60, 2)) for c in corners])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id int, x array<double>").repartition(3)
    found = sg.kmeans(df, "id", "x", range(2, 6), restarts=4)
    assert {k: len(c) for k, c in found.items()} == {k: k for k in range(2, 6)}
    rows = [(k, sg.silhouette(sg.assign(df, "x", c), "x", "segment").first()["silhouette"], c) for k, c in found.items()]
    k, centres = sg.best_k(rows)
    own = ((x[:, None] - centres) ** 2).sum(-1).argmin(1)
    assert k == 3 and all(np.allclose(centres[j], x[own == j].mean(0), atol=0.05) for j in range(3))
    assert [r["segment"] for r in sg.assign(df, "x", centres).orderBy("id").collect()] == own.tolist()


def test_pca_matches_numpy(spark):
    x = np.random.default_rng(10).normal(size=(300, 4)) @ np.array([[2, 0, 0, 1], [0, 1, 0, 1], [0, 0, 1, 0], [0, 0, 0, 0.2]])
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")).assign(id=range(300)))
    scored, loadings, share = sg.pca(df, list("abcd"))
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    np.testing.assert_allclose(share, values[::-1][:2] / values.sum(), atol=1e-9)
    want = np.abs(z @ vectors[:, ::-1][:, :2])
    np.testing.assert_allclose(np.abs(scored.orderBy("id").select("pc1", "pc2").toPandas()), want, atol=1e-8)


def test_segment_names(spark):
    rows = spark.createDataFrame([(0, 0.9, 5.0, 0.0), (1, 0.1, 1.0, 1.0), (2, 0.45, 2.5, 0.2)], "s int, late_rate double, mean_m3 double, direct_debit double")
    names = {r.s: r.name for r in sg.segment_profile(rows, "s", ["late_rate", "mean_m3", "direct_debit"]).collect()}
    assert names == {0: "atraso alto, consumo alto", 1: "puntual, consumo bajo, domiciliado", 2: "comportamiento típico"}


# ---------------------------------------------------------------- text models
def test_linear_fit_has_no_slope_left():
    rng = np.random.default_rng(31)
    n, size, classes, c = 120, 15, 3, 2.0
    dense = rng.random((n, size)) * (rng.random((n, size)) < 0.3)
    label = rng.integers(0, classes, n)
    rows, terms = np.nonzero(dense)
    model = tl.fit_linear(rows, terms, dense[rows, terms], label, classes, size, c, 300)
    z = dense @ model.weights + model.intercepts
    np.testing.assert_allclose(model.logits(rows, terms, dense[rows, terms], n), z)
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    w = (n / (classes * np.bincount(label)))[label]
    rest = w[:, None] * (p - np.eye(classes)[label]) / w.sum()
    assert np.abs(dense.T @ rest + model.weights / (c * n)).max() < 2e-5 and np.abs(rest.sum(0)).max() < 2e-5


WORDS = {"agua": ["fuga", "agua", "tubo", "calle", "charco"], "cobro": ["recibo", "cobro", "pago", "tarifa", "caro"]}


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(160):
        c = "agua" if i % 3 else "cobro"
        words = list(rng.choice(WORDS[c], 4)) + list(rng.choice(["señor", "favor", "urgente", f"caso{i}"], 2))
        rows.append((i, " ".join(words), c))
    return spark.createDataFrame(rows, "id bigint, text string, c string").cache()


def test_split_is_disjoint_and_stratified(texts):
    parts = tm.split_by_text(texts, "text", "c").toPandas()
    for _, g in parts.groupby("c"):
        assert g.is_test.sum() == max(1, math.floor(len(g) * 0.25 + 0.5))


def test_classifier_and_its_tables_agree(texts):
    parts = tm.split_by_text(texts, "text", "c").cache()
    train, test = parts.where(~F.col("is_test")).drop("is_test"), parts.where("is_test").drop("is_test")
    vectors, model, classes, table = tl.train_text_classifier(train, "id", "text", "c", folds=2, ngrams=(1, 2), penalties=(1.0,), max_iter=30)
    assert len(table) == 2 and table[0][2] >= table[1][2]
    direct = tl.predict(model, vectors.transform(test), vectors.size, classes, "guess").select("id", "c", "guess").toPandas().set_index("id").sort_index()
    assert (direct.c == direct.guess).mean() > 0.9
    tables = tl.export_model(vectors, model, classes, "c")
    scored = tm.score_with_model(test, "id", "text", tables["idf"], tables["weights"], tables["intercepts"], "c", vectors.n)
    scored = scored.toPandas().set_index("id").sort_index()
    assert (scored.c == direct.guess).all() and scored.known.all()


def test_unknown_words_use_the_intercept(spark, texts):
    vectors = tl.TextVectors(texts, "id", "text", 1)
    model = tl.fit_classifier(vectors.train, vectors.size, "c", ["agua", "cobro"], 1.0, 20)
    tables = tl.export_model(vectors, model, ["agua", "cobro"], "c")
    odd = spark.createDataFrame([(1, "zzz yyy"), (2, "")], "id bigint, text string")
    out = tm.score_with_model(odd, "id", "text", tables["idf"], tables["weights"], tables["intercepts"], "c", 1).collect()
    assert len(out) == 2 and not any(r.known for r in out)


def test_only_terms_of_the_fitting_texts_have_weights(texts):
    vectors = tl.TextVectors(texts, "id", "text", 2)
    classes = ["agua", "cobro"]
    model = tl.fit_classifiers(vectors.train, vectors.size, "c", classes, [1.0], 40, most=60)[1.0]
    weights = {r["index"]: r["w"] for r in model.weights.collect()}
    rows = vectors.train.orderBy("id").select("id", "c", "terms", "weights").toPandas()
    chosen = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(0.97 * 60 / len(rows) * 1_000_000)
    fitted = rows[rows.id.isin([r["id"] for r in vectors.train.where(chosen).collect()])]
    assert 20 < len(fitted) <= 60 and {i for t in fitted.terms for i in t} == set(weights) and len(weights) < vectors.size
    label = fitted.c.map({c: i for i, c in enumerate(classes)}).to_numpy()
    full = tl.fit_linear(*tl.entries_of(fitted), label, 2, vectors.size, 1.0, 40)
    for i, w in enumerate(full.weights):
        np.testing.assert_allclose(weights.get(i, [0.0, 0.0]), w, atol=1e-9)
    z = full.logits(*tl.entries_of(rows), len(rows))
    got = tl.predict(model, vectors.train, vectors.size, classes, "guess").orderBy("id").toPandas().guess
    assert got.tolist() == [classes[i] for i in z.argmax(axis=1)]
    exported = tl.export_model(vectors, model, classes, "c")["weights"].toPandas()
    assert len(exported) == 2 * vectors.size and (exported.weight != 0).sum() <= 2 * len(weights)


def test_a_fit_reads_every_text(spark):
    """20,000 of them at most were fitted."""
    n = 20_500
    rows = spark.range(n).select("id", F.array(F.col("id").cast("int")).alias("terms"), F.array(F.lit(1.0)).alias("weights"),
                                 F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("c"))
    model = tl.fit_classifiers(rows, n, "c", ["a", "b"], [1.0], 2)[1.0]
    weights = {r["index"]: r["w"] for r in model.weights.collect()}
    assert set(weights) == set(range(n)) and all((w[0] > w[1]) == (i % 3 == 0) for i, w in weights.items())


def test_a_fit_in_blocks_is_that_of_one_task(spark, texts, monkeypatch):
    vectors, classes = tl.TextVectors(texts, "id", "text", 1), ["agua", "cobro"]
    odd = spark.createDataFrame([(900, "agua", [], []), (901, "cobro", [], [])], "id bigint, c string, terms array<int>, weights array<double>")
    rows = vectors.train.unionByName(odd).unionByName(vectors.train.where("id < 5"))  # empty texts and repeated keys
    one = tl.fit_classifiers(rows, vectors.size, "c", classes, [0.02, 0.1], 100)
    monkeypatch.setattr(tl, "FIT_ENTRIES", 0)
    many = tl.fit_classifiers(rows, vectors.size, "c", classes, [0.02, 0.1], 100)
    for c in one:
        a, b = ({r["index"]: r["w"] for r in m[c].weights.collect()} for m in (one, many))
        assert set(a) == set(b) == set(range(vectors.size))
        np.testing.assert_allclose([b[i] for i in sorted(a)], [a[i] for i in sorted(a)], atol=2e-3)
        np.testing.assert_allclose(many[c].intercepts, one[c].intercepts, atol=2e-3)


def test_texts_of_a_fit_never_reach_the_driver(texts, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    vectors, rows, whole = tl.TextVectors(texts, "id", "text", 1), [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "toPandas", lambda self: pytest.fail("rows are collected"))
    monkeypatch.setattr(DataFrame, "collect", lambda self: rows.append(len(out := whole(self))) or out)
    models = tl.fit_classifiers(vectors.train, vectors.size, "c", ["agua", "cobro"], [0.5, 1.0], 20)
    assert len(models) == 2 and sum(rows) <= 4


def test_linear_fit_holds_no_copies_of_the_weights():
    rng = np.random.default_rng(5)
    n, classes, size = 30, 4, 100_000
    rows, terms = np.repeat(np.arange(n), 50), rng.integers(0, size, n * 50)
    tracemalloc.start()
    tl.fit_linear(rows, terms, rng.random(n * 50), np.arange(n) % classes, classes, size, 1.0, 15)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * 8 * size * classes  # the result, and one class at a time


def test_lsa_matches_svd(texts):
    vectors = tl.TextVectors(texts, "id", "text", 1)
    latent = tl.LatentVectors(vectors, components=3)
    rows = vectors.train.orderBy("id").select("terms", "weights").collect()
    a = np.zeros((len(rows), vectors.size))
    for i, r in enumerate(rows):
        a[i, r.terms] = r.weights
    u, s, _ = np.linalg.svd(a, full_matrices=False)
    np.testing.assert_allclose(latent.singular, s[:3], rtol=1e-3)
    got = np.array([r.unit for r in latent.transform(vectors.train).orderBy("id").select("unit").collect()])
    want = u[:, :3] * s[:3]
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    np.testing.assert_allclose(got @ got.T, want @ want.T, atol=0.01)
