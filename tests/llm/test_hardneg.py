"""Hard negatives against scoring every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import hardneg


def plain(rows, every, positives=5, negatives=3):
    """rows: {key: (label, integer vector)}."""
    out = []
    for a, (la, va) in rows.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, vb)), b, lb) for b, (lb, vb) in rows.items() if b != a)
        for s, p, _ in [r for r in scored if r[2] == la][:positives]:
            inside = [r for r in scored if r[2] != la and 50 * -s <= 100 * -r[0] <= 95 * -s][:negatives]
            out += [(a, p, n, b, -s, -t) for n, (t, b, _) in enumerate(inside, 1)]
    return sorted(out)


def whole(x):
    return np.floor(np.float32(x).astype(float) * 256).astype(int).tolist()


@pytest.mark.parametrize("dim, structured", [(5, False), (37, True), (64, True)])
def test_equals_all_pairs(spark, dim, structured, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK_ANCHORS", 20)  # several blocks
    monkeypatch.setattr(hardneg, "SIDE_ROWS", 40)
    monkeypatch.setattr(hardneg, "SIDE_ANCHORS", 7)
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(400, dim)) if not structured else np.repeat(rng.normal(size=(400, -(-dim // 8))), 8, axis=1)[:, :dim] + rng.normal(scale=.1, size=(400, dim))
    x[::9] = x[3]  # ties
    x[7] = 0
    data = [(i, v.astype(np.float32).tolist(), int(rng.integers(4))) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int").repartition(3)
    got = sorted(tuple(r) for r in hardneg.mined(df, F.col("vec_id") % 10 == 0).collect())
    assert got == plain({i: (lab, whole(v)) for i, v, lab in data}, 10) and len(got) > 100


def test_bounds_hold_and_prune(spark):
    rng = np.random.default_rng(1)
    x = np.floor(256 * np.repeat(rng.normal(size=(300, 8)), 8, axis=1) + rng.normal(size=(300, 64))).astype(np.int64)
    v = hardneg.Vectors(x, hardneg.summaries(x), np.float64)
    scores = x @ x.T
    for size, mean, deviation in v.levels:
        centre, span = size * mean @ mean.T, deviation @ deviation.T
        assert (centre - span <= scores + 1e-3).all() and (scores <= centre + span + 1e-3).all()
    low = np.sort(scores, axis=1)[:, -10].astype(float)
    i, j, score, left = hardneg.pairs_between(v, v, low, np.full(300, np.inf))
    assert sorted(zip(i, j)) == sorted(zip(*np.nonzero(scores >= low[:, None]))) and (score == scores[i, j]).all()
    assert left == sorted(left, reverse=True) and left[-1] < 300 * 300 / 4


def test_large_components_are_scored_exactly(spark):
    rng = np.random.default_rng(2)
    data = [(i, [float(v) for v in rng.integers(-1 << 21, 1 << 21, 6)], i % 2) for i in range(120)] + [(500, [1e300] * 6, 1)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int")
    got = sorted(tuple(r) for r in hardneg.mined(df, F.col("vec_id") % 4 == 0).collect())
    assert got == plain({i: (lab, [int(256 * x) for x in v]) for i, v, lab in data[:-1]}, 4) and max(r[4] for r in got) > 1 << 53


def test_defined_results(spark):
    nan = float("nan")
    data = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (1, [2.0, 1.0], 1), (2, [1.0, .5], 2), (3, [nan, 1.0], 2), (4, None, 1), (5, [1.0, None], 1), (6, [1.0, 1.0], None),
            (None, [1.0, 1.0], 1), (8, [1.0], 1), (9, [], 1), (10, [-1.0, -1.0], 3), (12, [0.0, 0.0], 3)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int").withColumn("rank", F.lit("x")).withColumn("key", F.lit(1))
    got = [tuple(r) for r in hardneg.mined(df, F.col("vec_id") % 2 == 0).collect()]
    assert sorted(got) == plain({0: (1, [256, 256]), 1: (1, [512, 256]), 2: (2, [256, 128]), 10: (3, [-256, -256]), 12: (3, [0, 0])}, 2)
    assert hardneg.mined(df.limit(0), F.col("vec_id") % 2 == 0).collect() == []
    assert hardneg.mined(df, F.lit(False)).collect() == []


def test_query_equals_its_sql(agrees):
    agrees("op13_hard_negatives")
