"""Forests over blocks, against trees grown by plain recursion from the same draws."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.operators import forests as fo
from rivulet.operators import models as ml


def _blocks(rng, sizes, widths):
    out = []
    for n in sizes:
        x = np.stack([rng.integers(0, w, n) for w in widths], axis=1)
        y = rng.random(n) < 0.2 + 0.6 * (x[:, 1] > 2)
        out.append((2 * x + y[:, None]).astype(np.uint8))
    return out


def _plain(x, y, times, columns_of, weights, widths, least):
    """Best split of one node by trying every column and bin: column, bin, labels left and right."""
    gini = lambda s: 1 - sum((s * weights / (s * weights).sum()) ** 2)
    count = lambda m: np.array([times[m & (y == c)].sum() for c in (0, 1)], float)
    best = (1e-9, -1, 0, None)
    whole = count(np.ones(len(y), bool))
    for c in columns_of:
        for b in range(widths[c] - 1):
            left, right = count(x[:, c] <= b), count(x[:, c] > b)
            if min(left.sum(), right.sum()) >= least:
                shares = [(s * weights).sum() / (whole * weights).sum() for s in (left, right)]
                gain = gini(whole) - shares[0] * gini(left) - shares[1] * gini(right)
                if gain > best[0] + 1e-12:
                    best = gain, c, b, np.array([left, right])
    return best[1:]


def test_levels_over_blocks_grow_the_tree_of_plain_recursion(monkeypatch):
    monkeypatch.setattr(fo, "SOME_ROWS", 50)
    rng, widths, weights, least = np.random.default_rng(3), np.array([2, 6, 9, 1, 2]), np.array([0.8, 1.3]), 5
    blocks = _blocks(rng, (300, 170, 1), widths)
    times = [fo.DRAWS[np.random.Generator(np.random.SFC64([42, 7, b])).integers(0, 65536, len(x), np.uint16)] for b, x in enumerate(blocks)]
    x, times = np.concatenate(blocks), np.concatenate(times).astype(int)
    y, x = x[:, 0] & 1, x >> 1
    tree = fo.Growing.root()
    rows_of = {0: np.arange(len(x))}
    for level in range(4):
        nodes = np.flatnonzero(tree.slot >= 0)
        drawn = fo.drawn_columns(42, 7, level, len(nodes), 5)
        counts = sum(fo.label_counts(b, i, tree, 7, level, 42, widths) for i, b in enumerate(blocks))
        column, last, labels = fo.best_splits(counts.astype(np.int64), drawn, widths, weights, least)
        grown = tree.split(column, last, labels, least, level == 3)
        for i, node in enumerate(nodes):
            own = rows_of[node]
            c, b, want = _plain(x[own], y[own], times[own], drawn[i], weights, widths, least)
            assert column[i] == c
            if c >= 0:
                assert last[i] == b and (labels[i] == want).all()
                left = grown.left[node]
                rows_of[left], rows_of[left + 1] = own[x[own, c] <= b], own[x[own, c] > b]
        tree = grown
    assert len(tree.column) > 9 and not tree.open()
    done = tree.tree(weights, [np.arange(w - 1.0) for w in widths])
    leaf = done.leaf(x.astype(float), done.limit)
    for node in set(leaf.tolist()):
        here = leaf == node
        n0, n1 = (weights[c] * times[here & (y == c)].sum() for c in (0, 1))
        assert done.value[node] == pytest.approx(n1 / (n0 + n1))


def _rows(spark, n, y):
    one = {c: F.lit(1.0) for c in ml.BINARY + ml.NUMERIC} | {"tariff": F.lit("a"), "area": F.lit("b")}
    one |= {c: (F.col("id") % 50).cast("double") for c in ml.NUMERIC}
    return spark.range(n).select(F.col("id").alias("bill_id"), y.cast("int").alias("y"), *[v.alias(c) for c, v in one.items()])


def test_a_forest_needs_no_more_jobs_for_more_rows_or_trees(spark):
    """Spark's forest kept a number per row and tree, and its tasks exchanged the sums of every node."""
    rows = _rows(spark, 4000, F.col("id") % 50 >= 20)
    sc = spark.sparkContext
    done = []
    for n, trees in ((400, 3), (4000, 40)):
        sc.setJobGroup(f"forest{n}", "")
        score = ml.random_forest(trees, 4)(rows.where(F.col("bill_id") < n))
        done.append(len(sc.statusTracker().getJobIdsForGroup(f"forest{n}")))
        got = score(rows, "p").agg(F.avg(F.when(F.col("y") == 1, F.col("p"))).alias("a"), F.avg(F.when(F.col("y") == 0, F.col("p"))).alias("b")).first()
        assert got["a"] > got["b"] + 0.3
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert done[1] <= done[0] + 6  # one level more may be open


def test_odd_labels(spark):
    ones = ml.random_forest(3, 3)(_rows(spark, 60, F.lit(1)))
    assert ones(_rows(spark, 5, F.lit(1)), "p").agg(F.min("p")).first()[0] == 1
    with pytest.raises(ValueError, match="null"):
        ml.random_forest(3, 3)(_rows(spark, 60, F.when(F.col("id") > 5, 1)))
