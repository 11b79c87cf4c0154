import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rivulet.llm import forest


def brute(rows, k):
    """{query: [(id, score)]} of rows whose id is divisible by 20."""
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            s = np.einsum("ij,ij->i", np.repeat(np.array([v], float), len(x), 0), x)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), s[j]) for j in order]
    return out


def run(spark, rows, k=20, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = {}
    for r in forest.nearest(df, F.col("vec_id") % 20 == 0, k, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def vectors(n, dim=16, seed=1, norms=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x *= rng.uniform(0.5, 3, (n, 1)).astype(np.float32) if norms else 1
    return [(i, [float(c) for c in v], "x") for i, v in enumerate(x)]


@pytest.mark.parametrize("norms", [False, True])
def test_recall_and_exact_scores(spark, norms):
    rows = vectors(3000, norms=norms)
    got, want = run(spark, rows, leaf=64), brute([r[:2] for r in rows], 20)
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.93
    x = {r[0]: np.array(r[1]) for r in rows}
    for q, found in got.items():
        assert all(abs(s - x[q] @ x[i]) < 1e-9 for i, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))


def test_copies_ties_and_odd_rows(spark):
    rows = [(i, [float(np.float32(c / np.linalg.norm(v))) for c in v], x) for i, v, x in vectors(300, dim=8)]
    same = rows[40][1]
    rows += [(i, same, "x") for i in range(1000, 1100)] + [rows[60], rows[60]]
    nan, inf = float("nan"), float("inf")
    odd = [(2000, None, "x"), (2020, [0.0] * 8, "x"), (2040, [nan] * 8, "x"), (2060, [inf] * 8, "x"), (2080, [1.0] * 3, "x"), (2100, [], "x"),
           (2120, [None] * 8, "x"), (None, same, "x")]
    got = run(spark, rows + odd, target_recall=1.0)
    want = brute([r[:2] for r in {r[0]: r for r in rows}.values()], 20)
    assert set(got) == set(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) > 0.99
    assert [i for i, _ in got[40]] == list(range(1000, 1020)) and [i for i, _ in got[1000]][:3] == [40, 1001, 1002]


def test_few_and_no_rows(spark):
    rows = vectors(5, dim=4)
    assert run(spark, rows) == {q: [(i, pytest.approx(s)) for i, s in f] for q, f in brute([r[:2] for r in rows], 20).items()}
    assert run(spark, rows[1:]) == {} and run(spark, [(0, None, "x")]) == {}
    assert run(spark, rows[:1]) == {}


def test_queue_opens_cells_by_distance():
    rng = np.random.default_rng(3)
    f = forest.grow(rng.normal(size=(500, 6)), 500, 10.0, trees=3, leaf=20)
    q = f.project(f.lifted(rng.normal(size=(1, 6))))[:, 0]
    order = list(f.search(q))
    assert len(order) == len(set(order)) == 3 << f.levels

    def cost(t, leaf):
        node, total = leaf + (1 << f.levels), 0.0
        for level in reversed(range(f.levels)):
            parent, side = node // 2, node % 2
            gap = q[t, level] - f.thresholds[t, parent]
            total += gap * gap if (gap > 0) != bool(side) else 0
            node = parent
        return total

    costs = [cost(*o) for o in order]
    assert np.allclose(costs, sorted(costs))


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute(rows, 20), {}
    for r in entry.queries()["op1_nearest"](spark, sf).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(got) == set(want)
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.92
