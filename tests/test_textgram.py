"""Products of texts and terms over blocks, against NumPy; what they store and move."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.operators import textgram as tg
from rivulet.operators import textlearn as tl
from rivulet.operators import textmodel as tm
from rivulet.session import discard, materialize


def test_products_are_those_of_the_matrix_for_any_cut_of_the_columns(spark, monkeypatch):
    rng = np.random.default_rng(0)
    a = np.where(rng.random((50, 30)) < 0.15, rng.random((50, 30)), 0)
    a[7] = 0  # an empty text
    a[:, 29], a[3, 29] = 0, 0.5  # a term of one text
    rows = [(i, [int(t) for t in np.flatnonzero(r)], [float(x) for x in r[r > 0]], i % 3 > 0) for i, r in enumerate(a)]
    df = spark.createDataFrame(rows, "id bigint, terms array<int>, weights array<double>, fitted boolean").repartition(3)
    gram, fitted, m = tg.TextGram(df, "id", "fitted", 5), np.arange(50) % 3 > 0, rng.random((6, 4))
    numbers = lambda z, width: np.array([r.v for r in gram.rows(z, np.eye(width)).orderBy("id").collect()])
    z = gram.start(6)
    u = numbers(z, 6)
    want = a @ a[fitted].T @ u[fitted] @ m
    assert gram.size == (a[fitted] > 0).any(axis=0).sum() and (gram.n, gram.fitted) == (50, fitted.sum())
    for most in (1, 4_000_000):
        monkeypatch.setattr(tg, "NUMBERS", most)
        y = gram.times(z, m, others=True)
        np.testing.assert_allclose(numbers(y, 4), want, atol=1e-9)
        np.testing.assert_allclose(gram.inner(z, y, m), (u[fitted] @ m).T @ want[fitted], atol=1e-9)
    plan = gram._columns(z, m, 0, True)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ids#" in line]
    assert scans and not any("Exchange" in line for line in scans)  # the entries stay where they lie


def test_latent_vectors_store_no_numbers_per_term(spark):
    """100 numbers per term of a growing vocabulary were what filled the disk."""
    words = 200
    rows = [(i, " ".join([f"comun{i % 4}", *(f"p{i}x{j}" for j in range(words))])) for i in range(60)]
    texts = spark.createDataFrame(rows, "id bigint, text string")
    vectors = tl.TextVectors(texts, "id", "text", 1)
    train = vectors.train.withColumn("fitted", F.lit(True))
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    size = lambda: sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(folder) for f in files)
    before = size()
    _, _, components = tl.latent_vectors(train, "id", "fitted", 4, components=40)
    assert components == 40 and size() - before < 60 * words * 40 * 8  # one number per term and dimension


def test_repeated_keys_are_one_text_with_their_sum(spark):
    schema = "id bigint, terms array<bigint>, weights array<double>, fitted boolean"
    rows = [(i, [1, 2 + i % 5, 9], [1.0, 0.5 + i, 0.25], True) for i in range(12)]
    twice = tg.TextGram(spark.createDataFrame([*rows, rows[4], (None, [], [], True)], schema).coalesce(1), "id", "fitted", 4, by_key=True)
    summed = [(k, t, [2 * x for x in w] if k == 4 else w, f) for k, t, w, f in rows]
    once = tg.TextGram(spark.createDataFrame(summed, schema).coalesce(1), "id", "fitted", 4)
    a, b = (np.linalg.eigvalsh(g.inner(g.start(5))) for g in (twice, once))
    np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)


def test_texts_are_scored_where_they_lie_as_from_the_tables(spark):
    rows = [(i, f"agua fuga{i % 3} calle" if i % 2 else f"pago recibo{i % 4} fuga{i % 3}", "xy"[i % 2], i % 4 != 3) for i in range(40)]
    rows += [(50, "nada nuevo", "x", False), (51, "", "y", False), (52, None, "y", False), (53, "", "x", True)]
    df = spark.createDataFrame(rows, "id bigint, text string, c string, fitted boolean")
    train, test = df.where("fitted"), df.where("NOT fitted")
    counts, idf = tm.counted(train, "id", "text", 1)
    model = tm.centroid_model(tm.weigh(counts, idf, "id"), train, "id", "c")
    want = sorted(tm.score_with_model(test, "id", "text", idf, model["weights"], model["intercepts"], "c", 1).collect(), key=str)
    got = sorted(tm.score_texts(df, "id", "text", F.col("fitted"), "c").collect(), key=str)
    assert [(r.id, r.c, r.known, pytest.approx(r.probability)) for r in got] == [(r.id, r.c, r.known, r.probability) for r in want]


def test_entries_are_packed_by_the_task_that_weighs_them(spark):
    """Vectors went from Python to the JVM and back before they were packed."""
    df = spark.createDataFrame([(i, f"agua fuga{i % 3}", "xy"[i % 2], i % 4 != 3) for i in range(12)], "id bigint, text string, c string, fitted boolean")
    pack = lambda rows, block: tg._packed(rows.rename_columns(["label" if c == "c" else c for c in rows.column_names]), block, False)
    packed = tg.tfidf_blocks(df, "id", "text", 1, F.col("fitted"), hashed=True, keep=["c"], packed=(pack, tg._schema("bigint", "string")))
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1 and "MapInArrow" not in plan.replace("FlatMapCoGroupsInArrow", "").replace("FlatMapGroupsInArrow", "")
    got = sorted((k, l, f) for r in packed.collect() for k, l, f in zip(r["keys"], r["labels"], r["fitted"]))
    assert got == sorted((r.id, r.c, r.fitted) for r in df.collect())
    gram = tg.TextGram.of_texts(df, "id", "text", F.col("fitted"), "c")
    assert gram.n == 12 and gram.fitted == 9 and gram.size == 4


def test_numbers_of_terms_come_back_from_their_mix():
    x = np.concatenate([np.arange(1000), np.random.default_rng(0).integers(-2**63, 2**63 - 1, 1000)])
    np.testing.assert_array_equal(tg.unmixed(tg._mix(x)), x)


def test_only_tables_of_the_shared_folder_are_removed(spark, tmp_path):
    kept = str(tmp_path / "kept")
    spark.range(3).write.parquet(kept)
    mine = materialize(spark.range(3))
    folder = mine.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0].replace("///", "/")
    discard(mine, spark.read.parquet(kept))
    assert not os.path.exists(folder) and spark.read.parquet(kept).count() == 3


def test_latent_vectors_leave_one_table(spark):
    """The numbers of every step stayed on the disk."""
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, [int(t) for t in rng.integers(0, 40, 6)], [1.0] * 6, i % 4 > 0) for i in range(60)],
                               "id bigint, terms array<int>, weights array<double>, fitted boolean")
    folder = materialize(df).sparkSession.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    out, _, _ = tl.latent_vectors(df, "id", "fitted", 3, components=5)
    assert len(set(os.listdir(folder)) - before) == 1 and out.count() == 60
