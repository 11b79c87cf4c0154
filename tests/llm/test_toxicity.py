import random

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from rivulet.llm import toxicity
from rivulet.llm.registry import fold

PLAIN = [f"word{i}" for i in range(300)]
RUDE = ["nasty", "vile", "rotten"]


def text(rnd, rude, words=60):
    out = rnd.choices(PLAIN, k=words)
    if rude:
        out[rnd.randrange(words)] = rnd.choice(RUDE)
    return " ".join(out)


@pytest.fixture(scope="module")
def model():
    rnd = random.Random(3)
    labels = [i % 4 == 0 for i in range(800)]
    return toxicity.train([text(rnd, y) for y in labels], [int(y) for y in labels], l1=4.0, alpha=0.5)


def test_features_are_those_of_a_plain_loop():
    docs = ["a b c d a b", "x", "", "c d"]
    got = {(int(t), int(b)) for bs, ts in toxicity.features(pa.array(docs, pa.large_string())) for b, t in zip(bs, ts)}
    counts = {}
    for i, d in enumerate(docs):
        w, seen = d.split(), set()
        for gaps in toxicity.SHAPES:
            offs = [0, *np.cumsum(gaps).astype(int)]
            seen |= {(gaps, tuple(w[j + o] for o in offs)) for j in range(len(w) - offs[-1])}
        counts[i] = len(seen)
    assert {i: sum(t == i for t, _ in got) for i in range(len(docs))} == counts
    again = {int(b) for bs, _ in toxicity.features(pa.array(["c d"], pa.large_string())) for b in bs}
    assert again == {b for t, b in got if t == 3}


def test_weights_are_sparse_and_right(model):
    assert 0 < len(model.buckets) < 3000
    rnd = random.Random(4)
    for rude in (0, 1):
        p = toxicity.scores(model, model.dense(), pa.array([text(rnd, rude) for _ in range(100)], pa.large_string()))
        assert np.mean((p >= 0.5) == rude) > 0.97


def test_score_is_a_plain_sum(model):
    d = "word1 vile word2 vile word3"
    active = {int(b) for bs, _ in toxicity.features(pa.array([d], pa.large_string())) for b in bs}
    total = model.bias + sum(w for b, w in zip(model.buckets, model.weights) if int(b) in active)
    got = toxicity.scores(model, model.dense(), pa.array([d], pa.large_string()))[0]
    assert abs(got - 1 / (1 + np.exp(-total))) < 1e-6


def test_odd_rows(spark, model):
    rnd = random.Random(6)
    rows = [(1, None, 5), (2, "", 5), (3, text(rnd, 0, 50_000) + " vile nasty rotten", 5), (4, text(rnd, 1), 5), (4, text(rnd, 1), 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic_score int")
    got = sorted((r["doc_id"], r["toxic_score"], r["toxic_predicted"]) for r in toxicity.predict(df, model).collect())
    base = 1 / (1 + np.exp(-model.bias))
    assert [r[0] for r in got] == [1, 2, 3, 4, 4] and abs(got[0][1] - base) < 1e-9 and got[0][1] == got[1][1]
    assert all(r[2] == 1 for r in got[2:])
    assert toxicity.predict(df.limit(0), model).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert {r["toxic_score"] for r in toxicity.predict(docs, model).collect()} == {0.5}


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = entry.queries()["op10_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic", fold("doc_id").alias("f"))
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("f = 0").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.02
