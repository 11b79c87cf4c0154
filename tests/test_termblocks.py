"""TF-IDF by blocks against plain Python, and what its shuffles carry."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rivulet.operators import termblocks as tb
from rivulet.operators import textmodel as tm

ROWS = [(1, "agua agua fuga calle agua", True), (2, "fuga calle", True), (2, "calle agua", True), (2, "medidor agua", False), (None, "agua lluvia", True),
        (None, "lluvia fuga", True), (5, "", True), (6, None, True), (7, "de la", True), (8, "nuevo fuga fuga", False), (9, "nuevo", False), (10, "calle fuga", None)]


def plain(n):
    """{(key, fitted): {term: weight}}."""
    counts = {}
    for key, text, fitted in ROWS:
        words = [w for w in (text or "").split() if w not in ("de", "la")]
        grams = [" ".join(words[i:i + size]) for size in range(1, n + 1) for i in range(len(words) - size + 1)]
        counts.setdefault((key, bool(fitted)), Counter()).update(grams)
    total, having = sum(bool(f) for *_, f in ROWS), Counter(t for (_, f), c in counts.items() if f for t in c)
    out = {}
    for k, c in counts.items():
        w = {t: (1 + math.log(tf)) * (math.log((1 + total) / (1 + having[t])) + 1) for t, tf in c.items() if having[t]}
        norm = math.sqrt(sum(x * x for x in w.values()))
        if w:
            out[k] = {t: x / norm for t, x in w.items()}
    return out


@pytest.mark.parametrize("n", [1, 2, 3])
def test_repeated_and_missing_keys_and_rows_that_are_not_fitted(spark, monkeypatch, n):
    monkeypatch.setattr(tb, "BLOCK_CHARS", 12)
    df = spark.createDataFrame(ROWS, "id bigint, text string, fitted boolean")
    want = plain(n)
    found = tb.tfidf_blocks(df, "id", "text", n, F.col("fitted")).collect()
    assert len(found) == len(want) and all(r.terms == sorted(r.terms) for r in found)
    for r in found:
        assert dict(zip(r.terms, r.weights)) == pytest.approx(want[r.id, r.fitted])
    hashed = {(r.id, r.fitted): sorted(r.weights) for r in tb.tfidf_blocks(df, "id", "text", n, F.col("fitted"), hashed=True).collect()}
    assert {k: pytest.approx(sorted(w.values())) for k, w in want.items()} == hashed


def test_no_texts(spark):
    assert tb.tfidf_blocks(spark.createDataFrame([], "id string, text string"), "id", "text").count() == 0


def test_entries_are_not_shuffled(spark):
    """Texts move by block, terms once per block; no exchange is by the term or of (text, term) rows."""
    df = spark.createDataFrame([(i, f"palabra{i % 7} otra{i % 3} mas{i}") for i in range(40)], "id bigint, text string")
    plan = tm.tfidf(df, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"hashpartitioning\((\w+?)#", plan)) == {"block", "bucket"} and "Generate" not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_keep_their_columns_and_one_of_a_key_is_first(spark):
    df = spark.createDataFrame([(k, t, f, f"c{i}") for i, (k, t, f) in enumerate(ROWS)], "id bigint, text string, fitted boolean, c string")
    found = tb.tfidf_blocks(df, "id", "text", 1, F.col("fitted"), keep=["c"]).collect()
    want = plain(1)
    assert sorted(r.c for r in found) == sorted(f"c{i}" for i in range(len(ROWS)))
    for r in found:
        assert dict(zip(r.terms, r.weights)) == pytest.approx({} if r.id is None else want.get((r.id, r.fitted), {}))
    assert len({(r.id, r.fitted) for r in found}) == sum(r.first for r in found)


def test_a_split_shuffles_no_texts_and_takes_the_first_of_each_class(spark):
    rows = [(f"texto {i}", "ab"[i % 5 == 0]) for i in range(90)] + [(None, "a"), ("sin clase", None), ("solo", "c")]
    df = spark.createDataFrame(rows, "text string, c string")
    parts = tm.split_by_text(df, "text", "c")
    assert "Exchange hashpartitioning" not in plan_of(parts) and "SortMergeJoin" not in plan_of(parts)
    hashes = df.select("text", "c", tm.text_hash(F.col("text")).alias("h")).where("h IS NOT NULL AND c IS NOT NULL").collect()
    want = {}
    for c in "abc":
        mine = sorted((r.h, r.text) for r in hashes if r.c == c)
        want |= {t: i < max(1, math.floor(len(mine) * 0.25 + 0.5)) for i, (_, t) in enumerate(mine)}
    assert {r.text: r.is_test for r in parts.collect()} == want


def test_vectors_are_scored_as_their_texts(spark):
    rows = [(i, f"agua fuga{i % 3} calle" if i % 2 else f"pago recibo{i % 4} fuga{i % 3}", "xy"[i % 2], i % 4 != 3) for i in range(40)]
    rows += [(50, "nada nuevo", "x", False), (50, "agua pago", "x", False), (51, "", "y", False)]
    df = spark.createDataFrame(rows, "id bigint, text string, c string, fitted boolean")
    train, test = df.where("fitted"), df.where("NOT fitted")
    counts, idf = tm.counted(train, "id", "text", 1)
    old = tm.centroid_model(tm.weigh(counts, idf, "id"), train, "id", "c")
    want = sorted(tm.score_with_model(test, "id", "text", idf, old["weights"], old["intercepts"], "c", 1).collect(), key=str)
    vectors = tb.tfidf_blocks(df, "id", "text", 1, F.col("fitted"), hashed=True, keep=["c"])
    model = tm.centroid_model(vectors.where("fitted"), train, "id", "c")
    got = sorted(tm.score_vectors(test, "id", vectors.where("NOT fitted AND first"), model["weights"], model["intercepts"], "c").collect(), key=str)
    assert [(r.id, r.c, r.known, pytest.approx(r.probability)) for r in got] == [(r.id, r.c, r.known, r.probability) for r in want]
    assert "hashpartitioning(id" not in plan_of(vectors)


def test_chunk_sizes_are_taken_once(spark):
    from rivulet.plans.texts import chunk_size_distribution

    out = chunk_size_distribution(spark, "/root/testdata/sf0.001")
    assert "documents.parquet" not in plan_of(out) and "part.parquet" not in plan_of(out)
