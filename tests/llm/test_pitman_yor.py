import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rivulet.llm import pitman_yor as py


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0D]+", low), ""]


def base(rows):
    """{id: (n_tokens, n_known, N, base score)} from (id, held out, text)."""
    counts = Counter(t for _, held, text in rows if not held for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    return {i: (len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts))
            for i, _, text in rows for ts in [tokens_of(text)]}


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, h boolean, text string, score string")
    return {r["doc_id"]: r for r in py.score(df, F.col("h")).collect()}


def test_packing_round_trip():
    for values in ([], [0], [5, 3, 0], [1 << 40, 7], list(range(1000))):
        assert py.unpack(py.pack(np.array(values, np.int64))).tolist() == values
    x = np.random.default_rng(1).random(100).astype(np.float32)
    assert (py.unpack(py.pack(x)) == x).all()
    words = pa.array(["", "a", "é😀", "longer"], pa.large_string())
    assert py.unpack_strings(py.pack_strings(words)).to_pylist() == words.to_pylist()


def test_pairs_round_trip():
    rng = np.random.default_rng(8)
    buckets, bucket = 7, 3
    u = np.sort(np.concatenate([rng.integers(0, 50, 200) * buckets + bucket, rng.integers(0, 300, 20)]))
    w = rng.integers(0, 10_000, len(u))
    order = np.lexsort((w, u))
    u, w = u[order], w[order]
    got = py.unpack_pairs(*py.pack_pairs(u, w, bucket, buckets), bucket, buckets)
    assert (got[0] == u).all() and (got[1] == w).all() and got[2].sum() == len(u)
    counts = np.array([0, 1, 2, 10, 12345, 10**9])
    assert np.allclose(py.about_back(py.about(counts)), counts, rtol=0.1, atol=0.1)


def partitions(n):
    """Sizes of the tables of every seating of n customers."""
    seatings = [[]]
    for _ in range(n):
        seatings = [s[:i] + [s[i] + 1] + s[i + 1:] for s in seatings for i in range(len(s))] + [s + [1] for s in seatings]
    return seatings


def weight(tables, d):
    return math.prod(math.prod(i - d for i in range(1, size)) for size in tables)


def test_stirling_numbers_by_enumeration():
    s = py.stirling(0.3, 6)
    for n in range(1, 7):
        for t in range(1, n + 1):
            assert math.isclose(math.exp(s[n, t]), sum(weight(x, 0.3) for x in partitions(n) if len(x) == t), rel_tol=1e-9)


def test_reseating_follows_the_exact_conditional():
    d, strength, others, chance, n = 0.6, 1.5, 4, 0.2, 4
    exact = Counter()
    for x in partitions(n):
        exact[len(x)] += weight(x, d) * math.prod((strength + d * (others + j)) * chance for j in range(len(x)))
    total, k = sum(exact.values()), 40_000
    out = py.reseat(np.full(k, n), np.ones(k, np.int64), np.full(k, others), np.full(k, chance), d, strength, np.random.default_rng(2), py.stirling(d, py.EXACT))
    for t in range(1, n + 1):
        assert abs((out == t).mean() - exact[t] / total) < 0.01


def test_many_customers_open_as_many_tables_as_one_by_one():
    d, strength, others, chance, n, k = 0.5, 1.0, 30, 0.05, 400, 3000
    rng = np.random.default_rng(3)
    got = py.reseat(np.full(k, n), np.ones(k, np.int64), np.full(k, others), np.full(k, chance), d, strength, rng, py.stirling(d, py.EXACT))
    seats = np.ones(k)
    for i in range(1, n):
        new, old = (strength + d * (others + seats)) * chance, i - d * seats
        seats += rng.random(k) < new / (new + old)
    assert abs(got.mean() / seats.mean() - 1) < 0.05


def test_single_occurrences_have_one_seating(spark):
    rows = [(1, False, "a b c"), (2, True, "a b"), (3, True, "x c"), (4, True, None), (5, True, "")]
    got = run(spark, rows)
    v, d = 4, 0.95  # a, b, c and the end; every dish has one customer everywhere

    def p1(w):
        return ((1 - d if w in ("a", "b", "c", "") else 0) + (1 + d * v) / (v + 1)) / (1 + v)

    def p2(w, u):
        seen = u in ("a", "b", "c", "")
        own = 1 - d if (u, w) in (("", "a"), ("a", "b"), ("b", "c"), ("c", "")) else 0
        return (own + (1 + d * seen) * p1(w)) / (1 + seen)

    for i, _, text in rows:
        ts = tokens_of(text)
        want = sum(math.log10(p2(w, u)) for u, w in zip(["", *ts], ts))
        assert math.isclose(got[i]["score"], want, rel_tol=1e-6), i


@pytest.mark.parametrize("entries", [py.BUCKET_ENTRIES, 40])
def test_base_score_whatever_the_buckets(spark, monkeypatch, entries):
    monkeypatch.setattr(py, "BUCKET_ENTRIES", entries)  # the small value makes many buckets and splits contexts
    monkeypatch.setattr(py, "BLOCK_BYTES", 3000)
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, i % 4 == 1, " ".join(rnd.choices(words, weights=range(1, 31), k=rnd.randrange(40)))) for i in range(200)]
    rows += [(900, False, "W1\x0bw2\n\t w3  É"), (901, True, None), (902, True, "new words only"), (903, False, ""), (904, True, "w29 " * 30_000)]
    got, want = run(spark, rows), base(rows)
    assert set(got) == set(want)
    for i, (n, known, total, score) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) and math.isclose(r["base_score"], score, rel_tol=1e-9)
    assert got[901]["score"] == got[903]["score"]


def test_distribution_sums_to_one():
    rng = np.random.default_rng(5)
    restaurant = np.sort(rng.integers(0, 20, 400))
    customers = rng.geometric(0.4, 400)
    parent = rng.dirichlet(np.ones(400))
    d, mean, last = py.sample_tables(restaurant, customers, parent, 1, 1.0)
    assert (last >= 1).all() and (last <= customers).all() and (mean >= 1).all()
    kept = customers - d * mean
    for r in range(20):
        at = restaurant == r
        total, back = customers[at].sum(), (d * mean[at]).sum()
        assert math.isclose((kept[at].sum() + (1.0 + back)) / (1.0 + total), 1.0, rel_tol=1e-9)


def test_no_rows_and_no_training(spark):
    assert run(spark, [(1, True, "a b")])[1]["train_tokens"] == 0
    df = spark.createDataFrame([], "doc_id long, h boolean, text string")
    assert py.score(df, F.col("h")).count() == 0


def test_held_out_texts_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op4_language_model"](spark, sf).collect()
    docs = [(r["doc_id"], zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1, r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = base(docs)
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:3]
        assert math.isclose(r["base_score"], want[r["doc_id"]][3], rel_tol=1e-9)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, h, _ in docs if h}
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    print("held-out log10 per token:", sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held), sum(r["base_score"] for r in held) / sum(r["n_tokens"] for r in held))
