import random

import numpy as np
import pyarrow as pa
import pytest

from rivulet.llm import jaccard
from rivulet.llm.components import components


def sets_of(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(id, class_id, copy_id, n_links) by comparing everything with everything."""
    sets = [sets_of(t) for _, t in rows]
    n = len(rows)
    links = [[j for j in range(n) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        copies = [rows[j][0] for j in range(n) if sets[j] == sets[i]] if sets[i] else [rows[i][0]]
        out.append((rows[i][0], min(rows[j][0] for j in seen), min(copies), len(links[i])))
    return sorted(out)


def corpus(seed, families=12, size=8):
    rnd, rows = random.Random(seed), []
    words = [f"w{i}" for i in range(500)]
    for _ in range(families):
        base = rnd.choices(words, k=rnd.randint(3, 120))
        for _ in range(rnd.randint(1, size)):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            rows.append(" ".join(t) if rnd.random() < 0.7 else "  ".join(t).upper() + "\n")
    rows += [rows[0]] * 5 + ["", "  ", "one", "ONE", "two words", None]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, copy string")
    got = sorted(tuple(r) for r in jaccard.near_duplicates(df).select("doc_id", "class_id", "copy_id", "n_links").collect())
    assert got == brute(rows)


def test_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 300)
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(40):
        t = list(base)
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(100)] = f"x{rnd.randrange(1000)}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard.near_duplicates(df).select("doc_id", "class_id", "copy_id", "n_links").collect())
    assert got == brute(rows)


def test_prefixes_shorten_until_the_recall_is_reached(spark, monkeypatch):
    tried = []
    plain = jaccard._linked
    monkeypatch.setattr(jaccard, "_linked", lambda g, t, d: tried.append(d) or plain(g, t, d))
    df = spark.createDataFrame(corpus(4), "doc_id long, text string")
    jaccard.near_duplicates(df, target_recall=1.0).count()
    assert tried == list(range(jaccard.DEPTH, jaccard.LEAST_DEPTH - 1, -1))[:len(tried)] and len(tried) > 1


def test_signature_agreement_estimates_similarity():
    a = " ".join(f"w{i}" for i in range(300))
    b = " ".join(f"w{i}" if i % 40 else "x" for i in range(300))
    h, begin = jaccard.shingles(pa.array([a, b]))
    sig = jaccard.signatures(h, begin)
    true = len(sets_of(a) & sets_of(b)) / len(sets_of(a) | sets_of(b))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.12


def test_shingles_of_long_and_odd_texts():
    texts = ["a b c d e f", "a", "", None, "A B C D E F", "é\x0bñ a b c d " * 20_000]
    h, begin = jaccard.shingles(pa.array(texts))
    assert np.diff(begin).tolist() == [len(sets_of(t)) for t in texts]
    assert (h[begin[0]:begin[1]] == h[begin[4]:begin[5]]).all()


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_keep_one(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (2, long), (2, long), (3, long.replace("w30", "x")), (4, "other text"), (4, "other text"), (5, ""), (5, ""), (6, None),
            (None, long), (7, "same id a"), (7, "same id b"), (None, "lost"), (None, "lost")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, class_id string")
    got = sorted((str(r["doc_id"]), str(r["text"])[:12]) for r in jaccard.keep_one(df).collect())
    assert got == sorted([("1", long[:12]), ("4", "other text"), ("5", ""), ("5", ""), ("6", "None"), ("7", "same id a"), ("7", "same id b"), ("None", "lost")])
    assert jaccard.keep_one(df.limit(0)).count() == 0


def test_keep_one_moves_no_text_when_many_rows_are_dropped(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 3)
    rows = [(i, f"text number {i % 4} of the four") for i in range(24)] + [(None, "text number 1 of the four")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = jaccard.keep_one(df)
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 1, 2, 3]
    joins = [line for line in left._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftAnti" in line]
    assert len(joins) >= 7 and all("strategy=broadcast" in line for line in joins)


def test_query(agrees):
    agrees("op5_jaccard_join", "/root/testdata/sf0.01")
