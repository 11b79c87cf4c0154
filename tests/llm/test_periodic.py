"""Periodic runs against trying every period at every place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa

import __spark_entry__ as entry
from rivulet.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > start and i + q - start >= max(24, 3 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def some_words(rng):
    w, v = [], rng.choice([1, 2, 3, 5, 50])
    for _ in range(rng.randint(0, 6)):
        if rng.random() < .4:
            w += [str(rng.randint(1, v)) for _ in range(rng.randint(1, 40))]
        else:
            block = [str(rng.randint(1, v)) for _ in range(rng.randint(1, 20))] * rng.randint(2, 9)
            w += block[:rng.randint(len(block) // 2, len(block))] * rng.choice([1, 1, 2])
    return w * rng.choice([1, 1, 1, 2, 4])


def found_in(texts):
    lists, kept = periodic._batch(pa.array(texts, pa.string()))
    return [[(r["start"], r["length"], r["period"]) for r in x] for x in lists.to_pylist()], kept.to_pylist()


def test_random_texts_equal_all_periods_tried():
    rng = random.Random(11)
    for _ in range(40):
        words = [some_words(rng) for _ in range(rng.randint(1, 20))]
        texts = [rng.choice(["", " ", "\n"]) + rng.choice([" ", "  ", "\x0b\t"]).join(w) + rng.choice(["", " "]) for w in words]
        found, kept = found_in([*texts, None])
        assert found == [*map(plain_runs, words), []]
        assert kept == [*(plain_collapsed(w, f) for w, f in zip(words, found)), ""]


def test_grammar_spells_the_words_and_no_pair_repeats():
    rng = np.random.default_rng(3)
    for size, kinds in ((500, 2), (2_000, 5), (60, 1)):
        words = rng.integers(0, kinds, size)
        g = periodic.grammar(words)

        def spell(symbol):
            return [symbol] if symbol < g.base else spell(g.left[symbol - g.base]) + spell(g.right[symbol - g.base])

        assert [x for s in g.top for x in spell(s)] == words.tolist()
        pairs = [tuple(p) for p in zip(g.top, g.top[1:])]
        apart = {}
        for i, p in enumerate(pairs):
            if not apart.get(p) or apart[p][-1] < i - 1:
                apart.setdefault(p, []).append(i)
        assert max(map(len, apart.values()), default=1) == 1
        for left, right, place, border, end in zip(g.left, g.right, g.place, g.border, g.end):
            assert spell(left) + spell(right) == words[place:end].tolist() and len(spell(left)) == border - place


def test_special_sequences():
    thue = " ".join("ab"[i.bit_count() & 1] for i in range(4_096))  # free of cubes
    x, y = "a", "a b"
    while len(y) < 3_000:
        x, y = y, y + " " + x
    texts = [thue, y, "a " * 5_000, " ".join(str(i % 701) for i in range(3_000)), "z " * 23, "z " * 24, "é\xa0 " * 24]
    found, kept = found_in(texts)
    assert found == [plain_runs(WORD.findall(t)) for t in texts]
    assert found[0] == [] and found[2] == [(0, 5_000, 1)] and found[3] == [(0, 3_000, 701)] and found[4] == [] and found[5] == [(0, 24, 1)]
    assert kept[2] == "a" and kept[6] == "é\xa0"


def test_a_run_s_ends_are_exact_when_hashes_collide(monkeypatch):
    monkeypatch.setattr(periodic, "PRIMES", (np.uint64(65_521),))  # too few bits: some batches are computed again
    rng = random.Random(5)
    words = [some_words(rng) for _ in range(60)]
    assert found_in([" ".join(w) for w in words])[0] == [plain_runs(w) for w in words]


def expected(doc_id, text):
    w = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = plain_runs(w)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{m},{q}\n" for s, m, q in found), plain_collapsed(w, found))]
    return (len(found), *best, 1000 * best[1] // best[2] if found else None, *sha)


def test_query(spark):
    job = entry.queries()["op11_periodic_runs"]
    found = {r[0]: tuple(r)[1:] for r in job(spark, "/root/testdata/sf0.001").collect()}
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in texts if len(r["text"] or "") < 30_000]
    assert len(found) == len(texts) and len(short) > 150
    for r in short:
        assert found[r["doc_id"]] == expected(*r)
    assert sum(x[0] > 0 for x in found.values()) >= 10


def test_nulls_repeats_clashing_names_and_empty_tables(spark, tmp_path):
    rows = [(10, "x y " * 30, 1), (10, "x y " * 30, 1), (11, None, 2), (None, "a", 3), (12, "", 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    out = periodic.periodic_runs(df)
    assert set(out.columns) == {"doc_id", "text", "runs", "collapsed"}
    got = sorted((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect())
    assert got == [(0, [], "a"), (10, [(0, 60, 2)], "x y"), (10, [(0, 60, 2)], "x y"), (11, [], ""), (12, [], "")]
    df.drop("runs").write.parquet(f"{tmp_path}/documents.parquet")
    assert entry.queries()["op11_periodic_runs"](spark, str(tmp_path)).count() == 5
    assert periodic.periodic_runs(df.limit(0)).collect() == []
