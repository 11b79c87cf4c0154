import random

import numpy as np
import pytest

import __spark_entry__ as entry
from rivulet.llm import leaks

LETTERS = "abcdefghijklmnop  "


def plain_edits(pattern, text):
    """Least edits of the whole pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(text, n, rnd):
    chars = list(text)
    for _ in range(n):
        i = rnd.randrange(len(chars))
        kind = rnd.choice("sid")
        if kind == "s":
            chars[i] = rnd.choice("qrstuvwxyz")
        elif kind == "i":
            chars.insert(i, rnd.choice("qrstuvwxyz"))
        else:
            del chars[i]
    return "".join(chars)


def words(rnd, n):
    return "".join(rnd.choices(LETTERS, k=n))


@pytest.mark.parametrize("seed", range(3))
def test_finds_what_plain_alignment_finds(seed):
    rnd = random.Random(seed)
    items = [(str(i), words(rnd, n)) for i, n in enumerate([8, 20, 60, 96, 97, 150, 300, 7])]
    block = leaks.Segments.build(items, leaks.Q, leaks.SEGMENT, leaks.STRIDE, leaks.EDIT_RATE)
    texts = ["", "short", words(rnd, 500)]
    for name, text in items:
        for n in (0, 1, 3, len(text) // 12, len(text) // 8):
            inner = edited(text, n, rnd)
            texts += [words(rnd, rnd.randrange(80)) + inner + words(rnd, rnd.randrange(80)), inner]
            cut = rnd.randrange(max(1, len(text) // 3))
            texts.append(words(rnd, 30) + text[cut:cut + 120])
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    got = {(t, i) for t, i, _, _ in leaks.find(block, block.filter_table(), leaks.characters("".join(texts)), offsets)}
    want = {(t, int(block.item[s])) for t, text in enumerate(texts) for s, c in enumerate(block.codes)
            if plain_edits("".join(map(chr, c)), text) <= block.budget[s]}
    assert got == want and len(want) > 40


def hits(items, texts):
    block = leaks.Segments.build(items, leaks.Q, leaks.SEGMENT, leaks.STRIDE, leaks.EDIT_RATE)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return leaks.find(block, block.filter_table(), leaks.characters("".join(texts)), offsets)


@pytest.mark.parametrize("n", [leaks.QUOTE, 96, 100, 120])
def test_a_quote_is_found_wherever_it_starts(n):
    rnd = random.Random(n)
    items = [(str(i), words(rnd, k)) for i, k in enumerate((345, 200, 97, 130))]
    texts, want = [], set()
    for i, (_, item) in enumerate(items):
        for a in range(len(item) - n + 1):
            want.add((len(texts), i))
            texts.append("".join(rnd.choices("QRSTUVWXYZ", k=rnd.randrange(120))) + item[a:a + n] + "".join(rnd.choices("QRSTUVWXYZ", k=50)))
    assert want <= {(t, i) for t, i, _, _ in hits(items, texts)}


def test_an_edited_quote_of_a_segment_and_a_stride_is_found():
    rnd = random.Random(3)
    item = words(rnd, 345)
    n = leaks.SEGMENT + leaks.STRIDE - 1
    texts = ["QRS" + edited(item[a:a + n], 9, rnd) + "TUV" for a in range(len(item) - n + 1)]
    assert {t for t, _, _, _ in hits([("x", item)], texts)} == set(range(len(texts)))


def test_items_shorter_than_a_qgram_are_looked_up_exactly(spark):
    items = [("a", "Kiwi"), ("b", "kiwi"), ("c", "x y"), ("d", ""), ("e", "  "), ("f", "abcdefg")]
    texts = ["two kiwis, a kiwi", "kiw", "ix\ny", "", "wi ab cdefg", "abcdefg", "kiwiabcdef"]
    got = sorted(hits(items, texts))
    names = [i for i in items if i[0] not in "de"]
    want = sorted((t, k, 0, leaks_text.find(leaks_item) + len(leaks_item)) for t, leaks_text in enumerate(x.replace("\n", " ") for x in texts)
                  for k, leaks_item in enumerate(i[1].lower() for i in names) if leaks_item in leaks_text)
    assert got == want and len(want) == 6
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = {(r["doc_id"], h["item"]) for r in leaks.mark(df, bench).collect() for h in r["leak_hits"]}
    assert found == {(t, names[k][0]) for t, k, _, _ in want}


def test_banded_alignment_is_exact_in_its_band():
    rnd = random.Random(9)
    for _ in range(50):
        pattern, text = words(rnd, 30), words(rnd, 60)
        a, b = leaks.characters(pattern)[None, :], leaks.characters(text)[None, :]
        edits, end = leaks._least_edits(a, b)
        assert edits[0] >= plain_edits(pattern, text)
        same = leaks._least_edits(b[:, 7:37], b)
        assert same[0][0] == 0 and same[1][0] == 37


def test_rows_of_every_kind(spark):
    rnd = random.Random(4)
    item = words(rnd, 200)
    items = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "tiny", "x"), (4, item, "x")], "item_id long, text string, doc_id string")
    long_text = words(rnd, 300_000) + "\n" + item.upper().replace(" ", "\n") + words(rnd, 1000)
    docs = [(1, None, 0), (2, "", 0), (3, long_text, 0), (4, item, 0), (4, item, 0), (None, "x" + item, 0), (5, words(rnd, 4000), 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, leak_hits int")
    got = leaks.mark(df, items).collect()
    found = {(r["doc_id"], h["item"], h["distance"]) for r in got for h in r["leak_hits"]}
    assert found == {(d, i, 0) for d in (3, 4, None) for i in ("1", "4")} and len(got) == len(docs)
    assert leaks.mark(df.limit(0), items).count() == 0
    assert all(r["leak_hits"] == [] for r in leaks.mark(df, items.limit(0)).collect())


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rnd = random.Random(5)
    items = [(i, words(rnd, 150)) for i in range(6)]
    df = spark.createDataFrame([(i, words(rnd, 50) + t) for i, t in items] + [(9, items[0][1] + items[5][1])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 200)
    found = {(r["doc_id"], h["item"]) for r in leaks.mark(df, bench).collect() for h in r["leak_hits"]}
    assert found == {(i, str(i)) for i in range(6)} | {(9, "0"), (9, "5")}


def test_query_finds_verbatim_items_and_nothing_clean(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in entry.queries()["op7_decontaminate"](spark, sf).collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    verbatim = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert verbatim and verbatim <= set(got) and all(got[p] == 0 for p in verbatim)
    for d, i in set(got) - verbatim:  # whatever else is found holds a segment with few edits
        block = leaks.Segments.build([("", items[i])], leaks.Q, leaks.SEGMENT, leaks.STRIDE, leaks.EDIT_RATE)
        norm = "".join(map(chr, leaks.characters(docs[d])))
        assert any(plain_edits("".join(map(chr, c)), norm) <= b for c, b in zip(block.codes, block.budget))
