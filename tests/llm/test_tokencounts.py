"""Token counts against the tokenizer library, for whole texts and for every prefix."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from rivulet.llm import tokencounts

FILE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "s", "t", "re", "ve", "ll", "'", " ", "  ", "\n", "\t", "1", "23", "é", "日本", "!", "--", "<|endoftext|>", "<|endo", "ftext|>",
         "😀", "the", "ing", "՘", "Ᲊ", "Ǆ", "\r\n", "'s", "'re", "'ll", " ", " ", "ſ"]


@pytest.fixture(scope="module")
def vocabulary():
    return tokencounts.Vocabulary.load(FILE)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(FILE)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_every_prefix_has_the_library_s_count(vocabulary, library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 22))) for _ in range(1_500)] + [" " * 300, "ab" * 400, "", "<|endoftext|>" * 3]
    lists = tokencounts.Counter(vocabulary).lists(pa.array([*texts, None])).to_pylist()
    assert lists[-1] == [0]
    for text, found in zip(texts, lists):
        assert found == [0] + library([text[:i] for i in range(1, len(text) + 1)]), text


def test_a_small_cache_gives_the_same_counts(vocabulary, monkeypatch):
    texts = pa.array([" ".join(random.Random(i).choices(PARTS, k=30)) for i in range(60)])
    whole = tokencounts.Counter(vocabulary).lists(texts).to_pylist()
    monkeypatch.setattr(tokencounts, "CACHE_UNITS", 5)
    counter = tokencounts.Counter(vocabulary)
    assert [x for i in range(60) for x in counter.lists(texts.slice(i, 1)).to_pylist()] == whole


def test_query_equals_the_library(spark, library):
    found = {r["doc_id"]: r for r in entry.queries()["op12_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {k: r["n_tokens"] for k, r in found.items()} == dict(zip(texts, library(list(texts.values()))))
    assert all(r["n_bytes"] == len(texts[k].encode()) and r["over_limit"] == (r["n_tokens"] > 1024) for k, r in found.items())
    for k, r in found.items():
        cut = texts[k][:r["kept_chars"]]
        assert library([cut])[0] == r["kept_tokens"] <= 1024
        assert (r["kept_chars"] == len(texts[k])) == (r["n_tokens"] <= 1024)


def test_stored_counts_answer_budgets(spark, vocabulary, library):
    text = "they'll  meet   again <|endoftext|> at 12:30, won't they?"
    df = spark.createDataFrame([(1, text, "x"), (1, text, "y"), (2, None, None), (3, "", "z")], "k int, text string, prefix_tokens string")
    stored = tokencounts.prefix_counts(df, vocabulary)
    assert stored.columns == ["k", "text", "prefix_tokens"] and stored.count() == 4
    p = F.col("prefix_tokens")
    rows = stored.select("k", *[tokencounts.longest_prefix(p, F.lit(b)).alias(f"cut{b}") for b in (-1, 0, 5, 99)], tokencounts.tokens_of_prefix(p, F.lit(9)).alias("nine"),
                         tokencounts.fits(p, F.lit(5)).alias("fits")).collect()
    counts = [0] + library([text[:i] for i in range(1, len(text) + 1)])
    for r in rows:
        assert r["cut-1"] is None
        if r["k"] == 1:
            assert (r["cut0"], r["cut5"], r["cut99"]) == (0, max(i for i, n in enumerate(counts) if n <= 5), len(text))
            assert r["nine"] == counts[9] and not r["fits"]
        else:
            assert (r["cut0"], r["cut5"], r["nine"], r["fits"]) == (0, 0, 0, True)


def test_empty_table_and_other_files(spark, vocabulary):
    empty = spark.createDataFrame([], "n_tokens int, text string")
    assert tokencounts.measured(empty, vocabulary, 10).collect() == []
    with pytest.raises((ValueError, KeyError)):
        tokencounts.Vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))
