import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from rivulet.llm import leaks
from tests.llm.test_jaccard import brute
from tests.llm.test_secrets import base_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input of the first stage and output of every stage, as lists of rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rnd = random.Random(1)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    base = docs.orderBy("doc_id").collect()
    clean = next(r["text"] for r in base if r["lang"] == "en" and 300 < r["n_chars"] < 2000)
    near = clean.split(" ")
    near[rnd.randrange(len(near))] = "changed"
    planted = [(90_001, clean), (90_002, " ".join(near)), (90_003, f"The one and {item} it was"), (90_004, "The one and that it was token=abcdefgh12345 of the"),
               (90_005, "12345 67890"), (90_006, None)]
    more = spark.createDataFrame([(i, t, "en", "planted", len(t or "")) for i, t in planted], "doc_id long, text string, lang string, source string, n_chars int")
    docs = docs.unionByName(more.select(*[more[c].cast(docs.schema[c].dataType) for c in docs.columns]))
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        out.append(docs.collect())
    return out


def test_every_stage_returns_the_columns_of_documents(stages):
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]
    assert list(stages[-1][0].asDict()) == ["doc_id", "lang", "source", "ids", "n_tokens", "round_trip"]


def test_language_stage_drops_what_has_no_language_and_keeps_the_rest(stages):
    before, after = ({r["doc_id"] for r in s} for s in stages[:2])
    assert {90_005, 90_006} <= before - after and len(before - after) <= 2 + len(before) // 50


def test_one_document_of_each_group_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1]]
    assert {r["doc_id"] for r in stages[2]} == {i for i, c, _, _ in brute(rows) if i == c}
    assert not {90_001, 90_002} & {r["doc_id"] for r in stages[2]}


def test_benchmark_stage_drops_what_holds_an_item(spark, stages):
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in stages[3]}
    gone = [r for r in stages[2] if r["doc_id"] not in kept]
    assert all(not any(x in r["text"] for _, x in items) for r in stages[3]) and 90_003 in {r["doc_id"] for r in gone}
    block = leaks.Segments.build(items, leaks.Q, leaks.SEGMENT, leaks.STRIDE, leaks.EDIT_RATE)
    for r in gone:
        codes = leaks.characters(r["text"])
        assert leaks.find(block, block.filter_table(), codes, leaks.np.array([0, len(codes)]))


def test_secrets_are_replaced_and_nothing_is_dropped(stages):
    before, after = ({r["doc_id"]: r for r in s} for s in stages[3:5])
    assert set(before) == set(after)
    for i, r in after.items():
        assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not base_spans(before[i]["text"]) and "<SECRET>" not in r["text"]:
            assert r["text"] == before[i]["text"]
    assert after[90_004]["text"] == "The one and that it was <SECRET> of the"


def test_encoding_is_whole(stages):
    assert {r["doc_id"] for r in stages[5]} == {r["doc_id"] for r in stages[4]}
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in stages[5])


def test_registered_pipeline_is_the_stages_in_order(spark):
    assert [re.sub(r"\W+", " ", n) for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "n gram Jaccard join", "benchmark decontamination", "secret scans", "SentencePiece encoding and decoding"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert 0 < entry.queries()["pipeline"](spark, SF).count() <= spark.read.parquet(f"{SF}/documents.parquet").count()


def test_columns_of_the_operators_own_names_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["_letters", "letters", "_th", "text_hash", "_hits", "hits", "_lang_pred", "lang_accepted", "_k", "_h", "_n", "key", "copy", "label", "hash", "_text", "spans"]
    docs = docs.limit(60).select("*", *[F.when(F.col("doc_id") % 3 > 0, F.lit(n)).alias(n) for n in names])
    odd = [(None, docs.first()["text"]), (None, docs.first()["text"]), (90_001, None), (90_002, ""), (90_003, "one"), (90_003, "one")]
    more = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars int")
    docs = docs.unionByName(more, allowMissingColumns=True)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if "round_trip" not in out.columns:
            assert out.columns == docs.columns
            kept = {r["doc_id"]: r for r in docs.collect()}
            rows = out.collect()
            assert rows and all(r[n] == kept[r["doc_id"]][n] for r in rows for n in names)
    last = corpus_pipeline.encoded(spark, spark.createDataFrame(odd, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source"), SF)
    empty = last.where("doc_id = 90001").first()
    assert empty["ids"] is None and empty["n_tokens"] == 0 and empty["round_trip"] and last.count() == 6 and last.where("round_trip").count() == 6


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
