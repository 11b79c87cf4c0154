import random

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from rivulet.llm import langid
from rivulet.llm.registry import fold

PIECES = {"xx": ["ka", "lo", "mi", "nu"], "yy": ["strz", "prch", "vlk", "zed"], "zz": ["ão", "ñé", "ui", "ço"]}


def sentence(lang, rnd, words):
    return " ".join("".join(rnd.choices(PIECES[lang], k=rnd.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def model():
    rnd = random.Random(1)
    rows = [(sentence(lang, rnd, 30), lang) for lang in PIECES for _ in range(60)]
    rnd.shuffle(rows)
    return langid.train([r[0] for r in rows], [r[1] for r in rows])


def test_grams_are_those_of_a_plain_loop():
    words = pa.array(["ab", "é", "abc"], pa.large_string())
    bucket, owner = langid.grams(words)
    for i, w in enumerate(words.to_pylist()):
        raw = b"\x01" + w.encode() + b"\x01"
        assert (owner == i).sum() == sum(max(0, len(raw) - n + 1) for n in langid.GRAMS)
    alone = [set(langid.grams(words.slice(i, 1))[0]) for i in range(3)]
    assert [set(bucket[owner == i]) for i in range(3)] == alone


def test_prediction_is_the_mean_over_words(model):
    text = "kalo strzvlk kalo"
    logits, _ = langid._logits(model, pa.array([text], pa.large_string()))
    each = []
    for w in text.split():
        b, _ = langid.grams(pa.array([w], pa.large_string()))
        each.append(model.table[b].mean(axis=0))
    assert np.allclose(logits[0], np.mean(each, axis=0) + model.bias, atol=1e-5)


def test_languages_rejection_and_odd_rows(spark, model):
    rnd = random.Random(2)
    rows = [(i, sentence(lang, rnd, 12), lang) for i, lang in enumerate(list(PIECES) * 20)]
    odd = [(100, None, "x"), (101, "", "x"), (102, "123 !?", "x"), (103, sentence("yy", rnd, 60_000), "yy"), (103, "ka", "xx")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang_pred string")
    got = [(r["doc_id"], r["lang_pred"], r["lang_score"], r["lang_accepted"]) for r in langid.predict(df, model).collect()]
    by = {}
    for r in got:
        by.setdefault(r[0], []).append(r)
    assert all(by[i][0][1] == lang and by[i][0][3] for i, _, lang in rows)
    assert all(by[i][0][1:] == ("und", 0.0, False) for i in (100, 101, 102))
    assert {r[1] for r in by[103]} == {"yy", "xx"}
    foreign = spark.createDataFrame([(1, "ωψχ ξθφ ωωω θθθ")], "doc_id long, text string")
    assert not langid.predict(foreign, model).first()["lang_accepted"]
    assert langid.predict(df.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "hello", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert {r["lang_pred"] for r in langid.predict(df, model).collect()} == {"und"}


def test_familiarity_is_that_of_a_plain_loop(model):
    texts = ["kalo strzvlk Qwxj", "", "12", "Qwxj", "mikalo " * 9]
    _, got = langid._logits(model, pa.array(texts, pa.large_string()))
    for text, found in zip(texts, got):
        words = [w for w in text.split() if w.isalpha()]
        each = [np.mean(model.seen[langid.grams(pa.array([w.lower()], pa.large_string()))[0]]) for w in words]
        assert found == pytest.approx(sorted(each)[1 if len(each) == 2 else (len(each) - 1) // 2] if len(each) > 1 else len(each))


def test_least_bound():
    value, right = np.array([0.9, 0.8, 0.7, 0.7, 0.1]), np.array([True, True, True, False, False])
    assert langid.least_bound(value, right, 0.75) == 0.7 and langid.least_bound(value, right, 1.0) == 0.8
    assert langid.least_bound(value, right, 0.6) == 0.0 and langid.least_bound(value[3:], right[3:], 0.5) > 0.7


def test_foreign_and_junk_texts_are_rejected_at_the_stated_rate(spark):
    sf = "/root/testdata/sf0.1"
    model = langid.fit(spark.read.parquet(f"{sf}/documents.parquet").where(fold("doc_id") != 0))
    assert model.kept >= langid.KEEP - 0.01 and model.foreign_rejected >= 0.8
    foreign = ["Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita",
               "Szybki brązowy lis przeskakuje nad leniwym psem, a pogoda jest dzisiaj bardzo ładna i ciepła",
               "Den snabba bruna räven hoppar över den lata hunden och vädret är mycket fint idag", "aaaa bbbb cccc dddd",
               "De snelle bruine vos springt over de luie hond en het is vandaag weer heel mooi weer buiten in Amsterdam"]
    df = spark.createDataFrame(list(enumerate(foreign)), "doc_id long, text string")
    assert [r["text"] for r in langid.predict(df, model).where("lang_accepted").collect()] == []
    own = spark.read.parquet(f"{sf}/documents.parquet").where(fold("doc_id") == 0)
    assert langid.predict(own.where("text RLIKE '[a-z]'"), model).selectExpr("avg(int(lang_accepted))").first()[0] > 0.99


def test_fit_takes_every_language_and_long_texts(spark):
    rows = [(i, "ka lo " * 30_000, "long") for i in range(3)] + [(9, "1 " * 40_000 + "zed", "late")]
    rows += [(100 + i, f"wo{chr(97 + i % 26)}{chr(97 + i // 26)} rd", f"l{i}") for i in range(300)] + [(7, "same text", "copies")] * 900
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.fitting_sample(df, "text", "lang", "doc_id", 20).collect()
    assert {r["lang"] for r in got} == {"long", "late", "copies", *[f"l{i}" for i in range(300)]}
    assert all(len(r["text"]) <= langid.PASSAGE_CHARS and any(c.isalpha() for c in r["text"]) for r in got)
    assert sum(r["lang"] == "copies" for r in got) <= 40


def test_columns_of_the_operator_s_own_names(spark, model):
    df = spark.createDataFrame([(1, "kalo mi", 5, "a", 2.5)], "doc_id long, text string, letters int, _letters string, Letters_x double")
    got = langid.predict(df, model).first()
    assert got["letters"] == 5 and got["_letters"] == "a" and got["Letters_x"] == 2.5 and got["lang_pred"] == "xx"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op8_language_id"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", fold("doc_id").alias("f"))
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(r["held_out"] == (r["f"] == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and r["lang"] is not None]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert np.mean([r["lang_accepted"] for r in held]) > 0.97
