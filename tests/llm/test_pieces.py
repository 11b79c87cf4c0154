import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as pb

import __spark_entry__ as entry
from rivulet.llm import pieces
from rivulet.llm.q_pieces import MODEL_FILE

VOCABULARY = pieces.Vocabulary.load(MODEL_FILE)
ENCODER, DECODER = pieces.Encoder(VOCABULARY), pieces.Decoder(VOCABULARY)
TEXTS = st.text(st.one_of(st.sampled_from(list("the and ing\n  ▁é語😀\t0123")), st.characters(exclude_categories=["Cs"])), max_size=40)


def brute(text):
    """Best path over the whole text, one character at a time."""
    if not text:
        return []
    mark = {" ": pieces.MARK, pieces.MARK: "\U0010fffe"}
    s = [mark.get(c, c) for c in " " + text]
    table = {p: i for i, p in enumerate(VOCABULARY.pieces) if VOCABULARY.normal[i]}
    best = [(0.0, None, None)] + [None] * len(s)
    for j in range(1, len(s) + 1):
        for size in range(min(16, j), 0, -1):
            i = table.get("".join(s[j - size:j]))
            score = VOCABULARY.scores[i] if i is not None else ENCODER.unknown if size == 1 else None
            if score is not None and (best[j] is None or best[j - size][0] + score > best[j][0]):
                best[j] = (best[j - size][0] + score, size, i)
    out, j = [], len(s)
    while j:
        _, size, i = best[j]
        raw = (" " + text)[j - 1].encode()
        out = ([i] if i is not None else [VOCABULARY.byte_ids[b] for b in raw]) + out
        j -= size
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_best_path_and_round_trip(texts):
    ids = ENCODER.encode(pa.array(texts, pa.string()))
    assert ids.to_pylist() == [brute(t) for t in texts]
    assert DECODER.decode(ids).to_pylist() == texts


def test_agrees_with_the_library():
    proto = pb.ModelProto()
    proto.ParseFromString(open(MODEL_FILE, "rb").read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for p in proto.pieces:  # small whole numbers, which single precision adds exactly
        p.score = max(p.score, -40_000.0)
    model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    v = pieces.Vocabulary(VOCABULARY.pieces, tuple(model.get_score(i) for i in range(len(VOCABULARY.pieces))), VOCABULARY.normal,
                          VOCABULARY.byte_ids, True)
    texts = ["The quick brown fox", "  two  spaces\nand lines", "größer als 12345", "a", "naïve façade 😀!", "Ciónrr élève schule"]
    assert pieces.Encoder(v).encode(pa.array(texts)).to_pylist() == [model.encode(t) for t in texts]


def test_long_unit_crosses_windows():
    text = "abcdefghi" * 2_500
    ids = ENCODER.encode(pa.array([text]))
    assert ids.to_pylist()[0] == brute(text) and DECODER.decode(ids).to_pylist() == [text]


def test_rows_of_every_kind(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "x " * 100_000, 5), (4, "hello", 5), (4, "hello", 5), (None, " ▁ ", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = pieces.decode(pieces.encode(df, VOCABULARY), VOCABULARY).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(r[0]), r[1]) for r in rows)
    assert all(r["decoded"] == r["text"] for r in got)
    assert [r["ids"] for r in got if r["doc_id"] in (1, 2)] == [None, []]
    assert sorted(map(str, pieces.encode_and_decode(df, VOCABULARY).collect())) == sorted(map(str, got))
    assert pieces.encode(df.limit(0), VOCABULARY).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in entry.queries()["op9_sentencepiece"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs) and all(r["round_trip"] for r in got.values())
    for d in sorted(docs, key=lambda d: len(d["text"]))[:20]:
        assert got[d["doc_id"]]["n_tokens"] == len(brute(d["text"]))
    assert np.all([r["n_tokens"] > 0 for r in got.values()])


@pytest.mark.parametrize("size", [1, 7])
def test_reset_of_the_cache(size, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_UNITS", size)
    e = pieces.Encoder(VOCABULARY)
    for t in ("one two three", "two three four", "one"):
        assert e.encode(pa.array([t])).to_pylist() == [brute(t)]
