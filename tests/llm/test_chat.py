import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from rivulet.llm import chat

PARTS = st.lists(st.sampled_from(["\\", "### ", "</turn>", "\n", "a", " ", "\\n", "é", "###", "</turn"]), max_size=8).map("".join)


@given(st.lists(st.tuples(PARTS, PARTS), max_size=4))
def test_any_turns_read_back(turns):
    pieces = [chat.format_turn(r, t) for r, t in turns]
    assert [(r, t) for r, t, _, _ in chat.parse("".join(p[0] for p in pieces))] == turns
    for (formatted, start, end), (_, text) in zip(pieces, turns):
        assert chat.unescape_text(formatted[start:end]) == text


def test_plain_text_is_not_escaped():
    assert chat.format_turn("user", "a # b \\ c")[0] == "### user\na # b \\ c\n</turn>\n"


@pytest.mark.parametrize("bad", ["x", "### user", "### user\nhello", "### user\na </turn> b\n</turn>\n", "### u\n### v\n\n</turn>\n"])
def test_parser_rejects(bad):
    with pytest.raises(ValueError):
        chat.parse(bad)


def test_nulls_ties_and_repeats(spark):
    rows = [(1, 1, "assistant", None, "x"), (1, 0, None, "q", "x"), (None, None, "user", "lost", "x"),
            (2, 0, "assistant", "b", "x"), (2, 0, "assistant", "a", "x"), (2, 0, "assistant", "a", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("\nq\nassistant\n\n") and got[1]["loss_chars"] == 0
    assert got[None]["n_turns"] == 1 and got[None]["loss_sha256"] == sha("")
    assert got[2]["loss_sha256"] == sha("aab") and got[2]["n_turns"] == 3
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_ties_follow_by_role_and_text_not_by_their_rendering(spark):
    texts = [("user", "### a"), ("user", "A"), ("user", "a"), ("user", "a\tb"), ("user", "a\nb"), ("user", "\\</turn>"), ("user", "[x"), ("a\\n", "z"), ("a\nb", "z"), ("a!", "z"), ("user", "")]
    df = spark.createDataFrame([(1, 0, *t) for t in texts[::-1]], "conv_id long, turn long, role string, text string").repartition(3)
    row = chat.read_back(chat.format_turns(df)).first()
    want = "".join(f"{r}\n{t}\n" for r, t in sorted(texts, key=lambda p: (p[0].encode(), p[1].encode())))
    assert row["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest() and row["n_turns"] == len(texts)


def test_very_long_text(spark):
    text = "\\</turn> ### " * 200_000
    df = spark.createDataFrame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string")
    row = chat.read_back(chat.format_turns(df)).first()
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_query(agrees):
    agrees("op3_chat_format")
