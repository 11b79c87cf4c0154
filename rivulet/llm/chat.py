r"""Chat formatting by grammar round trip.

A turn is rendered as ``### role\n`` text ``\n</turn>\n``. The parser is deterministic: ``### `` and
``</turn>`` are marks unless a backslash stands before them; a run of backslashes before a mark loses
one on reading. Every rendered turn is parsed again; where the recovered role or text is not the
source, that part is escaped one level further, until both are identical. A turn's rendering depends
on nothing else, so formatting needs no shuffle, and a conversation of any length is a sorted stream
of pieces, never one value.

Defined results: null role or text is empty; a null conversation is a conversation of its own; rows
of one turn number follow by role, then text; no rows, no conversations; repeated rows are repeated
turns; columns other than the four named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>"
MARK = re.compile(r"(\\*)(### |</turn>)")
MAX_LEVELS = 4


def escape_text(text: str) -> str:
    """One more backslash before every mark."""
    return MARK.sub(lambda m: "\\" + m[0], text)


def unescape_text(text: str) -> str:
    return MARK.sub(lambda m: m[0][1:] if m[1] else m[0], text)


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", role)


def render(role: str, text: str) -> str:
    """A turn from a role and a text that are already escaped."""
    return f"{OPEN}{role}\n{text}\n{CLOSE}\n"


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Turns as (role, text, start, end): unescaped, with the place of the escaped text. Raises ValueError."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"a turn must begin at {at}")
        line = formatted.find("\n", at)
        if line < 0:
            raise ValueError("the role has no end")
        close = next((m for m in MARK.finditer(formatted, line + 1) if not m[1]), None)
        if close is None or close[2] != CLOSE or close.start() <= line + 1:
            raise ValueError("the turn has no end, or a mark inside")
        end = close.start() - 1
        if formatted[end] != "\n" or formatted[close.end():close.end() + 1] != "\n":
            raise ValueError("the end mark does not stand alone")
        turns.append((unescape_role(formatted[at + len(OPEN):line]), unescape_text(formatted[line + 1:end]), line + 1, end))
        at = close.end() + 1
    return turns


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn and the place of its text, escaped until it reads back as given."""
    safe_role, safe_text = role, text
    for _ in range(MAX_LEVELS):
        formatted = render(safe_role, safe_text)
        try:
            turns = parse(formatted)
        except ValueError:
            turns = []
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return formatted, turns[0][2], turns[0][3]
        if unescape_role(safe_role) != role or "\n" in safe_role:
            safe_role = escape_role(safe_role)
        if unescape_text(safe_text) != text or any(not m[1] for m in MARK.finditer(safe_text)):
            safe_text = escape_text(safe_text)
    raise ValueError("the turn cannot be escaped")


def format_turns(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, turn, role, formatted, loss_start, loss_end: one rendered piece per row.

    The text of ``loss_role`` lies at characters loss_start to loss_end of the piece; for other
    roles both are null. The pieces of a conversation, in order, are its formatted text.
    """
    key = conversations.schema["conv_id"].dataType.simpleString()
    turn = conversations.schema["turn"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [format_turn(r, t) for r, t in zip(pdf["role"], pdf["text"])]
            masked = [r == loss_role for r in pdf["role"]]
            yield pd.DataFrame({
                "conv_id": pdf["conv_id"], "turn": pdf["turn"], "role": pdf["role"], "formatted": [r[0] for r in rows],
                "loss_start": pd.array([r[1] if m else None for r, m in zip(rows, masked)], dtype="Int64"),
                "loss_end": pd.array([r[2] if m else None for r, m in zip(rows, masked)], dtype="Int64")})

    source = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return source.mapInPandas(run, f"conv_id {key}, turn {turn}, role string, formatted string, loss_start bigint, loss_end bigint")


def _text_of(formatted: Column) -> Column:
    """The text of one rendered turn, unescaped; rows of one turn number follow by it."""
    inner = F.substring(formatted, F.instr(formatted, "\n") + 1, F.length(formatted) - F.instr(formatted, "\n") - len(f"\n{CLOSE}\n"))
    return F.regexp_replace(inner, r"\\(\\*(?:### |</turn>))", "$1")


def read_back(pieces: DataFrame) -> DataFrame:
    """What the formatted pieces hold, one row per conversation.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline of every turn), loss_chars,
    loss_sha256 (all text under the loss mask), formatted_chars. Pieces arrive sorted and are parsed
    and hashed one by one, so a task holds one turn at a time, however long a conversation is.
    """
    key = pieces.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None

        def row() -> tuple:
            return (current[1], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for pdf in batches:
            done = []
            for conv, null, piece, start, end in zip(pdf["conv_id"], pdf["_null"], pdf["formatted"], pdf["loss_start"], pdf["loss_end"]):
                key_now = (null, None if null else conv)
                if key_now != current:
                    if current is not None:
                        done.append(row())
                    current, state = key_now, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if start >= 0:
                    learned = unescape_text(piece[int(start):int(end)])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(piece)
            yield frame(done)
        if current is not None:
            yield frame([row()])

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"conv_id": "Int64"}) if whole else out

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    whole = key in ("tinyint", "smallint", "int", "bigint")
    ordered = (
        pieces.withColumn("_null", F.col("conv_id").isNull())
        .withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("loss_start", "loss_end")})
        .withColumn("conv_id", F.coalesce("conv_id", F.lit(0).cast(key)))
        .repartition("_null", "conv_id").sortWithinPartitions("_null", "conv_id", "turn", "role", _text_of(F.col("formatted"))))
    return ordered.mapInPandas(
        run, f"conv_id {key}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
