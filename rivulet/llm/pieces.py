"""SentencePiece encoding and decoding by batched numpy Viterbi.

A text (with the vocabulary's dummy prefix) is cut where no piece can cross: before a run of spaces,
and around line ends. Distinct units of equal length form a matrix and advance together: rolling
hashes of all substrings of one length probe the sorted keys of the pieces of that length, matches are
compared character by character, and for every end position the maximum over all piece lengths stores
a backpointer. The path with the largest sum of piece scores wins; of equal paths, the one with the
longer last piece. Characters without a piece are written as byte pieces.

Spaces travel as the vocabulary's mark. A mark that stands in a text itself is written as bytes, so
decoding gives every text back exactly.

Defined results: null stays null and has no ids; the empty text has an empty list. Texts are encoded
one by one, so repeated rows give repeated results. Columns called like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from rivulet.llm.textblocks import bound_batches, flat_bytes, lean, strings
from rivulet.session import share

MARK = "▁"
TAKEN = 0x110000  # stands for a mark that is part of a text
BASE = np.uint64(0x9E3779B97F4A7C15)
CELLS = 200_000  # characters of a matrix
WINDOW = 8_192  # positions whose matches are held at once
CACHE_UNITS = 200_000
NO_PATH = -1e300


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id, their scores, which of them may be chosen, and the ids of the 256 byte pieces."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    normal: tuple[bool, ...]
    byte_ids: tuple[int, ...]
    prefix: bool

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a model file with byte pieces and no normalisation; the file is only read here, on the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = tuple(model.id_to_piece(i) for i in range(n))
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        at = {p: i for i, p in enumerate(pieces)}
        byte_ids = tuple(at[f"<0x{b:02X}>"] for b in range(256))
        return Vocabulary(pieces, tuple(model.get_score(i) for i in range(n)), tuple(not s for s in special), byte_ids,
                          bool(model.encode("a", out_type=str)[0].startswith(MARK)))


def _hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of every row."""
    h = np.zeros(len(codes), np.uint64)
    for j in range(codes.shape[1]):
        h = h * BASE + codes[:, j].astype(np.uint64) + np.uint64(1)
    return h


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Encoder:
    """Tables for probing and the units met so far; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        chosen = [i for i, ok in enumerate(v.normal) if ok and v.pieces[i]]
        self.lengths: dict[int, tuple] = {}
        for size in sorted({len(v.pieces[i]) for i in chosen}):
            ids = np.array([i for i in chosen if len(v.pieces[i]) == size])
            codes = np.array([_codes(v.pieces[i]) for i in ids], np.uint32).reshape(len(ids), size)
            keys = _hashes(codes)
            order = np.argsort(keys, kind="stable")
            keys, ids, codes = keys[order], ids[order], codes[order]
            assert len(np.unique(keys)) == len(keys), "two pieces share a hash"
            some = np.zeros(1 << 16, bool)  # first bits of all keys: most substrings are no piece
            some[(keys >> np.uint64(48)).astype(np.int64)] = True
            self.lengths[size] = keys, ids, codes, np.array([v.scores[i] for i in ids]), some
        self.longest = max(self.lengths, default=1)
        self.unknown = min((v.scores[i] for i in chosen), default=0.0) - 10
        normal = [v.pieces[i] for i in chosen]
        self.cut_spaces = not any(MARK in p.lstrip(MARK) for p in normal)
        self.cut_lines = not any("\n" in p for p in normal)
        self.reset()

    def reset(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64)  # ids of all units, and how many each has

    def _matches(self, codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the piece at every start; no piece: NO_PATH and -1."""
        keys, ids, table, scores, some = self.lengths[size]
        windows = np.lib.stride_tricks.sliding_window_view(codes, size, axis=1)
        k, n = windows.shape[:2]
        h = np.zeros((k, n), np.uint64)
        for j in range(size):
            h = h * BASE + windows[:, :, j].astype(np.uint64) + np.uint64(1)
        h = h.ravel()
        hit = np.flatnonzero(some[(h >> np.uint64(48)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(keys, h[hit]), len(keys) - 1)
        equal = keys[spot] == h[hit]
        hit, spot = hit[equal], spot[equal]
        row, col = np.divmod(hit, n)
        same = (windows[row, col] == table[spot]).all(axis=1)
        hit, spot = hit[same], spot[same]
        value, which = np.full(k * n, NO_PATH), np.full(k * n, -1, np.int64)
        value[hit], which[hit] = scores[spot], ids[spot]
        return value.reshape(k, n), which.reshape(k, n)

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, id) along the best path of every row of a matrix of characters; unknown ones are -1 - code."""
        k, n = codes.shape
        best = np.full((k, n + 1), NO_PATH)
        best[:, 0] = 0
        back, which = np.zeros((k, n + 1), np.int16), np.full((k, n + 1), -1, np.int64)
        sizes = [s for s in self.lengths if s <= n]
        rows = np.arange(k)
        for a in range(0, n, WINDOW):
            b = min(n, a + WINDOW)
            low = max(0, a - self.longest)
            found = {s: self._matches(codes[:, low:min(n, b)], s) for s in sizes if min(n, b) - low >= s}
            order = sorted(set(found) | {1}, reverse=True)  # the longest first, so that it wins a tie
            for end in range(a + 1, b + 1):
                here = [s for s in order if s <= end and (s in found or s == 1)]
                value, ids = np.empty((len(here), k)), np.empty((len(here), k), np.int64)
                for i, s in enumerate(here):
                    at = end - s - low
                    value[i], ids[i] = (found[s][0][:, at], found[s][1][:, at]) if s in found else (NO_PATH, -1)
                    if s == 1:
                        value[i][ids[i] < 0] = self.unknown
                    value[i] += best[:, end - s]
                top = value.argmax(axis=0)
                best[:, end] = value[top, rows]
                back[:, end] = np.array(here)[top]
                which[:, end] = ids[top, rows]
        trail, at, live = [], np.full(k, n), rows
        while len(live):
            here = at[live]
            ids = which[live, here]
            ids = np.where(ids < 0, -1 - codes[live, here - 1].astype(np.int64), ids)
            trail.append((live, ids))
            at[live] = here - back[live, here]
            live = live[at[live] > 0]
        who, ids = np.concatenate([t[0] for t in trail][::-1]), np.concatenate([t[1] for t in trail][::-1])
        order = np.argsort(who, kind="stable")
        return who[order], ids[order]

    def _learn(self, units: list[str]) -> None:
        """Encode units that were not met yet, all of one length together."""
        by_size: dict[int, list[str]] = {}
        for u in units:
            by_size.setdefault(len(u), []).append(u)
        space, taken = ord(" "), ord(MARK)
        flat, sizes, known = [self.flat], [self.sizes], len(self.sizes)
        for size, group in by_size.items():
            step = max(1, CELLS // size)
            for i in range(0, len(group), step):
                part = group[i:i + step]
                codes = _codes("".join(part)).reshape(len(part), size).copy()
                codes[codes == taken] = TAKEN
                codes[codes == space] = taken
                row, ids = self._with_bytes(*self.viterbi(codes))
                flat.append(ids.astype(np.int32))
                sizes.append(np.bincount(row, minlength=len(part)))
                self.slots.update(zip(part, range(known, known + len(part))))
                known += len(part)
        self.flat, self.sizes = np.concatenate(flat), np.concatenate(sizes)

    def _with_bytes(self, row: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters replaced by the pieces of their UTF-8 bytes."""
        unknown = np.flatnonzero(ids < 0)
        if not len(unknown):
            return row, ids
        chars, which = np.unique(-1 - ids[unknown], return_inverse=True)
        raw = [(MARK if c == TAKEN else chr(c)).encode("utf-8", "surrogatepass") for c in chars.tolist()]
        counts = np.ones(len(ids), np.int64)
        counts[unknown] = np.array([len(r) for r in raw])[which]
        table = np.zeros((len(raw), 4), np.int64)
        for i, r in enumerate(raw):
            table[i, :len(r)] = [self.vocabulary.byte_ids[b] for b in r]
        source = np.repeat(np.arange(len(ids)), counts)
        place = np.arange(len(source)) - np.repeat(np.cumsum(counts) - counts, counts)
        char = np.zeros(len(ids), np.int64)
        char[unknown] = which
        out = ids[source]
        return row[source], np.where(out < 0, table[char[source], np.minimum(place, 3)], out)

    def encode(self, texts: pa.Array) -> pa.Array:
        """list<int> of every text."""
        null = texts.is_null().to_numpy(zero_copy_only=False)
        full = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.vocabulary.prefix:
            full = pc.if_else(pc.equal(full, ""), full, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), full, pa.scalar("", pa.large_string())))
        data, offsets = flat_bytes(full)
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        if self.cut_spaces and len(data):
            space = data == 0x20
            first[:-1] |= space
            first[1:-1] &= ~(space[1:] & space[:-1])
        if self.cut_lines and len(data):
            line = data == 0x0A
            first[:-1] |= line
            first[1:] |= line
        first[offsets] = True
        first = first[:-1]
        starts = np.flatnonzero(first)
        units = strings(data, starts, np.append(starts[1:], len(data))).dictionary_encode()
        if len(self.sizes) > CACHE_UNITS:
            self.reset()
        names = units.dictionary.to_pylist()
        self._learn([u for u in names if u not in self.slots])
        slot = np.fromiter(map(self.slots.__getitem__, names), np.int64, len(names))
        unit = slot[units.indices.to_numpy()] if len(names) else slot
        per = self.sizes[unit]
        begin = np.cumsum(self.sizes) - self.sizes
        total = np.concatenate([[0], np.cumsum(per)]).astype(np.int64)
        ids = self.flat[np.repeat(begin[unit] - total[:-1], per) + np.arange(total[-1])]
        ends = total[np.searchsorted(starts, offsets)] if len(starts) else np.zeros(len(texts) + 1, np.int64)
        out = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
        return pc.if_else(pa.array(null), pa.scalar(None, out.type), out) if null.any() else out


class Decoder:
    """Bytes of every piece; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        raw = [p.replace(MARK, " ").encode() if ok else b"" for p, ok in zip(vocabulary.pieces, vocabulary.normal)]
        for b, i in enumerate(vocabulary.byte_ids):
            raw[i] = bytes([b])
        self.sizes = np.array([len(x) for x in raw], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.prefix = vocabulary.prefix

    def decode(self, ids: pa.Array) -> pa.Array:
        """The text of every list; null stays null."""
        null = ids.is_null().to_numpy(zero_copy_only=False)
        piece = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        per = self.sizes[piece]
        total = np.concatenate([[0], np.cumsum(per)]).astype(np.int64)
        data = self.flat[np.repeat(self.begin[piece] - total[:-1], per) + np.arange(total[-1])]
        offsets = total[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        if self.prefix:
            some = offsets[1:] > offsets[:-1]
            keep = np.ones(len(data), bool)
            keep[offsets[:-1][some]] = False
            data = data[keep]
            offsets = offsets - np.concatenate([[0], np.cumsum(some)])
        text = pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        return pc.if_else(pa.array(null), pa.scalar(None, text.type), text)


def _with_columns(df: DataFrame, source: str, targets: dict[str, str], make, vocabulary: Vocabulary) -> DataFrame:
    """``df`` with the named columns, of which ``make(vocabulary)`` gives the values for a batch of ``source``."""
    spark = df.sparkSession
    bound_batches(spark)
    shared = share(spark, vocabulary)
    df = df.select(*[c for c in df.columns if c not in targets or c == source])
    kept = [f for f in df.schema.fields if f.name not in targets]
    types = [pa.list_(pa.int32()) if kind.startswith("array") else pa.string() for kind in targets.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make(shared.value)
        for batch in batches:
            new = [x.cast(t) for x, t in zip(work(batch.column(source)), types)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *new], [*[f.name for f in kept], *targets])

    fields = ", ".join(f"`{n}` {k}" for n, k in [*[(f.name, f.dataType.simpleString()) for f in kept], *targets.items()])
    return df.mapInArrow(lean(run), fields)


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the piece ids of every whole text."""
    return _with_columns(df, text, {ids: "array<int>"}, lambda v: lambda x, e=Encoder(v): [e.encode(x)], vocabulary)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids spell."""
    return _with_columns(df, ids, {text: "string"}, lambda v: lambda x, d=Decoder(v): [d.decode(x)], vocabulary)


def encode_and_decode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the ids of every text and what they decode to, in one pass."""

    def make(v: Vocabulary):
        encoder, decoder = Encoder(v), Decoder(v)

        def work(x: pa.Array) -> list[pa.Array]:
            coded = encoder.encode(x)
            return [coded, decoder.decode(coded)]

        return work

    return _with_columns(df, text, {ids: "array<int>", decoded: "string"}, make, vocabulary)
