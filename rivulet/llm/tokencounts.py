"""Token counts at every prefix of a text, by dynamic programming over the prefixes.

For a byte-pair vocabulary the encoding of a prefix ends in exactly one token, and two tokens may stand
side by side exactly when encoding their joined bytes gives the two back. So the encoding of a prefix of
length i is that of the prefix of length i - len(t) and the one token t that ends at i and fits the token
before it: the count of every prefix follows from shorter ones, no prefix is encoded again, and all of
them are exact.

The dynamic program runs once per distinct unit (a stretch that the vocabulary's splitting rule keeps
together); the counts of a text's prefixes are those of its units plus the tokens before. Where cutting a
text changes the units before the cut (runs of white space, contractions, special strings), the count is
that of the cut text.

``prefix_counts`` stores, per text, the count of every prefix in characters, 0 to all: truncation and
budgets are then lookups (``tokens_of_prefix``, ``longest_prefix``, ``fits``) without encoding anything.
A longer prefix may have fewer tokens, so the longest prefix within a budget is looked for in all of them.
``measured`` returns only the totals and one limit's cut, from the same table, which then stays in the task.

Defined results: a null text counts as empty; the empty text has 0 tokens and one prefix. Texts are
counted one by one, so repeated rows repeat. Columns called like a result are replaced. Memory holds
one Arrow batch (1 MB, or a single longer text) times the 4 bytes per character of its counts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.textblocks import bound_batches, flat_bytes, lean, strings
from rivulet.session import share

#: Distinct units, and characters of them, that a task remembers before it starts anew.
CACHE_UNITS, CACHE_CHARS = 300_000, 6_000_000
NEVER = 1 << 60
LETTER, DIGIT, SPACE, OTHER, SPECIAL = range(5)
#: The contractions that the splitting rule keeps together.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def character_classes(tokenizer) -> np.ndarray:
    """Letter, digit, white space or other, for every code point.

    Characters that this Python does not know yet are asked of the tokenizer itself, as libraries follow different editions of Unicode.
    """
    import unicodedata

    kinds = np.full(0x110000, OTHER, np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text = "".join(map(chr, points))
    number = np.array(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            kinds[number[m.start():m.end()]] = kind
    for c in np.flatnonzero(kinds < SPACE).tolist():
        if unicodedata.category(chr(c)) == "Cn":
            alone = [len(tokenizer.pre_tokenize_str(x + chr(c))) == 1 for x in ("a", "1")]
            kinds[c] = LETTER if alone[0] else DIGIT if alone[1] else OTHER
    return kinds


@dataclass(frozen=True)
class Vocabulary:
    """Tokens as bytes, merges by pair (rank and result), special strings, and the class of every code point."""

    tokens: dict[int, bytes]
    merges: dict[tuple[int, int], tuple[int, int]]
    specials: tuple[str, ...]
    kinds: np.ndarray

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a byte-level file; it is only read here, on the driver. Settings that the counts do not follow are refused."""
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, split = data["model"], data["pre_tokenizer"]
        simple = model["type"] == "BPE" and split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if not simple or odd or data["normalizer"] or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in data["added_tokens"]):
            raise ValueError(f"not a plain byte-level vocabulary: {path}")
        letters = byte_letters()
        specials = {a["content"] for a in data["added_tokens"]}
        tokens = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if t not in specials}
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            merges[model["vocab"][a], model["vocab"][b]] = rank, model["vocab"][a + b]
        if len({new for _, new in merges.values()}) < len(merges):
            raise ValueError(f"a token with two merges: {path}")
        return Vocabulary(tokens, merges, tuple(sorted(specials, key=lambda s: (-len(s), s))), character_classes(Tokenizer.from_file(path).pre_tokenizer))

    @cached_property
    def single(self) -> list[int]:
        """The token of every byte."""
        of = {t[0]: i for i, t in self.tokens.items() if len(t) == 1}
        return [of[b] for b in range(256)]

    def encode(self, raw: bytes) -> list[int]:
        """Merge the pair of least rank, the first of equal ones, until none is left. For short strings."""
        ids = [self.single[b] for b in raw]
        while len(ids) > 1:
            found = [(m[0], i, m[1]) for i in range(len(ids) - 1) if (m := self.merges.get((ids[i], ids[i + 1])))]
            if not found:
                break
            _, i, new = min(found)
            ids[i:i + 2] = [new]
        return ids


class Counter:
    """The dynamic program and the units met so far; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        self.child: dict[int, int] = {}  # (node * 256 + byte): node, of a tree of the tokens read from their end
        self.token = [-1]
        for i, raw in v.tokens.items():
            node = 0
            for b in reversed(raw):
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = len(self.token)
                    self.token.append(-1)
                node = nxt
            self.token[node] = i
        self.made = {new: (pair, rank) for pair, (rank, new) in v.merges.items()}
        self.edges: tuple[dict, dict] = ({}, {})
        self.reset()

    def reset(self) -> None:
        self.pairs: dict[tuple[int, int], bool] = {}
        self.slots: dict[str, int] = {}
        self.flat, self.begin, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The symbols at one end of a token while it is built, last first, and the rank of the merge that ends each."""
        known = self.edges[right].get(token)
        if known is None:
            known, at, rank = [], token, NEVER
            while True:
                known.append((at, rank))
                if at not in self.made:
                    break
                pair, rank = self.made[at]
                at = pair[right]
            self.edges[right][token] = known
        return known

    def _fits(self, left: int, right: int) -> bool:
        """Whether the two tokens may stand side by side; left -1: whether the right one may stand alone.

        They may not if some merge across their border comes before the merges that end its two symbols; of
        equal ranks the leftmost merge is first.
        """
        v = self.vocabulary
        if left < 0:
            ok = v.encode(v.tokens[right]) == [right]
        else:
            ok = self._fits(-1, right) if (alone := self.pairs.get((-1, right))) is None else alone
            ours, theirs, i, j = self._edge(left, True), self._edge(right, False), 0, 0
            while ok:
                (a, end_a), (b, end_b) = ours[i], theirs[j]
                merge = v.merges.get((a, b))
                if merge and merge[0] < end_a and merge[0] <= end_b:
                    ok = False
                # the symbol that was made last is the first to go when time runs backwards
                born_a = ours[i + 1][1] if i + 1 < len(ours) else -1
                born_b = theirs[j + 1][1] if j + 1 < len(theirs) else -1
                if born_a < 0 and born_b < 0:
                    break
                i, j = (i + 1, j) if born_a > born_b else (i, j + 1)
        self.pairs[left, right] = ok
        return ok

    def unit(self, raw: bytes, last: list[int], count: list[int]) -> None:
        """Carry the last token and the number of tokens of every prefix in bytes on to the end of ``raw``."""
        child, token, pairs = self.child, self.token, self.pairs
        for end in range(len(last), len(raw) + 1):
            node, at = 0, end
            while True:
                at -= 1
                node = child[node << 8 | raw[at]]
                t = token[node]
                if t >= 0:
                    before = last[at]
                    ok = pairs.get((before, t))
                    if ok if ok is not None else self._fits(before, t):
                        break
            last.append(t)
            count.append(count[at] + 1)

    def _learn(self, units: list[str]) -> None:
        flat, sizes, last, count, done = [], [], [-1], [0], b""
        for raw, u in sorted((u.encode(), u) for u in units):
            same = len(commonprefix((done, raw)))  # prefixes shared with the unit before keep their counts
            del last[same + 1:], count[same + 1:]
            self.unit(raw, last, count)
            flat += count[1:] if len(raw) == len(u) else [c for i, c in enumerate(count) if i and (i == len(raw) or raw[i] & 0xC0 != 0x80)]
            sizes.append(len(u))
            self.slots[u] = len(self.sizes) + len(sizes) - 1
            done = raw
        self.flat = np.concatenate([self.flat, np.array(flat, np.int32)])
        self.sizes = np.concatenate([self.sizes, np.array(sizes, np.int64)])
        self.begin = np.cumsum(self.sizes) - self.sizes
        if len(self.pairs) > CACHE_UNITS:
            self.pairs.clear()

    def _slots(self, units: pa.Array) -> np.ndarray:
        """The slot of every unit; new ones are learned."""
        coded = units.dictionary_encode()
        names = coded.dictionary.to_pylist()
        new = [u for u in names if u not in self.slots]
        if len(self.sizes) + len(new) > CACHE_UNITS or len(self.flat) > CACHE_CHARS:
            self.reset()
            new = names
        self._learn(new)
        slot = np.fromiter(map(self.slots.__getitem__, names), np.int64, len(names))
        return slot[coded.indices.to_numpy()] if len(names) else slot

    def prefixes(self, texts: pa.Array, specials: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count after every character of all texts joined, offsets of the texts in characters, in bytes)."""
        data, offsets = flat_bytes(texts)
        head = (data & 0xC0) != 0x80
        place = np.append(np.flatnonzero(head), len(data))  # byte of every character
        ends = np.concatenate([[0], np.cumsum(head)])[offsets]
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        n = len(codes)
        if not n:
            return np.empty(0, np.int64), ends, offsets
        kind, edge = self.vocabulary.kinds[codes], np.zeros(n + 1, bool)
        edge[ends] = True
        marks = self._special(data, head, ends, edge) if specials else []
        for a, b in marks:
            kind[a:b] = SPECIAL
            edge[[a, b]] = True
        start = self._starts(codes, kind, edge)
        first = np.flatnonzero(start)
        cut = place[np.append(first, n)]
        base_texts = strings(data, cut[:-1], cut[1:])
        plain = kind[first] != SPECIAL
        slot = self._slots(base_texts.filter(pa.array(plain)))
        sizes = np.diff(np.append(first, n))
        count = np.ones(n, np.int64)
        offset = np.arange(n) - np.repeat(first, sizes)
        begin = np.zeros(len(first), np.int64)
        begin[plain] = self.begin[slot]
        inner = np.repeat(plain, sizes)
        count[inner] = self.flat[(np.repeat(begin, sizes) + offset)[inner]]
        total = np.cumsum(count[np.append(first[1:], n) - 1])
        before = np.concatenate([[0], total[:-1]])
        text = np.searchsorted(ends, first, side="right") - 1
        before -= before[np.searchsorted(first, ends[:-1][text])]
        whole = np.repeat(before, sizes)
        count += whole
        self._cut_spaces(data, place, kind, edge, first, before, count)
        self._cut_contractions(codes, edge, start, first, before, count)
        for a, b in marks:
            self._cut_special(codes, a, b, kind, ends, first, before, count)
        return count, ends, offsets

    def _special(self, data: np.ndarray, head: np.ndarray, ends: np.ndarray, edge: np.ndarray) -> list[tuple[int, int]]:
        """Character ranges of special strings that lie inside one text."""
        if not self.vocabulary.specials:
            return []
        raw = data.tobytes()
        if not any(s.encode() in raw for s in self.vocabulary.specials):
            return []
        chars = np.concatenate([[0], np.cumsum(head)])
        pattern = regex.compile("|".join(map(regex.escape, self.vocabulary.specials)).encode())
        bytes_of, found = np.append(np.flatnonzero(head), len(data))[ends], []
        for a, b in zip(bytes_of[:-1].tolist(), bytes_of[1:].tolist()):
            if b > a:
                found += [(int(chars[m.start()]), int(chars[m.end()])) for m in pattern.finditer(raw, a, b)]
        return found

    def _starts(self, codes: np.ndarray, kind: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """The first character of every unit."""
        n = len(codes)
        start = edge[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        start |= kind == SPECIAL
        start[1:] &= edge[1:n] | (kind[1:] != SPECIAL)
        after = 1 + np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~edge[1:n])  # the last white space before it is a unit, or joins it
        start[after - 1] = True
        start[after] = codes[after - 1] != 0x20
        for at, word in self._contractions(codes, edge, start):
            start[at + 1] = False
            nxt = at + 1 + len(word)
            start[nxt[nxt < n]] = True
        return start

    def _contractions(self, codes: np.ndarray, edge: np.ndarray, start: np.ndarray) -> list[tuple[np.ndarray, str]]:
        """Places of apostrophes that begin a unit and are followed by one of the endings."""
        n = len(codes)
        marks = np.flatnonzero(start & (codes == 0x27))
        found = []
        for word in CONTRACTIONS:
            at = marks[marks + len(word) < n]
            for i, c in enumerate(word, 1):
                at = at[(codes[at + i] == ord(c)) & ~edge[at + i]]
            found.append((at, word))
        return found

    def _cut_spaces(self, data, place, kind, edge, first, before, count) -> None:
        """A prefix that ends with a run of white space has the whole run as one unit."""
        n = len(kind)
        space = kind == SPACE
        begin = np.flatnonzero(space & (edge[:n] | np.concatenate([[True], ~space[:-1]])))
        stop = 1 + np.flatnonzero(space & (edge[1:] | np.concatenate([~space[1:], [True]])))
        some = (stop - begin > 1) & ~edge[stop]
        begin, stop = begin[some], stop[some]
        if len(begin):
            slot = self._slots(strings(data, place[begin], place[stop]))
            count[stop - 1] = before[np.searchsorted(first, begin)] + self.flat[self.begin[slot] + self.sizes[slot] - 1]

    def _cut_contractions(self, codes, edge, start, first, before, count) -> None:
        """A prefix that ends inside a contraction has the apostrophe and the letter as two units."""
        for at, word in self._contractions(codes, edge, start):
            if len(word) > 1 and len(at):
                slot = self._slots(pa.array(["'", word[0]], pa.large_string()))
                count[at + 1] = before[np.searchsorted(first, at)] + int(self.flat[self.begin[slot]].sum())

    def _cut_special(self, codes, a: int, b: int, kind, ends, first, before, count) -> None:
        """A prefix that ends inside a special string has it as ordinary text, together with the unit before it."""
        begins = ends[np.searchsorted(ends, a)] == a or kind[a - 1] == SPECIAL
        low = a if begins else int(first[np.searchsorted(first, a) - 1])
        base = int(before[np.searchsorted(first, low)])
        tail = codes[low:b].tobytes().decode("utf-32-le")
        inner, _, _ = self.prefixes(pa.array([tail], pa.large_string()), specials=False)
        count[a:b - 1] = base + inner[a - low:b - 1 - low]

    def lists(self, texts: pa.Array) -> pa.Array:
        """list<int> of every text: the tokens of its prefixes of 0, 1, ... characters."""
        count, ends, _ = self.prefixes(texts)
        out = np.zeros(len(count) + len(texts), np.int32)
        out[np.arange(len(count)) + 1 + np.repeat(np.arange(len(texts)), np.diff(ends))] = count
        return pa.ListArray.from_arrays(pa.array((ends + np.arange(len(texts) + 1)).astype(np.int32)), pa.array(out))

    def summary(self, texts: pa.Array, limit: int) -> list[pa.Array]:
        """Bytes, tokens, and characters and tokens of the longest prefix of at most ``limit`` tokens."""
        count, ends, offsets = self.prefixes(texts)
        some = ends[1:] > ends[:-1]
        tokens, chars, kept = (np.zeros(len(texts), np.int64) for _ in range(3))
        tokens[some] = count[ends[1:][some] - 1]
        within = np.flatnonzero(count <= limit)
        if len(within):
            at = within[np.maximum(np.searchsorted(within, ends[1:]) - 1, 0)]
            good = some & (at >= ends[:-1]) & (at < ends[1:])
            chars[good] = (at + 1 - ends[:-1])[good]
            kept[good] = count[at[good]]
        return [pa.array(x) for x in (np.diff(offsets), tokens, chars, kept)]


def _with_columns(df: DataFrame, vocabulary: Vocabulary, source: str, targets: dict[str, str], work: Callable[[Counter, pa.Array], list[pa.Array]]) -> DataFrame:
    spark = df.sparkSession
    bound_batches(spark)
    shared = share(spark, vocabulary)
    df = df.select(*[c for c in df.columns if c not in targets or c == source])
    kept = [f for f in df.schema.fields if f.name not in targets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(shared.value)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *work(counter, batch.column(source))], [*[f.name for f in kept], *targets])

    fields = ", ".join(f"`{n}` {k}" for n, k in [*[(f.name, f.dataType.simpleString()) for f in kept], *targets.items()])
    return df.mapInArrow(lean(run), fields)


def prefix_counts(df: DataFrame, vocabulary: Vocabulary, text: str = "text", prefixes: str = "prefix_tokens") -> DataFrame:
    """``df`` with the token count of every prefix, 0 characters to all."""
    return _with_columns(df, vocabulary, text, {prefixes: "array<int>"}, lambda c, x: [c.lists(x)])


def measured(df: DataFrame, vocabulary: Vocabulary, limit: int, text: str = "text") -> DataFrame:
    """``df`` with n_bytes, n_tokens, and kept_chars and kept_tokens of the longest prefix within ``limit``."""
    targets = dict.fromkeys(["n_bytes", "n_tokens", "kept_chars", "kept_tokens"], "bigint")
    return _with_columns(df, vocabulary, text, targets, lambda c, x: c.summary(x, limit))


def tokens_of_prefix(prefixes: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` characters (at most all), from the stored counts."""
    return F.element_at(prefixes, (F.least(F.greatest(chars, F.lit(0)), F.size(prefixes) - 1) + 1).cast("int"))


def longest_prefix(prefixes: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens; null for a negative budget."""
    place = F.array_position(F.reverse(F.transform(prefixes, lambda n: n <= budget)), True)
    return F.when(budget >= 0, F.size(prefixes) - place)


def fits(prefixes: Column, budget: Column) -> Column:
    """Whether the whole text has at most ``budget`` tokens."""
    return F.element_at(prefixes, -1) <= budget
