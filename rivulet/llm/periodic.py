"""Periodic runs of words in a text, found on a grammar of the text.

Words are numbered per text. Re-Pair replaces repeated pairs of symbols by new symbols until no pair
repeats: rounds replace every occurrence that is the most frequent of the pairs around it (ties by a
hash), so many symbols are made at once. The symbols that remain at the top are joined by a balanced
tree. Every symbol and every node of the tree has a border between its two parts, and each run of the
text crosses the border of the smallest symbol around it. So the runs that cross a border are computed
once per symbol, on its first place in the text, and are then carried to all places where the derivation
puts the symbol. Intervals of one period that overlap by a period are parts of one run and are merged.

A run that crosses a border reaches at least 12 words and one and a half periods to one side of it, so
five words at the border come back one period further on that side. Only such periods are tried; how far
each reaches is found by bisection over hashes of word sequences. Merged runs are compared word by word
with the text, also that no neighbour extends them, so a colliding hash could not pass; the batch would
be computed again with other hashes.

A run is a stretch of consecutive words whose words q apart are identical, q the smallest such period, of
at least 24 words and 3 q, that no neighbouring word extends. ``collapsed`` keeps the words that no run
covers after its first q words.

Defined results: null is a text without words; a text of one word has no runs; runs never cross texts, and
repeated rows repeat. Columns called like a result are replaced. A text stays whole in one task: its words
cost some tens of bytes each, and a task holds one Arrow batch (1 MB, or a single longer text).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.textblocks import bound_batches, flat_bytes, lean, mix, runs, strings

LEAST_LENGTH, LEAST_EXPONENT = 24, 3
#: Words at a border that come back one period further: one before it and four after it, or the other way round.
GRAM = 5
#: Candidates (border, period) that are extended at once.
CHUNK = 1 << 18
PRIMES = (np.uint64(2_147_483_647), np.uint64(2_147_483_629))

WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False


@dataclass
class Grammar:
    """Symbols made by Re-Pair: both parts, first place, border and end there (word numbers), and the round they come from."""

    left: np.ndarray
    right: np.ndarray
    place: np.ndarray
    border: np.ndarray
    end: np.ndarray
    first: list[int]  # the first symbol of every round; symbols up to ``base`` are words
    base: int
    top: np.ndarray
    top_place: np.ndarray


def grammar(words: np.ndarray) -> Grammar:
    """Re-Pair in rounds over word ids that no two texts share, so that no repeated pair joins two texts."""
    seq, at = words.astype(np.int64), np.arange(len(words) + 1)
    base = symbols = int(words.max(initial=-1)) + 1
    live = np.ones(len(seq), bool)  # whether the pair that starts at a symbol may repeat; the last one starts none
    live[-1:] = False
    made, first = [], []
    while True:
        here = np.flatnonzero(live)
        pair = seq[here] << np.int64(32) | seq[here + 1]
        again = np.zeros(len(here), bool)  # the same pair starts one symbol before, as in a a a
        again[1:] = (here[1:] == here[:-1] + 1) & (pair[1:] == pair[:-1])
        number = np.arange(len(here))
        apart = (number - np.maximum.accumulate(np.where(again, 0, number))) % 2 == 0
        kinds, which = np.unique(pair, return_inverse=True)
        count = np.bincount(which[apart], minlength=len(kinds))
        repeated = count > 1
        if not repeated.any():
            break
        rank = np.empty(len(kinds), np.int64)
        rank[np.lexsort((mix(kinds.astype(np.uint64)), count))] = np.arange(1, len(kinds) + 1)
        weight = np.zeros(len(seq) + 1, np.int64)
        weight[here] = mine = np.where(repeated[which] & apart, rank[which], 0)
        chosen = (mine > weight[here + 1]) & (mine > weight[here - 1])
        chosen &= np.bincount(which[chosen], minlength=len(kinds))[which] > 1
        spot = here[chosen]
        _, begin, new = np.unique(which[chosen], return_index=True, return_inverse=True)
        one = spot[begin]
        made.append((seq[one], seq[one + 1], at[one], at[one + 1], at[one + 2]))
        first.append(symbols)
        live[here] = repeated[which]
        seq[spot] = symbols + new
        symbols += len(one)
        live[spot] = True
        live[spot[spot > 0] - 1] = True
        keep = np.ones(len(seq), bool)
        keep[spot + 1] = False
        seq, live, at = seq[keep], live[keep], at[np.append(keep, True)]
        live[-1] = False
    columns = [np.concatenate(c) for c in zip(*made)] if made else [np.empty(0, np.int64)] * 5
    return Grammar(*columns, first, base, seq, at)


class Sequences:
    """Hashes of all stretches of words, modulo two primes."""

    def __init__(self, words: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        value = mix(words.astype(np.uint64) + np.uint64(rng.integers(1 << 62)))
        self.tables = []
        for prime in PRIMES:
            power = np.ones(len(words) + 1, np.uint64)
            step, done = np.uint64(rng.integers(int(prime) // 4, int(prime) - 1)), 1
            while done < len(power):  # doubles the powers that are known
                power[done:2 * done] = power[:done][:len(power) - done] * step % prime
                step, done = step * step % prime, 2 * done
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value % prime * power[:-1] % prime)]) % prime
            self.tables.append((prime, power, sums))

    def equal(self, a: np.ndarray, shift: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the words [a, a + size) come back ``shift`` words later."""
        same, b = np.ones(len(a), bool), a + shift
        for prime, power, sums in self.tables:
            near = (sums[a + size] + prime - sums[a]) % prime
            far = (sums[b + size] + prime - sums[b]) % prime
            same &= near * power[shift] % prime == far
        return same

    def reach(self, a: np.ndarray, shift: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """The largest size up to ``most`` of equal stretches that begin (or end) at ``a``."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_] + 1) // 2
            begin = a[open_] if forward else a[open_] - middle
            same = self.equal(begin, shift[open_], middle)
            low[open_] = np.where(same, middle, low[open_])
            high[open_] = np.where(same, high[open_], middle - 1)
        return low


class Grams:
    """Where every stretch of GRAM words stands, in order."""

    def __init__(self, words: np.ndarray):
        n = max(0, len(words) - GRAM + 1)
        value, code = mix(words.astype(np.uint64) + np.uint64(1)), np.zeros(n, np.uint64)
        for j in range(GRAM):
            code = mix(code * np.uint64(31) + value[j:j + n])
        order = np.argsort(code, kind="stable")
        ordered = code[order]
        group = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])[:n]) if n else order
        self.span, self.place = n + 1, order
        self.key = group * self.span + order  # grows along the order
        self.spot, self.group = np.empty(n, np.int64), np.empty(n, np.int64)
        self.spot[order], self.group[order] = np.arange(n), group

    def between(self, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First of the ordered places of the gram at ``at`` that lie in [low, high], and how many there are."""
        base = self.group[at] * self.span
        begin = np.searchsorted(self.key, base + low, side="left")
        return begin, np.maximum(0, np.searchsorted(self.key, base + high, side="right") - begin)


def crossing(place: np.ndarray, border: np.ndarray, end: np.ndarray, grams: Grams, sequences: Sequences) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of the runs inside [place, end) that cross the border of a node."""
    most = (end - place) // LEAST_EXPONENT
    parts = []
    for right in (True, False):
        at = border - 1 if right else border - GRAM + 1
        ok = np.flatnonzero((end - place >= LEAST_LENGTH) & (at >= place) & (at + GRAM <= end))
        if not len(ok):
            continue
        a = at[ok]
        low, high = (a + 1, np.minimum(a + most[ok], end[ok] - GRAM)) if right else (np.maximum(a - most[ok], place[ok]), a - 1)
        begin, count = grams.between(a, low, high)
        total = np.cumsum(count)
        cuts = np.unique(np.searchsorted(total, np.arange(CHUNK, int(total[-1]) + CHUNK, CHUNK), side="left") + 1)
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ok)]):
            if i >= j or not count[i:j].sum():
                continue
            node = np.repeat(ok[i:j], count[i:j])
            inner = np.arange(len(node)) - np.repeat(np.cumsum(count[i:j]) - count[i:j], count[i:j])
            other = grams.place[np.repeat(begin[i:j], count[i:j]) + inner]
            period = np.abs(other - at[node])
            c = border[node] - (0 if right else period)
            start = c - sequences.reach(c, period, c - place[node], forward=False)
            stop = c + period + sequences.reach(c, period, end[node] - c - period, forward=True)
            good = stop - start >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
            parts.append((node[good], start[good], stop[good], period[good]))
    node, start, stop, period = (np.concatenate(c) for c in zip(*parts)) if parts else [np.empty(0, np.int64)] * 4
    order = np.lexsort((period, stop, start, node))
    node, start, stop, period = node[order], start[order], stop[order], period[order]
    new = np.ones(len(node), bool)  # of the periods of one stretch, the smallest
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return node[new], start[new], stop[new], period[new]


def _places(g: Grammar, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbol number, place) of every place of the wanted symbols in the derivation."""
    need = wanted.copy()
    bounds = [*(f - g.base for f in g.first), len(g.left)]
    for a, b in zip(bounds[:-1], bounds[1:]):  # a symbol is needed if a part of it is
        for part in (g.left[a:b], g.right[a:b]):
            own = part >= g.base
            need[a:b][own] |= need[part[own] - g.base]
    symbol, place = g.top - g.base, g.top_place[:-1]
    keep = symbol >= 0
    symbol, place = symbol[keep], place[keep]
    symbol, place = symbol[need[symbol]], place[need[symbol]]
    found = []
    for a in bounds[-2::-1]:
        now = symbol >= a
        s, p = symbol[now], place[now]
        found.append((s, p))
        parts = [(symbol[~now], place[~now])]
        for part, where in ((g.left[s], p), (g.right[s], p + g.border[s] - g.place[s])):
            own = part >= g.base
            own[own] = need[part[own] - g.base]
            parts.append((part[own] - g.base, where[own]))
        symbol, place = (np.concatenate(c) for c in zip(*parts))
    symbol, place = (np.concatenate(c) for c in zip(*found))
    return symbol[wanted[symbol]], place[wanted[symbol]]


def _merged(start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of one period that overlap by a period, joined; ordered by start, then period."""
    if not len(start):
        return start, stop, period
    order = np.lexsort((start, period))
    start, stop, period = start[order], stop[order], period[order]
    span = int(stop.max()) + 1
    far = np.maximum.accumulate(stop + period * span) - period * span
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] + period[1:] > far[:-1])
    first = np.flatnonzero(new)
    start, stop, period = start[first], np.maximum.reduceat(stop, first), period[first]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def _exact(words: np.ndarray, start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> bool:
    """Whether every stretch has its period and no neighbour extends it; compared word by word."""
    for s, e, p in zip(start.tolist(), stop.tolist(), period.tolist()):
        if not np.array_equal(words[s:e - p], words[s + p:e]) or (s and words[s - 1] == words[s - 1 + p]) or (e < len(words) and words[e] == words[e - p]):
            return False
    return True


def find_runs(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start, then period; ``text`` is the text of every word, in order."""
    if len(words) < LEAST_LENGTH:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    _, own = np.unique(text.astype(np.int64) << np.int64(32) | words.astype(np.int64), return_inverse=True)
    g, grams = grammar(own), Grams(own)
    # the tree over the top symbols of a text: the border before symbol j has the size of the lowest bit of j
    begins = np.flatnonzero(np.concatenate([[True], text[g.top_place[1:-1]] != text[g.top_place[:-2]]]))
    sizes = np.diff(np.append(begins, len(g.top)))
    origin = np.repeat(begins, sizes)
    j = np.arange(len(g.top)) - origin
    inner = np.flatnonzero(j > 0)
    low_bit = j[inner] & -j[inner]
    top = (g.top_place[inner - low_bit], g.top_place[inner], g.top_place[np.minimum(inner + low_bit, (origin + np.repeat(sizes, sizes))[inner])])
    for seed in range(4):
        sequences = Sequences(own, seed)
        _, *whole = crossing(*top, grams, sequences)
        node, start, stop, period = crossing(g.place, g.border, g.end, grams, sequences)
        if len(node):
            wanted = np.zeros(len(g.left), bool)
            wanted[node] = True
            symbol, place = _places(g, wanted)
            order = np.argsort(symbol, kind="stable")
            symbol, place = symbol[order], place[order]
            begin = np.searchsorted(symbol, node)
            count = np.searchsorted(symbol, node, side="right") - begin
            run = np.repeat(np.arange(len(node)), count)
            shift = place[np.repeat(begin, count) + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)] - g.place[node[run]]
            whole = [np.concatenate([x, y]) for x, y in zip(whole, (start[run] + shift, stop[run] + shift, period[run]))]
        found = _merged(*whole)
        if _exact(own, *found):
            return found
    raise ArithmeticError("four pairs of hashes collided")


def _batch(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Runs (start, length, period) of every text, and the text without repetitions."""
    data, offsets = flat_bytes(texts)
    begin, end, text = runs(WORD[data], offsets)
    coded = strings(data, begin, end).dictionary_encode()
    start, stop, period = find_runs(coded.indices.to_numpy().astype(np.int64), text)
    first = np.searchsorted(text, np.arange(len(texts) + 1))  # first word of every text
    owner = text[start] if len(start) else start
    values = pa.StructArray.from_arrays([pa.array(start - first[owner]), pa.array(stop - start), pa.array(period)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)), values)
    cover = np.zeros(len(begin) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, stop, -1)
    kept = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
    # every kept word with one space after it, but for the last one of a text
    last = np.ones(len(kept), bool)
    last[:-1] = text[kept[1:]] != text[kept[:-1]]
    mark = np.zeros(len(data) + 1, np.int8)
    mark[begin[kept]] += 1
    mark[end[kept][last]] -= 1
    mark[end[kept][~last] + 1] -= 1
    keep = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    spaced = data.copy()
    spaced[end[kept][~last]] = 0x20
    size = end[kept] - begin[kept] + ~last
    total = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(text[kept], np.arange(len(texts) + 1))]
    return lists, pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(total.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(spaced[keep])))


def periodic_runs(df: DataFrame, text: str = "text", found: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``df`` with its texts' runs, by start, then period, and the words that remain, joined by one space."""
    spark = df.sparkSession
    bound_batches(spark)
    targets = {found: "array<struct<start:bigint,length:bigint,period:bigint>>", collapsed: "string"}
    df = df.select(*[c for c in df.columns if c not in targets or c == text])
    kept = [f for f in df.schema.fields if f.name not in targets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, texts = _batch(batch.column(text))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], lists, texts.cast(pa.string())], [*[f.name for f in kept], *targets])

    fields = ", ".join(f"`{n}` {k}" for n, k in [*[(f.name, f.dataType.simpleString()) for f in kept], *targets.items()])
    return df.mapInArrow(lean(run), fields)


def greatest(found: Column) -> Column:
    """The run with the greatest exact length / period; of equal ones the smallest start, then period; null for none."""
    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(found, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)
