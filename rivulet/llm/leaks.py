"""Benchmark decontamination by the q-gram lemma.

Items are cut into overlapping segments, one every STRIDE characters. A text that holds a segment of m
characters with at most e edits shares at least m - q + 1 - q * e of its q-grams with it, on diagonals that
lie no more than e apart. Every task looks up the q-grams of its texts in a table of the items' q-grams,
counts the shared ones per item in overlapping diagonal bands, keeps the bands that reach the bound, counts
those again per segment, and verifies each segment that reaches the bound by an alignment limited to the
band. Texts are read whole and once; nothing is shuffled.

Guaranteed: wherever it starts in the item, a verbatim quote of QUOTE = 87 characters or more is found, as is
a quote of 103 (SEGMENT + STRIDE - 1) or more with at most 9 edits. An item of 8 to 95 characters is one
segment: it is found whole with edits in a tenth of it, not by a shorter part. An item shorter than ``q`` is
found at every exact occurrence, also inside a word.

The table is broadcast in blocks of BLOCK_CHARS item characters, one pass over the texts per block, so
an item set of any size is covered and no broadcast exceeds the bound.

Characters are compared after lower-casing A-Z and taking all white space as blanks. Defined results:
null and empty texts have no hits; null items and short items of blanks only have no segments; a text
that repeats an item, or items that are equal, give each item once with its least distance; repeated
rows give repeated results; columns called like the result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.textblocks import bound_batches, lean
from rivulet.session import share

Q = 8
SEGMENT, STRIDE, EDIT_RATE = 96, 8, 0.1
#: Least length of a verbatim quote that is always found: the segment that starts at most 9 characters before it lacks no more than its budget.
QUOTE = SEGMENT - int(SEGMENT * EDIT_RATE)
BLOCK_CHARS = 2_000_000
#: Characters whose q-grams are looked up at once, cells of one alignment, and shared q-grams counted per segment at once.
PART, CELLS, SHARED = 1 << 20, 1 << 21, 1 << 18
BITS = 22
BASE = np.uint64(0x9E3779B97F4A7C15)
HITS = "array<struct<item:string,distance:int,end:int>>"


def normal(codes: np.ndarray) -> np.ndarray:
    """Characters as they are compared."""
    out = codes.copy()
    out[(out >= 65) & (out <= 90)] += 32
    out[((out >= 9) & (out <= 13)) | (out == 0xA0)] = 32
    return out


def characters(text: str) -> np.ndarray:
    return normal(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))


def qgrams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q characters from every position on, by doubling."""
    if q == 1:
        return codes.astype(np.uint64) + np.uint64(1)
    half = q // 2
    low = qgrams(codes, half)
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power = np.uint64(pow(int(BASE), half, 1 << 64))
    out = low[:n] * power + low[half:half + n]
    return out * BASE + codes[q - 1:q - 1 + n].astype(np.uint64) + np.uint64(1) if q % 2 else out


def top(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass(frozen=True)
class Segments:
    """One block of items: their characters one after the other, the segments (in order of ``begin``, where they start
    there) with their edit budgets and bounds, the table of the items' q-grams, and the items shorter than ``q`` by length."""

    items: tuple[str, ...]
    flat: np.ndarray
    start: np.ndarray
    longest: int
    item: np.ndarray
    begin: np.ndarray
    sizes: np.ndarray
    budget: np.ndarray
    bound: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    offset: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]
    q: int

    @staticmethod
    def build(rows: list[tuple[str, str]], q: int, size: int, stride: int, rate: float) -> Segments:
        items, codes, item, starts, sizes = [], [], [], [], []
        for name, text in rows:
            c = characters(text)
            if len(c) < q and not (c != 32).any():
                continue
            for s in [0] if len(c) <= size else [*range(0, len(c) - size, stride), len(c) - size]:
                item.append(len(items))
                starts.append(s)
                sizes.append(min(len(c), size))
            items.append(name)
            codes.append(c)
        lengths = np.array([len(c) for c in codes], np.int64)
        start = np.cumsum(lengths) - lengths
        item, starts, sizes = (np.array(x, np.int64) for x in (item, starts, sizes))
        budget = np.minimum((sizes * rate).astype(np.int64), np.maximum(sizes - q, 0) // q)
        hashes = [qgrams(c, q) for c in codes]
        flat = np.concatenate(hashes or [np.empty(0, np.uint64)])
        counts = np.array([len(h) for h in hashes], np.int64)
        order = np.argsort(flat, kind="stable")
        keys, first = np.unique(flat[order], return_index=True)
        owner = np.repeat(np.arange(len(codes)), counts)
        offset = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
        short = {}
        for n in sorted({len(c) for c in codes if len(c) < q}):
            some = np.flatnonzero(lengths == n)
            found = np.concatenate([qgrams(codes[i], n) for i in some])
            order_n = np.argsort(found, kind="stable")
            short[n] = (found[order_n], some[order_n])
        return Segments(tuple(items), np.concatenate(codes or [np.empty(0, np.uint32)]), start, int(lengths.max(initial=0)), item,
                        start[item] + starts, sizes, budget, sizes - q + 1 - q * budget, keys,
                        np.append(first, len(flat)).astype(np.int64), owner[order], offset[order], short, q)

    @property
    def codes(self) -> tuple[np.ndarray, ...]:
        """Characters of every segment."""
        return tuple(self.flat[b:b + n] for b, n in zip(self.begin, self.sizes))

    def filter_table(self) -> np.ndarray:
        some = np.zeros(1 << BITS, bool)
        some[top(self.keys)] = True
        return some


def _least_edits(pattern: np.ndarray, region: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of whole patterns (k x m) against any part of regions (k x (m + w - 1)), and where that part
    ends. Only cells whose diagonal is one of the w of the band take part."""
    k, m = pattern.shape
    w = region.shape[1] - m + 1
    across = np.arange(w)
    d = np.zeros((k, w), np.int32)
    for i in range(m):
        step = d + (region[:, i:i + w] != pattern[:, i:i + 1])
        step[:, :-1] = np.minimum(step[:, :-1], d[:, 1:] + 1)  # a pattern character is missing
        d = np.minimum.accumulate(step - across, axis=1) + across  # extra characters in the text
    best = d.argmin(axis=1)
    return d[np.arange(k), best], best + m


def find(segments: Segments, some: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, item, distance, end) of the verified segments in texts that lie one after the other in ``codes``."""
    q = segments.q
    short = find_short(segments, codes, offsets)
    places, keys = [], []
    for a in range(0, len(codes), PART):
        h = qgrams(codes[a:a + PART + q - 1], q)
        at = np.flatnonzero(some[top(h)])
        places.append(at + a)
        keys.append(h[at])
    if not places or not len(segments.keys):
        return short
    place, key = np.concatenate(places), np.concatenate(keys)
    spot = np.minimum(np.searchsorted(segments.keys, key), max(0, len(segments.keys) - 1))
    hit = segments.keys[spot] == key
    place, spot = place[hit], spot[hit]
    text = np.searchsorted(offsets, place, side="right") - 1
    inside = place + q <= offsets[text + 1]
    place, spot, text = place[inside], spot[inside], text[inside]
    counts = segments.first[spot + 1] - segments.first[spot]
    entry = np.repeat(segments.first[spot] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    item, at = segments.owner[entry], segments.offset[entry]
    one = np.searchsorted(segments.item, np.arange(len(segments.items)))  # the segments of an item have one size and budget
    text = np.repeat(text, counts)
    diagonal = np.repeat(place, counts) - offsets[text] - at + segments.longest  # not negative
    band = diagonal // (segments.budget[one[item]] + 1)  # band b holds the diagonals of b and b + 1
    bands = int(band.max(initial=0)) + 2
    group = (text * len(segments.items) + item) * bands
    value, inverse, number = np.unique(np.concatenate([group + band, group + np.maximum(band - 1, 0)]), return_inverse=True, return_counts=True)
    many = max(1, len(segments.items))
    enough = number >= segments.bound[one[value // bands % many]]
    row = np.flatnonzero(enough[inverse])  # shared q-grams of the bands that may hold a segment
    row = row[np.argsort(inverse[row], kind="stable")]
    member, spot = inverse[row], row % max(1, len(at))
    spot = segments.start[item[spot]] + at[spot]
    found, a = [], 0
    while a < len(member):  # whole bands, of about SHARED q-grams
        b = int(np.searchsorted(member, member[min(a + SHARED, len(member) - 1)], side="right" if a + SHARED >= len(member) else "left"))
        b = b if b > a else int(np.searchsorted(member, member[a], side="right"))
        found += _verified(segments, value, member[a:b], spot[a:b], bands, codes, offsets)
        a = b
    return short + found


def _verified(segments: Segments, value: np.ndarray, member: np.ndarray, spot: np.ndarray, bands: int, codes: np.ndarray,
              offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The segments within their budgets, from shared q-grams: the band (an index of ``value``) and where they lie in the items."""
    many, total = max(1, len(segments.items)), max(1, len(segments.begin))
    own = value[member] // bands % many
    one = np.searchsorted(segments.item, own)
    low = np.searchsorted(segments.begin, np.maximum(spot - (segments.sizes[one] - segments.q), segments.start[own]))
    counts = np.searchsorted(segments.begin, spot, side="right") - low
    covering = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    pair, number = np.unique(np.repeat(member, counts) * total + covering, return_counts=True)
    pair = pair[number >= segments.bound[pair % total]]
    segment, text, band = pair % total, value[pair // total] // bands // many, value[pair // total] % bands
    found = []
    shape = segments.sizes[segment] * 1_000 + segments.budget[segment]
    for kind in np.unique(shape):
        chosen = np.flatnonzero(shape == kind)
        m, e = int(kind // 1_000), int(kind % 1_000)
        w = 2 * (e + 1) + 2 * e  # the two bands, and what the edits may add on both sides
        for part in np.array_split(chosen, max(1, len(chosen) * (m + w) // CELLS)):
            inside = segments.begin[segment[part]] - segments.start[segments.item[segment[part]]]
            begin = band[part] * (e + 1) - segments.longest + inside - e
            index = begin[:, None] + np.arange(m + w - 1)[None, :]
            size = (offsets[text[part] + 1] - offsets[text[part]])[:, None]
            out = (index < 0) | (index >= size)
            region = codes[np.where(out, 0, index + offsets[text[part]][:, None])]
            region[out] = 0xFFFFFFFF
            pattern = segments.flat[segments.begin[segment[part]][:, None] + np.arange(m)[None, :]]
            edits, end = _least_edits(pattern, region)
            good = np.flatnonzero(edits <= e)
            found += zip(text[part][good].tolist(), segments.item[segment[part][good]].tolist(), edits[good].tolist(),
                         np.minimum((begin[good] + end[good]), size[good, 0]).tolist())
    return found


def find_short(segments: Segments, codes: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, item, 0, end) of the first exact occurrence of every item shorter than ``q``."""
    found = {}
    for n, (keys, items) in segments.short.items():
        for a in range(0, len(codes), PART):
            h = qgrams(codes[a:a + PART + n - 1], n)
            low, high = np.searchsorted(keys, h), np.searchsorted(keys, h, side="right")
            hit = np.flatnonzero(high > low)
            text = np.searchsorted(offsets, hit + a, side="right") - 1
            kept = hit + a + n <= offsets[text + 1]
            hit, text = hit[kept], text[kept]
            for i in range(int((high[hit] - low[hit]).max(initial=0))):  # equal items have equal keys
                some = hit[low[hit] + i < high[hit]]
                own, item = text[low[hit] + i < high[hit]], items[low[some] + i]
                same = (codes[(some + a)[:, None] + np.arange(n)] == segments.flat[segments.start[item][:, None] + np.arange(n)]).all(axis=1)
                value, first = np.unique(own[same] * len(segments.items) + item[same], return_index=True)
                for v, place in zip(value.tolist(), (some[same][first] + a).tolist()):
                    t = v // len(segments.items)
                    found.setdefault((t, v % len(segments.items)), place + n - int(offsets[t]))
    return [(t, i, 0, end) for (t, i), end in found.items()]


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of about BLOCK_CHARS characters; one block at a time is on the driver."""
    block, size = [], 0
    rows = items.where(F.col(text).isNotNull()).select(F.col(key).cast("string"), F.col(text).cast("string"))
    for name, value in rows.toLocalIterator():
        block.append((name, value))
        size += len(value)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def mark(documents: DataFrame, items: DataFrame, *, text: str = "text", item_key: str = "item_id", item_text: str = "text",
         hits: str = "leak_hits", q: int = Q, segment: int = SEGMENT, stride: int = STRIDE, edit_rate: float = EDIT_RATE) -> DataFrame:
    """``documents`` with the array ``hits``: every item found in the text, with the least distance of any of its
    segments and where (in characters) the first segment of that distance ends."""
    spark = documents.sparkSession
    bound_batches(spark)
    if segment > SEGMENT:
        raise ValueError(f"segments may have at most {SEGMENT} characters")
    df = documents.drop(hits).withColumn(hits, F.array().cast(HITS))
    kept = [f for f in df.schema.fields if f.name != hits]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    entry = pa.struct([("item", pa.string()), ("distance", pa.int32()), ("end", pa.int32())])

    def scan(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            some = block.filter_table()
            for batch in batches:
                raw, found, a = batch.column(text).to_pylist(), {}, 0
                while a < len(raw):  # texts of about PART characters at a time
                    b, size = a, 0
                    while b < len(raw) and (b == a or size < PART):
                        size += len(raw[b] or "")
                        b += 1
                    part = [t or "" for t in raw[a:b]]
                    offsets = np.concatenate([[0], np.cumsum([len(t) for t in part])]).astype(np.int64)
                    for t, i, distance, end in find(block, some, characters("".join(part)), offsets):
                        found.setdefault(a + t, {}).setdefault(i, []).append((distance, end))
                    a = b
                new = [[*old, *[{"item": block.items[i], "distance": min(x)[0], "end": min(x)[1]} for i, x in sorted(found.get(t, {}).items())]]
                       for t, old in enumerate(batch.column(hits).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(f.name) for f in kept], pa.array(new, pa.list_(entry))], [*[f.name for f in kept], hits])

        return run

    for rows in _blocks(items, item_key, item_text):
        block = Segments.build(rows, q, segment, stride, edit_rate)
        if block.items:
            df = df.mapInArrow(lean(scan(share(spark, block))), f"{fields}, `{hits}` {HITS}")
    return df
