"""Helpers for texts in numpy: one flat array per batch instead of one Python object per word."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of an Arrow batch sent to a Python worker; a single longer row still travels whole.
BATCH_BYTES = 1 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches to BATCH_BYTES in this session, as numpy arrays of a batch take several times its size."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for a task that gives its memory back when it ends: workers live on, and idle ones must stay small."""

    def task(batches: Iterator) -> Iterator:
        pa.set_memory_pool(pa.system_memory_pool())
        yield from run(batches)
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
        if trim is not None:
            trim(0)

    return task


def unused(columns: list[str], name: str) -> str:
    """``name`` with as many underscores before it as it takes for no column to begin with it, in any case of letters."""
    taken = [c.lower() for c in columns]
    while any(c.startswith(name.lower()) for c in taken):
        name = f"_{name}"
    return name


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts joined, and the offsets of each (one more than texts); null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0]:offsets[-1]] if len(texts) else whole[:0], offsets - offsets[0]


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeStringArray:
    """The byte ranges [starts, ends) as strings; ranges must be in order and not overlap."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    if len(starts) and (starts[1:] != ends[:-1]).any():
        keep = np.zeros(len(data) + 1, np.int8)
        keep[starts] += 1  # starts are distinct, and so are ends
        keep[ends] -= 1
        data = data[np.cumsum(keep[:-1], dtype=np.int8).astype(bool)]
    elif len(starts):
        data = data[starts[0]:ends[-1]]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross a text's end: starts, ends, and the text of each."""
    if not len(mask):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    before = np.empty(len(mask), bool)
    before[0] = False
    before[1:] = mask[:-1]
    inner = offsets[1:-1]
    before[inner[inner < len(mask)]] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.empty(len(mask), bool)
    after[-1] = False
    after[:-1] = mask[1:]
    after[inner[(inner > 0) & (inner <= len(mask))] - 1] = False
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


LETTERS = np.zeros(256, bool)
LETTERS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
WORDS = LETTERS.copy()
WORDS[[*range(ord("0"), ord("9") + 1), ord("_")]] = True


def words_of(texts: pa.Array, marks: np.ndarray = WORDS) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of lower-cased texts (runs of marked bytes), the word of every token, and its text."""
    data, offsets = flat_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    starts, ends, text = runs(marks[data], offsets)
    coded = strings(data, starts, ends).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), text


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words: a polynomial over their bytes, mixed."""
    data, offsets = flat_bytes(words)
    if not len(words):
        return np.empty(0, np.uint64)
    sizes = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    longest = int(sizes.max(initial=1))
    powers = np.cumprod(np.full(longest, 0x100000001B3, np.uint64), dtype=np.uint64)
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers[place]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    return mix(sums[offsets[1:]] - sums[offsets[:-1]] + sizes.astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
