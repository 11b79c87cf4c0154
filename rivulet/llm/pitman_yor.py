"""Scoring texts with a hierarchical Pitman-Yor language model.

The model is a word-pair model: every preceding word is a context with a restaurant of its own, all of
them share one parent, the restaurant of single words, and that one draws from even chances over the
known words and one unknown. Words are customers; a context's tables are the parent's customers.
Seatings are sampled by Gibbs sweeps that reseat all customers of one dish of one restaurant given all
other seatings: for dishes of up to EXACT customers the number of tables is drawn from its exact
conditional distribution, for larger ones the customers are seated one after the other. Predictions
are averaged over the sweeps after the first ones.

The work is dealt out twice. Texts are encoded in blocks of bounded size with a vocabulary of their
own. A block's distinct words go to buckets of words, its distinct pairs to buckets of contexts, as
packed arrays, so that what moves is one entry per block and distinct pair, never one per token; the
answers return to the blocks, where every text is scored whole. Contexts with a large share of all
tokens are split over the buckets by their second word. Discounts are estimated per bucket from its
counts; a bucket returns the masses its discounts leave and take, so the split contexts still sum to one.

Defined results: a null text is empty and is one end token; a null key belongs to fold 0; rows are
scored one by one, so repeated rows are repeated evidence and get equal scores; without training texts
all words are unknown and evenly likely. Only the named columns are read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rivulet.llm.textblocks import bound_batches, flat_bytes, hash_words, lean, mix, runs, strings
from rivulet.session import materialize, shared_folder

BLOCK_BYTES = 10 << 20
#: Packed entries of a bucket; the number of buckets follows from the number of entries.
BUCKET_ENTRIES = 1_500_000
STRENGTH, PARENT_STRENGTH = 1.0, 1.0
SWEEPS, KEPT = 4, 3
EXACT = 24
_BLANKS = np.zeros(256, bool)
_BLANKS[[*range(9, 14), 32]] = True


def pack(values: np.ndarray) -> bytes:
    """Integers (not negative) or float32 as compressed byte planes."""
    kind = b"f" if values.dtype.kind == "f" else b"i"
    raw = values.astype(np.float32).view(np.uint32) if kind == b"f" else values.astype(np.uint64)
    width = 4 if kind == b"f" else max(1, (int(raw.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(raw.astype(f"<u{raw.itemsize}")).view(np.uint8).reshape(-1, raw.itemsize)[:, :width].T
    body = pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True) if len(values) else b""
    return kind + bytes([width]) + len(values).to_bytes(8, "little") + body


def unpack(data: bytes) -> np.ndarray:
    kind, width, n = data[:1], data[1], int.from_bytes(data[2:10], "little")
    size = 4 if kind == b"f" else 8
    out = np.zeros((n, size), np.uint8)
    if n:
        out[:, :width] = np.frombuffer(pa.decompress(data[10:], decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.reshape(-1).view(np.float32) if kind == b"f" else out.reshape(-1).view(np.int64)


def pack_strings(words: pa.Array) -> bytes:
    data, offsets = flat_bytes(words)
    sizes = pack(np.diff(offsets))
    return len(sizes).to_bytes(8, "little") + sizes + pack(data)


def unpack_strings(data: bytes) -> pa.Array:
    cut = 8 + int.from_bytes(data[:8], "little")
    sizes, flat = unpack(data[8:cut]), unpack(data[cut:]).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(flat))


def sequence(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words (number 0 is the end mark), the numbers of all tokens, and the tokens of each text, its end included."""
    data, offsets = flat_bytes(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    starts, ends, text = runs(~_BLANKS[data], offsets)
    coded = strings(data, starts, ends).dictionary_encode()
    words = pa.concat_arrays([pa.array([""], pa.large_string()), coded.dictionary.cast(pa.large_string())])
    lengths = np.bincount(text, minlength=len(texts)) + 1
    tokens = np.zeros(int(lengths.sum()), np.int64)
    tokens[np.arange(len(text)) + text] = coded.indices.to_numpy().astype(np.int64) + 1
    return words, tokens, lengths


def pairs(tokens: np.ndarray, learned: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, word) numbers, their learned counts, and the pair of every token. A text's first
    word follows the end mark, as every text ends with one."""
    before = np.concatenate([[0], tokens[:-1]])
    key, which = np.unique(before * size + tokens, return_inverse=True)
    return key // size, key % size, np.bincount(which, weights=learned, minlength=len(key)).astype(np.int64), which


def stirling(discount: float, n: int) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers of n customers and t tables, rows and columns 0 to n."""
    s = np.full((n + 1, n + 1), -np.inf)
    s[0, 0] = 0
    for i in range(n):
        for t in range(i + 2):
            stay = s[i, t] + math.log(i - discount * t) if t and i - discount * t > 0 else -np.inf
            s[i + 1, t] = np.logaddexp(stay, s[i, t - 1] if t else -np.inf)
    return s


def reseat(customers: np.ndarray, tables: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, strength: float,
           rng: np.random.Generator, table: np.ndarray) -> np.ndarray:
    """New numbers of tables of dishes, given the tables of all other dishes of their restaurants.

    ``customers`` has at least 1 everywhere, ``others`` counts the restaurant's tables without the dish's,
    ``parent`` is the dish's chance in the parent. ``table`` is stirling(discount, EXACT).
    """
    out = np.ones_like(customers)
    for n in range(2, EXACT + 1):
        at = np.flatnonzero(customers == n)
        if not len(at):
            continue
        new = np.log(np.maximum((strength + discount * (others[at][:, None] + np.arange(n))) * parent[at][:, None], 1e-300))
        weight = np.cumsum(new, axis=1) + table[n, 1:n + 1]
        share = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
        out[at] = 1 + (rng.random(len(at))[:, None] * share[:, -1:] >= share).sum(axis=1)
    at = np.flatnonzero(customers > EXACT)
    seated, opened = np.ones(len(at)), np.ones(len(at))
    total, base, chance = customers[at].astype(float), others[at].astype(float), parent[at]
    while True:
        live = seated < total
        if not live.any():
            break
        new = (strength + discount * (base + opened)) * chance
        old = seated - discount * opened
        # so many customers at once that their chances hardly change
        step = np.where(live, np.minimum(total - seated, np.maximum(1, np.floor(0.02 * (old + new)))), 0).astype(np.int64)
        opened += rng.binomial(step, new / (new + old))
        seated += step
    out[at] = opened.astype(out.dtype)
    return np.minimum(out, customers)


def discount_of(customers: np.ndarray) -> float:
    """Discount from the dishes with one and with two customers."""
    once, twice = int((customers == 1).sum()), int((customers == 2).sum())
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def sample_tables(restaurant: np.ndarray, customers: np.ndarray, parent: np.ndarray, seed: int, strength: float, more: np.ndarray | None = None,
                  sweeps: int = SWEEPS, kept: int = KEPT) -> tuple[float, np.ndarray, np.ndarray]:
    """Discount, the mean and the last numbers of tables of all dishes. ``restaurant`` numbers the restaurants
    from 0; ``more`` scales a restaurant's tables to those it has in all buckets."""
    rng = np.random.default_rng(seed)
    discount = discount_of(customers)
    table = stirling(discount, EXACT)
    tables = np.ones_like(customers)
    mean = np.zeros(len(customers))
    size = int(restaurant.max(initial=-1)) + 1 if more is None else len(more)
    factor = np.ones(size) if more is None else more
    for sweep in range(sweeps):
        in_all = np.bincount(restaurant, weights=tables, minlength=size) * factor
        tables = reseat(customers, tables, np.maximum(0, in_all[restaurant] - tables), parent, discount, strength, rng, table)
        if sweep >= sweeps - kept:
            mean += tables / kept
    return discount, mean, tables


def _blocks(documents: DataFrame, key: str, text: str, held_out: Column, buckets: int) -> DataFrame:
    """One row per block: keys and marks, tokens, words, learned counts. Stored in buckets by block, so that
    the blocks do not move again when words and pairs come back to them."""
    source = documents.select(F.col(key).alias("key"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, waiting, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for lot in cut(batch):
                waiting.append(lot)
                size += lot.column("text").nbytes
                if size >= BLOCK_BYTES:
                    yield block(waiting, (part << 24) + number)
                    number, waiting, size = number + 1, [], 0
        if waiting:
            yield block(waiting, (part << 24) + number)

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows == 0:
            return
        if batch.column("text").nbytes <= BLOCK_BYTES or batch.num_rows == 1:
            yield batch
        else:
            half = batch.num_rows // 2
            yield from cut(pa.RecordBatch.from_pydict({n: pc.take(batch.column(n), pa.array(np.arange(half))) for n in batch.schema.names}))
            yield from cut(pa.RecordBatch.from_pydict({n: pc.take(batch.column(n), pa.array(np.arange(half, batch.num_rows))) for n in batch.schema.names}))

    def block(waiting: list[pa.RecordBatch], name: int) -> pa.RecordBatch:
        rows = pa.Table.from_batches(waiting).combine_chunks()
        words, tokens, lengths = sequence(rows["text"].chunk(0) if rows["text"].num_chunks else pa.array([], pa.string()))
        learned = ~rows["held_out"].to_numpy().astype(bool)
        counts = np.bincount(tokens[np.repeat(learned, lengths)], minlength=len(words))
        sink = pa.BufferOutputStream()
        keys = rows.select(["key", "held_out"])
        with pa.ipc.new_stream(sink, keys.schema) as writer:
            writer.write_table(keys)
        distinct = len(np.unique(np.concatenate([[0], tokens[:-1]]) * len(words) + tokens))
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([pack(lengths)], pa.binary()), pa.array([pack(tokens)], pa.binary()),
             pa.array([pack_strings(words)], pa.binary()), pa.array([pack(counts)], pa.binary()), pa.array([len(words)]), pa.array([distinct])], names)

    names = ["block", "keys", "lengths", "tokens", "words", "counts", "n_words", "n_pairs"]
    made = source.mapInArrow(lean(run), "block bigint, keys binary, lengths binary, tokens binary, words binary, counts binary, n_words bigint, n_pairs bigint")
    name = f"blocks_{uuid.uuid4().hex}"
    made.write.format("parquet").option("path", f"{shared_folder(documents.sparkSession)}/{name}").bucketBy(buckets, "block").saveAsTable(name)
    return documents.sparkSession.table(name)


ANSWER = "block bigint, kind string, bucket int, a binary, b binary"
_ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])


def _answers(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 5, _ANSWER.types)], schema=_ANSWER)


def _vocabulary(blocks: DataFrame, buckets: int) -> DataFrame:
    """Per block and bucket the places of its words in the bucket (a) and their learned counts (b); per bucket
    a row of kind size with the number of words, of known words and of learned tokens."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, words, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "words", "counts"))):
                words, counts = unpack_strings(words), unpack(counts)
                place = word_buckets(words, buckets)
                out = []
                for b in range(buckets):
                    at = np.flatnonzero(place == b)
                    if len(at):
                        out.append((name, b, pack_strings(words.take(pa.array(at))), pack(counts[at])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["block", "bucket", "words", "counts"])

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        lists = [unpack_strings(w) for w in table["words"].to_pylist()]
        coded = pa.concat_arrays(lists).dictionary_encode()
        place = coded.indices.to_numpy().astype(np.int64)
        total = np.bincount(place, weights=np.concatenate([unpack(c) for c in table["counts"].to_pylist()]), minlength=len(coded.dictionary)).astype(np.int64)
        rank = np.empty(len(total), np.int64)  # frequent words get small places, so that packed numbers are short
        rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
        bucket, rows, at = table["bucket"][0].as_py(), [], 0
        for name, words in zip(table["block"].to_pylist(), lists):
            mine = place[at:at + len(words)]
            rows.append((name, "word", bucket, pack(rank[mine]), pack(total[mine])))
            at += len(words)
        rows.append((-1, "size", bucket, pack(np.array([len(total), int((total > 0).sum()), int(total.sum())])), b""))
        return _answers(rows)

    return materialize(blocks.select("block", "words", "counts").mapInArrow(ask, "block bigint, bucket int, words binary, counts binary")
                       .groupBy("bucket").applyInArrow(merge, ANSWER))


def word_buckets(words: pa.Array, buckets: int) -> np.ndarray:
    return (hash_words(words) % np.uint64(buckets)).astype(np.int64)


class _Block:
    """A block with the global numbers and counts of its words."""

    def __init__(self, row: dict, answers: list[dict], buckets: int):
        self.words = unpack_strings(row["words"])
        self.place = word_buckets(self.words, buckets)
        self.number, self.count = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), np.int64)
        for a in answers:
            if a["kind"] == "word":
                at = np.flatnonzero(self.place == a["bucket"])
                self.number[at], self.count[at] = unpack(a["a"]) * buckets + a["bucket"], unpack(a["b"])
        self.keys = pa.ipc.open_stream(row["keys"]).read_all()
        self.held_out = self.keys["held_out"].to_numpy().astype(bool)
        self.lengths, self.tokens = unpack(row["lengths"]), unpack(row["tokens"])
        context, word, self.pair_count, self.which = pairs(self.tokens, np.repeat(~self.held_out, self.lengths), len(self.words))
        self.context, self.word = context, word

    def deal(self, buckets: int, hot: float) -> tuple[np.ndarray, list[np.ndarray]]:
        """Pairs in the order in which they are dealt out, cut by bucket."""
        u, w = self.number[self.context], self.number[self.word]
        spread = (mix(w.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        bucket = (u + np.where(self.count[self.context] >= hot, spread, 0)) % buckets
        order = np.lexsort((w, u, bucket))
        return order, np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets)))


def about(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte, to a few per cent."""
    return np.round(8 * np.log2(counts + 1)).astype(np.int64)


def about_back(codes: np.ndarray) -> np.ndarray:
    return np.exp2(codes / 8) - 1


def pack_pairs(u: np.ndarray, w: np.ndarray, bucket: int, buckets: int) -> tuple[bytes, bytes, bytes, bytes]:
    """Sorted (context, word) numbers: contexts' quotients by the number of buckets, what their remainders add to the
    bucket (0 but for split contexts), words per context, and the words' steps inside a context."""
    first, size = _contexts_of(u)
    step = np.diff(w, prepend=0)
    step[first] = w[first]
    return pack(np.diff(u[first] // buckets, prepend=0)), pack((u[first] - bucket) % buckets), pack(size), pack(step)


def unpack_pairs(quotient: bytes, rest: bytes, size: bytes, step: bytes, bucket: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts and words of all entries, and the words per context."""
    size, total = unpack(size), np.cumsum(unpack(step))
    first = np.cumsum(size) - size
    before = np.where(first > 0, total[np.maximum(first - 1, 0)], 0)
    contexts = np.cumsum(unpack(quotient)) * buckets + (unpack(rest) + bucket) % buckets
    return np.repeat(contexts, size), total - np.repeat(before, size), size


def _contexts_of(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and number of entries of every context in sorted entries."""
    first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]])) if len(u) else np.empty(0, np.int64)
    return first, np.diff(np.append(first, len(u)))


def _seated(blocks: DataFrame, vocabulary: DataFrame, word_count: int, buckets: int, hot: float, n: int, v: int) -> DataFrame:
    """Restaurants of all contexts. Kinds: pair (per block: mass kept by each pair, mass given back by each
    context), up (per word bucket: places of words, and their tables), hot (context, mass given back here)."""
    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        answers, out = right.to_pylist(), []
        for row in left.to_pylist():
            block = _Block(row, answers, word_count)
            _, parts = block.deal(buckets, hot)
            for b, at in enumerate(parts):
                if not len(at):
                    continue
                u, w = block.number[block.context[at]], block.number[block.word[at]]
                first, _ = _contexts_of(u)
                out.append((row["block"], b, *pack_pairs(u, w, b, buckets), pack(block.count[block.context[at[first]]]),
                            pack(block.pair_count[at]), pack(about(block.count[block.word[at]]))))
        kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 7)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 9, kinds)], names=names)

    def seat(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        rows, bucket = table.to_pylist(), table["bucket"][0].as_py()
        entries = [unpack_pairs(r["quotient"], r["rest"], r["size"], r["step"], bucket, buckets) for r in rows]
        size = [e[2] for e in entries]
        u, w = (np.concatenate([e[i] for e in entries]) for i in (0, 1))
        uc = np.concatenate([np.repeat(unpack(r["context_count"]), s) for r, s in zip(rows, size)])
        c, wc = (np.concatenate([unpack(r[x]) for r in rows]) for x in ("count", "word_count"))
        order = np.lexsort((w, u))
        new = np.ones(len(order), bool)
        new[1:] = (u[order][1:] != u[order][:-1]) | (w[order][1:] != w[order][:-1])
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        total = np.bincount(kind, weights=c).astype(np.int64)
        lead = order[new]
        context = np.cumsum(np.concatenate([[True], u[lead][1:] != u[lead][:-1]])) - 1
        seen = np.flatnonzero(total > 0)
        kept, back = np.zeros(len(total)), np.zeros(int(context.max(initial=-1)) + 1)
        up = []
        if len(seen):
            # chances of single words before their restaurant is known: discounted counts
            d0 = 0.5
            parent = np.maximum((about_back(wc[lead][seen]) - d0 + (PARENT_STRENGTH + d0 * v) / (v + 1)) / (PARENT_STRENGTH + n), 1e-300)
            here = np.bincount(context, weights=total)
            more = np.where(here > 0, uc[lead][np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))] / np.maximum(here, 1), 1)
            discount, mean, last = sample_tables(context[seen], total[seen], parent, bucket, STRENGTH, np.maximum(more, 1))
            kept[seen] = total[seen] - discount * mean
            back += np.bincount(context[seen], weights=discount * mean, minlength=len(back))
            word, which = np.unique(w[lead][seen], return_inverse=True)
            tables = np.bincount(which, weights=last).astype(np.int64)
            home = word % word_count
            for b in np.unique(home):
                at = np.flatnonzero(home == b)
                up.append((-1, "up", int(b), pack(word[at] // word_count), pack(tables[at])))
        out, at = [], 0
        for r, s in zip(rows, size):
            mine = kind[at:at + int(s.sum())]
            first = np.cumsum(s) - s
            out.append((r["block"], "pair", bucket, pack(kept[mine].astype(np.float32)), pack(back[context[mine[first]]].astype(np.float32))))
            at += int(s.sum())
        begin = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        burning = np.flatnonzero(uc[lead][begin] >= hot)
        out += [(int(u[lead][begin[i]]), "hot", bucket, pack(back[i:i + 1].astype(np.float32)), b"") for i in burning]
        return _answers(out + up)

    names = ["block", "bucket", "quotient", "rest", "size", "step", "context_count", "count", "word_count"]
    asked = blocks.groupBy("block").cogroup(vocabulary.where("kind = 'word'").groupBy("block")).applyInArrow(
        ask, "block bigint, bucket int, " + ", ".join(f"{x} binary" for x in names[2:]))
    return materialize(asked.groupBy("bucket").applyInArrow(seat, ANSWER))


def _parent(vocabulary: DataFrame, seated: DataFrame, v: int) -> DataFrame:
    """The restaurant of single words. Kinds: single (per block: mass kept by each word), sum (per bucket: mass
    given back, customers)."""

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.sort_by("block").to_pylist()
        size = next((unpack(r["a"])[0] for r in rows if r["kind"] == "size"), 0)
        customers = np.zeros(int(size), np.int64)
        for r in right.to_pylist():
            np.add.at(customers, unpack(r["a"]), unpack(r["b"]))
        seen, kept, back = np.flatnonzero(customers > 0), np.zeros(int(size)), 0.0
        bucket = rows[0]["bucket"] if rows else 0
        if len(seen):
            # one restaurant: its tables elsewhere are as many as here in proportion, nearly one per known word
            more = np.array([max(1.0, v / len(seen))])
            discount, mean, _ = sample_tables(np.zeros(len(seen), np.int64), customers[seen], np.full(len(seen), 1 / (v + 1)), bucket, PARENT_STRENGTH, more)
            kept[seen], back = customers[seen] - discount * mean, float((discount * mean).sum())
        out = [(r["block"], "single", bucket, pack(kept[unpack(r["a"])].astype(np.float32)), b"") for r in rows if r["kind"] == "word"]
        out.append((-1, "sum", bucket, np.array([back, customers.sum()], np.float64).tobytes(), b""))
        return _answers(out)

    return materialize(vocabulary.groupBy("bucket").cogroup(seated.where("kind = 'up'").groupBy("bucket")).applyInArrow(merge, ANSWER))


def score(documents: DataFrame, held_out: Column, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability)
    for every row; the model learns from the rows that are not held out."""
    spark = documents.sparkSession
    bound_batches(spark)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = documents.select(key).schema[0].dataType
    blocks = _blocks(documents, key, text, held_out, min(50_000, max(64, width)))
    n_words, n_pairs = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_pairs"), F.lit(0))).first()
    cores = spark.sparkContext.defaultParallelism
    word_count = max(2 * cores, math.ceil(n_words / BUCKET_ENTRIES))
    pair_count = max(2 * cores, math.ceil(n_pairs / BUCKET_ENTRIES))
    vocabulary = _vocabulary(blocks, word_count)
    known, learned = 0, 0
    for r in vocabulary.where("kind = 'size'").select("a").collect():  # three numbers per bucket
        _, more, tokens = unpack(bytes(r["a"]))
        known, learned = known + int(more), learned + int(tokens)
    hot = max(1.0, learned / (4 * pair_count))  # at most 4 * pair_count contexts have as many tokens
    seated = _seated(blocks, vocabulary, word_count, pair_count, hot, learned, known)
    given = {r["block"]: r["back"] for r in seated.where("kind = 'hot'").groupBy("block").agg(F.collect_list("a").alias("back")).collect()}
    given = {u: float(sum(unpack(bytes(x))[0] for x in parts)) for u, parts in given.items()}
    parent = _parent(vocabulary, seated, known)
    sums = [np.frombuffer(bytes(r["a"]), np.float64) for r in parent.where("kind = 'sum'").select("a").collect()]
    back0, customers = (float(sum(s[i] for s in sums)) for i in (0, 1))
    shared = spark.sparkContext.broadcast(given)
    out_type = pa.schema([("key", to_arrow_type(kind)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                          ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        given = shared.value
        answers, out = right.to_pylist(), []
        for row in left.to_pylist():
            block = _Block(row, answers, word_count)
            single = np.zeros(len(block.words))
            order, parts = block.deal(pair_count, hot)
            kept, back = np.zeros(len(order)), np.zeros(len(order))
            for a in answers:
                if a["kind"] == "single":
                    single[block.place == a["bucket"]] = unpack(a["a"])
                elif a["kind"] == "pair":
                    at = parts[a["bucket"]]
                    _, size = _contexts_of(block.number[block.context[at]])
                    kept[at], back[at] = unpack(a["a"]), np.repeat(unpack(a["b"]), size)
            split = np.flatnonzero(block.count >= hot)  # contexts of all buckets
            everywhere = np.zeros(len(block.words))
            everywhere[split] = [given.get(int(u), 0.0) for u in block.number[split]]
            back = np.where((block.count >= hot)[block.context], everywhere[block.context], back)
            even = 1 / (known + 1)
            p1 = (single + (PARENT_STRENGTH + back0) * even) / (PARENT_STRENGTH + customers)
            p2 = (kept + (STRENGTH + back) * p1[block.word]) / (STRENGTH + block.count[block.context])
            count = block.count
            base = np.log10((count + 0.5) / (learned + 0.5 * (known + 1)))
            begin = np.cumsum(block.lengths) - block.lengths
            out.append(pa.Table.from_arrays(
                [block.keys["key"], block.keys["held_out"], pa.array(block.lengths), pa.array(np.add.reduceat((count > 0).astype(np.int64)[block.tokens], begin)),
                 pa.array(np.full(len(begin), learned)), pa.array(np.add.reduceat(base[block.tokens], begin)),
                 pa.array(np.add.reduceat(np.log10(p2)[block.which], begin))], schema=out_type))
        return pa.concat_tables(out) if out else out_type.empty_table()

    back = vocabulary.where("kind = 'word'").unionByName(seated.where("kind = 'pair'")).unionByName(parent.where("kind = 'single'"))
    fields = f"key {kind.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return blocks.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(finish, fields).withColumnRenamed("key", key)
