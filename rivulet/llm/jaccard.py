"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

A text is the set of its shingles (five lower-cased words that follow each other; all words of a
shorter text). Texts of one set form a copy class, represented once. The signature of a set is TREES
sequences of DEPTH minimum hashes; a tree is the sorted list of its sequences, that is a prefix trie,
and two neighbours in it match on a prefix. Candidates are those that share a prefix of the current
depth in any tree. Their connected groups are verified exactly, set against set, in blocks of bounded
size; the links found estimate how many were missed (each link of similarity s is found with
probability 1 - (1 - s^depth)^TREES), and prefixes are shortened until the estimated recall reaches
the target.

Only representatives meet, copies are never paired. Trees are sorted by range, so a prefix shared by
very many texts spreads over tasks; a large group is cut into blocks that meet pairwise, and only
sums and a spanning forest leave a block.

Defined results: texts without words (null, empty, blank) have no links; every input row gives a row;
rows with equal ids and different texts are told apart by their text; a class is named by its least
id, nulls last. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm.components import components
from rivulet.llm.textblocks import bound_batches, flat_bytes, hash_words, lean, mix, runs, strings, unused
from rivulet.session import materialize

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH, LEAST_DEPTH = 24, 6, 3
TARGET_RECALL = 0.9995
#: Shingles of a block; larger groups are cut into blocks that meet pairwise.
BLOCK_SHINGLES = 1 << 18
#: Rows to drop (an id and a hash each) of one broadcast, about; more are dealt by a hash into several.
BROADCAST_ROWS = 2_000_000
_BLANKS = np.zeros(256, bool)
_BLANKS[[*range(9, 14), 32]] = True


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after the other, and where each text begins."""
    data, offsets = flat_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    starts, ends, text = runs(~_BLANKS[data], offsets)
    coded = strings(data, starts, ends).dictionary_encode()
    token = hash_words(coded.dictionary)[coded.indices.to_numpy()] if len(starts) else np.empty(0, np.uint64)
    count = np.bincount(text, minlength=len(texts))
    first = np.cumsum(count) - count
    h = np.zeros(len(token), np.uint64)
    left = (first + count)[text] - np.arange(len(token))  # words up to the text's end
    for i in range(words):
        h[:len(token) - i] = np.where(left[:len(token) - i] > i, mix(h[:len(token) - i] * np.uint64(31) + token[i:]), h[:len(token) - i])
    keep = (left >= words) | (np.arange(len(token)) == first[text])
    h, text = h[keep], text[keep]
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[new], text[new]
    return h, np.searchsorted(text, np.arange(len(texts) + 1))


_RNG = np.random.default_rng(20240229)
_FACTORS = (_RNG.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_TERMS = _RNG.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)


def signatures(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Minimum hashes of every set, texts x (TREES * DEPTH); empty sets are all ones."""
    out = np.full((len(begin) - 1, TREES * DEPTH), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(begin[1:] > begin[:-1])
    if len(some):
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        work = np.empty_like(low)
        for i in range(TREES * DEPTH):
            np.multiply(low, _FACTORS[i], out=work)
            np.add(work, _TERMS[i], out=work)
            np.bitwise_xor(work, work >> np.uint32(15), out=work)
            out[some, i] = np.minimum.reduceat(work, begin[some])
    return out


def _sets(documents: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(key, th, copy, n, signature): the text's hash, the fingerprint and size of its set, and the signature."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, begin = shingles(batch.column("text"), words)
            raw = np.ascontiguousarray(h).tobytes()
            copy = [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() for a, b in zip(begin, begin[1:])]
            sig = np.ascontiguousarray(signatures(h, begin).astype(">u4"))
            width = 4 * TREES * DEPTH
            blob = sig.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("th"), pa.array(copy, pa.binary()), pa.array(np.diff(begin)),
                 pa.array([blob[i * width:(i + 1) * width] for i in range(batch.num_rows)], pa.binary())], ["key", "th", "copy", "n", "signature"])

    source = documents.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(lean(run), f"key {kind}, th bigint, copy binary, n bigint, signature binary")


def _trie_edges(representatives: DataFrame) -> DataFrame:
    """(a, b, depth): in every tree, each sequence with the first one of the longest prefix it shares with
    its predecessor. The groups connected by edges of at least some depth are those that share prefixes of it."""
    width = 4 * DEPTH
    trees = representatives.select("copy", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.substring(F.col("signature"), t * width + 1, F.lit(width)))).alias("tree", "path"))
    trees = trees.select(F.concat(F.unhex(F.lpad(F.hex("tree"), 4, "0")), "path").alias("path"), "copy")
    parts = int(representatives.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the first sequence with each prefix length of the current one
        path, copy, first = None, None, [None] * (DEPTH + 1)
        for batch in batches:
            a, b, depth, edge_path = [], [], [], []
            for p, c in zip(batch.column("path").to_pylist(), batch.column("copy").to_pylist()):
                if path is None:
                    a.append(c)
                    b.append(c)
                    depth.append(-1)  # the ends of a partition, matched with those of the next one below
                    edge_path.append(p)
                    common = 0
                else:
                    common = shared(path, p)
                    if common >= LEAST_DEPTH:
                        a.append(first[common])
                        b.append(c)
                        depth.append(common)
                        edge_path.append(None)
                for k in range(common + 1, DEPTH + 1):
                    first[k] = c
                path, copy = p, c
            yield rows(a, b, depth, edge_path)
        if path is not None:
            yield rows([copy], [copy], [-1], [path])

    def shared(p: bytes, q: bytes) -> int:
        if p == q:
            return DEPTH
        if p[:2 + 4 * LEAST_DEPTH] != q[:2 + 4 * LEAST_DEPTH]:
            return 0
        k = LEAST_DEPTH
        while p[:6 + 4 * k] == q[:6 + 4 * k]:
            k += 1
        return k

    def rows(a: list, b: list, depth: list, path: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(depth, pa.int32()), pa.array(path, pa.binary())], ["a", "b", "depth", "path"])

    found = materialize(
        trees.repartitionByRange(parts, "path", "copy").sortWithinPartitions("path", "copy").mapInArrow(lean(run), "a binary, b binary, depth int, path binary"))
    order = Window.orderBy("path", "a")  # two rows per partition
    ends = found.where("depth = -1").select("a", "path", F.lag("a").over(order).alias("b"), F.lag("path").over(order).alias("before"))
    common = sum((F.when(F.substring("path", 1, 2 + 4 * k) == F.substring("before", 1, 2 + 4 * k), 1).otherwise(0)
                  for k in range(1, DEPTH + 1)), F.lit(0))
    joined = ends.where("b is not null").select("b", "a", common.alias("depth")).where(F.col("depth") >= LEAST_DEPTH)
    return found.where("depth >= 0").select("a", "b", "depth").unionByName(joined.select(F.col("b").alias("a"), F.col("a").alias("b"), "depth"))


def _verify(x: list[tuple], y: list[tuple] | None, limit: Fraction, found_with) -> list[list]:
    """[copy, root, links, expected] of every member of a block (y is None) or of two different blocks.

    A member is (copy, copies, hashes). Links are weighted by the copies of the other side, and expected
    is the same divided by the chance to be found. The root is the least member connected here.
    """
    members = x if y is None else x + y
    sizes = np.array([len(m[2]) for m in members], np.int64)
    weight = np.array([m[1] for m in members], np.float64)
    n, split = len(members), len(x)
    base = np.arange(n) if y is None else np.arange(split, n)
    flat = np.concatenate([members[i][2] for i in base])
    owner = np.repeat(base, sizes[base])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    links, expected, parent = np.zeros(n), np.zeros(n), list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(split):
        low, high = np.searchsorted(flat, members[i][2], "left"), np.searchsorted(flat, members[i][2], "right")
        count = high - low
        spots = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        common = np.bincount(owner[spots], minlength=n)
        union = sizes[i] + sizes - common
        good = np.flatnonzero((common * limit.denominator >= limit.numerator * union) & (common > 0))
        good = good[good > i]
        if len(good):
            chance = found_with(common[good] / union[good])
            links[i] += weight[good].sum()
            links[good] += weight[i]
            expected[i] += (weight[good] / chance).sum()
            expected[good] += weight[i] / chance
            for j in good.tolist():
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    return [[members[i][0], members[root(i)][0], links[i], expected[i]] for i in range(n)]


def _linked(grouped: DataFrame, threshold: float, depth: int) -> DataFrame:
    """(copy, root, links, expected, blocks) from (label, blocks, i, j, side, copy, copies, hashes)."""
    limit = Fraction(threshold).limit_denominator(10_000)

    def found_with(s: np.ndarray) -> np.ndarray:
        return 1 - (1 - s ** depth) ** TREES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides, blocks = None, ([], []), 1
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("label", "i", "j", "side", "copy", "copies", "hashes", "blocks")]
            for label, i, j, side, copy, copies, hashes, many in zip(*columns):
                if (label, i, j) != key:
                    out += finish(key, sides, blocks)
                    key, sides, blocks = (label, i, j), ([], []), many
                sides[side].append((copy, copies, np.frombuffer(hashes, np.uint64)))
            yield rows(out)
        yield rows(finish(key, sides, blocks))

    def finish(key, sides, blocks) -> list[list]:
        if key is None:
            return []
        x, y = ([*sides[0]], None) if key[1] == key[2] else ([*sides[0]], [*sides[1]])
        if y is not None and not (x and y):
            return []
        return [[*r, blocks] for r in _verify(sorted(x, key=lambda m: m[0]), y, limit, found_with)]

    def rows(out: list[list]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["copy", "root", "links", "expected", "blocks"])

    ordered = grouped.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "side", "copy")
    return ordered.mapInArrow(lean(run), "copy binary, root binary, links double, expected double, blocks bigint")


def _members(documents: DataFrame, key: str, text: str, words: int, chosen: DataFrame) -> DataFrame:
    """``chosen`` (copy, rep, th, ...) with the shingle hashes of each representative."""
    more = [f for f in chosen.schema.fields if f.name not in ("rep", "th")]
    source = documents.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_th"), F.col(text).cast("string").alias("text"))
    on = chosen["rep"].eqNullSafe(source["_key"]) & (chosen["th"] == source["_th"])
    joined = source.join(chosen, on).select("text", *[f.name for f in more])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, begin = shingles(batch.column("text"), words)
            raw = [h[a:b].tobytes() for a, b in zip(begin, begin[1:])]
            # a text hash shared by two texts: only the one that is the copy's
            good = [hashlib.blake2b(r, digest_size=16).digest() == c for r, c in zip(raw, batch.column("copy").to_pylist())]
            out = pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in more], pa.array(raw, pa.binary())], [*[f.name for f in more], "hashes"])
            yield out.filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(lean(run), f"{fields}, hashes binary").dropDuplicates(["copy"])


def near_duplicates(documents: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD,
                    target_recall: float = TARGET_RECALL) -> DataFrame:
    """One row per input row: key, text_hash, class_id (least key of the texts connected by links),
    copy_id (least key of those with the same set), n_links (other rows with similarity >= threshold),
    has_words, class_key (the same for all rows of a class, whatever their keys)."""
    bound_batches(documents.sparkSession)
    sets = materialize(_sets(documents, key, text, words))
    classes = materialize(
        sets.where("n > 0").groupBy("copy").agg(
            F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("signature").alias("signature"),
            F.min(F.struct(F.col("key").isNull(), F.col("key"), F.col("th"))).alias("least"))
        .select("copy", "copies", "n", "signature", F.col("least.key").alias("rep"), F.col("least.th").alias("th")))
    edges = _trie_edges(classes)
    edges = materialize(edges.groupBy("a", "b").agg(F.max("depth").alias("depth")))
    verified = None
    for depth in range(DEPTH, LEAST_DEPTH - 1, -1):
        groups = components(edges.where(F.col("depth") >= depth), "a", "b")
        grouped = materialize(groups.join(classes.drop("signature"), groups["node"] == classes["copy"]).drop("node"))
        sizes = grouped.groupBy("label").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
        chosen = grouped.join(sizes, "label")
        block = F.pmod(F.xxhash64("copy"), F.col("blocks"))
        members = _members(documents, key, text, words, chosen.select("copy", "rep", "th", "copies", "label", "blocks", block.alias("block")))
        pairs = members.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
        pairs = pairs.select("label", "blocks", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                             (F.col("block") > F.col("other")).cast("int").alias("side"), "copy", "copies", "hashes")
        verified = materialize(_linked(pairs, threshold, depth))
        found, expected = verified.agg(F.sum("links"), F.sum("expected")).first()
        if not expected or found / expected >= target_recall:
            break
    sums = verified.groupBy("copy").agg(F.sum("links").cast("bigint").alias("links"))
    roots = verified.where("blocks = 1").select("copy", "root")
    several = verified.where("blocks > 1").select("copy", "root")
    if not several.isEmpty():
        joined = components(several, "copy", "root")
        alone = several.join(joined, several["copy"] == joined["node"], "left_anti").select("copy", F.col("copy").alias("root")).distinct()
        roots = roots.unionByName(joined.select(F.col("node").alias("copy"), F.col("label").alias("root"))).unionByName(alone)
    linked = roots.join(sums, "copy").join(classes.select("copy", "rep"), "copy")
    names = linked.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull(), F.col("rep"))).alias("least"))
    linked = materialize(linked.join(names, "root").select("copy", "root", "links", F.col("least.rep").alias("class_id")))
    info = classes.select("copy", "copies", "rep").join(linked, "copy", "left")
    info = info.select("copy", F.struct(
        F.lit(1).alias("known"), F.when(F.col("links").isNotNull(), F.col("class_id")).otherwise(F.col("rep")).alias("class_id"),
        F.coalesce("root", "copy").alias("class_key"), F.col("rep").alias("copy_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")).alias("info"))
    # a copy class is unique in info, so only the documents' side can be uneven, and that Spark can split
    return sets.select("key", "th", "copy", "n").join(info, "copy", "left").select(
        F.col("key").alias(key), F.col("th").alias("text_hash"),
        F.when(F.col("info").isNull(), F.col("key")).otherwise(F.col("info.class_id")).alias("class_id"),
        F.when(F.col("info").isNull(), F.col("key")).otherwise(F.col("info.copy_id")).alias("copy_id"),
        F.coalesce(F.col("info.n_links"), F.lit(0)).cast("bigint").alias("n_links"), (F.col("n") > 0).alias("has_words"), F.coalesce("info.class_key", "copy").alias("class_key"))


def keep_one(documents: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``documents`` with one row of every class, that of the least key; texts without words all stay.
    Other columns, of any name, pass through."""
    found = near_duplicates(documents, key=key, text=text, **options).where("has_words")
    rows = materialize(found.groupBy("class_key", F.col(key).alias("_k"), F.col("text_hash").alias("_h")).agg(F.count(F.lit(1)).alias("_n")))
    lead = rows.groupBy("class_key").agg(F.min(F.struct(F.col("_k").isNull(), F.col("_k"), F.col("_h"))).alias("lead"))
    judged = rows.join(lead, "class_key").select("_k", "_h", "_n", (F.col("lead._k").eqNullSafe(F.col("_k")) & (F.col("lead._h") == F.col("_h"))).alias("_first"))
    drop = materialize(judged.where("not _first").select("_k", "_h"))
    blocks = max(1, -(-drop.count() // BROADCAST_ROWS))  # one broadcast join each, in one scan: no text moves at any size
    mark = unused(documents.columns, "text_hash")
    left = documents.withColumn(mark, F.xxhash64(text))
    for b in range(blocks):
        block = F.broadcast(drop.where(F.pmod(F.xxhash64("_k", "_h"), F.lit(blocks)) == b))
        left = left.join(block, left[key].eqNullSafe(block["_k"]) & (left[mark] == block["_h"]), "left_anti")
    again = materialize(judged.where("_first and _n > 1").select("_k", "_h"))
    if again.isEmpty():
        return left.drop(mark)
    on = left[key].eqNullSafe(again["_k"]) & (left[mark] == again["_h"])
    once = left.join(again, on, "left_semi").dropDuplicates([key, mark])
    return left.join(again, on, "left_anti").unionByName(once).drop(mark)
