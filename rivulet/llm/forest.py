"""Approximate nearest neighbours by a forest of random-projection trees.

Nearness is the inner product. Vectors get one more component, so that all have the same length and
the largest inner product is the smallest distance. A tree has orthogonal random directions, one per
level; a node splits at the median of its part of a bounded sample, so a tree is its directions and
its thresholds. All rows are assigned to leaves. A query's leaves come from one priority queue shared
by all trees: nodes leave it in the order of the squared distance between query and cell, and opening
one puts both halves back. The candidates of the leaves are scored exactly on the original vectors.

How many leaves to open is measured, not guessed: for a bounded set of queries the true neighbours are
found by a scan, and the number is the least one whose recall reaches the target.

Leaves are dealt to groups of bounded size, queries to blocks of bounded size; a group and a block
meet in a task, which returns the best k per query, never pairs. Of equal vectors only the k + 1
smallest ids can be neighbours, and only those take part; equal queries are searched once.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, null ids,
and vectors of another length than the most frequent one (the smaller one of a tie) take no part;
repeated rows count once; with fewer candidates than k, all are returned.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm.textblocks import bound_batches
from rivulet.session import materialize, share

TREES, LEAF = 4, 128
SAMPLE_ROWS = 32_768
#: Queries with which the recall is measured, and the recall to reach.
TRIAL_QUERIES, TARGET_RECALL = 200, 0.96
GROUP_ROWS, BLOCK_QUERIES = 8_192, 50_000


@dataclass(frozen=True)
class Forest:
    """directions: trees x levels x (dim + 1); thresholds: trees x (2 ** levels), a heap from index 1 on."""

    directions: np.ndarray
    thresholds: np.ndarray
    scale: float

    @property
    def levels(self) -> int:
        return self.directions.shape[1]

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Rows scaled to length 1 by one more component."""
        y = x / self.scale
        return np.hstack([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))[:, None]])

    def project(self, lifted: np.ndarray) -> np.ndarray:
        """trees x rows x levels."""
        return np.einsum("nd,tld->tnl", lifted, self.directions, optimize=True)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """trees x rows: the leaf of every row."""
        p = self.project(self.lifted(x))
        node = np.ones(p.shape[:2], np.int64)
        tree = np.arange(len(p))[:, None]
        for level in range(self.levels):
            node = 2 * node + (p[:, :, level] > self.thresholds[tree, node])
        return node - (1 << self.levels)

    def search(self, projected: np.ndarray) -> Iterator[tuple[int, int]]:
        """(tree, leaf) by growing distance; ``projected`` is trees x levels of one query."""
        levels, first = self.levels, 1 << self.levels
        margin, cut = projected.tolist(), self.thresholds
        queue = [(0.0, t, 0, 1) for t in range(len(margin))]
        while queue:
            cost, t, level, node = heapq.heappop(queue)
            while level < levels:
                gap = margin[t][level] - cut[t, node]
                near = 2 * node + (gap > 0)
                heapq.heappush(queue, (cost + gap * gap, t, level + 1, near ^ 1))
                node, level = near, level + 1
            yield t, node - first


def grow(sample: np.ndarray, rows: int, scale: float, trees: int = TREES, leaf: int = LEAF, seed: int = 17) -> Forest:
    """Trees for ``rows`` rows, from a sample of them."""
    rng = np.random.default_rng(seed)
    width = sample.shape[1] + 1
    levels = max(0, min(width, math.ceil(math.log2(max(1, rows / leaf))), int(math.log2(max(1, len(sample) / 4)))))
    directions = np.empty((trees, levels, width))
    for t in range(trees):
        directions[t] = np.linalg.qr(rng.normal(size=(width, width)))[0][:levels]
    forest = Forest(directions, np.zeros((trees, max(2, 1 << levels))), scale)
    p = forest.project(forest.lifted(sample))
    for t in range(trees):
        node = np.ones(len(sample), np.int64)
        for level in range(levels):
            order = np.lexsort((p[t, :, level], node))
            names, begin, count = np.unique(node[order], return_index=True, return_counts=True)
            forest.thresholds[t, names] = p[t, order[begin + (count - 1) // 2], level]
            node = 2 * node + (p[t, :, level] > forest.thresholds[t, node])
    return forest


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a binary column as float64 vectors."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1) if raw else np.empty((0, 1))


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products pair by pair; equal vectors get equal scores wherever they stand."""
    return np.einsum("ij,ij->i", queries, rows)


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of every query, larger score first, then smaller id; an id counts once per query."""
    order = np.lexsort((ids, -score, query))
    q, i = query[order], ids[order]
    new = np.ones(len(order), bool)
    new[1:] = (q[1:] != q[:-1]) | (i[1:] != i[:-1])  # equal ids of one vector have equal scores, and are neighbours here
    order, q = order[new], q[new]
    begin = np.searchsorted(q, q, side="left")
    return order[np.arange(len(q)) - begin < k]


class _Top:
    """The k best candidates so far of every query of a matrix."""

    def __init__(self, vectors: np.ndarray, k: int):
        self.vectors, self.k = vectors, k
        self.query, self.ids, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def add(self, which: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Candidates ``rows`` for the queries ``which``."""
        rough = self.vectors[which] @ rows.T
        if rough.shape[1] > self.k:
            least = np.partition(rough, rough.shape[1] - self.k, axis=1)[:, -self.k]
            q, r = np.nonzero(rough >= (least - 1e-9 * np.maximum(1, np.abs(least)))[:, None])
        else:
            q, r = (x.ravel() for x in np.indices(rough.shape))
        self.query = np.concatenate([self.query, which[q]])
        self.ids = np.concatenate([self.ids, ids[r]])
        self.score = np.concatenate([self.score, _exact(self.vectors[which[q]], rows[r])])
        if len(self.query) > 1_000_000:
            self.trim()

    def trim(self) -> None:
        keep = _best(self.query, self.ids, self.score, self.k)
        self.query, self.ids, self.score = self.query[keep], self.ids[keep], self.score[keep]


def _lists(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * 3
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()))], ["query", "ids", "scores"])


def usable(vector: str) -> Column:
    """Not null or empty, all components finite, not all zero."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _packed(df: DataFrame) -> DataFrame:
    """id, vector as the bytes of its components (float64)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, n = batch.column("vector").flatten().to_numpy(zero_copy_only=False) + 0.0, batch.num_rows
            raw, width = np.ascontiguousarray(flat, np.float64).tobytes(), 8 * (len(flat) // max(1, n))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([raw[i * width:(i + 1) * width] for i in range(n)], pa.binary())], ["id", "vector"])

    return df.mapInArrow(run, "id bigint, vector binary")


def _some(df: DataFrame, rows: int, total: int) -> DataFrame:
    """About ``rows`` rows and never more than twice as many, by a hash of the id."""
    part = 1 + min(1_000_000, rows * 1_000_000 // max(1, total))
    return df.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < part).limit(2 * rows)


def _scan(base: DataFrame, trial: pa.Table, forest: Forest, k: int) -> pa.Table:
    """True neighbours of a bounded set of queries, with their leaves: query (place), id, score, leaves."""
    shared = share(base.sparkSession, (forest, _matrix(trial["vector"].combine_chunks())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, vectors = shared.value
        top, leaf = _Top(vectors, k), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = _matrix(batch.column("vector")), batch.column("id").to_numpy()
            top.add(np.arange(len(vectors)), ids, x)
            top.trim()
            live = np.unique(top.ids)
            mine = np.flatnonzero(np.isin(ids, live))
            leaf = {i: v for i, v in leaf.items() if i in set(live.tolist())} | dict(zip(ids[mine].tolist(), forest.leaves(x[mine]).T.tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(top.query), pa.array(top.ids), pa.array(top.score), pa.array([leaf[i] for i in top.ids.tolist()], pa.list_(pa.int64()))],
            ["query", "id", "score", "leaves"])

    found = base.mapInArrow(run, "query bigint, id bigint, score double, leaves array<bigint>")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r").toArrow()


def leaves_to_open(forest: Forest, vectors: np.ndarray, ids: np.ndarray, truth: pa.Table, recall: float) -> tuple[int, float]:
    """The least number of leaves that finds the share ``recall`` of the true neighbours, and the share it finds."""
    needed: list[int] = []
    everything = len(forest.directions) << forest.levels
    query, found, leaves = truth["query"].to_numpy(), truth["id"].to_numpy(), truth["leaves"].to_pylist()
    p = forest.project(forest.lifted(vectors / np.linalg.norm(vectors, axis=1, keepdims=True) * forest.scale))
    for i in range(len(vectors)):
        rest = {int(j): set(enumerate(leaves[j])) for j in np.flatnonzero((query == i) & (found != ids[i]))}
        for number, place in enumerate(forest.search(p[:, i]), 1):
            hit = [j for j, own in rest.items() if place in own]
            for j in hit:
                needed.append(number)
                del rest[j]
            if not rest:
                break
    if not needed:
        return everything, 1.0
    needed.sort()
    number = needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]
    return number, sum(x <= number for x in needed) / len(needed)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, *, key: str = "vec_id", vector: str = "embedding", trees: int = TREES, leaf: int = LEAF,
            target_recall: float = TARGET_RECALL) -> DataFrame:
    """query_id, rank, key, score, opened (leaves per query), recall (measured on the trial queries)."""
    spark = rows.sparkSession
    bound_batches(spark)
    good = rows.where(usable(vector) & F.col(key).isNotNull())
    schema = f"query_id bigint, rank int, {key} bigint, score double, opened int, recall double"
    common = good.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not common:
        return spark.createDataFrame([], schema)
    good = good.where(F.size(vector) == common[0]["n"]).select(
        F.col(key).cast("bigint").alias("id"), F.transform(F.col(vector).cast("array<double>"), lambda x: x + 0.0).alias("vector"), is_query.alias("q"))
    distinct = good.groupBy("id", "vector").agg(F.max("q").alias("q"))
    by_vector = Window.partitionBy("vector").orderBy("id")
    base = materialize(_packed(distinct.withColumn("_r", F.row_number().over(by_vector)).where(F.col("_r") <= k + 1).select("id", "vector")))
    asked = _packed(distinct.where("q").select("id", "vector"))
    asked = materialize(asked)
    reps = materialize(asked.groupBy("vector").agg(F.min("id").alias("id")))
    total, n_queries = base.count(), reps.count()
    if not n_queries:
        return spark.createDataFrame([], schema)

    def length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"))
            yield pa.RecordBatch.from_arrays([pa.array(np.linalg.norm(x, axis=1).max(initial=0, keepdims=True))], ["m"])

    scale = base.mapInArrow(length, "m double").agg(F.max("m")).first()[0] * (1 + 1e-12)
    forest = grow(_matrix(_some(base, SAMPLE_ROWS, total).toArrow()["vector"].combine_chunks()), total, scale, trees, leaf)
    trial = _some(reps, TRIAL_QUERIES, n_queries).limit(TRIAL_QUERIES).toArrow()
    opened, recall = len(forest.directions) << forest.levels, 1.0
    if trial.num_rows:
        truth = _scan(base, trial, forest, k + 1)
        opened, recall = leaves_to_open(forest, _matrix(trial["vector"].combine_chunks()), trial["id"].to_numpy(), truth, target_recall)
    shared = share(spark, forest)
    groups, blocks = math.ceil(total / GROUP_ROWS), math.ceil(n_queries / BLOCK_QUERIES)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = shared.value.leaves(_matrix(batch.column("vector")))
            for t in range(len(leaves)):
                for b in range(blocks):
                    n = batch.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, t, np.int32)), pa.array((leaves[t] % groups).astype(np.int32)), pa.array(np.full(n, b, np.int32)),
                         pa.array(leaves[t]), batch.column("id"), batch.column("vector")], ["tree", "part", "block", "leaf", "id", "vector"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            x = _matrix(batch.column("vector"))
            p = forest.project(forest.lifted(x / np.linalg.norm(x, axis=1, keepdims=True) * forest.scale))
            ids, raw, out = batch.column("id").to_pylist(), batch.column("vector").to_pylist(), []
            for i in range(len(ids)):
                found: dict[tuple[int, int], list[int]] = {}
                for number, (t, leaf) in enumerate(forest.search(p[:, i])):
                    if number == opened:
                        break
                    found.setdefault((t, leaf % groups), []).append(leaf)
                out += [(t, g, ids[i] % blocks, ids[i], raw[i], leaves) for (t, g), leaves in found.items()]
            columns = list(zip(*out)) or [[]] * 6
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["tree", "part", "block", "query", "vector", "leaves"])

    def meet(questions: pa.Table, rows: pa.Table) -> pa.Table:
        if not questions.num_rows or not rows.num_rows:
            return _lists([])
        who = questions["query"].to_numpy()
        lists = questions["leaves"].combine_chunks()
        wanted, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        asker = np.repeat(np.arange(len(who)), sizes)
        order = np.argsort(wanted, kind="stable")
        wanted, asker = wanted[order], asker[order]
        leaf, ids, x = rows["leaf"].to_numpy(), rows["id"].to_numpy(), _matrix(rows["vector"].combine_chunks())
        by_leaf = np.argsort(leaf, kind="stable")
        leaf, ids, x = leaf[by_leaf], ids[by_leaf], x[by_leaf]
        top = _Top(_matrix(questions["vector"].combine_chunks()), k + 1)
        for one in np.unique(wanted):
            a, b = np.searchsorted(leaf, [one, one + 1])
            c, d = np.searchsorted(wanted, [one, one + 1])
            if a < b:
                top.add(asker[c:d], ids[a:b], x[a:b])
        top.trim()
        order = np.argsort(top.query, kind="stable")
        number, ids, score = top.query[order], top.ids[order], top.score[order]
        one, first = np.unique(number, return_index=True)
        return _lists([(int(who[q]), i.tobytes(), s.tobytes()) for q, i, s in zip(one, np.split(ids, first[1:]), np.split(score, first[1:]))])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k + 1 best of every query; its lists follow each other."""
        query, ids, score = None, [], []

        def best() -> tuple[np.ndarray, np.ndarray]:
            i, s = np.concatenate(ids), np.concatenate(score)
            keep = _best(np.zeros(len(i), np.int64), i, s, k + 1)
            return i[keep], s[keep]

        def row() -> tuple:
            i, s = best()
            return query, [{"less": -x, "id": y} for x, y in zip(s.tolist(), i.tolist())]

        for batch in batches:
            done = []
            for q, i, s in zip(*(batch.column(c).to_pylist() for c in ("query", "ids", "scores"))):
                if q != query:
                    done += [row()] if query is not None else []
                    query, ids, score = q, [], []
                ids.append(np.frombuffer(i, np.int64))
                score.append(np.frombuffer(s, np.float64))
                if len(ids) > 64:
                    i, s = best()
                    ids, score = [i], [s]
            yield answers_of(done)
        yield answers_of([row()] if query is not None else [])

    def answers_of(rows: list[tuple]) -> pa.RecordBatch:
        found = pa.list_(pa.struct([("less", pa.float64()), ("id", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], found)], ["query", "found"])

    on = ["tree", "part", "block"]
    left = reps.select("id", "vector").mapInArrow(ask, "tree int, part int, block int, query bigint, vector binary, leaves array<bigint>")
    right = base.mapInArrow(place, "tree int, part int, block int, leaf bigint, id bigint, vector binary")
    met = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(meet, "query bigint, ids binary, scores binary")
    best = met.repartition("query").sortWithinPartitions("query").mapInArrow(merge, "query bigint, found array<struct<less:double,id:bigint>>")
    answers = best.join(reps.select(F.col("id").alias("query"), "vector"), "query")
    full = asked.select(F.col("id").alias("query_id"), "vector").join(answers.select("vector", "found"), "vector")
    own = F.slice(F.filter("found", lambda f: f["id"] != F.col("query_id")), 1, k)
    return full.select("query_id", F.posexplode(own).alias("rank", "f")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("f.id").alias(key), (-F.col("f.less")).alias("score"),
        F.lit(opened).alias("opened"), F.lit(float(recall)).alias("recall"))
