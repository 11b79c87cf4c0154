"""Hard negatives, found with summaries of vector segments.

Vectors are scaled to integers. Each is cut into segments, of which the mean and the deviation (the length
of what the mean leaves) are stored with it; a coarser segment's mean and deviation follow from its parts.
The inner product of two segments is their size times the means' product, plus or minus at most the
product of the deviations. So summed segments bound a score from both sides: a pair is refined from
coarse to fine segments while its bounds reach scores that are still wanted, and only then scored exactly.

Anchors are dealt into blocks of bounded size. Each block is broadcast and meets all rows twice, where
they lie, without moving them: first for the best rows of the anchor's own label (its positives), then,
within the window of scores that each positive allows, for the best rows of other labels. What is still
wanted shrinks as a task's lists fill. A task returns only its lists, which a window per anchor and
positive joins.

Defined results: rows with a null key, label or vector, an empty vector, null or non-finite components, or
another length than the most frequent one (the smaller of a tie) take no part, nor do rows whose scaled
components are so large that a sum of their products need not fit a long. Rows repeated under one key
count once; of different ones, the one with the smallest label, then vector. Zero vectors take part, with
score 0. Higher scores come first, ties by smaller key. An anchor without another row of its label, or a
positive without a row in its window (as for every negative score), gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm.textblocks import bound_batches
from rivulet.session import materialize, share, shared_folder, spread

#: Components of a finest segment, and how many finest segments form one of each coarser level.
FINEST, COARSER = 2, (8, 2)
#: Anchors that are broadcast at once; anchors and rows that meet in one matrix.
BLOCK_ANCHORS, SIDE_ANCHORS, SIDE_ROWS = 8_192, 512, 2_048
#: Below this share of pairs left, they are refined pair by pair and not as a matrix.
FEW = 1 / 16
NONE = np.iinfo(np.int64).min


def summaries(x: np.ndarray) -> np.ndarray:
    """Mean and deviation of every finest segment of the rows, side by side."""
    width = -(-x.shape[1] // (FINEST * COARSER[0])) * FINEST * COARSER[0]
    parts = np.pad(x.astype(np.float64), ((0, 0), (0, width - x.shape[1]))).reshape(len(x), -1, FINEST)
    mean = parts.mean(axis=2)
    return np.hstack([mean, np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2))])


class Vectors:
    """Rows with the summaries of all levels, coarse to fine: (size of a segment, means, deviations)."""

    def __init__(self, x: np.ndarray, summary: np.ndarray, exact: type):
        self.x = x.astype(exact)
        self.length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        mean, deviation = np.hsplit(summary, 2)
        self.levels = []
        for group in (*COARSER, 1):
            m, d = mean.reshape(len(x), -1, group), deviation.reshape(len(x), -1, group)
            whole = m.mean(axis=2)
            self.levels.append((FINEST * group, whole, np.sqrt((d * d + FINEST * (m - whole[:, :, None]) ** 2).sum(axis=2))))

    def take(self, which: np.ndarray) -> Vectors:
        part = object.__new__(Vectors)
        part.x, part.length = self.x[which], self.length[which]
        part.levels = [(n, m[which], d[which]) for n, m, d in self.levels]
        return part


def pairs_between(a: Vectors, b: Vectors, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(row of a, row of b, score) with low <= score <= high, both given per row of a; and the pairs left after every level."""
    rounding = 1e-12 * a.length * b.length.max(initial=0) + 1e-9
    least, most = low - rounding, high + rounding
    alive, i, j, left = np.ones((len(a.x), len(b.x)), bool), None, None, []
    for (size, m, d), (_, mean, deviation) in zip(a.levels, b.levels):
        if i is None:
            centre, span = size * (m @ mean.T), d @ deviation.T
            alive &= (centre + span >= least[:, None]) & (centre - span <= most[:, None])
            left.append(int(np.count_nonzero(alive)))
            if left[-1] < FEW * alive.size:
                i, j = np.nonzero(alive)
        else:
            centre, span = size * np.einsum("ij,ij->i", m[i], mean[j]), np.einsum("ij,ij->i", d[i], deviation[j])
            ok = (centre + span >= least[i]) & (centre - span <= most[i])
            i, j = i[ok], j[ok]
            left.append(len(i))
    if i is None:
        score = a.x @ b.x.T
        i, j = np.nonzero(alive & (score >= low[:, None]) & (score <= high[:, None]))
        return i, j, score[i, j].astype(np.int64), left
    score = np.einsum("ij,ij->i", a.x[i], b.x[j])
    ok = (score >= low[i]) & (score <= high[i])
    return i[ok], j[ok], score[ok].astype(np.int64), left


class Lists:
    """The k best (score, then smaller key) of every slot so far."""

    def __init__(self, slots: int, k: int):
        self.slots, self.k = slots, k
        self.slot, self.score, self.key = (np.empty(0, np.int64) for _ in range(3))
        self.floor = np.full(slots, NONE)  # scores below are of no use to a slot
        self.worst = np.full(slots, np.iinfo(np.int64).max)  # the key that an equal score has to beat

    def add(self, slot: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        useful = (score > self.floor[slot]) | ((score == self.floor[slot]) & (key < self.worst[slot]))
        if not useful.any():
            return
        slot, score, key = (np.concatenate([x, y[useful]]) for x, y in ((self.slot, slot), (self.score, score), (self.key, key)))
        order = np.lexsort((key, -score, slot))
        place = np.arange(len(order)) - np.searchsorted(slot[order], slot[order])
        keep = place < self.k
        self.slot, self.score, self.key = slot[order][keep], score[order][keep], key[order][keep]
        last = np.flatnonzero(place[keep] == self.k - 1)
        self.floor[self.slot[last]], self.worst[self.slot[last]] = self.score[last], self.key[last]


def packed(df: DataFrame) -> DataFrame:
    """key, label, the vector as bytes (int64) and its summaries as bytes (float64); vectors have one length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) if batch.num_rows else np.empty((0, 1), np.int64)
            rows, notes = np.ascontiguousarray(x, np.int64), summaries(x)
            raw = [pa.array([y[i].tobytes() for i in range(len(y))], pa.binary()) for y in (rows, notes)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), *raw], ["key", "label", "vector", "summary"])

    return df.mapInArrow(run, "key bigint, label bigint, vector binary, summary binary")


def _vectors(batch, exact: type) -> Vectors:
    """The vectors of a table or batch."""
    def matrix(name: str, kind: type) -> np.ndarray:
        raw = batch.column(name).to_pylist()
        return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1)

    return Vectors(matrix("vector", np.int64), matrix("summary", np.float64), exact)


def _numbers(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy()


def _best_of(found: DataFrame, slot: list[str], k: int) -> DataFrame:
    """The k best rows of every slot with their rank, from the lists of all tasks."""
    order = Window.partitionBy(*slot).orderBy(F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _positives(base: DataFrame, anchors: pa.Table, k: int, exact: type) -> DataFrame:
    """anchor (place), key, score, rank: the best other rows of the anchor's label."""
    shared = share(base.sparkSession, anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        asked, own, label = _vectors(anchors, exact), _numbers(anchors, "key"), _numbers(anchors, "label")
        lists, of = Lists(len(own), k), {v: np.flatnonzero(label == v) for v in np.unique(label).tolist()}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, keys, labels = _vectors(batch, exact), _numbers(batch, "key"), _numbers(batch, "label")
            for value in np.unique(labels).tolist():
                here = np.flatnonzero(labels == value)
                group = of.get(value, here[:0])
                for part in np.split(group, range(SIDE_ANCHORS, len(group), SIDE_ANCHORS)):
                    for some in np.split(here, range(SIDE_ROWS, len(here), SIDE_ROWS)):
                        if len(part):
                            low = np.maximum(lists.floor[part], -2.0 ** 63)
                            i, j, score, _ = pairs_between(asked.take(part), rows.take(some), low, np.full(len(part), np.inf))
                            other = own[part[i]] != keys[some[j]]
                            lists.add(part[i[other]], score[other], keys[some[j[other]]])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (lists.slot, lists.key, lists.score)], ["anchor", "key", "score"])

    return _best_of(base.mapInArrow(run, "anchor bigint, key bigint, score bigint"), ["anchor"], k)


def _negatives(base: DataFrame, anchors: pa.Table, windows: pa.Table, k: int, exact: type) -> DataFrame:
    """slot (row of ``windows``: anchor, low, high), key, score, rank: the best rows of other labels inside the window."""
    shared = share(base.sparkSession, (anchors, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, windows = shared.value
        asked, label = _vectors(anchors, exact), _numbers(anchors, "label")
        owner, low, high = (_numbers(windows, c) for c in ("anchor", "low", "high"))
        lists = Lists(len(owner), k)
        begin = np.searchsorted(owner, np.arange(len(label) + 1))  # the slots of an anchor follow each other
        live = np.flatnonzero(np.diff(begin))
        for batch in batches:
            rows, keys, labels = _vectors(batch, exact), _numbers(batch, "key"), _numbers(batch, "label")
            for a in range(0, len(live), SIDE_ANCHORS):
                part = live[a:a + SIDE_ANCHORS]
                for b in range(0, batch.num_rows, SIDE_ROWS):
                    some = np.arange(b, min(b + SIDE_ROWS, batch.num_rows))
                    useful = np.maximum(low, lists.floor)
                    least = np.minimum.reduceat(useful, begin[live])[a:a + SIDE_ANCHORS].astype(float)
                    most = np.maximum.reduceat(high, begin[live])[a:a + SIDE_ANCHORS].astype(float)
                    i, j, score, _ = pairs_between(asked.take(part), rows.take(some), least, most)
                    other = label[part[i]] != labels[some[j]]
                    i, j, score = part[i[other]], some[j[other]], score[other]
                    for n in range(int(np.diff(begin).max(initial=0))):
                        slot = begin[i] + n
                        good = slot < begin[i + 1]
                        good[good] = (score[good] >= useful[slot[good]]) & (score[good] <= high[slot[good]])
                        lists.add(slot[good], score[good], keys[j[good]])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (lists.slot, lists.key, lists.score)], ["slot", "key", "score"])

    return _best_of(base.mapInArrow(run, "slot bigint, key bigint, score bigint"), ["slot"], k)


def _whole(column: Column, scale: float) -> Column:
    """Components times ``scale``, rounded down."""
    return F.transform(column.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))


def mined(rows: DataFrame, is_anchor: Column, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = 256,
          positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A negative's score is from ``least`` to ``most`` per cent of the positive's.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    named = rows.select(F.col(key).cast("bigint").alias("key"), F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("vector"),
                        F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    full = named.where(F.col("key").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0))
    common = full.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not common:
        return spark.createDataFrame([], schema)
    width = common[0]["n"]
    bound = math.isqrt(((1 << 63) - 1) // width) - 1
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < float(bound)))
    good = full.where((F.size("vector") == width) & finite).withColumn("vector", _whole(F.col("vector"), scale))
    one = good.groupBy("key").agg(F.min(F.struct("label", "vector")).alias("r"), F.max("anchor").alias("anchor"))
    one = materialize(one.select("key", "r.label", "r.vector", "anchor"))
    base = spread(materialize(packed(one.select("key", "label", "vector"))), "key")
    largest = one.agg(F.max(F.array_max(F.transform("vector", lambda x: F.abs(x))))).first()[0]
    exact = np.float64 if largest is None or width * largest * largest < 1 << 53 else np.int64
    asked = one.where("anchor")
    blocks = max(1, -(-asked.count() // BLOCK_ANCHORS))
    asked = materialize(packed(asked.select("key", "label", "vector")).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))))
    out = shared_folder(spark)
    for block in range(blocks):
        anchors = asked.where(F.col("block") == block).drop("block").orderBy("key").toArrow().combine_chunks()
        if not anchors.num_rows:
            continue
        best = _positives(base, anchors, positives, exact).select("anchor", "key", "score").orderBy("anchor", F.desc("score"), "key").toArrow()
        score = best["score"].to_pylist()  # at most ``positives`` rows per anchor of the block
        windows = pa.table({"anchor": best["anchor"], "positive": best["key"], "score": best["score"],
                            "low": pa.array([-(-least * s // 100) for s in score], pa.int64()), "high": pa.array([most * s // 100 for s in score], pa.int64())})
        wanted = windows.filter(pa.array([s >= 0 for s in score], pa.bool_())).combine_chunks()
        found = _negatives(base, anchors, wanted, negatives, exact)
        slots = spark.createDataFrame(pa.table({
            "slot": pa.array(np.arange(wanted.num_rows)), "anchor_id": anchors["key"].take(wanted["anchor"]), "positive_id": wanted["positive"], "positive_score": wanted["score"]}))
        found.join(F.broadcast(slots), "slot").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("key").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out) if asked.count() else spark.createDataFrame([], schema)
