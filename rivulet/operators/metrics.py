"""Classification metrics from aggregates over distinct scores or threshold buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.ranks import exact_quantiles, pick_quantiles, running_totals, value_counts
from rivulet.session import materialize

# Threshold grids.
BEST_GRID = tuple(round(0.1 + 0.01 * i, 2) for i in range(81))
CURVE_GRID = tuple(round(0.2 + 0.05 * i, 2) for i in range(13))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def cumulative_by_score(df: DataFrame, y: str, p: str, groups=()) -> DataFrame:
    """Per distinct score: positives and rows at it, and true/false positives at or above it."""
    runs = running_totals(df, p, {"pos": F.sum(F.col(y).cast("bigint")), "n": F.count(F.lit(1))}, groups)
    tp = F.col("pos_all") - F.col("pos_before")
    fp = F.col("n_all") - F.col("n_before") - tp
    return runs.select(*groups, p, "pos", "n", tp.alias("tp"), fp.alias("fp"), "pos_all", "n_all",
                       (F.col("n_before") - F.col("pos_before")).alias("neg_below"))


def ranking_metrics(df: DataFrame, y: str, p: str, groups=()) -> DataFrame:
    """Average precision (step sum over distinct scores) and ROC-AUC; one row, or one per group."""
    c = cumulative_by_score(df, y, p, groups)
    neg = F.col("n") - F.col("pos")
    ap = F.sum(F.col("pos") / F.col("pos_all") * F.col("tp") / (F.col("tp") + F.col("fp")))
    auc = F.sum(F.col("pos") * (F.col("neg_below") + neg / 2)) / F.max(F.col("pos_all").cast("double") * (F.col("n_all") - F.col("pos_all")))
    return c.groupBy(*groups).agg(ap.alias("average_precision"), auc.alias("roc_auc"))


#: Scores that are sorted at once, by a task or in a range of scores.
SORTED_ROWS = 4_000_000


def _distinct(group: np.ndarray, p: np.ndarray, pos: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct (group, score) in order, with their positives and rows."""
    order = np.lexsort((p, group))
    group, p = group[order], p[order]
    first = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (p[1:] != p[:-1])]) if len(p) else np.zeros(0, np.int64)
    add = lambda x: np.add.reduceat(x[order], first) if len(first) else np.zeros(0, np.int64)
    return group[first], p[first], add(pos), add(n)


def score_ranges(df: DataFrame, p: str, ranges: int) -> list[float]:
    """Scores that cut the rows into so many parts of about the same size."""
    if ranges < 2:
        return []
    cuts = pick_quantiles(value_counts(df, p), p, {f"q{i}": i / ranges for i in range(1, ranges)}).first()
    return sorted({cuts[f"q{i}"] for i in range(1, ranges)} - {None}) if cuts else []


def average_precisions(df: DataFrame, y: str, p: str, group: str, groups: int, edges: list[float]) -> DataFrame:
    """(group, average_precision) of ``ranking_metrics`` for many groups 0 .. ``groups`` - 1 over similar scores.

    Tasks sort and count their own scores and deal them out by the ranges between ``edges``; a range is finished in one
    task, as arrays, given the positives and rows above it. Any edges give the same result.
    """

    def packed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        of, score, label = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in rows]) for c in range(3))
        at = np.searchsorted(edges, score, side="right") if edges else np.zeros(len(score), np.int64)
        key, score, pos, n = _distinct(at * groups + of, score, label.astype(np.int64), np.ones(len(score), np.int64))
        ends = np.searchsorted(key, np.arange((len(edges) + 1) * groups + 1)).reshape(-1)
        found = np.flatnonzero(ends[groups::groups] > ends[:-1:groups])
        part = lambda x, kind: pa.array([x[ends[i * groups]:ends[(i + 1) * groups]].astype(kind) for i in found], pa.list_(pa.from_numpy_dtype(kind)))
        total = lambda x: pa.array([np.bincount(key[a:b] - i * groups, x[a:b], groups).astype(np.int64) for i in found for a, b in [(ends[i * groups], ends[(i + 1) * groups])]], pa.list_(pa.int64()))
        sizes = pa.array([np.diff(ends[i * groups:(i + 1) * groups + 1]).astype(np.int32) for i in found], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), sizes, part(score, np.float64), part(pos, np.int32), part(n, np.int32), total(pos), total(n)],
                                          ["range", "sizes", "p", "pos", "n", "all_pos", "all_n"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= SORTED_ROWS:
                yield packed(held)
                held = []
        if sum(x.num_rows for x in held):
            yield packed(held)

    rows = df.where(F.col(p).isNotNull()).select(F.col(group).cast("int"), F.col(p).cast("double"), F.coalesce(F.col(y).cast("int"), F.lit(0)))
    dealt = materialize(rows.mapInArrow(pack, "range int, sizes array<int>, p array<double>, pos array<int>, n array<int>, all_pos array<bigint>, all_n array<bigint>"))
    sums = dealt.select("range", F.posexplode(F.arrays_zip("all_pos", "all_n")).alias("g", "x")).groupBy("range", "g").agg(
        F.sum("x.all_pos").alias("pos"), F.sum("x.all_n").alias("n")).collect()  # two numbers per range and group
    whole = np.zeros((2, len(edges) + 2, groups))
    for r in sums:
        whole[:, r["range"], r["g"]] = r["pos"], r["n"]
    above = whole[:, ::-1].cumsum(axis=1)[:, ::-1]  # from a range up

    def finish(found: pa.Table) -> pa.Table:
        at = found["range"][0].as_py()
        sizes, score, pos, n = (found[c].combine_chunks().flatten().to_numpy() for c in ("sizes", "p", "pos", "n"))
        key, score, pos, n = _distinct(np.repeat(np.tile(np.arange(groups), len(found)), sizes), score, pos.astype(np.int64), n.astype(np.int64))
        out = []
        for g, (a, b) in enumerate(zip(*(np.searchsorted(key, np.arange(groups) + i) for i in (0, 1)))):
            tp, upto = (x[a:b][::-1].cumsum()[::-1] + above[i, at + 1, g] for i, x in enumerate((pos, n)))
            if above[0, 0, g]:
                out.append((g, float((pos[a:b] / above[0, 0, g] * tp / upto).sum())))
        return pa.table({"g": pa.array([x[0] for x in out], pa.int32()), "s": pa.array([x[1] for x in out], pa.float64())})

    parts = dealt.select("range", "sizes", "p", "pos", "n").groupBy("range").applyInArrow(finish, "g int, s double")
    return parts.groupBy(F.col("g").alias(group)).agg(F.sum("s").alias("average_precision"))


def at_threshold(y: str, p: str, threshold) -> dict[str, Column]:
    """Aggregates for F1, precision, recall (0 for 0/0) and Brier score."""
    yes, hit = F.col(y).cast("int") == 1, F.col(p) >= threshold
    tp, fp, fn = F.count_if(yes & hit), F.count_if(~yes & hit), F.count_if(yes & ~hit)
    gap = F.col(p) - F.col(y).cast("int")
    return {"f1": _ratio(2 * tp, 2 * tp + fp + fn), "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn),
            "brier": F.avg(gap * gap)}


def classification_metrics(df: DataFrame, y: str, p: str, threshold: float) -> DataFrame:
    rank = ranking_metrics(df, y, p)
    at = df.agg(*[c.alias(n) for n, c in at_threshold(y, p, threshold).items()])
    return at.withColumns({"average_precision": rank.select("average_precision").scalar(), "roc_auc": rank.select("roc_auc").scalar()})


def threshold_table(df: DataFrame, y: str, p: str, grid) -> DataFrame:
    """tp, fp, fn and metrics at every threshold of a grid.

    Rows are first counted per bucket between thresholds, so the data is read once and
    the grid only meets at most ``len(grid) + 1`` counts.
    """
    grid = [float(g) for g in grid]
    bucket = F.size(F.filter(F.lit(grid), lambda g: g <= F.col(p)))
    counts = df.groupBy(bucket.alias("_b")).agg(F.sum(F.col(y).cast("bigint")).alias("_pos"), F.count(F.lit(1)).alias("_n"))
    levels = F.array(*[F.struct(F.lit(i + 1).alias("_i"), F.lit(g).alias("threshold")) for i, g in enumerate(grid)])
    # each bucket adds its counts to every threshold; those below it count as flagged
    spread = counts.select("*", F.inline(levels))
    flagged = F.col("_b") >= F.col("_i")
    out = spread.groupBy("threshold").agg(
        F.sum(F.when(flagged, F.col("_pos")).otherwise(0)).alias("tp"), F.sum(F.when(flagged, F.col("_n") - F.col("_pos")).otherwise(0)).alias("fp"),
        F.sum(F.when(~flagged, F.col("_pos")).otherwise(0)).alias("fn"), F.sum(F.when(flagged, F.col("_n")).otherwise(0)).alias("flagged"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return out.withColumns({"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "f1": _ratio(2 * tp, 2 * tp + fp + fn)})


def best_threshold(df: DataFrame, y: str, p: str, grid=BEST_GRID) -> DataFrame:
    """First threshold with the greatest F1; one row."""
    return arg_best(threshold_table(df, y, p, grid), "f1", "threshold").select("threshold", "f1")


def arg_best(df: DataFrame, score: str, grid: str) -> DataFrame:
    """Row with the greatest score, the smallest grid value on ties."""
    return df.orderBy(F.col(score).desc(), F.col(grid)).limit(1)


def arg_best_median(df: DataFrame, score: str, grid: str) -> DataFrame:
    """Grid value in the middle of those that share the greatest score (the upper one of two)."""
    best = df.agg(F.max_by(F.struct(score), F.struct(score)).alias("_m")).select(F.col("_m")[score]).scalar()
    tied = df.where(F.col(score) == best).agg(F.array_sort(F.collect_list(grid)).alias("_t"))  # at most one entry per grid value
    return tied.select(F.element_at("_t", F.floor(F.size("_t") / 2).cast("int") + 1).alias(grid))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: list) -> DataFrame:
    """One row per label, one count column per predicted label; labels that never occur stay as zeros."""
    cells = df.groupBy(actual).pivot(predicted, labels).agg(F.count(F.lit(1)))
    every = df.sparkSession.createDataFrame([(v,) for v in labels], [actual])
    return every.join(F.broadcast(cells.where(F.col(actual).isin(labels))), actual, "left").na.fill(0)


def errors_by_segment(df: DataFrame, segment: str, y: str, p: str, threshold: float) -> DataFrame:
    at = at_threshold(y, p, threshold)
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(y).cast("int")).alias("rate"),
                                   at["recall"].alias("recall"), at["precision"].alias("precision"))


def calibration(df: DataFrame, y: str, p: str, bins: int = 10) -> DataFrame:
    """Right-closed quantile bins without repeated edges: mean score, mean label, rows, and the mean bias."""
    names = {f"q{i}": i / bins for i in range(bins + 1)}
    quantiles = exact_quantiles(df, p, names).select(F.array_distinct(F.array(*names)).alias("e")).first()["e"]
    inner = [float(e) for e in quantiles[1:-1]]
    bucket = F.size(F.filter(F.lit(inner), lambda e: e < F.col(p))) if inner else F.lit(0)
    rows = df.groupBy((bucket + 1).alias("bin")).agg(
        F.avg(p).alias("predicted"), F.avg(F.col(y).cast("int")).alias("actual"), F.count(F.lit(1)).alias("n"))
    return rows.withColumn("bias", F.avg(F.col("predicted") - F.col("actual")).over(Window.partitionBy(F.lit(0))))  # one row per bin


def error_profile(df: DataFrame, y: str, p: str, threshold: float, columns: list[str]) -> DataFrame:
    """Mean of the columns among hits, misses, false alarms and correct rejections."""
    yes, hit = F.col(y).cast("int") == 1, F.col(p) >= threshold
    group = (F.when(yes & hit, "late found").when(yes, "late missed").when(hit, "false alarm").otherwise("on time"))
    return df.groupBy(group.alias("outcome")).agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(c).cast("double")).alias(c) for c in columns])


# ---------------------------------------------------------------- splits and baselines
def ranked_periods(df: DataFrame, period: str) -> DataFrame:
    """Distinct periods numbered from 1 (the calendar bounds them), with their count."""
    one = Window.partitionBy(F.lit(0))
    return df.select(period).distinct().withColumns({
        "period_no": F.row_number().over(one.orderBy(period)), "periods": F.count(F.lit(1)).over(one)})


def temporal_split(df: DataFrame, period: str, test_periods: int = 4) -> DataFrame:
    """Add ``is_test``: the last ``test_periods`` periods."""
    marks = ranked_periods(df, period).select(period, (F.col("period_no") > F.col("periods") - test_periods).alias("is_test"))
    return df.join(F.broadcast(marks), period)


def time_series_folds(df: DataFrame, period: str, folds: int = 5) -> DataFrame:
    """(fold, period, is_validation): validation blocks of n // (folds + 1) periods, training strictly before."""
    size = F.floor(F.col("periods") / (folds + 1))
    start = F.col("periods") - (folds - F.col("fold") + 1) * size
    rows = ranked_periods(df, period).withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    rows = rows.withColumn("_start", start).where(F.col("period_no") <= F.col("_start") + size)
    return rows.select("fold", period, (F.col("period_no") > F.col("_start")).alias("is_validation"))


def baselines(df: DataFrame, is_test: str, y: str, previous: str) -> DataFrame:
    """Test rows with the constant training rate and the previous label (the rate where unknown)."""
    rate = df.where(~F.col(is_test)).agg(F.avg(F.col(y).cast("int")).alias("r")).select("r").scalar()
    return df.where(F.col(is_test)).withColumn("constant", rate).withColumn("previous_rule", F.coalesce(F.col(previous), F.col("constant")))


# ---------------------------------------------------------------- multi-class
def per_class(df: DataFrame, actual: str, predicted: str, weight: Column | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class that occurs on either side."""
    w = weight if weight is not None else F.lit(1)
    rows = df.groupBy(actual, predicted).agg(F.sum(w).alias("_w"))  # classes squared rows
    sides = rows.select(F.inline(F.array(
        F.struct(F.col(actual).alias("category"), F.when(F.col(actual) == F.col(predicted), F.col("_w")).otherwise(0).alias("tp"),
                 F.col("_w").alias("actual_n"), F.lit(0).cast("bigint").alias("predicted_n")),
        F.struct(F.col(predicted).alias("category"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("actual_n"),
                 F.col("_w").alias("predicted_n")))))
    out = sides.groupBy("category").agg(F.sum("tp").alias("tp"), F.sum("actual_n").alias("support"), F.sum("predicted_n").alias("_p"))
    p, r = _ratio(F.col("tp"), F.col("_p")), _ratio(F.col("tp"), F.col("support"))
    return out.select("category", p.alias("precision"), r.alias("recall"),
                      _ratio(2 * F.col("tp"), F.col("support") + F.col("_p")).alias("f1"), "support", "tp")


def accuracy_macro_f1(df: DataFrame, actual: str, predicted: str, weight: Column | None = None) -> DataFrame:
    return per_class(df, actual, predicted, weight).agg(
        F.sum("support").alias("n"), (F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg("f1").alias("f1_macro"))


def confusions_list(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Off-diagonal cells as one text, most frequent first (classes squared entries)."""
    cells = df.where(F.col(actual) != F.col(predicted)).groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct((-F.col("n")).alias("o"), F.concat(actual, F.lit(" -> "), predicted, F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("t"))
    return cells.agg(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["t"]), ", ").alias("confusions"))
