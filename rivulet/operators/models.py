"""Late-payment models: features, preprocessing, fits, temporal validation, importance.

Logistic regression is Spark ML's, forests, boosting and the network are fitted by the executors in ``forests``,
``boosting`` and ``network``; every fit reads all of its rows where they lie.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators import boosting as bo
from rivulet.operators import forests as fo
from rivulet.operators import metrics as mt
from rivulet.operators import network as nw
from rivulet.operators.ranks import pick_quantiles, value_counts
from rivulet.operators.windows import payment_history
from rivulet.session import materialize

SEED = 42
# Columns known only after the bill is issued, which no feature may use.
FORBIDDEN = {"paid_on", "days_late", "paid", "leak", "late", "overdue_unpaid", "paid_without_date"}
REASONS = {
    "tariff": "customer segment", "area": "neighbourhood", "direct_debit": "associated with paying on time",
    "sewer": "changes the amount and the service", "treatment": "changes the amount", "silent": "an estimated bill may be disputed",
    "inconsistent": "a doubtful reading may be disputed", "m3": "consumption of the period", "total": "amount to pay",
    "tenure_months": "time as a customer", "month": "season of the calendar", "previous_label": "last known earlier label",
    "late_rate_so_far": "payment habit", "late_last_6": "recent habit", "bills_with_history": "how much history backs the habit",
    "m3_vs_avg6": "a jump of consumption gives an unexpected bill",
}
CATEGORICAL = ["tariff", "area"]
BINARY = ["direct_debit", "sewer", "treatment", "silent", "inconsistent"]
NUMERIC = ["m3", "total", "tenure_months", "month", "previous_label", "late_rate_so_far", "late_last_6", "bills_with_history", "m3_vs_avg6"]


def assert_no_leakage(features) -> None:
    leaked = sorted(set(features) & FORBIDDEN)
    if leaked:
        raise ValueError(f"forbidden columns used as features: {', '.join(leaked)}")


def payment_features(analysis: DataFrame) -> DataFrame:
    """Features of every bill, one row per (conn_id, period); each has its reason and none is forbidden."""
    used = CATEGORICAL + BINARY + NUMERIC
    assert_no_leakage(used)
    if set(used) != set(REASONS):
        raise ValueError("every feature needs a reason")
    rows = payment_history(analysis).withColumns({c: F.col(c).cast("double") for c in BINARY + NUMERIC})
    return rows.withColumns({c: F.col(c).cast("string") for c in CATEGORICAL}).select(
        "bill_id", "conn_id", "period", "trainable", F.col("late").cast("int").alias("y"), *used)


@dataclass(frozen=True)
class Preprocessor:
    """Median fill with missing marks, optional standard scale, one-hot with a bucket for rare values."""

    medians: dict[str, float]
    marked: list[str]
    scale: dict[str, tuple[float, float]]
    values: dict[str, tuple[list[str], list[str]]]

    @classmethod
    def fit(cls, train: DataFrame, scale: bool, rare: int = 20) -> "Preprocessor":
        columns = NUMERIC + BINARY
        long = train.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("x")) for c in columns])))
        medians = {r["c"]: r["m"] for r in pick_quantiles(value_counts(long, "x", ["c"]), "x", {"m": 0.5}, ["c"]).collect()}
        nulls = train.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
        marked = [c for c in columns if nulls[c]]
        counts = {}
        for c in CATEGORICAL:  # the categories of a model, a few dozen values
            rows = train.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).orderBy(c).collect()
            counts[c] = ([r[c] for r in rows if r["n"] >= rare], [r[c] for r in rows if r["n"] < rare])
        out = cls(medians, marked, {}, counts)
        if not scale:
            return out
        names = out.numeric()
        stats = train.select(*[e.alias(n) for n, e in names.items()]).agg(
            *[f(n).alias(f"{k}_{n}") for n in names for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        return cls(medians, marked, {n: (stats[f"m_{n}"], stats[f"s_{n}"] or 1.0) for n in names}, counts)

    def numeric(self) -> dict[str, Column]:
        filled = {c: F.coalesce(F.col(c), F.lit(self.medians.get(c, 0.0))) for c in NUMERIC + BINARY}
        return filled | {f"{c}_missing": F.col(c).isNull().cast("double") for c in self.marked}

    def size(self) -> int:
        return len(NUMERIC + BINARY) + len(self.marked) + sum(len(v) + bool(r) for v, r in self.values.values())

    def array(self) -> Column:
        """All features of a row; an unknown value gets no one-hot mark."""
        parts = [(e - self.scale[n][0]) / self.scale[n][1] if self.scale else e for n, e in self.numeric().items()]
        for c, (common, rare) in self.values.items():
            parts += [F.coalesce(F.col(c) == v, F.lit(False)).cast("double") for v in common]
            if rare:
                parts.append(F.coalesce(F.col(c).isin(rare), F.lit(False)).cast("double"))
        return F.array(*parts)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the ``features`` vector."""
        return df.withColumn("features", array_to_vector(self.array()))


Scorer = Callable[[DataFrame, str], DataFrame]
Fit = Callable[[DataFrame], Scorer]


def _named(estimator):
    """Output columns that cannot meet a column of the data."""
    return estimator.setProbabilityCol("_probability").setRawPredictionCol("_raw").setPredictionCol("_prediction")


def label_sizes(train: DataFrame) -> dict[int, int]:
    return {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}


def balanced(train: DataFrame) -> tuple[DataFrame, float]:
    """Add ``weight`` = n / (2 rows of the class), and the sum of the weights."""
    n = label_sizes(train)
    total = sum(n.values())
    weight = reduce(lambda acc, c: acc.when(F.col("y") == c, total / (len(n) * n[c])), n, F)
    return train.withColumn("weight", weight), float(total)


def _fit(estimator_of: Callable[[float], object], scale: bool) -> Fit:
    def fit(train: DataFrame) -> Scorer:
        prep = Preprocessor.fit(train, scale)
        rows, total = balanced(train)
        model = _named(estimator_of(total)).fit(prep.transform(rows).select("features", F.col("y").cast("double").alias("label"), "weight"))

        def score(df: DataFrame, out: str) -> DataFrame:
            scored = model.transform(prep.transform(df))
            return scored.withColumn(out, vector_to_array("_probability")[1]).drop("features", "_raw", "_probability", "_prediction")

        return score

    return fit


def logistic(c: float = 0.5, max_iter: int = 200) -> Fit:
    """Balanced logistic regression; the penalty 1 / (C sum of weights) matches an unscaled L2 term."""
    return _fit(lambda total: LogisticRegression(
        weightCol="weight", regParam=1.0 / (c * total), standardization=False, maxIter=max_iter, tol=1e-5), True)


def random_forest(trees: int = 300, depth: int = 12, least: int = 20, key: str = "bill_id") -> Fit:
    """Balanced forest; a root of the columns is tried per node."""

    def fit(train: DataFrame) -> Scorer:
        prep, n = Preprocessor.fit(train, False), label_sizes(train)
        if None in n or not n:
            raise ValueError("a forest needs rows, and no label may be null")
        weights = tuple(sum(n.values()) / (len(n) * n[c]) if c in n else 0.0 for c in (0, 1))
        model = fo.fit(train, prep.array(), prep.size(), weights, key=key, trees=trees, depth=depth, least=least, seed=SEED)
        return lambda df, out: bo.score(df, model, prep.array(), out)

    return fit


def gradient_boosting(rounds: int = 300, leaves: int = 15, key: str = "bill_id") -> Fit:
    """Balanced boosting; trees grow best first to ``leaves`` leaves, with an L2 term of 1."""

    def fit(train: DataFrame) -> Scorer:
        prep = Preprocessor.fit(train, False)
        rows, _ = balanced(train)
        model = bo.fit(rows, prep.array(), prep.size(), key=key, rounds=rounds, leaves=leaves)
        return lambda df, out: bo.score(df, model, prep.array(), out)

    return fit


def soft_vote(fits: list[Fit]) -> Fit:
    """Mean of the members' probabilities."""

    def fit(train: DataFrame) -> Scorer:
        scorers = [f(train) for f in fits]

        def score(df: DataFrame, out: str) -> DataFrame:
            names = [f"_p{i}" for i in range(len(scorers))]
            for s, n in zip(scorers, names):
                df = s(df, n)
            return df.withColumn(out, sum((F.col(n) for n in names), F.lit(0.0)) / len(names)).drop(*names)

        return score

    return fit


def out_of_fold(train: DataFrame, fit: Fit, folds: int = 5) -> DataFrame:
    """Validation scores of the temporal folds: (bill_id, y, p, fold)."""
    marks = materialize(mt.time_series_folds(train, "period", folds))

    def one(k: int) -> DataFrame:
        fold = F.broadcast(marks.where(F.col("fold") == k).drop("fold"))
        rows = train.join(fold, "period")
        scorer = fit(rows.where(~F.col("is_validation")))
        return scorer(rows.where("is_validation"), "p").select("bill_id", "y", "p", F.lit(k).alias("fold"))

    with ThreadPoolExecutor(folds) as pool:  # the folds' jobs run side by side
        return materialize(reduce(DataFrame.unionByName, pool.map(one, range(1, folds + 1))))


def mean_of(scores: list[DataFrame]) -> DataFrame:
    """Mean score per bill: the vote of models that were scored on the same rows."""
    every = reduce(DataFrame.unionByName, scores)
    return every.groupBy("bill_id", "fold").agg(F.first("y").alias("y"), F.avg("p").alias("p"))


def choose_by_cv(train: DataFrame, fits: dict[str, Fit], folds: int = 5, vote: str | None = None) -> list[tuple[str, float, float]]:
    """(model, out-of-fold average precision, threshold), best first; the test rows are never seen.

    With ``vote``, the mean of all models' scores is a candidate of that name; it needs no further fits.
    """
    scores = {name: out_of_fold(train, fit, folds) for name, fit in fits.items()}
    if vote is not None:
        scores[vote] = materialize(mean_of(list(scores.values())))
    out = []
    for name, rows in scores.items():
        ap = mt.ranking_metrics(rows, "y", "p").first()["average_precision"]
        out.append((name, ap, mt.best_threshold(rows, "y", "p").first()["threshold"]))
    return sorted(out, key=lambda r: -r[1])


def permutation_importance(test: DataFrame, score: Scorer, columns: list[str], key: str = "bill_id", repeats: int = 5,
                           rows_per_bucket: int = 100_000) -> DataFrame:
    """Drop of average precision when a column takes another row's value; all variants are scored in one pass
    and ranked as arrays, range of scores by range (``metrics.average_precisions``).

    Rows fall into random buckets and random order by a hash of key and repeat; a column takes
    the value of the next row there, which permutes it without sorting the table in one task.
    """
    test = materialize(test)
    n = test.count()
    buckets = max(1, math.ceil(n / rows_per_bucket))
    whole = F.struct(*columns)
    rows = test
    for r in range(repeats):
        order = F.xxhash64(F.col(key), F.lit(r))
        w = Window.partitionBy(F.pmod(F.xxhash64(F.col(key), F.lit(-1 - r)), F.lit(buckets))).orderBy(order)
        first = F.first(whole).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        rows = rows.withColumn(f"_next{r}", F.coalesce(F.lead(whole).over(w), first))
    variants = F.array(*[F.struct(F.lit(i * repeats + r).alias("_variant"), F.lit(c).alias("column"), F.lit(r).alias("repeat"),
                                  F.struct(*[(F.col(f"_next{r}")[c] if c == k else F.col(k)).alias(k) for k in columns]).alias("_x"))
                         for i, c in enumerate(columns) for r in range(repeats)])
    others = [c for c in test.columns if c not in columns]
    long = rows.select(*others, F.inline(variants)).select(*others, "_variant", "column", "repeat", "_x.*")
    scored = materialize(score(test, "p").select("y", "p"))
    base = mt.ranking_metrics(scored, "y", "p").first()["average_precision"]
    many = len(columns) * repeats
    edges = mt.score_ranges(scored, "p", math.ceil(n * many / mt.SORTED_ROWS))
    each = mt.average_precisions(score(long, "p").select("y", "p", "_variant"), "y", "p", "_variant", many, edges)
    drop = F.lit(base) - F.col("average_precision")
    column = F.element_at(F.array(*map(F.lit, columns)), (F.floor(F.col("_variant") / repeats) + 1).cast("int"))
    return each.groupBy(column.alias("column")).agg(F.avg(drop).alias("importance"), F.stddev_pop(drop).alias("spread"))


def batch_predict(rows: DataFrame, score: Scorer, threshold: float, name: str, version: str = "v1") -> DataFrame:
    """Predictions of the bills that are not due yet."""
    return score(rows.where(~F.col("trainable")), "probability").select(
        "conn_id", "period", "probability", (F.col("probability") >= threshold).alias("predicted_late"),
        F.lit(name).alias("model"), F.lit(version).alias("version"))


def prediction_summary(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count(F.lit(1)).alias("bills"), F.min("period").alias("first_period"), F.max("period").alias("last_period"),
        F.count_if("predicted_late").alias("at_risk"), F.avg("probability").alias("mean_probability"))


def train_network(train: DataFrame, valid: DataFrame, epochs: int = 100, patience: int = 10, hidden: tuple[int, ...] = (64, 32),
                  key: str = "bill_id") -> tuple[Scorer, list[tuple[int, float, float]]]:
    """Network with dropout and balanced loss, stopped early by the loss of ``valid``; and the loss curve."""
    prep = Preprocessor.fit(train, True)
    network, history = nw.train(train, valid, prep.array(), prep.size(), key=key, hidden=hidden, epochs=epochs, patience=patience)
    return lambda df, out: nw.score(df, network, prep.array(), out), history
