"""Exact ranks, running totals and quantiles of unbounded groups without a single-task sort.

A column is first reduced to its distinct values per group. Many of them are dealt out by range of
(group, value), as many buckets as their count asks for; the totals of the buckets give each bucket
its offset, and a window inside one bucket finishes the exact running total. Any cut between buckets
gives the same result. Distinct values and buckets are materialised, so the source is read once and a
recomputed task sees the same numbers.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.session import materialize


#: Distinct values of a bucket, which one window sorts.
BUCKET_VALUES = 100_000


def _with_bucket(counts: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """Add ``_bucket``: the number of the range the (group, value) falls into."""
    n = math.ceil(counts.count() / BUCKET_VALUES)
    if n <= 1:
        return counts.withColumn("_bucket", F.lit(0))
    return materialize(counts.repartitionByRange(n, *groups, value).withColumn("_bucket", F.spark_partition_id()))


def running_totals(
    df: DataFrame, value: str, sums: dict[str, Column], groups: list[str] | tuple = ()
) -> DataFrame:
    """Per (group, distinct value): each sum, its total over smaller values and over the group.

    Columns: groups, ``value``, and for each name ``n``: ``n``, ``n_before``, ``n_all``.
    """
    groups = list(groups)
    present = df.where(F.col(value).isNotNull())
    counts = materialize(present.groupBy(*groups, value).agg(*[c.alias(n) for n, c in sums.items()]))
    counts = _with_bucket(counts, value, groups)
    per_bucket = counts.groupBy(*groups, "_bucket").agg(*[F.sum(n).alias(f"_{n}") for n in sums])
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *[F.col(g).alias(f"_g_{g}") for g in groups],
        F.col("_bucket").alias("_b"),
        *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}_off") for n in sums],
        *[F.sum(f"_{n}").over(whole).alias(f"{n}_all") for n in sums],
    )
    inside = Window.partitionBy(*groups, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    on = reduce(lambda a, c: a & c, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups], F.col("_bucket") == F.col("_b"))
    return (
        counts.withColumns({f"_{n}_in": F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in sums})
        .join(offsets, on)
        .select(*groups, value, *[c for n in sums for c in (
            F.col(n), (F.col(f"_{n}_off") + F.col(f"_{n}_in")).alias(f"{n}_before"), F.col(f"{n}_all"))])
    )


def value_counts(df: DataFrame, value: str, groups=(), weight: str | None = None) -> DataFrame:
    """``running_totals`` of row counts (``n``), or of a weight column."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return running_totals(df, value, {"n": n}, groups)


def pick_quantiles(ranked: DataFrame, value: str, probs: dict[str, float], groups=()) -> DataFrame:
    """Linear-interpolation quantiles from ``value_counts`` rows, one row per group."""
    first, until = F.col("n_before"), F.col("n_before") + F.col("n")
    parts, out = [], []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("n_all") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        parts += [
            F.max(F.when((first <= lo) & (lo < until), F.col(value))).alias(f"_{name}_lo"),
            F.max(F.when((first <= hi) & (hi < until), F.col(value))).alias(f"_{name}_hi"),
            F.max(pos - lo).alias(f"_{name}_t"),
        ]
        a, b = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((a + (b - a) * F.col(f"_{name}_t")).alias(name))
    return ranked.groupBy(*groups).agg(F.max("n_all").alias("n"), *parts).select(*groups, "n", *out)


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], groups=()) -> DataFrame:
    """Exact quantiles per group (also of one group with most rows): columns groups, n, names."""
    return pick_quantiles(value_counts(df, value, groups), value, probs, groups)


def average_ranks(df: DataFrame, value: str, groups=(), weight: str | None = None, out: str = "rank") -> DataFrame:
    """Distinct values with their count ``n`` and rank, ties averaged."""
    ranked = value_counts(df, value, groups, weight)
    return ranked.select(*groups, value, "n", "n_all", (F.col("n_before") + (F.col("n") + 1) / 2).alias(out))
