"""Joins with the cardinality the caller promises, checked inside the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_side(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with one row per key; a repeated key fails the job when the row is used.

    The aggregate shuffles on the join keys, so the join that follows reuses that
    partitioning. Rows of a repeated key are reduced map-side before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    packed = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(F.struct(F.lit(1).alias("x"), F.col(c).alias("v"))).alias(c) for c in rest]
    )
    broken = F.raise_error(F.lit(f"join key ({', '.join(keys)}) is not unique"))

    def pick(c: str) -> Column:
        value = F.col(c)["v"]
        return F.when(F.col("_n") == 1, value).otherwise(broken.cast(df.schema[c].dataType)).alias(c)

    return packed.select(*keys, *[pick(c) for c in rest])


def join_many_to_one(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join; the right key must be unique."""
    return left.join(unique_side(right, on), on, "left")


def join_one_to_one(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join; the key must be unique on both sides."""
    return unique_side(left, on).join(unique_side(right, on), on, "left").select(
        *left.columns, *[c for c in right.columns if c not in on]
    )


#: Rows of one key that one task may take in a join.
ROWS_PER_TASK = 200_000


def hot_keys(counts: DataFrame, key: str, n: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, _salts): keys with more rows than one task should take, and into how many parts each is split."""
    return counts.where(F.col(n) > rows_per_task).select(key, F.ceil(F.col(n) / rows_per_task).cast("int").alias("_salts"))


def salted_join(big: DataFrame, lookup: DataFrame, key: str, hot: DataFrame, spread: Column) -> DataFrame:
    """Inner join on ``key`` in which the rows of a hot key are split, by a hash of ``spread``, into as many parts as ``hot_keys`` says.

    Only the lookup rows of hot keys are repeated; every other key joins as usual. ``hot`` has one
    row per so many rows of ``big`` at most, so the optimizer may choose how to join it by its size.
    """
    left = big.join(hot, key, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = lookup.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    # the lookup has one row per key and salt, so its hash tables are even and nothing needs sorting
    return left.join(right.hint("shuffle_hash"), [key, "_salt"]).drop("_salt")


def lookup_broadcast(df: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    """Left lookup join; the lookup is broadcast if its size, as measured while the query runs, is below the session's limit."""
    return df.join(lookup, on, "left")


def keep_matching(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def drop_matching(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")


def disjoint(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """One row: keys the two sides share and whether they share none."""
    shared = a.select(*on).distinct().join(b.select(*on), on, "left_semi")
    return shared.agg(F.count(F.lit(1)).alias("shared")).withColumn("disjoint", F.col("shared") == 0)


def range_join(
    alarms: DataFrame, complaints: DataFrame, *, key: str, start: str, ts: str, category: str, wanted, lookback_days: int = 7
) -> DataFrame:
    """Keys with an alarm that have a wanted complaint from ``lookback_days`` before it onward.

    Only existence matters, so each side is first reduced to one row per key (earliest
    alarm, latest wanted complaint) and no pair of rows of a hot key is ever formed.
    """
    first = alarms.where(F.col(start).isNotNull()).groupBy(key).agg(F.min(start).alias("_start"))
    last = complaints.where(F.col(category).isin(*wanted)).groupBy(key).agg(F.max(ts).alias("_last"))
    return first.join(last, key, "left").select(
        key,
        F.coalesce(F.col("_last") >= F.col("_start") - F.expr(f"INTERVAL {lookback_days} DAYS"), F.lit(False)).alias("matched"),
    )
