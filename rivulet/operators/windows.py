"""Window operators. Every partition is a key whose rows the calendar or k bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def payment_history(df: DataFrame, *, key: str = "conn_id", period: str = "period", late: str = "late", m3: str = "m3") -> DataFrame:
    """History known when a bill is issued; needs one row per (key, period).

    previous_label: last known earlier label. late_rate_so_far: its mean. late_last_6:
    late bills among the last six. bills_with_history: earlier known labels.
    m3_vs_avg6: consumption over the mean of the previous six, null for a mean of 0 or less.
    """
    w = Window.partitionBy(key).orderBy(period)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    six = w.rowsBetween(-6, -1)
    y = F.col(late).cast("double")
    avg6 = F.avg(m3).over(six)
    return df.withColumns({
        "previous_label": F.last(y, ignorenulls=True).over(past),
        "late_rate_so_far": F.avg(y).over(past),
        "late_last_6": F.sum(y).over(six),
        "bills_with_history": F.count(y).over(past),
        "m3_vs_avg6": F.col(m3) / F.when(avg6 > 0, avg6),
    })


def moving_average(value: Column, by: list[str], order: str, n: int) -> Column:
    """Mean of the last ``n`` rows, null until there are ``n``."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(1 - n, 0)
    return F.when(F.count(value).over(w) == n, F.avg(value).over(w))


def rolling_energy(value: Column, by: list[str], order: str, n: int = 72) -> Column:
    return moving_average(value * value, by, order, n)


def lag_row(value: Column, by: list[str], order: str, n: int = 1) -> Column:
    return F.lag(value, n).over(Window.partitionBy(*by).orderBy(order))


def sustained_run(df: DataFrame, above: Column, by: list[str], order: str, n: int, out: str) -> DataFrame:
    """True from the ``n``-th consecutive row on which ``above`` holds; null counts as false."""
    w = Window.partitionBy(*by).orderBy(order)
    island = Window.partitionBy(*by, "_island").orderBy(order)
    return (
        df.withColumn("_above", F.coalesce(above, F.lit(False)))
        .withColumn("_island", F.count_if(~F.col("_above")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(out, F.col("_above") & (F.count_if(F.col("_above")).over(
            island.rowsBetween(Window.unboundedPreceding, 0)) >= n))
        .drop("_above", "_island")
    )


def latest_per_key(df: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """First row per key in the given order; Spark limits each map task to one row per key first."""
    w = Window.partitionBy(*keys).orderBy(*newest)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, out: str = "place") -> DataFrame:
    """First ``n`` rows per key with their place; map tasks keep at most ``n`` rows per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)


def first_alarm_after(df: DataFrame, key: str, ts: str, alarm: str, truth: str) -> DataFrame:
    """Per key: true start, first alarm at or after it (any alarm where there is no true start)."""
    starts = df.groupBy(key).agg(F.min(F.when(F.col(truth), F.col(ts))).alias("true_start"))
    alarms = df.where(F.col(alarm)).join(starts, key).where(F.col("true_start").isNull() | (F.col(ts) >= F.col("true_start")))
    return starts.join(alarms.groupBy(key).agg(F.min(ts).alias("first_alarm")), key, "left")
