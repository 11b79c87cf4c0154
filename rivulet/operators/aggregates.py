"""Summaries: box statistics, histogram, segment rates, portfolio, value counts, text counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.ranks import exact_quantiles, pick_quantiles, running_totals, value_counts
from rivulet.session import materialize


def one(df: DataFrame, column: str) -> Column:
    """A one-row aggregate as a scalar subquery."""
    return df.select(column).scalar()


def box_stats(df: DataFrame, value: str, group: str, max_outliers: int = 50) -> DataFrame:
    """Quartiles, n, whiskers inside the 1.5 IQR fences and at most ``max_outliers`` evenly spaced outliers."""
    box = exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group])
    box = box.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).withColumn(
        "_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    rows = df.where(F.col(value).isNotNull()).join(box.select(group, "_lo", "_hi"), group)
    inside = F.col(value).between(F.col("_lo"), F.col("_hi"))
    whiskers = rows.where(inside).groupBy(group).agg(F.min(value).alias("min"), F.max(value).alias("max"))
    outliers = value_counts(rows.where(~inside), value, [group])
    # evenly spaced positions 0..n-1, truncated; the last one is exactly n - 1
    step = (F.col("n_all") - 1) / F.lit(max_outliers - 1)
    spots = F.transform(
        F.sequence(F.lit(0), F.lit(max_outliers - 1)),
        lambda i: F.when(i == max_outliers - 1, F.col("n_all") - 1).otherwise(F.floor(i * step)))
    here = F.size(F.filter(spots, lambda s: (s >= F.col("n_before")) & (s < F.col("n_before") + F.col("n"))))
    times = F.when(F.col("n_all") <= max_outliers, F.col("n").cast("int")).otherwise(here)
    kept = outliers.withColumn("_times", times).where("_times > 0").groupBy(group).agg(
        F.array_sort(F.flatten(F.collect_list(F.array_repeat(F.col(value), F.col("_times"))))).alias("outliers"))
    return (
        box.drop("_lo", "_hi").join(whiskers, group, "left").join(kept, group, "left")
        .withColumn("outliers", F.coalesce("outliers", F.array().cast("array<double>")))
    )


def outlier_fence(df: DataFrame, value: str, group: str, width: float = 3.0) -> DataFrame:
    """Rows above Q3 + ``width`` IQR per group."""
    box = exact_quantiles(df, value, {"q1": 0.25, "q3": 0.75}, [group])
    fence = box.select(group, (F.col("q3") + width * (F.col("q3") - F.col("q1"))).alias("fence"))
    return df.join(fence, group).groupBy(group).agg(
        F.max("fence").alias("fence"), F.count_if(F.col(value) > F.col("fence")).alias("outliers"))


def monthly_mean_pivot(df: DataFrame, period: str, by: str, value: Column, columns: list) -> DataFrame:
    return df.groupBy(period).pivot(by, columns).agg(F.avg(value))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins with counts; the last bin includes its right edge; empty bins stay."""
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = one(ends, "lo"), one(ends, "hi")
    position = F.floor((F.col(value) - lo) / (hi - lo) * bins) + 1
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.least(F.coalesce(position, F.lit(1)), F.lit(bins)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    grid = ends.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "lo", "hi")
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("left_edge"), (F.col("lo") + F.col("bin") * width).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"))


def rate_by_segments(df: DataFrame, label: str, segments: list[str]) -> DataFrame:
    """(variable, value, rate, n) for each segment column, from one pass."""
    texts = df.select(*[F.col(s).cast("string").alias(s) for s in segments], F.col(label).cast("double").alias("_y"))
    grouped = texts.groupingSets([[s] for s in segments], *segments).agg(
        F.avg("_y").alias("rate"), F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_set"))
    # grouping_id has a 0 bit only at the column that is grouped by
    full = (1 << len(segments)) - 1
    codes = [full - (1 << (len(segments) - 1 - i)) for i in range(len(segments))]
    variable = reduce(lambda acc, i: acc.when(F.col("_set") == codes[i], segments[i]), range(len(segments)), F)
    value = reduce(lambda acc, i: acc.when(F.col("_set") == codes[i], F.col(segments[i])), range(len(segments)), F)
    return grouped.select(variable.alias("variable"), value.alias("value"), "rate", "n")


def portfolio_by_period(df: DataFrame, period: str, amount: str, label: str) -> DataFrame:
    """Billed and late amount per period, and the late share of everything billed."""
    late = F.when(F.coalesce(F.col(label), F.lit(False)), F.col(amount)).otherwise(0.0)
    months = df.groupBy(period).agg(F.sum(amount).alias("billed"), F.sum(late).alias("late_amount"))
    every = Window.partitionBy(F.lit(0))  # one row per period
    return months.withColumn("share", F.sum("late_amount").over(every) / F.sum("billed").over(every))


def value_shares(df: DataFrame, columns: list[str], top: int = 3) -> DataFrame:
    """Counts per value of each column, descending, with the share of the value and of the top ones."""
    shaped = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in columns])).alias("_kv"))
    counts = shaped.groupBy("_kv").agg(F.count(F.lit(1)).alias("n")).select("_kv.*", "n")
    placed = running_totals(counts.withColumn("_o", F.struct((-F.col("n")).alias("less"), "value")), "_o", {"one": F.count(F.lit(1)), "m": F.sum("n")}, ["variable"])
    placed = materialize(placed.select("variable", F.col("_o.value").alias("value"), F.col("m").alias("n"), (F.col("one_before") + 1).cast("int").alias("place"), "m_all"))
    first = placed.where(F.col("place") <= top).groupBy("variable").agg((F.sum("n") / F.max("m_all")).alias("top_share"))
    return placed.join(F.broadcast(first), "variable").select(  # one row per variable
        "variable", "value", "n", "place", (F.col("n") / F.col("m_all")).alias("share"), "top_share")


def reading_quality(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if("null_reading").alias("null_readings"), F.count_if("backward").alias("backward"),
        F.count_if("silent").alias("silent"), F.round(F.avg(F.col("inconsistent").cast("int")) * 100, 2).alias("pct_inconsistent"))


def unique_texts(df: DataFrame, text: str, category: str, one_category: bool = True) -> DataFrame:
    """One row per distinct text: its first category by name and occurrences.

    With ``one_category`` two categories for a text are an error. A text without any category keeps null.
    """
    grouped = df.groupBy(text).agg(F.min(category).alias("_lo"), F.max(category).alias("_hi"), F.count(F.lit(1)).alias("occurrences"))
    first = F.col("_lo")
    if one_category:
        clash = F.raise_error(F.lit("a text has more than one category"))
        first = F.when(F.col("_lo").eqNullSafe(F.col("_hi")), first).otherwise(clash.cast("string"))
    return grouped.select(text, first.alias(category), "occurrences")


def ambiguous_labels(df: DataFrame, text: str, label: str) -> DataFrame:
    """How many texts carry more than one label."""
    per_text = df.groupBy(text).agg((F.min(label) != F.max(label)).alias("_many"))
    return per_text.agg(F.count(F.lit(1)).alias("texts"), F.count_if(F.col("_many")).alias("ambiguous"))


def per_customer_profile(df: DataFrame, key: str = "conn_id") -> DataFrame:
    """Mean, variation, seasonality, late rate, flags, tenure and tariff per connection; nulls take the median."""
    season = F.avg(F.when(F.col("month").isin(4, 5, 6), F.col("m3")))
    mean = F.avg("m3")
    profile = df.where("trainable").groupBy(key).agg(
        mean.alias("mean_m3"),
        (F.stddev_samp("m3") / F.nullif(mean, F.lit(0.0))).alias("cv_m3"),
        (season / F.nullif(mean, F.lit(0.0))).alias("seasonality"),
        F.avg(F.col("late").cast("int")).alias("late_rate"),
        F.avg(F.col("direct_debit").cast("int")).alias("direct_debit"),
        F.avg(F.col("inconsistent").cast("int")).alias("pct_inconsistent"),
        F.max("tenure_months").alias("tenure_months"),
        F.min_by("tariff", "period").alias("tariff"),
    )
    return fill_with_median(profile, [c for c in profile.columns if c not in (key, "tariff")])


def fill_with_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace nulls by the column's exact median; one pass ranks all columns."""
    df = materialize(df)
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_x")) for c in columns])))
    medians = pick_quantiles(value_counts(long, "_x", ["_column"]), "_x", {"median": 0.5}, ["_column"])
    found = {r["_column"]: r["median"] for r in medians.collect()}  # one number per column
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(found[c])) for c in columns if found.get(c) is not None})


def crosstab(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    return df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0)


def category_texts(df: DataFrame, category: str, text: str) -> DataFrame:
    return df.groupBy(category).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(text).alias("n_texts"))


def arg_extreme(df: DataFrame, what: str, by: str) -> DataFrame:
    """Rows with the greatest and the smallest ``by``; ties go to the smallest ``what``."""
    return df.agg(
        F.min_by(what, F.struct(-F.col(by), F.col(what))).alias("highest"), F.max(by).alias("highest_value"),
        F.min_by(what, F.struct(F.col(by), F.col(what))).alias("lowest"), F.min(by).alias("lowest_value"))


def sort_output(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.orderBy(*keys)
