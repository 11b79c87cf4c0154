"""Time series. Pulses are first summed per series and hour or day, so a series is bounded by the calendar."""

from __future__ import annotations

from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import holtwinters as hw
from rivulet.operators.stats import welch

# Reported lags in hours.
ACF_LAGS = (1, 2, 3, 6, 12, 24, 48, 72, 168)


def complete_calendar(df: DataFrame, by: list[str], ts: str, step: str) -> DataFrame:
    """Every (series, time) of the common calendar, left-joined to ``df``; missing rows stay null."""
    ends = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    grid = df.select(*by).distinct().withColumn(ts, F.explode(F.sequence(lo, hi, F.expr(f"INTERVAL {step}"))))
    return grid.join(df, [*by, ts], "left")


def hourly_total(df: DataFrame, ts: str, value: str, by: list[str], label: str | None = None) -> DataFrame:
    """Sum per series and hour on the complete hourly calendar; an hour without pulses is 0."""
    aggs = [F.sum(value).alias(value)] + ([F.max(label).alias(label)] if label else [])
    hours = df.groupBy(*by, F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")).agg(*aggs)
    full = complete_calendar(hours, by, "hour", "1 HOUR").withColumn(value, F.round(F.coalesce(value, F.lit(0.0)), 6))
    return full.withColumn(label, F.coalesce(label, F.lit(False))) if label else full


def resample_daily(hourly: DataFrame, value: str, by: list[str], how: str = "sum") -> DataFrame:
    """Calendar-day bins; empty days are 0 for sums and null for means."""
    agg = F.sum(value) if how == "sum" else F.avg(value)
    days = hourly.groupBy(*by, F.to_date("hour").alias("day")).agg(F.round(agg, 6).alias(value))
    full = complete_calendar(days, by, "day", "1 DAY")
    return full.withColumn(value, F.coalesce(value, F.lit(0.0))) if how == "sum" else full


def seasonal_decompose(df: DataFrame, by: list[str], order: str, value: str, period: int = 12) -> DataFrame:
    """Additive decomposition: centred moving average with straight-line ends, seasonal means centred at 0.

    ``position`` counts from 0; the ends continue the line through the ``period``
    nearest trend points.
    """
    half = period // 2
    w = Window.partitionBy(*by).orderBy(order)
    whole = Window.partitionBy(*by)
    x = F.col(value)
    inner = F.sum(x).over(w.rowsBetween(1 - half, half - 1))
    average = (0.5 * F.lag(x, half).over(w) + inner + 0.5 * F.lead(x, half).over(w)) / period
    df = df.withColumn("position", F.row_number().over(w) - 1).withColumn("_n", F.count(F.lit(1)).over(whole))
    df = df.withColumn("_ma", average)
    t = F.col("position").cast("double")
    head = (F.col("position") >= half) & (F.col("position") < half + period)
    tail = (F.col("position") < F.col("_n") - half) & (F.col("position") >= F.col("_n") - half - period)
    for name, rows in (("head", head), ("tail", tail)):
        df = df.withColumn(f"_{name}_slope", F.regr_slope(F.when(rows, F.col("_ma")), F.when(rows, t)).over(whole))
        df = df.withColumn(f"_{name}_icpt", F.regr_intercept(F.when(rows, F.col("_ma")), F.when(rows, t)).over(whole))
    line = F.when(F.col("position") < half, F.col("_head_icpt") + F.col("_head_slope") * t).otherwise(
        F.col("_tail_icpt") + F.col("_tail_slope") * t)
    df = df.withColumn("trend", F.coalesce("_ma", line)).withColumn("_season", F.col("position") % period)
    season = Window.partitionBy(*by, "_season")
    df = df.withColumn("_mean", F.avg(x - F.col("trend")).over(season))
    first_cycle = F.avg(F.when(F.col("position") < period, F.col("_mean"))).over(whole)
    df = df.withColumn("seasonal", F.col("_mean") - first_cycle)
    return df.withColumn("residual", x - F.col("trend") - F.col("seasonal")).select(
        *by, order, value, "position", "trend", "seasonal", "residual")


def decomposition_summary(parts: DataFrame, by: list[str], month: Column, order: str) -> DataFrame:
    """Month with the highest and lowest seasonal part, and the change of the trend."""
    s = F.round("seasonal", 9)
    return parts.groupBy(*by).agg(
        F.min_by(month, F.struct(-s, month)).alias("peak_month"), F.max("seasonal").alias("peak"),
        F.min_by(month, F.struct(s, month)).alias("trough_month"), F.min("seasonal").alias("trough"),
        (F.max_by("trend", order) - F.min_by("trend", order)).alias("trend_change"))


def naive_forecasts(df: DataFrame, by: list[str], order: str, value: str, test: int = 6, season: int = 12) -> DataFrame:
    """Test rows with the last training value and the value one season before."""
    w = Window.partitionBy(*by).orderBy(order)
    whole = Window.partitionBy(*by)
    placed = df.withColumn("_i", F.row_number().over(w)).withColumn("_n", F.count(F.lit(1)).over(whole))
    placed = placed.withColumn("_test", F.col("_i") > F.col("_n") - test)
    last_train = F.max_by(F.when(~F.col("_test"), F.col(value)), F.when(~F.col("_test"), F.col("_i"))).over(whole)
    out = placed.withColumns({"naive": last_train, "seasonal_naive": F.lag(value, season).over(w)})
    return out.where("_test").drop("_i", "_n", "_test")


def forecast_scores(df: DataFrame, actual: str, models: list[str]) -> DataFrame:
    """MAE, RMSE and MAPE % per model column, best MAE first."""
    long = df.select(actual, F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("forecast")) for m in models])))
    err = F.col(actual) - F.col("forecast")
    return long.groupBy("model").agg(
        F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
        (100 * F.avg(F.abs(err / F.col(actual)))).alias("mape_pct")).orderBy("mae", "model")


def holt_winters(
    df: DataFrame, by: list[str], order: str, value: str, period: int = 12, ahead: int = 6,
    grid=tuple(product((0.1, 0.3, 0.5, 0.7, 0.9), (0.01, 0.1, 0.3), (0.01, 0.1, 0.3, 0.5))),
) -> DataFrame:
    """Additive trend and season, smoothing weights from a grid by least squared error, ``ahead`` forecasts.

    One ordered array per series (one value per period) is folded once per grid point;
    series times grid points spread over the cluster. A series shorter than two seasons gets
    null forecasts, and ``problem`` says so.
    """
    values = df.groupBy(*by).agg(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(order), F.col(value)))), lambda r: r[value].cast("double")).alias("x"))
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.size(a)
    first, second = F.slice("x", 1, period), F.slice("x", period + 1, period)
    long_enough = F.size("x") >= 2 * period
    start = values.where(long_enough).withColumn("level0", mean(first)).withColumn(
        "trend0", (mean(second) - F.col("level0")) / period).withColumn(
        "season0", F.transform(first, lambda v: v - F.col("level0")))
    weights = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(bt).alias("beta"), F.lit(g).alias("gamma")) for a, bt, g in grid])
    runs = start.select("*", F.inline(weights))
    alpha, beta, gamma = F.col("alpha"), F.col("beta"), F.col("gamma")
    state = F.struct(F.col("level0").alias("level"), F.col("trend0").alias("trend"), F.col("season0").alias("season"),
                     F.lit(0.0).alias("sse"))

    def step(s, v):
        # the season array is a queue: its head belongs to this period and returns at the tail
        old = F.element_at(s["season"], 1)
        guess = s["level"] + s["trend"] + old
        level = alpha * (v - old) + (1 - alpha) * (s["level"] + s["trend"])
        trend = beta * (level - s["level"]) + (1 - beta) * s["trend"]
        season = F.concat(F.slice(s["season"], 2, period - 1), F.array(gamma * (v - level) + (1 - gamma) * old))
        return F.struct(level.alias("level"), trend.alias("trend"), season.alias("season"),
                        (s["sse"] + (v - guess) * (v - guess)).alias("sse"))

    fitted = runs.withColumn("_end", F.aggregate("x", state, step))
    best = fitted.groupBy(*by).agg(F.min_by(
        F.struct("alpha", "beta", "gamma", "_end"), F.struct(F.col("_end")["sse"], alpha, beta, gamma)).alias("b"))
    end = F.col("b")["_end"]
    forecast = F.transform(F.sequence(F.lit(1), F.lit(ahead)), lambda h: end["level"] + h * end["trend"]
                           + F.element_at(end["season"], (h - 1) % period + 1))
    found = best.select(*by, F.col("b")["alpha"].alias("alpha"), F.col("b")["beta"].alias("beta"), F.col("b")["gamma"].alias("gamma"),
                        end["sse"].alias("sse"), F.posexplode(forecast).alias("step", "forecast"), F.lit(None).cast("string").alias("problem"))
    none = F.lit(None).cast("double")
    short = values.where(~long_enough).select(
        *by, none.alias("alpha"), none.alias("beta"), none.alias("gamma"), none.alias("sse"), F.explode(F.sequence(F.lit(0), F.lit(ahead - 1))).alias("step"),
        none.alias("forecast"), F.lit("shorter than two seasons").alias("problem"))
    return found.unionByName(short).withColumn("step", F.col("step") + 1)


def holt_winters_fitted(df: DataFrame, by: list[str], order: str, value: str, period: int = 12, ahead: int = 6) -> DataFrame:
    """Additive trend and season with fitted weights and start values: (by, alpha, beta, gamma, sse, step, forecast, problem).

    The weights lie in [0, 1]; for any of them the start values of least squared error are solved for. A series
    holds one value per period of the calendar and is fitted whole by one task. A series with a null, or shorter
    than two seasons, gets null forecasts, and ``problem`` says so.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by).schema.fields)
    schema = f"{fields}, alpha double, beta double, gamma double, sse double, step int, forecast double, problem string"

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(order)[value].to_numpy(float)
        weights, error, found, problem = [None] * 3, None, [None] * ahead, None
        if np.isnan(x).any():
            problem = "a missing value"
        elif len(x) < 2 * period:
            problem = "shorter than two seasons"
        else:
            weights, start, error = hw.fit(x, period)
            found = hw.forecast(x, weights, start, period, ahead)
        rows = [(*key, *weights, error, h, f, problem) for h, f in enumerate(found, 1)]
        return pd.DataFrame(rows, columns=[*by, "alpha", "beta", "gamma", "sse", "step", "forecast", "problem"])

    return df.select(*by, order, F.col(value).cast("double").alias(value)).groupBy(*by).applyInPandas(one, schema)


def forecast_table(df: DataFrame, by: list[str], order: str, value: str, test: int = 6, season: int = 12) -> DataFrame:
    """The test rows with the forecasts of all models: ``naive``, ``seasonal_naive``, ``holt_winters``; each sees the rows before only."""
    w = Window.partitionBy(*by).orderBy(order)
    placed = df.withColumn("_i", F.row_number().over(w)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*by)))
    fitted = holt_winters_fitted(placed.where(F.col("_i") <= F.col("_n") - test).drop("_i", "_n"), by, order, value, season, test)
    steps = placed.where(F.col("_i") > F.col("_n") - test).select(*by, order, (F.col("_i") - F.col("_n") + test).cast("int").alias("step"))
    ours = steps.join(fitted.select(*by, "step", F.col("forecast").alias("holt_winters")), [*by, "step"], "left").drop("step")
    return naive_forecasts(df, by, order, value, test, season).join(ours, [*by, order])


def autocorrelation(df: DataFrame, by: list[str], order: str, value: str, lags=ACF_LAGS) -> DataFrame:
    """Biased autocorrelation at the given lags and the 95 % band."""
    w = Window.partitionBy(*by).orderBy(order)
    centred = df.withColumn("_d", F.col(value) - F.avg(value).over(Window.partitionBy(*by)))
    shifted = centred.withColumns({f"_l{k}": F.col("_d") * F.lag("_d", k).over(w) for k in lags})
    sums = shifted.groupBy(*by).agg(F.sum(F.col("_d") * F.col("_d")).alias("_0"), F.count(F.lit(1)).alias("n"),
                                    *[F.sum(f"_l{k}").alias(f"_{k}") for k in lags])
    rows = F.array(*[F.struct(F.lit(k).alias("lag"), (F.col(f"_{k}") / F.col("_0")).alias("acf")) for k in lags])
    return sums.select(*by, (1.96 / F.sqrt("n")).alias("band"), F.inline(rows))


def change_point(df: DataFrame, by: list[str], order: str, value: str, margin: int = 14) -> DataFrame:
    """One shift of the mean: the split with the least two-segment squared error, earliest on ties, and Welch's t."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    df = df.withColumn("_d", F.col(value) - F.avg(value).over(whole))
    d = F.col("_d")
    df = df.withColumns({
        "k": F.count(F.lit(1)).over(w), "n": F.count(F.lit(1)).over(whole),
        "_s1": F.sum(d).over(w), "_q1": F.sum(d * d).over(w), "_s": F.sum(d).over(whole), "_q": F.sum(d * d).over(whole),
        "_mean": F.avg(value).over(whole),
    })
    k, n = F.col("k"), F.col("n")
    s2, q2 = F.col("_s") - F.col("_s1"), F.col("_q") - F.col("_q1")
    sse1, sse2 = F.col("_q1") - F.col("_s1") * F.col("_s1") / k, q2 - s2 * s2 / (n - k)
    splits = df.where((k >= margin) & (k < n - margin)).withColumns({
        "sse": F.round(sse1 + sse2, 6),
        "mean_before": F.col("_mean") + F.col("_s1") / k, "mean_after": F.col("_mean") + s2 / (n - k),
        "_v1": sse1 / (k - 1), "_v2": sse2 / (n - k - 1),
    })
    t, dof = welch(k, F.col("mean_before"), F.col("_v1"), n - k, F.col("mean_after"), F.col("_v2"))
    best = F.min_by(F.struct(F.col(order).alias("at"), "k", "sse", "mean_before", "mean_after",
                             (100 * (F.col("mean_after") / F.col("mean_before") - 1)).alias("change_pct"),
                             t.alias("t"), dof.alias("df")), F.struct("sse", "k"))
    return splits.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def long_series(parts: list[tuple[str, DataFrame, Column, Column]]) -> DataFrame:
    """Union of named series as (serie, ts, valor)."""
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("serie"), ts.cast("timestamp_ntz").alias("ts"), value.cast("double").alias("valor"))
        for name, df, ts, value in parts])
