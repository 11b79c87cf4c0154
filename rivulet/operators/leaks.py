"""Leak detection: night-flow score, unsupervised threshold, sustained alarm and its evaluation.

The label only measures the result; no score or threshold reads it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.ranks import exact_quantiles
from rivulet.operators.series import complete_calendar
from rivulet.operators.windows import sustained_run
from rivulet.session import materialize

# Detector settings.
REFERENCE_DAYS = 21
REFERENCE_HOURS = REFERENCE_DAYS * 24
WINDOW_HOURS = 72
THRESHOLD_PERCENTILE = 0.995
SUSTAINED_HOURS = 24
NIGHT_HOURS = (2, 3, 4)
SENSITIVITY_FACTORS = (0.8, 1.0, 1.2, 1.5)


def with_hour_index(hourly: DataFrame, series: str) -> DataFrame:
    return hourly.withColumn("hour_index", F.row_number().over(Window.partitionBy(series).orderBy("hour")) - 1)


def night_flow_score(hourly: DataFrame, series: str, value: str, out: str = "score") -> DataFrame:
    """Mean flow of the night hours over its reference median, given to the hours of the next day.

    A reference median of 0 gives no score.
    """
    nights = hourly.where(F.hour("hour").isin(*NIGHT_HOURS)).groupBy(series, F.to_date("hour").alias("day")).agg(
        F.avg(value).alias("_night"))
    nights = complete_calendar(nights, [series], "day", "1 DAY")
    day_no = F.row_number().over(Window.partitionBy(series).orderBy("day"))
    nights = nights.withColumn("_no", day_no)
    # at most REFERENCE_DAYS values per series reach the percentile
    median = F.percentile(F.when(F.col("_no") <= REFERENCE_DAYS, F.col("_night")), 0.5).over(Window.partitionBy(series))
    scored = nights.select(series, F.date_add("day", 1).alias("day"),
                           (F.col("_night") / F.nullif(median, F.lit(0.0))).alias(out))
    return hourly.withColumn("day", F.to_date("hour")).join(scored, [series, "day"], "left").drop("day")


def unsupervised_threshold(scored: DataFrame, score: str = "score") -> Column:
    """High percentile of all series' scores in the reference hours, as a scalar."""
    reference = scored.where((F.col("hour_index") < REFERENCE_HOURS) & F.col(score).isNotNull() & ~F.isnan(score))
    return exact_quantiles(reference, score, {"threshold": THRESHOLD_PERCENTILE}).select("threshold").scalar()


def sustained_alarm(scored: DataFrame, series: str, threshold: Column, score: str = "score", out: str = "alarm",
                    hours: int = SUSTAINED_HOURS) -> DataFrame:
    """Alarm from the ``hours``-th consecutive hour above the threshold; never inside the reference hours."""
    raised = sustained_run(scored, F.coalesce(F.col(score), F.lit(0.0)) > threshold, [series], "hour", hours, out)
    return raised.withColumn(out, F.col(out) & (F.col("hour_index") >= REFERENCE_HOURS))


def series_detection(alarmed: DataFrame, series: str, label: str = "leak", score: str = "score", alarm: str = "alarm",
                     also: list[str] | tuple = ()) -> DataFrame:
    """Per series: real, detected, starts, delay in hours, highest score, and hourly TP, FP, FN.

    With a real leak only alarms at or after its start count as detection.
    """
    keys = [series, *also]
    started = F.min(F.when(F.col(label), F.col("hour"))).over(Window.partitionBy(*keys))
    rows = alarmed.withColumn("true_start", started)
    after = F.col(alarm) & (F.col("true_start").isNull() | (F.col("hour") >= F.col("true_start")))
    late = F.col("hour_index") >= REFERENCE_HOURS
    truth = F.col(label) & late
    out = rows.groupBy(*keys).agg(
        F.first("true_start").alias("true_start"), F.min(F.when(after, F.col("hour"))).alias("detected_at"),
        F.max(F.when(late, F.col(score))).alias("max_score"),
        F.count_if(F.col(alarm) & truth).alias("tp_hours"), F.count_if(F.col(alarm) & ~truth).alias("fp_hours"),
        F.count_if(~F.col(alarm) & truth).alias("fn_hours"))
    delay = F.timestamp_diff("HOUR", F.col("true_start"), F.col("detected_at"))
    return out.withColumns({
        "real": F.col("true_start").isNotNull(), "detected": F.col("detected_at").isNotNull(),
        "delay_h": F.when(F.col("true_start").isNotNull(), delay),
    })


def detection_summary(per_series: DataFrame, by: list[str] | tuple = ()) -> DataFrame:
    """Series and hour precision and recall, F1 and median delay."""
    per_series = materialize(per_series)
    agg = per_series.groupBy(*by).agg(
        F.count_if(F.col("real") & F.col("detected")).alias("tp"), F.count_if(~F.col("real") & F.col("detected")).alias("fp"),
        F.count_if(F.col("real") & ~F.col("detected")).alias("fn"),
        F.sum("tp_hours").alias("_tph"), F.sum("fp_hours").alias("_fph"), F.sum("fn_hours").alias("_fnh"))
    delays = exact_quantiles(per_series.where(F.col("real") & F.col("detected")).withColumn("delay_h", F.col("delay_h").cast("double")),
                             "delay_h", {"median_delay_h": 0.5}, list(by)).drop("n")
    ratio = lambda a, c: F.col(a) / F.nullif(F.col(a) + F.col(c), F.lit(0))
    if by:
        out = agg.join(delays, list(by), "left")
    else:
        out = agg.withColumn("median_delay_h", delays.scalar())
    out = out.withColumns({"precision": ratio("tp", "fp"), "recall": ratio("tp", "fn")})
    p, r = F.col("precision"), F.col("recall")
    return out.withColumns({
        "f1": F.when(F.coalesce(p * r, F.lit(0.0)) > 0, 2 * p * r / (p + r)).otherwise(0.0),
        "hour_precision": ratio("_tph", "_fph"), "hour_recall": ratio("_tph", "_fnh"),
    }).drop("_tph", "_fph", "_fnh")


def detect(scored: DataFrame, series: str, factor: float = 1.0, hours: int = SUSTAINED_HOURS) -> DataFrame:
    """Threshold, alarm and per-series detection of a scored hourly table."""
    scored = materialize(scored)
    return series_detection(sustained_alarm(scored, series, unsupervised_threshold(scored) * factor, hours=hours), series)


def threshold_sensitivity(scored: DataFrame, series: str, factors=SENSITIVITY_FACTORS, hours: int = SUSTAINED_HOURS) -> DataFrame:
    """Detection summary at each multiple of the threshold; scores and threshold are computed once."""
    scored = materialize(scored)
    limit = unsupervised_threshold(scored)
    every = reduce(DataFrame.unionByName, [
        series_detection(sustained_alarm(scored, series, limit * f, hours=hours), series).withColumn("factor", F.lit(float(f)))
        for f in factors])
    return detection_summary(every, ["factor"])


def method_comparison(methods: dict[str, DataFrame], series: str, hours: int = SUSTAINED_HOURS) -> DataFrame:
    every = reduce(DataFrame.unionByName, [
        detect(scored, series, hours=hours).withColumn("method", F.lit(name)) for name, scored in methods.items()])
    return detection_summary(every, ["method"])


def anomaly_table(per_series: DataFrame, series: str, level: int, version: str = "v1") -> DataFrame:
    """Detected series as anomaly rows."""
    return per_series.where("detected").select(
        F.col(series).alias("series"), F.col("detected_at").alias("ts"), F.lit(level).alias("wavelet_level"),
        F.col("max_score").alias("score"), F.lit("fuga_probable").alias("kind"), F.col("real").alias("real_leak"),
        F.lit(version).alias("version"))


def example_series(hourly: DataFrame, series: str, label: str = "leak") -> DataFrame:
    """The series with most labelled hours and when they start."""
    marked = hourly.where(F.col(label)).groupBy(series).agg(F.count(F.lit(1)).alias("leak_hours"), F.min("hour").alias("start"))
    return marked.orderBy(F.col("leak_hours").desc(), series).limit(1)
