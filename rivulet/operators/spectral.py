"""Fourier and wavelet operators: one NumPy kernel per series, the series spread over the cluster.

A series has one row per hour of the calendar, which bounds what a task holds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import wavelet as wv
from rivulet.operators.leaks import REFERENCE_HOURS, WINDOW_HOURS
from rivulet.operators.windows import rolling_energy

PEAK_GAP = 2  # bins next to a chosen peak that belong to it


def pick_peaks(power: np.ndarray, n: int) -> list[int]:
    """Strongest bins after 0, none within PEAK_GAP bins of a stronger one."""
    free = np.ones(len(power), dtype=bool)
    free[0] = False
    peaks: list[int] = []
    while len(peaks) < n and free.any():
        best = int(np.argmax(np.where(free, power, -np.inf)))
        peaks.append(best)
        free[max(0, best - PEAK_GAP):best + PEAK_GAP + 1] = False
    return peaks


def power_spectrum(df: DataFrame, series: str, order: str, value: str, peaks: int = 6) -> DataFrame:
    """Per series and bin: frequency (cycles per hour), coefficient, power, and the place among the peaks."""
    kind = df.schema[series].dataType.simpleString()

    def transform(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(order)[value].to_numpy(float)
        coef = np.fft.rfft(x - x.mean())
        power = np.abs(coef) ** 2
        place = pd.array([None] * len(power), dtype="Int32")
        for i, k in enumerate(pick_peaks(power, peaks), 1):
            place[k] = i
        return pd.DataFrame({
            series: pdf[series].iloc[0], "k": np.arange(len(power)), "freq": np.fft.rfftfreq(len(x)), "re": coef.real, "im": coef.imag,
            "power": power, "peak": place, "n": len(x), "mean": x.mean()})

    return df.select(series, order, value).groupBy(series).applyInPandas(
        transform, f"{series} {kind}, k int, freq double, re double, im double, power double, peak int, n int, mean double")


def spectrum_share(spectrum: DataFrame, series: str) -> Column:
    """Percent of the energy without bin 0."""
    whole = Window.partitionBy(series)
    return 100 * F.col("power") / F.sum(F.when(F.col("k") > 0, F.col("power"))).over(whole)


def dominant_frequencies(spectrum: DataFrame, series: str, n: int = 5) -> DataFrame:
    out = spectrum.withColumn("energy_pct", spectrum_share(spectrum, series)).where(F.col("peak") <= n)
    return out.select(series, "peak", F.round("freq", 5).alias("cycles_per_hour"), F.round(24 * F.col("freq"), 3).alias("cycles_per_day"),
                      F.round(1 / F.col("freq"), 2).alias("period_h"), F.round("energy_pct", 2).alias("energy_pct"))


def harmonic_energy(spectrum: DataFrame, series: str) -> DataFrame:
    """Percent of the energy at exactly 1 to 6 whole cycles per day."""
    per_day = 24 * F.col("freq")
    exact = (F.abs(per_day - F.rint(per_day)) < 1e-9) & F.rint(per_day).between(1, 6)
    return spectrum.withColumn("_share", spectrum_share(spectrum, series)).groupBy(series).agg(
        F.coalesce(F.sum(F.when(exact, F.col("_share"))), F.lit(0.0)).alias("harmonic_pct"))


def spectrum_band(spectrum: DataFrame, series: str, low: float = 0.1, high: float = 6.0) -> DataFrame:
    out = spectrum.withColumn("energy_pct", spectrum_share(spectrum, series)).withColumn("cycles_per_day", 24 * F.col("freq"))
    return out.where(F.col("cycles_per_day").between(low, high)).select(series, "k", "cycles_per_day", "energy_pct")


def reconstruct(df: DataFrame, spectrum: DataFrame, series: str, order: str, value: str) -> DataFrame:
    """Mean plus the chosen peaks, evaluated at every hour; ``r2`` is the share of variation they explain."""
    waves = spectrum.where(F.col("peak").isNotNull()).groupBy(series).agg(
        F.array_sort(F.collect_list(F.struct("peak", "k", "re", "im"))).alias("_waves"), F.max("n").alias("_n"), F.max("mean").alias("_mean"))
    t = F.row_number().over(Window.partitionBy(series).orderBy(order)) - 1

    def wave(acc, w):
        angle = 2 * F.lit(np.pi) * w["k"] * F.col("_t") / F.col("_n")
        twice = F.when(2 * w["k"] == F.col("_n"), 1.0).otherwise(2.0)
        return acc + twice * (w["re"] * F.cos(angle) - w["im"] * F.sin(angle)) / F.col("_n")

    out = df.select(series, order, value).withColumn("_t", t).join(waves, series).withColumn(
        "rebuilt", F.aggregate("_waves", F.col("_mean"), wave))
    whole = Window.partitionBy(series)
    err, dev = F.col(value) - F.col("rebuilt"), F.col(value) - F.col("_mean")
    return out.withColumn("r2", 1 - F.sum(err * err).over(whole) / F.sum(dev * dev).over(whole)).select(series, order, value, "rebuilt", "r2")


def dwt_energy(df: DataFrame, series: str, order: str, value: str) -> DataFrame:
    """Relative energy of the 5-level db4 transform: A5, D5 .. D1, adding up to 1."""
    kind = df.schema[series].dataType.simpleString()
    names = [f"A{wv.LEVELS}"] + [f"D{i}" for i in range(wv.LEVELS, 0, -1)]

    def energy(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = wv.decompose(pdf.sort_values(order)[value].to_numpy(float))
        e = np.array([(p**2).sum() for p in parts])
        return pd.DataFrame([[pdf[series].iloc[0], *(e / e.sum())]], columns=[series, *names])

    return df.select(series, order, value).groupBy(series).applyInPandas(
        energy, f"{series} {kind}, " + ", ".join(f"{n} double" for n in names))


def dwt_reconstruct(df: DataFrame, series: str, order: str, value: str) -> DataFrame:
    """Every hour with the full inverse transform and with the approximation alone."""
    kind, when = (df.schema[c].dataType.simpleString() for c in (series, order))

    def inverse(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        x = pdf[value].to_numpy(float)
        parts = wv.decompose(x)
        flat = [parts[0], *[np.zeros_like(p) for p in parts[1:]]]
        return pdf.assign(rebuilt=wv.compose(parts, len(x)), approximation=wv.compose(flat, len(x)))

    return df.select(series, order, value).groupBy(series).applyInPandas(
        inverse, f"{series} {kind}, {order} {when}, {value} double, rebuilt double, approximation double")


def swt_energies(df: DataFrame, series: str, order: str, value: str) -> DataFrame:
    """Squared approximation and summed squared details of the stationary transform, per hour."""
    kind, when = (df.schema[c].dataType.simpleString() for c in (series, order))

    def energies(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        approx, *details = wv.stationary(pdf[value].to_numpy(float))
        return pd.DataFrame({series: pdf[series], order: pdf[order], "approx": approx, "detail": np.sqrt(sum(d**2 for d in details))})

    return df.select(series, order, value).groupBy(series).applyInPandas(
        energies, f"{series} {kind}, {order} {when}, approx double, detail double")


def swt_score(hourly: DataFrame, series: str, value: str, out: str = "score") -> DataFrame:
    """Rolling energy of the approximation over that of the details, relative to its reference median.

    ``hourly`` has series, hour, hour_index and the value.
    """
    e = swt_energies(hourly, series, "hour", value)
    ratio = rolling_energy(F.col("approx"), [series], "hour", WINDOW_HOURS) / F.nullif(
        rolling_energy(F.col("detail"), [series], "hour", WINDOW_HOURS), F.lit(0.0))
    rows = hourly.join(e.withColumn("_ratio", ratio).drop("approx", "detail"), [series, "hour"])
    reference = F.col("hour_index").between(WINDOW_HOURS, REFERENCE_HOURS - 1)
    # at most REFERENCE_HOURS values per series reach the percentile
    median = F.percentile(F.when(reference, F.col("_ratio")), 0.5).over(Window.partitionBy(series))
    return rows.withColumn(out, F.col("_ratio") / F.nullif(median, F.lit(0.0))).drop("_ratio")


def energy_by_group(energy: DataFrame, hourly: DataFrame, series: str, label: str = "leak") -> DataFrame:
    """Mean percent energy of series with and without a leak; the label only describes the groups."""
    marked = hourly.groupBy(series).agg(F.max(label).alias("leak"))
    names = [c for c in energy.columns if c != series]
    return energy.join(marked, series).groupBy("leak").agg(*[(100 * F.avg(n)).alias(n) for n in names])
