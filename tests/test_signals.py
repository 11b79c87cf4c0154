"""Spectrum, wavelets, detectors and forecasts, on square waves, chirps and hand-made tables."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.functions import holtwinters as hw
from rivulet.functions import wavelet as wv
from rivulet.operators import leaks as lk
from rivulet.operators import series as se
from rivulet.operators import spectral as sp
from rivulet.operators import windows as wn

FIRST = dt.datetime(2023, 11, 1)
HOURS = 90 * 24


def pump(phase, lost_from=None, lost=0.4):
    """A pump that runs six hours of every eighteen, with a ripple, and from some hour on a constant loss."""
    t = np.arange(HOURS)
    flow = np.where((t + phase) % 18 < 6, 3.0, 0.5) + 0.01 * np.cos(0.7 * t + phase)
    lossy = t >= (HOURS if lost_from is None else lost_from)
    return flow + lost * lossy, lossy


@pytest.fixture(scope="module")
def pumps(spark):
    frames = []
    for name, phase, lost_from in (("even", 0, None), ("late", 5, 70 * 24 + 9), ("early", 11, 45 * 24 + 15)):
        flow, lossy = pump(phase, lost_from)
        frames.append(pd.DataFrame({"series": name, "hour": pd.date_range(FIRST, periods=HOURS, freq="h"), "hour_index": np.arange(HOURS), "volume": flow, "leak": lossy}))
    return spark.createDataFrame(pd.concat(frames)).withColumn("hour", F.col("hour").cast("timestamp_ntz")).cache()


# ---------------------------------------------------------------- spectrum
def test_strongest_period_is_the_pump_cycle(pumps):
    spectrum = sp.power_spectrum(pumps, "series", "hour", "volume")
    top = sp.dominant_frequencies(spectrum, "series").where("peak = 1 and series = 'even'").first()
    assert top["period_h"] == pytest.approx(18, rel=0.02)


def test_more_peaks_explain_more(pumps):
    spectrum = sp.power_spectrum(pumps, "series", "hour", "volume")
    flow = pumps.where("series = 'even'").sort("hour").toPandas()["volume"].to_numpy()
    rebuilt = sp.reconstruct(pumps, spectrum, "series", "hour", "volume").where("series = 'even'").sort("hour").toPandas()
    # the rest is orthogonal to what was kept, so the explained share is the ratio of the energies
    centred, kept = flow - flow.mean(), rebuilt["rebuilt"].to_numpy() - flow.mean()
    assert kept @ (centred - kept) == pytest.approx(0, abs=1e-6)
    assert rebuilt["r2"][0] == pytest.approx((kept @ kept) / (centred @ centred), abs=1e-9) and rebuilt["r2"][0] > 0.7


@pytest.mark.parametrize("power, n, want", [
    ([0, 4, 9, 4, 0, 0, 6, 0], 2, [2, 6]), ([0, 1, 2, 3, 4, 5], 2, [5, 2]), ([0, 7, 7, 0, 1], 1, [1])])
def test_peaks_keep_a_distance(power, n, want):
    assert sp.pick_peaks(np.array(power, float), n) == want


# ---------------------------------------------------------------- wavelets
@pytest.mark.parametrize("n", [32, 33, 500, 1024])
def test_wavelets_rebuild_a_chirp(n):
    x = np.cos(np.linspace(0, 9, n) ** 2) * np.linspace(1, 5, n)
    parts = wv.decompose(x)
    np.testing.assert_allclose(wv.compose(parts, n), x, atol=1e-9)
    if n % 32 == 0:
        energy = x @ x
        assert sum(p @ p for p in parts) == pytest.approx(energy) and sum(p @ p for p in wv.stationary(x)) == pytest.approx(energy)


def test_details_ignore_straight_lines():
    line = np.linspace(-3, 3, 256)
    inner = [d[8:-8] for d in wv.decompose(line)[1:] if len(d) > 24]
    assert inner and max(np.abs(d).max() for d in inner) < 1e-9


def test_shares_of_energy(pumps):
    shares = sp.dwt_energy(pumps, "series", "hour", "volume")
    table = shares.toPandas().set_index("series")
    assert (table.to_numpy() >= 0).all() and np.allclose(table.sum(axis=1), 1)
    by_leak = {r["leak"]: r["A5"] for r in sp.energy_by_group(shares, pumps, "series").collect()}
    assert by_leak[True] > by_leak[False]  # a constant loss adds to the slowest part


def test_rebuilt_in_spark(pumps):
    gap = sp.dwt_reconstruct(pumps, "series", "hour", "volume").select(F.max(F.abs(F.col("rebuilt") - F.col("volume")))).first()[0]
    assert gap < 1e-9


# ---------------------------------------------------------------- detectors
def test_losses_are_found_after_they_begin(pumps):
    scored = {"swt": sp.swt_score(pumps, "series", "volume"), "flow": lk.night_flow_score(pumps, "series", "volume")}
    for name in scored:
        rows = {r["series"]: r for r in lk.detect(scored[name], "series").collect()}
        for series in ("late", "early"):
            if rows[series]["detected"]:
                assert rows[series]["delay_h"] >= 0, name
    table = {r["method"]: r for r in lk.method_comparison(scored, "series").collect()}
    assert set(table) == set(scored) and table["flow"]["recall"] == 1.0


@pytest.mark.parametrize("marks, length, want", [
    ("110111", 2, "010011"), ("1111", 1, "1111"), ("1110111", 4, "0000000"), ("0111", 3, "0001")])
def test_runs_must_last(spark, marks, length, want):
    rows = [("s", FIRST + dt.timedelta(hours=i), int(m)) for i, m in enumerate(marks)]
    df = spark.createDataFrame(rows, "s string, hour timestamp_ntz, high int")
    out = wn.sustained_run(df, F.col("high") == 1, ["s"], "hour", length, "run").sort("hour").collect()
    assert "".join(str(int(r["run"])) for r in out) == want


# ---------------------------------------------------------------- history and change
def test_history_sees_only_the_past(spark):
    late = [None, True, True, None, False, True]
    rows = [(9, f"2024-{i + 1:02d}", label, 10.0 * (i + 1)) for i, label in enumerate(late)]
    out = wn.payment_history(spark.createDataFrame(rows, "conn_id int, period string, late boolean, m3 double")).sort("period").collect()
    for i, row in enumerate(out):
        known = [x for x in late[:i] if x is not None]
        assert row["bills_with_history"] == len(known)
        assert row["previous_label"] == (float(known[-1]) if known else None)
        assert row["late_rate_so_far"] == (pytest.approx(sum(known) / len(known)) if known else None)
    assert out[0]["m3_vs_avg6"] is None


def test_change_point_of_a_ramp_with_a_step(spark):
    level = [5.0, 5.2, 4.8, 5.1] * 6 + [9.0, 9.1, 8.8] * 6
    rows = [("z", dt.date(2022, 3, 10) + dt.timedelta(days=i), v) for i, v in enumerate(level)]
    got = se.change_point(spark.createDataFrame(rows, "s string, day date, v double"), ["s"], "day", "v").first()
    before, after = np.array(level[:24]), np.array(level[24:])
    spread = before.var(ddof=1) / 24 + after.var(ddof=1) / 18
    assert got["k"] == 24 and got["at"] == dt.date(2022, 4, 3)
    assert got["t"] == pytest.approx((before.mean() - after.mean()) / np.sqrt(spread), abs=1e-6)


# ---------------------------------------------------------------- Holt-Winters
def forecasts(spark, values, **options):
    rows = [("z", i, float(v)) for i, v in enumerate(values)]
    return se.holt_winters(spark.createDataFrame(rows, "s string, i int, v double"), ["s"], "i", "v", **options).sort("step").collect()


def test_a_pure_season_on_a_level_is_continued_exactly(spark):
    season = [3.0, -1.0, -2.0, 0.0]
    out = forecasts(spark, [10 + season[i % 4] for i in range(16)], period=4, ahead=4)
    assert out[0]["sse"] == pytest.approx(0, abs=1e-18) and out[0]["problem"] is None
    np.testing.assert_allclose([r["forecast"] for r in out], [10 + s for s in season])


def test_one_period_by_hand(spark):
    # period 1: level 2, trend 4 - 2; the season is zero and stays zero with gamma 0
    out = forecasts(spark, [2.0, 4.0], period=1, ahead=2, grid=((0.5, 0.0, 0.0),))
    # 2: guess 4, level 0.5 * 2 + 0.5 * 4 = 3; 4: guess 5, level 0.5 * 4 + 0.5 * 5 = 4.5
    assert out[0]["sse"] == pytest.approx((2 - 4) ** 2 + (4 - 5) ** 2)
    assert [r["forecast"] for r in out] == [pytest.approx(6.5), pytest.approx(8.5)]


def test_the_best_grid_point_wins(spark):
    values = np.random.default_rng(21).normal(50, 4, 40)
    grid = ((0.1, 0.01, 0.01), (0.9, 0.3, 0.5), (0.5, 0.1, 0.1))
    alone = [forecasts(spark, values, grid=(g,))[0]["sse"] for g in grid]
    assert forecasts(spark, values, grid=grid)[0]["sse"] == pytest.approx(min(alone))


def test_short_series_stay_with_a_reason(spark):
    out = forecasts(spark, range(20), ahead=3)
    assert [(r["step"], r["forecast"], r["problem"]) for r in out] == [(i, None, "shorter than two seasons") for i in (1, 2, 3)]


def test_hours_without_pulses_are_zero(spark):
    minutes = [("a", 5, 1.5), ("a", 59, 0.5), ("a", 130, 4.0), ("b", 61, 1.0)]
    rows = spark.createDataFrame([(s, FIRST + dt.timedelta(minutes=m), v) for s, m, v in minutes], "s string, ts timestamp_ntz, v double")
    out = se.hourly_total(rows, "ts", "v", ["s"]).sort("s", "hour").collect()
    assert [(r["s"], r["v"]) for r in out] == [("a", 2.0), ("a", 0.0), ("a", 4.0), ("b", 0.0), ("b", 1.0), ("b", 0.0)]


# ---------------------------------------------------------------- fitted smoothing
def plain_smoothing(x, weights, start, period, ahead):
    a, b, g = weights
    level, trend, *season = start
    error = 0.0
    for v in x:
        old = season.pop(0)
        error += (v - level - trend - old) ** 2
        before, level = level, a * (v - old) + (1 - a) * (level + trend)
        trend = b * (level - before) + (1 - b) * trend
        season.append(g * (v - level) + (1 - g) * old)
    return error, [level + h * trend + season[(h - 1) % period] for h in range(1, ahead + 1)]


def test_fit_is_no_worse_than_any_grid_point_and_follows_the_recursion():
    rng = np.random.default_rng(6)
    x = 50 + 0.4 * np.arange(48) + 8 * np.sin(np.arange(48) * np.pi / 6) + rng.normal(0, 2, 48)
    weights, start, error = hw.fit(x, 12)
    assert ((weights >= 0) & (weights <= 1)).all()
    plain, ahead = plain_smoothing(x, weights, start, 12, 6)
    assert error == pytest.approx(plain) and hw.forecast(x, weights, start, 12, 6) == pytest.approx(ahead)
    first, second = x[:12].mean(), x[12:24].mean()
    for w in hw.GRID:
        assert error <= plain_smoothing(x, w, [first, (second - first) / 12, *(x[:12] - first)], 12, 1)[0] + 1e-9
        assert error <= hw.costs(x, w[None], 12)[0][0] + 1e-9


def test_start_values_are_the_least_squares_ones():
    x = np.random.default_rng(8).normal(20, 3, 30)
    w = np.array([0.37, 0.12, 0.2])
    cost, (start,) = hw.costs(x, w[None], 4)
    for i in range(6):
        for step in (-1e-3, 1e-3):
            other = start.copy()
            other[i] += step
            assert plain_smoothing(x, w, other, 4, 1)[0] >= cost[0] - 1e-9


def test_known_weights_are_found_again():
    period, w, rng = 4, (0.3, 0.1, 0.6), np.random.default_rng(3)
    level, trend, season, x = 100.0, 0.5, [5.0, -3.0, 1.0, -3.0], []
    for _ in range(400):  # the series follows the recursion with small errors
        old = season.pop(0)
        x.append(level + trend + old + rng.normal(0, 1))
        before, level = level, w[0] * (x[-1] - old) + (1 - w[0]) * (level + trend)
        trend = w[1] * (level - before) + (1 - w[1]) * trend
        season.append(w[2] * (x[-1] - level) + (1 - w[2]) * old)
    found, _, error = hw.fit(np.array(x), period)
    np.testing.assert_allclose(found, w, atol=0.12)
    assert error <= hw.costs(np.array(x), np.array([w]), period)[0][0] + 1e-9


def test_fitted_operator_and_ranking(spark):
    rng = np.random.default_rng(2)
    rows = [("a", i, 30 + i + 5 * np.sin(i * np.pi / 6) + rng.normal(0, .1)) for i in range(36)] + [("b", i, 1.0) for i in range(10)]
    rows += [("c", i, None if i == 4 else 2.0 + i) for i in range(30)]
    df = spark.createDataFrame([(s, i, None if v is None else float(v)) for s, i, v in rows], "s string, i int, v double")
    out = {}
    for r in se.holt_winters_fitted(df, ["s"], "i", "v").orderBy("s", "step").collect():
        out.setdefault(r["s"], []).append(r)
    assert {k: (len(v), v[0]["problem"]) for k, v in out.items()} == {"a": (6, None), "b": (6, "shorter than two seasons"), "c": (6, "a missing value")}
    assert all(r["forecast"] is None for k in "bc" for r in out[k]) and [r["step"] for r in out["a"]] == [1, 2, 3, 4, 5, 6]
    table = se.forecast_table(df.where("s = 'a'"), ["s"], "i", "v")
    best = se.forecast_scores(table, "v", ["naive", "seasonal_naive", "holt_winters"]).collect()
    assert [r["model"] for r in best][0] == "holt_winters" and best[0]["mae"] < 0.5 and table.count() == 6
    assert se.holt_winters_fitted(df.limit(0), ["s"], "i", "v").collect() == []
