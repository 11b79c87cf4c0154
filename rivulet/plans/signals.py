"""Queries of the time-series, Fourier, wavelet and leak-detection operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet.functions import wavelet as wv
from rivulet.operators import leaks as lk
from rivulet.operators import series as se
from rivulet.operators import spectral as sp
from rivulet.operators import windows as wn
from rivulet.plans import bindings as b
from rivulet.plans.bindings import BILLS, COMPLAINTS, CONNECTIONS, TELEMETRY
from rivulet.plans.registry import query, with_ctes
from rivulet.plans.summaries import r6


def hourly(spark, sf):
    rows = se.hourly_total(b.telemetry(spark, sf), "ts", "volume", ["series"], "leak")
    return lk.with_hour_index(rows, "series")


def total_hourly(spark, sf):
    tele = b.telemetry(spark, sf).withColumn("series", F.lit("total"))
    return se.hourly_total(tele, "ts", "volume", ["series"])


def total_daily(spark, sf):
    return se.resample_daily(total_hourly(spark, sf), "volume", ["series"])


def monthly(spark, sf):
    rows = b.bills(spark, sf).join(b.connections(spark, sf).select("conn_id", "tariff"), "conn_id")
    # decimal sums do not depend on the order of the rows
    mean = F.sum(F.col("m3").cast("decimal(12,3)")).cast("double") / F.count(F.lit(1))
    return rows.groupBy("tariff", "period").agg(mean.alias("m3"))


HOURLY = f"""{TELEMETRY},
raw_hours AS (SELECT series, date_trunc('hour', ts) AS hour, sum(volume) AS v, bool_or(leak) AS l FROM telemetry GROUP BY 1, 2),
hours AS (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM raw_hours),
hourly AS (
  SELECT s.series, h.hour, row_number() OVER (PARTITION BY s.series ORDER BY h.hour) - 1 AS hour_index,
         round(coalesce(r.v, 0), 6) AS volume, coalesce(r.l, false) AS leak
  FROM (SELECT DISTINCT series FROM raw_hours) s CROSS JOIN hours h LEFT JOIN raw_hours r ON r.series = s.series AND r.hour = h.hour),
total_hourly AS (
  SELECT h.hour, round(coalesce(sum(r.v), 0), 6) AS volume FROM hours h LEFT JOIN raw_hours r ON r.hour = h.hour GROUP BY 1),
total_daily AS (SELECT CAST(hour AS DATE) AS day, round(sum(volume), 6) AS volume FROM total_hourly GROUP BY 1)"""

MONTHLY = f"""{BILLS}, {CONNECTIONS},
monthly AS (SELECT tariff, period, CAST(sum(CAST(b.m3 AS DECIMAL(12,3))) AS DOUBLE) / count(*) AS m3 FROM bills b JOIN connections USING (conn_id) GROUP BY 1, 2)"""


@query("complete_hours", with_ctes(HOURLY) + "SELECT series, hour, volume, leak FROM hourly")
def complete_hours(spark, sf):
    return hourly(spark, sf).select("series", "hour", "volume", "leak")


@query("monthly_series", with_ctes(MONTHLY) + "SELECT * FROM monthly")
def monthly_series(spark, sf):
    return monthly(spark, sf)


@query("hourly_total", with_ctes(HOURLY) + "SELECT hour, volume FROM total_hourly")
def hourly_total(spark, sf):
    return total_hourly(spark, sf).select("hour", "volume")


@query("resample_daily", with_ctes(HOURLY) + """
  SELECT series, CAST(hour AS DATE) AS day, round(sum(volume), 6) AS total, round(avg(volume), 6) AS mean FROM hourly GROUP BY 1, 2""")
def resample_daily(spark, sf):
    rows = hourly(spark, sf)
    total = se.resample_daily(rows, "volume", ["series"]).withColumnRenamed("volume", "total")
    mean = se.resample_daily(rows, "volume", ["series"], "mean").withColumnRenamed("volume", "mean")
    return total.join(mean, ["series", "day"])


@query("daily_total_and_ma7", with_ctes(HOURLY) + """
  SELECT day, volume, CASE WHEN count(*) OVER w = 7 THEN round(avg(volume) OVER w, 6) END AS ma7 FROM total_daily
  WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def daily_total_and_ma7(spark, sf):
    return total_daily(spark, sf).withColumn("ma7", r6(wn.moving_average(F.col("volume"), ["series"], "day", 7))).select("day", "volume", "ma7")


@query("rolling_energy", with_ctes(HOURLY) + """
  SELECT series, hour, CASE WHEN count(*) OVER w = 72 THEN avg(round(volume * 100) * round(volume * 100)) OVER w END AS energy FROM hourly
  WINDOW w AS (PARTITION BY series ORDER BY hour ROWS BETWEEN 71 PRECEDING AND CURRENT ROW)""")
def rolling_energy(spark, sf):
    return hourly(spark, sf).select("series", "hour", wn.rolling_energy(F.rint(F.col("volume") * 100), ["series"], "hour", 72).alias("energy"))


@query("lag_day", with_ctes(HOURLY) + """, d AS (SELECT series, CAST(hour AS DATE) AS day, round(sum(volume), 6) AS volume FROM hourly GROUP BY 1, 2)
  SELECT series, day, volume, lag(volume) OVER (PARTITION BY series ORDER BY day) AS previous FROM d""")
def lag_day(spark, sf):
    days = se.resample_daily(hourly(spark, sf), "volume", ["series"])
    return days.withColumn("previous", wn.lag_row(F.col("volume"), ["series"], "day"))


@query("sustained_run", with_ctes(HOURLY) + """,
  a AS (SELECT *, volume > 60 AS above FROM hourly),
  g AS (SELECT *, sum(CAST(NOT above AS INTEGER)) OVER (PARTITION BY series ORDER BY hour) AS grp FROM a),
  p AS (SELECT *, sum(CAST(above AS INTEGER)) OVER (PARTITION BY series, grp ORDER BY hour) AS pos FROM g)
  SELECT series, hour, above AND pos >= 4 AS sustained FROM p""")
def sustained_run(spark, sf):
    return wn.sustained_run(hourly(spark, sf), F.col("volume") > 60, ["series"], "hour", 4, "sustained").select("series", "hour", "sustained")


@query("first_alarm_after", with_ctes(HOURLY) + """,
  s AS (SELECT series, min(hour) FILTER (leak) AS true_start FROM hourly GROUP BY 1)
  SELECT s.series, any_value(true_start) AS true_start, min(hour) FILTER (volume > 400 AND (true_start IS NULL OR hour >= true_start)) AS first_alarm
  FROM s JOIN hourly h ON h.series = s.series GROUP BY 1""")
def first_alarm_after(spark, sf):
    return wn.first_alarm_after(hourly(spark, sf).withColumn("alarm", F.col("volume") > 400), "series", "hour", "alarm", "leak")


# ---------------------------------------------------------------- decomposition and forecasts
DECOMPOSED = f"""{MONTHLY},
p AS (SELECT *, row_number() OVER (PARTITION BY tariff ORDER BY period) - 1 AS i, count(*) OVER (PARTITION BY tariff) AS n FROM monthly),
a AS (SELECT *, (0.5 * lag(m3, 6) OVER w + sum(m3) OVER (PARTITION BY tariff ORDER BY period ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
        + 0.5 * lead(m3, 6) OVER w) / 12 AS ma FROM p WINDOW w AS (PARTITION BY tariff ORDER BY period)),
fit AS (SELECT tariff, regr_slope(ma, i) FILTER (i >= 6 AND i < 18) AS hs, regr_intercept(ma, i) FILTER (i >= 6 AND i < 18) AS hi,
       regr_slope(ma, i) FILTER (i < n - 6 AND i >= n - 18) AS ts, regr_intercept(ma, i) FILTER (i < n - 6 AND i >= n - 18) AS ti FROM a GROUP BY 1),
tr AS (SELECT a.*, coalesce(ma, CASE WHEN i < 6 THEN hi + hs * i ELSE ti + ts * i END) AS trend FROM a JOIN fit USING (tariff)),
se AS (SELECT tariff, i % 12 AS s, avg(m3 - trend) AS mean FROM tr GROUP BY 1, 2),
sc AS (SELECT *, mean - avg(mean) OVER (PARTITION BY tariff) AS seasonal FROM se),
decomposed AS (SELECT tariff, period, i, m3, trend, seasonal, m3 - trend - seasonal AS residual
  FROM tr JOIN sc USING (tariff) WHERE sc.s = tr.i % 12)"""


def decomposed(spark, sf):
    return se.seasonal_decompose(monthly(spark, sf), ["tariff"], "period", "m3")


@query("seasonal_decompose", with_ctes(DECOMPOSED) + """
  SELECT tariff, period, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, round(residual, 6) AS residual FROM decomposed""")
def seasonal_decompose(spark, sf):
    return decomposed(spark, sf).select("tariff", "period", r6("trend").alias("trend"), r6("seasonal").alias("seasonal"), r6("residual").alias("residual"))


@query("decomposition_summary", with_ctes(DECOMPOSED) + """, m AS (SELECT *, CAST(substring(period, 6, 2) AS INTEGER) AS mon, round(seasonal, 9) AS s FROM decomposed)
  SELECT tariff, arg_min(mon, (-s, mon)) AS peak_month, round(max(seasonal), 6) AS peak, arg_min(mon, (s, mon)) AS trough_month,
         round(min(seasonal), 6) AS trough, round(max_by(trend, period) - min_by(trend, period), 6) AS trend_change FROM m GROUP BY 1""")
def decomposition_summary(spark, sf):
    out = se.decomposition_summary(decomposed(spark, sf), ["tariff"], F.substring("period", 6, 2).cast("int"), "period")
    return out.withColumns({c: r6(c) for c in ("peak", "trough", "trend_change")})


NAIVE = f"""{MONTHLY},
p AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY tariff) AS n, lag(m3, 12) OVER w AS seasonal_naive
      FROM monthly WINDOW w AS (PARTITION BY tariff ORDER BY period)),
l AS (SELECT tariff, max_by(m3, i) AS naive FROM p WHERE i <= n - 6 GROUP BY 1),
naive AS (SELECT tariff, period, m3, naive, seasonal_naive FROM p JOIN l USING (tariff) WHERE i > n - 6)"""


def naive(spark, sf):
    return se.naive_forecasts(monthly(spark, sf), ["tariff"], "period", "m3")


@query("naive_forecast", with_ctes(NAIVE) + "SELECT tariff, period, m3, naive FROM naive")
def naive_forecast(spark, sf):
    return naive(spark, sf).select("tariff", "period", "m3", "naive")


@query("seasonal_naive", with_ctes(NAIVE) + "SELECT tariff, period, m3, seasonal_naive FROM naive")
def seasonal_naive(spark, sf):
    return naive(spark, sf).select("tariff", "period", "m3", "seasonal_naive")


@query("forecast_scores", with_ctes(NAIVE) + " UNION ALL ".join(f"""
  SELECT '{m}' AS model, round(avg(abs(m3 - {m})), 6) AS mae, round(sqrt(avg(pow(m3 - {m}, 2))), 6) AS rmse,
         round(100 * avg(abs((m3 - {m}) / m3)), 6) AS mape_pct FROM naive""" for m in ("naive", "seasonal_naive")))
def forecast_scores(spark, sf):
    out = se.forecast_scores(naive(spark, sf), "m3", ["naive", "seasonal_naive"])
    return out.withColumns({c: r6(c) for c in ("mae", "rmse", "mape_pct")})


@query("holt_winters_additive")
def holt_winters_additive(spark, sf):
    return se.holt_winters_fitted(monthly(spark, sf), ["tariff"], "period", "m3")


@query("forecast_ranking")
def forecast_ranking(spark, sf):
    """All three forecasts of the last six months, the best mean error first."""
    table = se.forecast_table(monthly(spark, sf), ["tariff"], "period", "m3")
    models = ["naive", "seasonal_naive", "holt_winters"]
    scores = se.forecast_scores(table.where(F.col("holt_winters").isNotNull()), "m3", models)
    return scores.withColumn("place", F.row_number().over(Window.orderBy("mae", "model")))  # one row per model


@query("autocorrelation", with_ctes(HOURLY) + """,
  d AS (SELECT hour, volume - (SELECT avg(volume) FROM total_hourly) AS d, row_number() OVER (ORDER BY hour) AS i FROM total_hourly),
  s AS (SELECT sum(d * d) AS q, count(*) AS n FROM d)
  SELECT CAST(k AS INTEGER) AS lag, round(sum(x.d * y.d) / any_value(q), 6) AS acf, round(any_value(1.96 / sqrt(n)), 6) AS band
  FROM (SELECT unnest([1, 2, 3, 6, 12, 24, 48, 72, 168]) AS k) JOIN d x ON true JOIN d y ON y.i = x.i - k, s GROUP BY 1""")
def autocorrelation(spark, sf):
    out = se.autocorrelation(total_hourly(spark, sf), ["series"], "hour", "volume")
    return out.select("lag", r6("acf").alias("acf"), r6("band").alias("band"))


@query("change_point", with_ctes(HOURLY) + """,
  x AS (SELECT series, CAST(hour AS DATE) AS day, round(sum(volume), 6) AS v FROM hourly GROUP BY 1, 2),
  i AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY day) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM x),
  s AS (SELECT a.series, a.day, a.i AS k, a.n, count(*) FILTER (b.i < a.i) AS n1,
          avg(b.v) FILTER (b.i < a.i) AS m1, var_samp(b.v) FILTER (b.i < a.i) AS v1, avg(b.v) FILTER (b.i >= a.i) AS m2, var_samp(b.v) FILTER (b.i >= a.i) AS v2
        FROM i a JOIN i b ON a.series = b.series WHERE a.i >= 7 AND a.i < a.n - 7 GROUP BY ALL),
  e AS (SELECT *, round(v1 * (k - 1) + v2 * (n - k - 1), 6) AS sse FROM s)
  SELECT series, day AS at, k, sse, round(m1, 6) AS mean_before, round(m2, 6) AS mean_after, round(100 * (m2 / m1 - 1), 6) AS change_pct,
         round((m1 - m2) / sqrt(v1 / k + v2 / (n - k)), 6) AS t,
         round(pow(v1 / k + v2 / (n - k), 2) / (pow(v1 / k, 2) / (k - 1) + pow(v2 / (n - k), 2) / (n - k - 1)), 6) AS df
  FROM e QUALIFY row_number() OVER (PARTITION BY series ORDER BY sse, k) = 1""")
def change_point(spark, sf):
    days = se.resample_daily(hourly(spark, sf), "volume", ["series"])
    out = se.change_point(days, ["series"], "day", "volume", margin=7)
    return out.withColumns({c: r6(c) for c in ("mean_before", "mean_after", "change_pct", "t", "df")})


@query("export_long_series", with_ctes(HOURLY, MONTHLY) + """
  SELECT 'hourly' AS serie, hour AS ts, volume AS valor FROM total_hourly
  UNION ALL SELECT 'daily', CAST(day AS TIMESTAMP), volume FROM total_daily
  UNION ALL SELECT 'monthly ' || tariff, CAST(CAST(period || '-01' AS DATE) AS TIMESTAMP), m3 FROM monthly""")
def export_long_series(spark, sf):
    months = monthly(spark, sf)
    parts = [("hourly", total_hourly(spark, sf), F.col("hour"), F.col("volume")),
             ("daily", total_daily(spark, sf), F.col("day"), F.col("volume")),
             ("monthly", months, F.to_date(F.concat("period", F.lit("-01"))), F.col("m3"))]
    first = se.long_series(parts[:2])
    named = months.select(F.concat(F.lit("monthly "), "tariff").alias("serie"), parts[2][2].cast("timestamp_ntz").alias("ts"), F.col("m3").alias("valor"))
    return first.unionByName(named)


# ---------------------------------------------------------------- Fourier
SPECTRUM = f"""{HOURLY},
z AS (SELECT series, hour_index AS t, volume - avg(volume) OVER (PARTITION BY series) AS d, count(*) OVER (PARTITION BY series) AS n FROM hourly),
spectrum AS (
  SELECT *, re * re + im * im AS power FROM (
  SELECT series, CAST(k AS INTEGER) AS k, k / any_value(n) AS freq, any_value(n) AS n, sum(d * cos(2 * pi() * ((k * t) % n) / n)) AS re, -sum(d * sin(2 * pi() * ((k * t) % n) / n)) AS im
  FROM z JOIN (SELECT unnest(range(0, (SELECT max(n) FROM z) // 2 + 1)) AS k) ON true GROUP BY series, k)),
shares AS (SELECT *, 100 * power / sum(power) FILTER (k > 0) OVER (PARTITION BY series) AS pct FROM spectrum)"""


def spectrum(spark, sf):
    return sp.power_spectrum(hourly(spark, sf), "series", "hour", "volume")


@query("power_spectrum", with_ctes(SPECTRUM) + "SELECT series, k, round(freq, 9) AS freq, round(sqrt(power), 5) AS amplitude FROM spectrum WHERE k > 0")
def power_spectrum(spark, sf):
    return spectrum(spark, sf).where("k > 0").select("series", "k", r6("freq", 9).alias("freq"), r6(F.sqrt("power"), 5).alias("amplitude"))


def _peaks_sql(n: int) -> str:
    """The strongest bin, then the strongest more than two bins from all before it, and so on."""
    out = [SPECTRUM]
    for i in range(1, n + 1):
        apart = "".join(f" AND abs(s.k - (SELECT k FROM q{j} WHERE q{j}.series = s.series)) > 2" for j in range(1, i))
        out.append(f"q{i} AS (SELECT series, max_by(k, power) AS k FROM spectrum s WHERE k > 0{apart} GROUP BY 1)")
    out.append("peaks AS (" + " UNION ALL ".join(f"SELECT series, k, {i} AS peak FROM q{i}" for i in range(1, n + 1)) + ")")
    return with_ctes(*out)


@query("dominant_peaks", _peaks_sql(5) + """
  SELECT series, peak, round(freq, 5) AS cycles_per_hour, round(24 * freq, 3) AS cycles_per_day, round(1 / freq, 2) AS period_h, round(pct, 2) AS energy_pct
  FROM peaks JOIN shares USING (series, k)""")
def dominant_peaks(spark, sf):
    return sp.dominant_frequencies(spectrum(spark, sf), "series")


@query("harmonic_energy", with_ctes(SPECTRUM) + """
  SELECT series, round(coalesce(sum(pct) FILTER (abs(24 * freq - round(24 * freq)) < 1e-9 AND round(24 * freq) BETWEEN 1 AND 6), 0), 6) AS harmonic_pct
  FROM shares GROUP BY 1""")
def harmonic_energy(spark, sf):
    return sp.harmonic_energy(spectrum(spark, sf), "series").withColumn("harmonic_pct", r6("harmonic_pct"))


@query("spectrum_band", with_ctes(SPECTRUM) + """
  SELECT series, k, round(24 * freq, 9) AS cycles_per_day, round(pct, 6) AS energy_pct FROM shares WHERE 24 * freq BETWEEN 0.1 AND 6""")
def spectrum_band(spark, sf):
    return sp.spectrum_band(spectrum(spark, sf), "series").withColumns({"cycles_per_day": r6("cycles_per_day", 9), "energy_pct": r6("energy_pct")})


@query("reconstruct_top_k", _peaks_sql(6) + """,
  wave AS (SELECT h.series, h.hour, any_value(h.volume) AS volume, any_value(m.mean) AS mean, any_value(m.mean) + sum(CASE WHEN 2 * s.k = s.n THEN 1 ELSE 2 END
      * (re * cos(2 * pi() * ((s.k * h.hour_index) % s.n) / s.n) - im * sin(2 * pi() * ((s.k * h.hour_index) % s.n) / s.n)) / s.n) AS rebuilt
    FROM hourly h JOIN peaks USING (series) JOIN spectrum s ON s.series = h.series AND s.k = peaks.k
    JOIN (SELECT series, avg(volume) AS mean FROM hourly GROUP BY 1) m ON m.series = h.series GROUP BY 1, 2)
  SELECT series, hour, volume, round(rebuilt, 6) AS rebuilt, round(1 - sum(pow(volume - rebuilt, 2)) OVER (PARTITION BY series) / sum(pow(volume - mean, 2)) OVER (PARTITION BY series), 6) AS r2
  FROM wave""")
def reconstruct_top_k(spark, sf):
    rows = hourly(spark, sf)
    out = sp.reconstruct(rows, spectrum(spark, sf), "series", "hour", "volume")
    return out.withColumns({"rebuilt": r6("rebuilt"), "r2": r6("r2")})


# ---------------------------------------------------------------- wavelets
def _dwt_sql() -> str:
    """Five levels of the periodised db4 transform: a value reaches output (i - 4 + m) / 2 through tap m."""
    taps = ", ".join(f"({m}, {lo!r}::DOUBLE, {hi!r}::DOUBLE)" for m, (lo, hi) in enumerate(zip(map(float, wv.DB4_LOW), map(float, wv.DB4_HIGH))))
    out = [HOURLY, f"taps(m, lo, hi) AS (VALUES {taps})", "a0 AS (SELECT series, hour_index AS i, volume AS v FROM hourly)"]
    for level in range(1, wv.LEVELS + 1):
        x = f"a{level - 1}"
        out += [
            f"n{level} AS (SELECT max(i) + 1 + (max(i) + 1) % 2 AS n FROM {x})",
            f"p{level} AS (SELECT * FROM {x} UNION ALL SELECT series, i + 1, v FROM {x} WHERE i = (SELECT n - 2 FROM n{level}) AND (SELECT max(i) + 2 FROM {x}) = (SELECT n FROM n{level}))",
            f"""f{level} AS (SELECT series, ((i - 4 + m) % n + n) % n // 2 AS i, sum(lo * v) AS v, sum(hi * v) AS d FROM p{level}, taps, n{level}
  WHERE ((i - 4 + m) % n + n) % n % 2 = 0 GROUP BY 1, 2)""",
            f"a{level} AS (SELECT series, i, v FROM f{level})"]
    energies = [f"SELECT series, 'D{k}' AS part, sum(d * d) AS e FROM f{k} GROUP BY 1" for k in range(1, wv.LEVELS + 1)]
    energies.append(f"SELECT series, 'A{wv.LEVELS}', sum(v * v) FROM a{wv.LEVELS} GROUP BY 1")
    out.append(f"en AS ({' UNION ALL '.join(energies)})")
    parts = [f"A{wv.LEVELS}"] + [f"D{k}" for k in range(wv.LEVELS, 0, -1)]
    out.append("energy AS (SELECT series, " + ", ".join(f"sum(e) FILTER (part = '{q}') / sum(e) AS {q}" for q in parts) + " FROM en GROUP BY 1)")
    return with_ctes(*out)


PARTS = ["A5", "D5", "D4", "D3", "D2", "D1"]


@query("dwt_energy", _dwt_sql() + "SELECT series, " + ", ".join(f"round({q}, 9) AS {q}" for q in PARTS) + " FROM energy")
def dwt_energy(spark, sf):
    out = sp.dwt_energy(hourly(spark, sf), "series", "hour", "volume")
    return out.select("series", *[r6(q, 9).alias(q) for q in PARTS])


@query("dwt_reconstruct")
def dwt_reconstruct(spark, sf):
    rows = sp.dwt_reconstruct(hourly(spark, sf), "series", "hour", "volume")
    return rows.groupBy("series", F.to_date("hour").alias("day")).agg(
        F.avg("volume").alias("volume"), F.avg("approximation").alias("approximation"),
        F.max(F.abs(F.col("volume") - F.col("rebuilt"))).alias("max_error"))


@query("energy_by_group", _dwt_sql() + "SELECT l.leak, " + ", ".join(f"round(100 * avg({q}), 6) AS {q}" for q in PARTS) + """ FROM energy
  JOIN (SELECT series, bool_or(leak) AS leak FROM hourly GROUP BY 1) l USING (series) GROUP BY 1""")
def energy_by_group(spark, sf):
    rows = hourly(spark, sf)
    out = sp.energy_by_group(sp.dwt_energy(rows, "series", "hour", "volume"), rows, "series")
    return out.select("leak", *[r6(q).alias(q) for q in PARTS])


def _swt_sql() -> str:
    """Five levels of the stationary transform on the series filled up to a multiple of 32 hours, and its score."""
    taps = ", ".join(f"({m}, {lo!r}::DOUBLE, {hi!r}::DOUBLE)" for m, (lo, hi) in enumerate(zip(map(float, wv.DB4_LOW), map(float, wv.DB4_HIGH))))
    out = [HOURLY, f"taps(m, lo, hi) AS (VALUES {taps})", "ln AS (SELECT max(hour_index) + 1 AS n0, (max(hour_index) + 32) // 32 * 32 AS n FROM hourly)",
           """a0 AS (SELECT series, hour_index AS i, volume AS v FROM hourly
  UNION ALL SELECT series, n0 + j, volume FROM hourly, ln, range(0, 32) t(j) WHERE hour_index = n0 - 1 AND n0 + j < n)"""]
    for level in range(1, wv.LEVELS + 1):
        step = 2 ** (level - 1)
        out += [f"""f{level} AS (SELECT series, ((i - {4 * step} + m * {step}) % n + n) % n AS i, sum(lo * v) / sqrt(2) AS v, sum(hi * v) / sqrt(2) AS d
  FROM a{level - 1}, taps, ln GROUP BY 1, 2)""", f"a{level} AS (SELECT series, i, v FROM f{level})"]
    details = " UNION ALL ".join(f"SELECT series, i, d FROM f{k}" for k in range(1, wv.LEVELS + 1))
    out += [f"dt AS (SELECT series, i, sum(d * d) AS d2 FROM ({details}) GROUP BY 1, 2)",
            f"""rt AS (SELECT a.series, a.i, CASE WHEN count(*) OVER w = 72 THEN avg(a.v * a.v) OVER w / avg(d2) OVER w END AS r
  FROM a{wv.LEVELS} a JOIN dt USING (series, i), ln WHERE a.i < n0 WINDOW w AS (PARTITION BY a.series ORDER BY a.i ROWS BETWEEN 71 PRECEDING AND CURRENT ROW))""",
            "md AS (SELECT series, quantile_cont(r, 0.5) FILTER (i BETWEEN 72 AND 503) AS med FROM rt GROUP BY 1)"]
    return with_ctes(*out)


def swt_scored(spark, sf):
    return sp.swt_score(hourly(spark, sf), "series", "volume")


@query("swt_score", _swt_sql() + """
  SELECT h.series, h.hour, round(r / nullif(med, 0), 7) AS score FROM hourly h JOIN rt ON rt.series = h.series AND rt.i = h.hour_index JOIN md ON md.series = h.series""")
def swt_score(spark, sf):
    return swt_scored(spark, sf).select("series", "hour", r6("score", 7).alias("score"))


@query("signal_features", _dwt_sql() + "SELECT series, " + ", ".join(f"round({q}, 9) AS energia_{q}" for q in PARTS) + " FROM energy")
def signal_features(spark, sf):
    e = sp.dwt_energy(hourly(spark, sf), "series", "hour", "volume")
    return e.select("series", *[r6(q, 9).alias(f"energia_{q}") for q in PARTS])


# ---------------------------------------------------------------- leak detection
ALARM_HOURS = 6
NIGHT = f"""{HOURLY},
nd AS (SELECT series, CAST(hour AS DATE) AS day, avg(volume) AS night FROM hourly WHERE hour(hour) IN (2, 3, 4) GROUP BY 1, 2),
nn AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY day) AS no FROM nd),
nm AS (SELECT series, quantile_cont(night, 0.5) FILTER (no <= 21) AS med FROM nn GROUP BY 1),
sc AS (SELECT series, day + 1 AS day, night / nullif(med, 0) AS score FROM nn JOIN nm USING (series)),
scored AS (SELECT h.*, s.score FROM hourly h LEFT JOIN sc s ON s.series = h.series AND s.day = CAST(h.hour AS DATE)),
thr AS (SELECT quantile_cont(score, 0.995) AS threshold FROM scored WHERE hour_index < 504 AND score IS NOT NULL)"""


def _alarms(factors: str) -> str:
    return f"""{NIGHT},
fa AS (SELECT unnest({factors}) AS factor),
ab AS (SELECT s.*, factor, coalesce(score, 0) > threshold * factor AS above FROM scored s, thr, fa),
isl AS (SELECT *, sum(CAST(NOT above AS INTEGER)) OVER (PARTITION BY factor, series ORDER BY hour) AS grp FROM ab),
al AS (SELECT *, above AND sum(CAST(above AS INTEGER)) OVER (PARTITION BY factor, series, grp ORDER BY hour) >= {ALARM_HOURS} AND hour_index >= 504 AS alarm,
       min(hour) FILTER (leak) OVER (PARTITION BY factor, series) AS true_start FROM isl),
det AS (SELECT factor, series, any_value(true_start) AS true_start,
    min(hour) FILTER (alarm AND (true_start IS NULL OR hour >= true_start)) AS detected_at, max(score) FILTER (hour_index >= 504) AS max_score,
    count(*) FILTER (alarm AND leak AND hour_index >= 504) AS tp_hours, count(*) FILTER (alarm AND NOT (leak AND hour_index >= 504)) AS fp_hours,
    count(*) FILTER (NOT alarm AND leak AND hour_index >= 504) AS fn_hours FROM al GROUP BY 1, 2),
dd AS (SELECT *, true_start IS NOT NULL AS real, detected_at IS NOT NULL AS detected, date_diff('hour', true_start, detected_at) AS delay_h FROM det),
su AS (SELECT factor, count(*) FILTER (real AND detected) AS tp, count(*) FILTER (NOT real AND detected) AS fp, count(*) FILTER (real AND NOT detected) AS fn,
    quantile_cont(CAST(delay_h AS DOUBLE), 0.5) FILTER (real AND detected) AS median_delay_h, sum(tp_hours) AS tph, sum(fp_hours) AS fph, sum(fn_hours) AS fnh
  FROM dd GROUP BY 1),
pr AS (SELECT *, tp / nullif(tp + fp, 0) AS "precision", tp / nullif(tp + fn, 0) AS recall FROM su),
summary AS (SELECT factor, tp, fp, fn, median_delay_h, round("precision", 6) AS "precision", round(recall, 6) AS recall,
    round(CASE WHEN "precision" * recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0 END, 6) AS f1,
    round(tph / nullif(tph + fph, 0), 6) AS hour_precision, round(tph / nullif(tph + fnh, 0), 6) AS hour_recall FROM pr)"""


ROUNDED = ("precision", "recall", "f1", "hour_precision", "hour_recall")


def night_scored(spark, sf):
    return lk.night_flow_score(hourly(spark, sf), "series", "volume")


@query("night_flow_score", with_ctes(NIGHT) + "SELECT series, hour, round(score, 9) AS score FROM scored")
def night_flow_score(spark, sf):
    return night_scored(spark, sf).select("series", "hour", r6("score", 9).alias("score"))


@query("spread_previous_day", with_ctes(HOURLY) + """,
  d AS (SELECT series, CAST(hour AS DATE) AS day, round(sum(volume), 6) AS v FROM hourly GROUP BY 1, 2)
  SELECT h.series, h.hour, d.v AS previous_day FROM hourly h LEFT JOIN d ON d.series = h.series AND d.day = CAST(h.hour AS DATE) - 1""")
def spread_previous_day(spark, sf):
    rows = hourly(spark, sf)
    days = se.resample_daily(rows, "volume", ["series"]).select("series", F.date_add("day", 1).alias("day"), F.col("volume").alias("previous_day"))
    return rows.withColumn("day", F.to_date("hour")).join(days, ["series", "day"], "left").select("series", "hour", "previous_day")


@query("unsupervised_threshold", with_ctes(NIGHT) + """
  SELECT any_value(round(threshold, 9)) AS threshold, count(*) FILTER (score > threshold) AS hours_above FROM scored, thr""")
def unsupervised_threshold(spark, sf):
    scored = night_scored(spark, sf)
    limit = lk.unsupervised_threshold(scored)
    return scored.withColumn("_t", limit).agg(r6(F.max("_t"), 9).alias("threshold"), F.count_if(F.col("score") > F.col("_t")).alias("hours_above"))


@query("sustained_alarm", with_ctes(_alarms("[0.8::DOUBLE]")) + "SELECT series, hour, alarm FROM al")
def sustained_alarm(spark, sf):
    scored = night_scored(spark, sf)
    return lk.sustained_alarm(scored, "series", lk.unsupervised_threshold(scored) * 0.8, hours=ALARM_HOURS).select("series", "hour", "alarm")


@query("series_detection", with_ctes(_alarms("[0.8::DOUBLE]")) + """
  SELECT series, true_start, detected_at, round(max_score, 9) AS max_score, tp_hours, fp_hours, fn_hours, real, detected, delay_h FROM dd""")
def series_detection(spark, sf):
    return lk.detect(night_scored(spark, sf), "series", 0.8, ALARM_HOURS).withColumn("max_score", r6("max_score", 9))


@query("detection_eval", with_ctes(_alarms("[0.8::DOUBLE]")) + "SELECT * EXCLUDE (factor) FROM summary")
def detection_eval(spark, sf):
    out = lk.detection_summary(lk.detect(night_scored(spark, sf), "series", 0.8, ALARM_HOURS))
    return out.withColumns({c: r6(c) for c in ROUNDED})


@query("threshold_sensitivity", with_ctes(_alarms("[0.8::DOUBLE, 1.0::DOUBLE, 1.2::DOUBLE, 1.5::DOUBLE]")) + "SELECT * FROM summary")
def threshold_sensitivity(spark, sf):
    out = lk.threshold_sensitivity(night_scored(spark, sf), "series", hours=ALARM_HOURS)
    return out.withColumns({c: r6(c) for c in ROUNDED})


@query("method_comparison")
def method_comparison(spark, sf):
    methods = {"wavelet": swt_scored(spark, sf), "night flow": night_scored(spark, sf)}
    return lk.method_comparison(methods, "series", ALARM_HOURS)


@query("anomaly_table", with_ctes(_alarms("[0.8::DOUBLE]")) + """
  SELECT series, detected_at AS ts, 5 AS wavelet_level, round(max_score, 9) AS score, 'fuga_probable' AS kind, real AS real_leak, 'v1' AS version
  FROM dd WHERE detected""")
def anomaly_table(spark, sf):
    found = lk.detect(night_scored(spark, sf), "series", 0.8, ALARM_HOURS)
    return lk.anomaly_table(found, "series", 5).withColumn("score", r6("score", 9))


@query("alarms_vs_complaints", with_ctes(_alarms("[0.8::DOUBLE]"), COMPLAINTS) + """
  SELECT count(*) AS alarmed, count(*) FILTER (EXISTS (SELECT 1 FROM complaints c WHERE c.series = dd.series AND c.category IN ('fr', 'de')
    AND c.reported >= dd.detected_at - INTERVAL 7 DAY)) AS with_complaint FROM dd WHERE detected""")
def alarms_vs_complaints(spark, sf):
    from rivulet.operators.joins import range_join

    found = lk.detect(night_scored(spark, sf), "series", 0.8, ALARM_HOURS).where("detected")
    hits = range_join(found, b.complaints(spark, sf), key="series", start="detected_at", ts="reported", category="category", wanted=("fr", "de"))
    return hits.agg(F.count(F.lit(1)).alias("alarmed"), F.count_if("matched").alias("with_complaint"))


@query("example_series", with_ctes(HOURLY) + """
  SELECT series, count(*) AS leak_hours, min(hour) AS start FROM hourly WHERE leak GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def example_series(spark, sf):
    return lk.example_series(hourly(spark, sf), "series")
