"""Queries of the aggregate, window, top-k and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import aggregates as ag
from rivulet.operators import joins as jn
from rivulet.operators import ranks as rk
from rivulet.operators import windows as wn
from rivulet.plans import bindings as b
from rivulet.plans.bindings import BILLS, BILLS_RAW, CONNECTIONS, READINGS
from rivulet.plans.cleaning import ANALYSIS, analysis_table
from rivulet.plans.registry import query, with_ctes


def r6(c, d=6):
    return F.round(c, d)


def events(spark, sf):
    return b.table(spark, sf, "events")


@query("data_summary", with_ctes(BILLS_RAW) + """
  SELECT 'bills' AS table_name, count(*) AS n_rows, min(period) AS first, max(period) AS last, count(DISTINCT conn_id) AS distinct_ids
  FROM bills_raw
  UNION ALL SELECT 'documents', count(*), min(lang), max(lang), count(DISTINCT text) FROM documents""")
def data_summary(spark, sf):
    def row(df, name, span, ids):
        return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(span).alias("first"), F.max(span).alias("last"),
                      F.countDistinct(ids).alias("distinct_ids")).select(F.lit(name).alias("table_name"), "*")
    return row(b.bills_raw(spark, sf), "bills", "period", "conn_id").unionByName(
        row(b.table(spark, sf, "documents"), "documents", "lang", "text"))


@query("box_stats", """
  WITH q AS (SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                    quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
  f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
  w AS (SELECT event_type, min(value) AS mn, max(value) AS mx FROM events JOIN f USING (event_type) WHERE value BETWEEN lo AND hi GROUP BY 1),
  o AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i,
               count(*) OVER (PARTITION BY event_type) AS m FROM events JOIN f USING (event_type) WHERE value < lo OR value > hi),
  s AS (SELECT event_type, list(value ORDER BY value) AS outliers FROM (
          SELECT event_type, value FROM o WHERE m <= 50
          UNION ALL
          SELECT event_type, value FROM o, range(50) t(k)
          WHERE m > 50 AND i = CASE WHEN k = 49 THEN m - 1 ELSE CAST(floor(k * ((m - 1) / 49.0::DOUBLE)) AS BIGINT) END) GROUP BY 1)
  SELECT event_type, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, mn AS min, mx AS max,
         coalesce(outliers, []) AS outliers
  FROM f LEFT JOIN w USING (event_type) LEFT JOIN s USING (event_type)""")
def box_stats(spark, sf):
    out = ag.box_stats(events(spark, sf), "value", "event_type")
    return out.select("event_type", "n", r6("q1").alias("q1"), r6("median").alias("median"), r6("q3").alias("q3"), "min", "max", "outliers")


@query("outlier_fence_3iqr", """
  WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
  SELECT event_type, round(any_value(q3 + 3 * (q3 - q1)), 6) AS fence, count(*) FILTER (value > q3 + 3 * (q3 - q1)) AS outliers
  FROM events JOIN q USING (event_type) GROUP BY 1""")
def outlier_fence_3iqr(spark, sf):
    return ag.outlier_fence(events(spark, sf), "value", "event_type").withColumn("fence", r6("fence"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("monthly_mean_pivot", with_ctes(BILLS_RAW) + "SELECT period, " + ", ".join(
    f"round(avg(m3) FILTER (priority = '{p}'), 6) AS p{p[0]}" for p in PRIORITIES) + " FROM bills_raw GROUP BY 1")
def monthly_mean_pivot(spark, sf):
    out = ag.monthly_mean_pivot(b.bills_raw(spark, sf), "period", "priority", F.col("m3"), PRIORITIES)
    return out.select("period", *[r6(F.col(f"`{p}`")).alias(f"p{p[0]}") for p in PRIORITIES])


@query("histogram", """
  WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
  c AS (SELECT CAST(least(floor((o_totalprice - lo) / (hi - lo) * 20) + 1, 20) AS INTEGER) AS bin, count(*) AS n FROM orders, e GROUP BY 1)
  SELECT CAST(k + 1 AS INTEGER) AS bin, round(lo + k * ((hi - lo) / 20), 6) AS left_edge, round(lo + (k + 1) * ((hi - lo) / 20), 6) AS right_edge,
         coalesce(n, 0) AS n
  FROM range(20) t(k) CROSS JOIN e LEFT JOIN c ON bin = k + 1""")
def histogram(spark, sf):
    out = ag.histogram(b.table(spark, sf, "orders"), "o_totalprice", 20)
    return out.withColumns({"left_edge": r6("left_edge"), "right_edge": r6("right_edge")})


@query("median_and_p90", """
  SELECT count(*) AS n, round(quantile_cont(o_totalprice, 0.5), 6) AS median, round(quantile_cont(o_totalprice, 0.9), 6) AS p90 FROM orders""")
def median_and_p90(spark, sf):
    out = rk.exact_quantiles(b.table(spark, sf, "orders"), "o_totalprice", {"median": 0.5, "p90": 0.9})
    return out.select("n", r6("median").alias("median"), r6("p90").alias("p90"))


@query("late_rate_by_segments", with_ctes(BILLS, CONNECTIONS) + """,
  h AS (SELECT *, last_value(CAST(late AS INTEGER) IGNORE NULLS) OVER (PARTITION BY conn_id ORDER BY period
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM censored),
  j AS (SELECT CAST(late AS INTEGER) AS y, tariff, CAST(direct_debit AS VARCHAR) AS direct_debit, CAST(area AS VARCHAR) AS area,
               CASE previous WHEN 1 THEN 'late' WHEN 0 THEN 'on time' ELSE 'none' END AS previous
        FROM h JOIN connections USING (conn_id) WHERE trainable)
  SELECT 'tariff' AS variable, tariff AS value, round(avg(y), 6) AS rate, count(*) AS n FROM j GROUP BY tariff
  UNION ALL SELECT 'direct_debit', direct_debit, round(avg(y), 6), count(*) FROM j GROUP BY direct_debit
  UNION ALL SELECT 'area', area, round(avg(y), 6), count(*) FROM j GROUP BY area
  UNION ALL SELECT 'previous', previous, round(avg(y), 6), count(*) FROM j GROUP BY previous""")
def late_rate_by_segments(spark, sf):
    history = wn.payment_history(b.censored(spark, sf))
    previous = F.when(F.col("previous_label") == 1, "late").when(F.col("previous_label") == 0, "on time").otherwise("none")
    rows = history.where("trainable").withColumn("previous", previous).join(b.connections(spark, sf), "conn_id")
    return ag.rate_by_segments(rows, "late", ["tariff", "direct_debit", "area", "previous"]).withColumn("rate", r6("rate"))


@query("portfolio_by_period", with_ctes(BILLS) + """,
  p AS (SELECT period, sum(total) AS billed, sum(CASE WHEN late THEN total ELSE 0 END) AS late_amount FROM censored WHERE trainable GROUP BY 1)
  SELECT period, round(billed, 2) AS billed, round(late_amount, 2) AS late_amount,
         round(sum(late_amount) OVER () / sum(billed) OVER (), 6) AS share FROM p""")
def portfolio_by_period(spark, sf):
    out = ag.portfolio_by_period(b.censored(spark, sf).where("trainable"), "period", "total", "late")
    return out.select("period", r6("billed", 2).alias("billed"), r6("late_amount", 2).alias("late_amount"), r6("share").alias("share"))


@query("value_counts", """
  WITH c AS (SELECT 'lang' AS variable, lang AS value, count(*) AS n FROM documents GROUP BY lang
             UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source),
  p AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n DESC, value) AS pl FROM c)
  SELECT variable, value, n, CAST(pl AS INTEGER) AS place, round(n / sum(n) OVER (PARTITION BY variable), 6) AS share,
         round(sum(n) FILTER (pl <= 3) OVER (PARTITION BY variable) / sum(n) OVER (PARTITION BY variable), 6) AS top_share FROM p""")
def value_counts(spark, sf):
    return ag.value_shares(b.table(spark, sf, "documents"), ["lang", "source"]).withColumns({"share": r6("share"), "top_share": r6("top_share")})


@query("reading_quality", with_ctes(READINGS) + """
  SELECT count(*) FILTER (null_reading) AS null_readings, count(*) FILTER (backward) AS backward, count(*) FILTER (silent) AS silent,
         round(avg(CAST(inconsistent AS INTEGER)) * 100, 2) AS pct_inconsistent FROM readings""")
def reading_quality(spark, sf):
    return ag.reading_quality(b.readings(spark, sf))


@query("unique_texts", """
  SELECT md5(text) AS text_md5, min(lang) AS lang, count(*) AS occurrences FROM documents GROUP BY text""")
def unique_texts(spark, sf):
    """The first language of every text, as texts may come in several: shared junk or short lines."""
    return ag.unique_texts(b.table(spark, sf, "documents"), "text", "lang", one_category=False).select(F.md5("text").alias("text_md5"), "lang", "occurrences")


@query("ambiguous_labels", """
  SELECT count(*) AS texts, count(*) FILTER (n > 1) AS ambiguous FROM (SELECT text, count(DISTINCT source) AS n FROM documents GROUP BY 1)""")
def ambiguous_labels(spark, sf):
    return ag.ambiguous_labels(b.table(spark, sf, "documents"), "text", "source")


PROFILE = f"""{ANALYSIS},
raw_profile AS (
  SELECT conn_id, avg(m3) AS mean_m3, stddev_samp(m3) / nullif(avg(m3), 0) AS cv_m3,
         avg(m3) FILTER (month IN (4, 5, 6)) / nullif(avg(m3), 0) AS seasonality, avg(CAST(late AS INTEGER)) AS late_rate,
         avg(CAST(direct_debit AS INTEGER)) AS direct_debit, avg(CAST(inconsistent AS INTEGER)) AS pct_inconsistent,
         max(tenure_months) AS tenure_months, min_by(tariff, period) AS tariff
  FROM analysis WHERE trainable GROUP BY 1),
profile AS (
  SELECT conn_id, tariff, """ + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM raw_profile)) AS {c}" for c in (
    "mean_m3", "cv_m3", "seasonality", "late_rate", "direct_debit", "pct_inconsistent", "tenure_months")) + " FROM raw_profile)"
PROFILE_COLUMNS = ["mean_m3", "cv_m3", "seasonality", "late_rate", "direct_debit", "pct_inconsistent", "tenure_months"]


@query("per_customer_profile", with_ctes(PROFILE) + "SELECT conn_id, tariff, " + ", ".join(
    f"round({c}, 7) AS {c}" for c in PROFILE_COLUMNS) + " FROM profile")
def per_customer_profile(spark, sf):
    return ag.per_customer_profile(analysis_table(spark, sf)).select("conn_id", "tariff", *[r6(c, 7).alias(c) for c in PROFILE_COLUMNS])


def customer_means(spark, sf):
    return analysis_table(spark, sf).where("trainable").groupBy("conn_id").agg(
        r6(F.avg("m3"), 7).alias("mean_m3"), r6(F.avg("days_late")).alias("mean_days_late"), F.max("tenure_months").alias("tenure_months"),
        r6(F.avg(F.col("inconsistent").cast("int"))).alias("pct_inconsistent"), r6(F.avg(F.col("late").cast("int"))).alias("late_rate"))


CUSTOMER_MEANS = f"""{ANALYSIS},
customer_means AS (
  SELECT conn_id, round(avg(m3), 7) AS mean_m3, round(avg(days_late), 6) AS mean_days_late, max(tenure_months) AS tenure_months,
         round(avg(CAST(inconsistent AS INTEGER)), 6) AS pct_inconsistent, round(avg(CAST(late AS INTEGER)), 6) AS late_rate
  FROM analysis WHERE trainable GROUP BY 1)"""


@query("customer_means_for_corr", with_ctes(CUSTOMER_MEANS) + "SELECT * FROM customer_means")
def customer_means_for_corr(spark, sf):
    return customer_means(spark, sf)


@query("crosstab", with_ctes(BILLS, CONNECTIONS) + """
  SELECT direct_debit, count(*) FILTER (NOT late) AS on_time, count(*) FILTER (late) AS late
  FROM censored JOIN connections USING (conn_id) WHERE trainable GROUP BY 1""")
def crosstab(spark, sf):
    rows = b.censored(spark, sf).where("trainable").join(b.connections(spark, sf), "conn_id")
    out = ag.crosstab(rows, "direct_debit", "late", [False, True])
    return out.select("direct_debit", F.col("`false`").alias("on_time"), F.col("`true`").alias("late"))


@query("category_rows_vs_unique_texts", """
  SELECT lang, count(*) AS n_rows, count(DISTINCT text) AS n_texts FROM documents GROUP BY 1""")
def category_rows_vs_unique_texts(spark, sf):
    return ag.category_texts(b.table(spark, sf, "documents"), "lang", "text")


@query("arg_extreme", with_ctes(BILLS_RAW) + """, m AS (SELECT period, round(avg(m3), 7) AS v FROM bills_raw GROUP BY 1)
  SELECT (SELECT period FROM m ORDER BY v DESC, period LIMIT 1) AS highest, max(v) AS highest_value,
         (SELECT period FROM m ORDER BY v, period LIMIT 1) AS lowest, min(v) AS lowest_value FROM m""")
def arg_extreme(spark, sf):
    months = b.bills_raw(spark, sf).groupBy("period").agg(r6(F.avg("m3"), 7).alias("v"))
    return ag.arg_extreme(months, "period", "v")


# ---------------------------------------------------------------- windows
@query("payment_history", with_ctes(BILLS) + """
  SELECT bill_id, last_value(CAST(late AS INTEGER) IGNORE NULLS) OVER past::DOUBLE AS previous_label,
         round(avg(CAST(late AS INTEGER)) OVER past, 6) AS late_rate_so_far,
         CAST(sum(CAST(late AS INTEGER)) OVER six AS DOUBLE) AS late_last_6, count(late) OVER past AS bills_with_history,
         round(m3 / CASE WHEN avg(m3) OVER six > 0 THEN avg(m3) OVER six END, 6) AS m3_vs_avg6
  FROM censored
  WINDOW past AS (PARTITION BY conn_id ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         six AS (PARTITION BY conn_id ORDER BY period ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)""")
def payment_history(spark, sf):
    out = wn.payment_history(b.censored(spark, sf))
    return out.select("bill_id", "previous_label", r6("late_rate_so_far").alias("late_rate_so_far"), "late_last_6",
                      "bills_with_history", r6("m3_vs_avg6").alias("m3_vs_avg6"))


@query("average_ranks", """
  SELECT o_totalprice AS total, count(*) AS n, avg(rn) AS rank FROM (SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice) AS rn FROM orders)
  GROUP BY 1""")
def average_ranks(spark, sf):
    return rk.average_ranks(b.table(spark, sf, "orders").withColumnRenamed("o_totalprice", "total"), "total").select("total", "n", "rank")


@query("last_n", with_ctes(BILLS) + """
  SELECT conn_id, period, total, CAST(rn AS INTEGER) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY conn_id ORDER BY period DESC) AS rn FROM bills) WHERE rn <= 6""")
def last_n(spark, sf):
    return wn.top_n(b.bills(spark, sf).select("conn_id", "period", "total"), ["conn_id"], [F.col("period").desc()], 6)


@query("sort_output", with_ctes(BILLS) + "SELECT conn_id, period, total FROM bills")
def sort_output(spark, sf):
    return ag.sort_output(b.bills(spark, sf).select("conn_id", "period", "total"), ["conn_id", "period"])


# ---------------------------------------------------------------- sets
@query("stack", """
  SELECT 'customer' AS origin, c_custkey AS id, c_nationkey AS nation FROM customer
  UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier""")
def stack(spark, sf):
    c = b.table(spark, sf, "customer").select(F.lit("customer").alias("origin"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    s = b.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"), F.lit("supplier").alias("origin"))
    return c.unionByName(s)


@query("assert_disjoint", """
  SELECT count(DISTINCT doc_id) AS shared, count(*) = 0 AS disjoint FROM documents d
  WHERE md5(text) < '4' AND text IN (SELECT text FROM documents WHERE md5(text) >= '4')""")
def assert_disjoint(spark, sf):
    docs = b.table(spark, sf, "documents")
    test = F.md5("text") < "4"
    return jn.disjoint(docs.where(test), docs.where(~test), ["text"])
