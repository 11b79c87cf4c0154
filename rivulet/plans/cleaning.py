"""Queries of the cleaning, tariff and join operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.text import WHITE
from rivulet.operators import cleaning as cl
from rivulet.operators import joins as jn
from rivulet.operators import tariff as tf
from rivulet.plans import bindings as b
from rivulet.plans.bindings import BILLS, BILLS_RAW, COMPLAINTS, CONNECTIONS, LINE_BILLS, READINGS, READINGS_RAW, TARIFF
from rivulet.plans.registry import query, with_ctes

L, D, S, TS, I = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType(), T.IntegerType()
SCHEMAS = {
    "customer": T.StructType().add("c_custkey", L).add("c_name", S).add("c_nationkey", I).add("c_acctbal", D).add("c_mktsegment", S),
    "orders": T.StructType().add("o_orderkey", L).add("o_custkey", L).add("o_orderstatus", S).add("o_totalprice", D)
    .add("o_orderdate", TS).add("o_orderpriority", S),
    "events": T.StructType().add("event_id", L).add("ts", TS).add("user_id", L).add("event_type", S).add("value", D).add("props", S),
    "documents": T.StructType().add("doc_id", L).add("text", S).add("lang", S).add("source", S).add("n_chars", L),
    "lineitem": T.StructType().add("l_orderkey", L).add("l_partkey", L).add("l_suppkey", L).add("l_linenumber", I)
    .add("l_quantity", D).add("l_extendedprice", D).add("l_discount", D).add("l_tax", D).add("l_returnflag", S)
    .add("l_linestatus", S).add("l_shipdate", TS),
}


@query("load_tables", """
  SELECT 'customer' AS table_name, count(*) AS n, max(c_name) AS greatest FROM customer
  UNION ALL SELECT 'orders', count(*), CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) FROM orders
  UNION ALL SELECT 'events', count(*), CAST(max(CAST(ts AS DATE)) AS VARCHAR) FROM events
  UNION ALL SELECT 'documents', count(*), max(source) FROM documents
  UNION ALL SELECT 'lineitem', count(*), CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) FROM lineitem""")
def load_tables(spark, sf):
    tables = cl.load_tables(spark, sf, SCHEMAS)
    greatest = {"customer": F.max("c_name"), "orders": F.max(F.to_date("o_orderdate")).cast("string"),
                "events": F.max(F.to_date("ts")).cast("string"), "documents": F.max("source"),
                "lineitem": F.max(F.to_date("l_shipdate")).cast("string")}
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n"), greatest[name].alias("greatest")).select(
            F.lit(name).alias("table_name"), "n", "greatest")
        out = part if out is None else out.unionByName(part)
    return out


def _profile_sql(name: str, cols: list[str]) -> str:
    nulls = " + ".join(f"count(*) - count({c})" for c in cols)
    return f"SELECT '{name}' AS table_name, count(*) AS n_rows, {len(cols)} AS n_columns, {nulls} AS null_cells FROM {name}"


@query("profile_tables", with_ctes(READINGS_RAW) + " UNION ALL ".join(
    [_profile_sql(n, s.fieldNames()) for n, s in SCHEMAS.items()]
    + [_profile_sql("readings_raw", ["conn_id", "period_no", "read_on", "initial", "final", "m3", "silent", "part_id", "supplier_id"])]))
def profile_tables(spark, sf):
    return cl.profile_tables({**cl.load_tables(spark, sf, SCHEMAS), "readings_raw": b.readings_raw(spark, sf)})


@query("load_complaints", """
  SELECT lang AS category, count(*) AS n, sum(length(text))::BIGINT AS characters
  FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL GROUP BY 1""")
def load_complaints(spark, sf):
    df = cl.load_complaints(b.table(spark, sf, "documents"), "text", "lang", ["source"])
    return df.groupBy(F.col("lang").alias("category")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("characters"))


@query("load_tariff_table", with_ctes(TARIFF) + "SELECT * FROM tariff_table")
def load_tariff_table(spark, sf):
    return b.tariff_table(spark, sf)


@query("tariff_types", with_ctes(TARIFF) + "SELECT DISTINCT tariff FROM tariff_table WHERE quarter = '2026-T3'")
def tariff_types(spark, sf):
    return tf.tariff_types(b.tariff_table(spark, sf), "2026-T3")


NAMES = {"ECONOMY": "Económica", "MEDIUM": "Media"}


@query("tariff_documents", with_ctes(TARIFF) + """, named AS (
  SELECT *, CASE tariff WHEN 'ECONOMY' THEN 'Económica' WHEN 'MEDIUM' THEN 'Media' ELSE tariff END AS name,
         (row_number() OVER (PARTITION BY tariff ORDER BY m3) - 1) // 10 AS blk FROM tariff_table WHERE quarter = '2026-T3'),
blocks AS (
  SELECT tariff, name, blk, 'Tarifa ' || name || ' (' || tariff || '), periodo 2026-T3, importe de agua de ' || min(m3) || ' a ' || max(m3)
    || ' m³: ' || string_agg(m3 || ' m³ = $' || format('{:,.2f}', CAST(amount AS DOUBLE)), '; ' ORDER BY m3) || '.' AS para
  FROM named GROUP BY 1, 2, 3),
top AS (SELECT tariff, max(m3) AS m, format('{:,.2f}', CAST(max_by(amount, m3) AS DOUBLE)) AS a FROM named GROUP BY 1)
SELECT tariff, 'Tarifario 2026-T3: ' || name AS title,
  string_agg(para, chr(10) || chr(10) ORDER BY blk) || chr(10) || chr(10) || 'Si el consumo de la tarifa ' || name || ' supera ' || any_value(m)
   || ' m³ se cobra el importe de ' || any_value(m) || ' m³ ($' || any_value(a) || ').' AS text
FROM blocks JOIN top USING (tariff) GROUP BY tariff, name""")
def tariff_documents(spark, sf):
    return tf.tariff_documents(b.tariff_table(spark, sf), "2026-T3", NAMES)


# ---------------------------------------------------------------- cleaning
@query("dedupe_keep_latest", with_ctes(BILLS) + "SELECT conn_id, period, bill_id, issued, total FROM bills")
def dedupe_keep_latest(spark, sf):
    return b.bills(spark, sf).select("conn_id", "period", "bill_id", "issued", "total")


@query("flag_readings", with_ctes(READINGS) + """
  SELECT conn_id, period_no, read_on, null_reading, backward, inconsistent FROM readings""")
def flag_readings(spark, sf):
    return b.readings(spark, sf).select("conn_id", "period_no", "read_on", "null_reading", "backward", "inconsistent")


MAPPING = {"AUTOMOBILE": "comercial", "BUILDING": "publico_oficial", "FURNITURE": "domestico_medio",
           "HOUSEHOLD": "domestico_alto", "MACHINERY": "industrial"}


@query("map_values", """
  SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'comercial' WHEN 'BUILDING' THEN 'publico_oficial'
    WHEN 'FURNITURE' THEN 'domestico_medio' WHEN 'HOUSEHOLD' THEN 'domestico_alto' WHEN 'MACHINERY' THEN 'industrial' END AS tariff
  FROM customer""")
def map_values(spark, sf):
    return cl.map_values(b.table(spark, sf, "customer"), "c_mktsegment", MAPPING, "tariff").select("c_custkey", "tariff")


@query("tariff_quarter", with_ctes(BILLS_RAW) + """
  SELECT period, CASE WHEN period >= '1998-07' THEN '2026-T3' ELSE '2026-T2' END AS quarter, count(*) AS n FROM bills_raw GROUP BY 1, 2""")
def tariff_quarter(spark, sf):
    return b.bills_raw(spark, sf).groupBy("period", tf.tariff_quarter(F.col("period"), b.SWITCH).alias("quarter")).agg(
        F.count(F.lit(1)).alias("n"))


@query("round_half_up_int", """
  SELECT o_orderkey, CAST(floor(coalesce(o_totalprice / 10000, 0) + 0.5) AS INTEGER) AS m3 FROM orders""")
def round_half_up_int(spark, sf):
    return b.table(spark, sf, "orders").select("o_orderkey", tf.round_half_up_int(F.col("o_totalprice") / 10000).alias("m3"))


@query("water_amount", with_ctes(LINE_BILLS) + """
  SELECT tariff, quarter, billed_m3, water, count(*) AS n FROM priced GROUP BY ALL""")
def water_amount(spark, sf):
    bills = b.line_bills(spark, sf).withColumn("quarter", tf.tariff_quarter(F.col("period"), b.SWITCH))
    priced = tf.water_amount(bills, b.tariff_table(spark, sf), tariff="tariff", m3="m3", quarter="quarter")
    return priced.groupBy("tariff", "quarter", "billed_m3", "water").agg(F.count(F.lit(1)).alias("n"))


def _recomputed(spark, sf):
    return tf.recompute_bills(b.line_bills(spark, sf), b.tariff_table(spark, sf), period="period", tariff="tariff", m3="m3",
                              sewer="sewer", treatment="treatment", domestic=b.DOMESTIC, switch=b.SWITCH)


@query("bill_breakdown", with_ctes(LINE_BILLS) + """
  SELECT bill_id, line, tariff, m3, water, sewer_amount, treatment_amount, subtotal, vat, CAST(subtotal + vat AS DECIMAL(12,2)) AS total
  FROM broken_down""")
def bill_breakdown(spark, sf):
    return _recomputed(spark, sf).select("bill_id", "line", "tariff", "m3", "water", "sewer_amount", "treatment_amount",
                                         "subtotal", "vat", "total")


@query("recompute_bills", with_ctes(LINE_BILLS) + """
  SELECT tariff, quarter, count(*) AS bills, round(sum(old_total), 2) AS total_before,
         CAST(sum(CAST(subtotal + vat AS DECIMAL(12,2))) AS DOUBLE) AS total_after
  FROM broken_down GROUP BY 1, 2""")
def recompute_bills(spark, sf):
    return _recomputed(spark, sf).groupBy("tariff", "quarter").agg(
        F.count(F.lit(1)).alias("bills"), F.round(F.sum("old_total"), 2).alias("total_before"),
        F.sum("total").cast("double").alias("total_after"))


@query("censor_labels", with_ctes(BILLS) + """
  SELECT bill_id, late, trainable, overdue_unpaid, paid_without_date FROM censored""")
def censor_labels(spark, sf):
    return b.censored(spark, sf).select("bill_id", "late", "trainable", "overdue_unpaid", "paid_without_date")


@query("drop_hidden", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_hidden(spark, sf):
    return cl.drop_hidden(b.table(spark, sf, "customer"), ("c_name", "c_acctbal"))


@query("calendar_features", with_ctes(BILLS, CONNECTIONS) + """
  SELECT bill_id, CAST(period || '-01' AS DATE) AS period_date, CAST(year(CAST(period || '-01' AS DATE)) AS INTEGER) AS year,
         CAST(month(CAST(period || '-01' AS DATE)) AS INTEGER) AS month,
         round(date_diff('day', since, CAST(period || '-01' AS DATE)) / 30.44::DOUBLE, 1) AS tenure_months,
         CAST(CASE WHEN paid_on IS NOT NULL THEN greatest(date_diff('day', due, paid_on), 0) END AS INTEGER) AS days_late
  FROM bills JOIN connections USING (conn_id)""")
def calendar_features(spark, sf):
    df = b.bills(spark, sf).join(b.connections(spark, sf), "conn_id")
    return cl.calendar_features(df).select("bill_id", "period_date", "year", "month", "tenure_months", "days_late")


def analysis_table(spark, sf):
    """Bills with readings (1:1 by bill) and connections (m:1), calendar columns added."""
    reads = cl.dedupe_keep_latest(b.readings_raw(spark, sf).drop("period_no"), ["conn_id"], ["read_on"])
    reads = cl.flag_readings(reads, "initial", "final").select(
        F.col("conn_id").alias("bill_id"), "read_on", "initial", "final", "silent", "inconsistent")
    df = jn.join_one_to_one(b.censored(spark, sf), reads, ["bill_id"])
    return cl.calendar_features(jn.join_many_to_one(df, b.connections(spark, sf), ["conn_id"]))


ANALYSIS = f"""{BILLS}, {CONNECTIONS}, {READINGS_RAW},
reads AS (
  SELECT conn_id AS bill_id, read_on, initial, final, silent, final IS NULL OR coalesce(final < initial, false) AS inconsistent
  FROM readings_raw QUALIFY row_number() OVER (PARTITION BY conn_id
    ORDER BY read_on DESC, initial DESC, coalesce(final, -1e300) DESC, m3 DESC, silent DESC, part_id DESC, supplier_id DESC) = 1),
analysis AS (
  SELECT censored.*, reads.* EXCLUDE (bill_id), connections.* EXCLUDE (conn_id),
         CAST(month(CAST(period || '-01' AS DATE)) AS INTEGER) AS month,
         round(date_diff('day', since, CAST(period || '-01' AS DATE)) / 30.44::DOUBLE, 1) AS tenure_months,
         CAST(CASE WHEN paid_on IS NOT NULL THEN greatest(date_diff('day', due, paid_on), 0) END AS INTEGER) AS days_late
  FROM censored LEFT JOIN reads USING (bill_id) LEFT JOIN connections USING (conn_id))"""
ANALYSIS_COLUMNS = ["conn_id", "period", "bill_id", "late", "trainable", "total", "read_on", "initial", "final", "inconsistent",
                    "area", "tariff", "direct_debit", "since", "month", "tenure_months", "days_late"]


@query("build_analysis_table", with_ctes(ANALYSIS) + f"SELECT {', '.join(ANALYSIS_COLUMNS)} FROM analysis")
def build_analysis_table(spark, sf):
    return analysis_table(spark, sf).select(*ANALYSIS_COLUMNS).orderBy("conn_id", "period")


@query("quality_report", with_ctes(BILLS, READINGS, CONNECTIONS) + """
  SELECT * FROM (VALUES
    (0, 'readings: raw rows', (SELECT count(*) FROM readings_raw)),
    (1, 'readings: kept', (SELECT count(*) FROM readings)),
    (2, 'readings: null', (SELECT count(*) FROM readings WHERE null_reading)),
    (3, 'readings: backward', (SELECT count(*) FROM readings WHERE backward)),
    (4, 'bills: paid without date', (SELECT count(*) FROM censored WHERE paid_without_date)),
    (5, 'bills: overdue and unpaid', (SELECT count(*) FROM censored WHERE overdue_unpaid)),
    (6, 'bills: censored', (SELECT count(*) FROM censored WHERE NOT trainable)),
    (7, 'label: late among trainable', (SELECT count(*) FROM censored WHERE trainable AND late)),
    (8, 'complaints: rows', (SELECT count(*) FROM documents)),
    (9, 'complaints: distinct texts', (SELECT count(DISTINCT text) FROM documents))) v(step_order, step, result)""")
def quality_report(spark, sf):
    n = F.count(F.lit(1))
    yes = lambda c: F.count_if(c)
    return cl.quality_report([
        (b.readings_raw(spark, sf), [("readings: raw rows", n)]),
        (b.readings(spark, sf), [("readings: kept", n), ("readings: null", yes(F.col("null_reading"))),
                                 ("readings: backward", yes(F.col("backward")))]),
        (b.censored(spark, sf), [("bills: paid without date", yes(F.col("paid_without_date"))),
                                 ("bills: overdue and unpaid", yes(F.col("overdue_unpaid"))),
                                 ("bills: censored", yes(~F.col("trainable"))),
                                 ("label: late among trainable", yes(F.col("trainable") & F.col("late")))]),
        (b.table(spark, sf, "documents"), [("complaints: rows", n), ("complaints: distinct texts", F.countDistinct("text"))]),
    ])


@query("recent_periods", with_ctes(BILLS_RAW) + """
  SELECT bill_id, period, total FROM bills_raw WHERE period IN (SELECT DISTINCT period FROM bills_raw ORDER BY period DESC LIMIT 3)""")
def recent_periods(spark, sf):
    return cl.recent_periods(b.bills_raw(spark, sf), "period", 3).select("bill_id", "period", "total")


@query("training_filter", with_ctes(ANALYSIS) + """
  SELECT bill_id, tariff, month, late FROM analysis
  WHERE trainable AND tariff = 'HOUSEHOLD' AND month IN (4, 5, 6) AND late IN (true, false)""")
def training_filter(spark, sf):
    df = analysis_table(spark, sf)
    return df.where(F.col("trainable") & (F.col("tariff") == "HOUSEHOLD") & F.col("month").isin(4, 5, 6)
                    & F.col("late").isin(True, False)).select("bill_id", "tariff", "month", "late")


@query("drop_short_text", """
  SELECT doc_id, lang, length(text) AS n_characters FROM documents WHERE length(trim(text, '""" + WHITE + """')) >= 10""")
def drop_short_text(spark, sf):
    return cl.drop_short_text(b.table(spark, sf, "documents"), "text", 10).select(
        "doc_id", "lang", F.length("text").cast("bigint").alias("n_characters"))


@query("min_examples", "SELECT lang, count(*) AS n, count(*) >= 120 AS enough FROM documents GROUP BY 1")
def min_examples(spark, sf):
    return cl.min_examples(b.table(spark, sf, "documents"), "lang", 120)


# ---------------------------------------------------------------- joins
@query("join_many_to_one", with_ctes(BILLS_RAW, CONNECTIONS) + """
  SELECT bill_id, conn_id, area, tariff, sewer, treatment FROM bills_raw LEFT JOIN connections USING (conn_id)""")
def join_many_to_one(spark, sf):
    return jn.join_many_to_one(b.bills_raw(spark, sf).select("bill_id", "conn_id"), b.connections(spark, sf), ["conn_id"]).select(
        "bill_id", "conn_id", "area", "tariff", "sewer", "treatment")


@query("join_one_to_one", with_ctes(BILLS, READINGS) + """
  SELECT b.bill_id, 1 AS period_no, total, r.m3 AS reading_m3 FROM bills b
  LEFT JOIN readings r ON r.conn_id = b.bill_id AND r.period_no = 1""")
def join_one_to_one(spark, sf):
    left = b.bills(spark, sf).select("bill_id", F.lit(1).alias("period_no"), "total")
    right = b.readings(spark, sf).select(F.col("conn_id").alias("bill_id"), "period_no", F.col("m3").alias("reading_m3"))
    return jn.join_one_to_one(left, right, ["bill_id", "period_no"])


@query("lookup_broadcast", with_ctes(LINE_BILLS) + """
  SELECT b.tariff, b.quarter, count(*) AS lines, count(t.amount) AS found FROM line_bills b
  LEFT JOIN tariff_table t ON t.quarter = b.quarter AND t.tariff = b.tariff AND t.m3 = b.billed_m3 GROUP BY 1, 2""")
def lookup_broadcast(spark, sf):
    bills = b.line_bills(spark, sf).select("tariff", tf.tariff_quarter(F.col("period"), b.SWITCH).alias("quarter"),
                                           tf.round_half_up_int(F.col("m3")).alias("m3"))
    return jn.lookup_broadcast(bills, b.tariff_table(spark, sf), ["quarter", "tariff", "m3"]).groupBy("tariff", "quarter").agg(
        F.count(F.lit(1)).alias("lines"), F.count("amount").alias("found"))


@query("keep_matching", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def keep_matching(spark, sf):
    wanted = b.table(spark, sf, "labels").where("quality = 1").select("doc_id")
    return jn.keep_matching(b.table(spark, sf, "documents").select("doc_id", "lang"), wanted, ["doc_id"])


@query("drop_matching", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def drop_matching(spark, sf):
    return jn.drop_matching(b.table(spark, sf, "documents").select("doc_id", "lang"),
                            b.table(spark, sf, "labels").select("doc_id"), ["doc_id"])


@query("range_join", with_ctes(COMPLAINTS) + """,
  alarms AS (SELECT user_id AS conn, min(ts) AS start FROM events WHERE event_type = 'error' GROUP BY 1)
  SELECT conn, EXISTS (SELECT 1 FROM complaints c WHERE c.complaint_id % 150 = a.conn AND category IN ('fr', 'de')
    AND c.reported >= a.start - INTERVAL 7 DAY) AS matched FROM alarms a""")
def range_join(spark, sf):
    alarms = b.table(spark, sf, "events").where("event_type = 'error'").select(F.col("user_id").alias("conn"), F.col("ts").alias("start"))
    complaints = b.complaints(spark, sf).withColumn("conn", F.col("complaint_id") % 150)
    return jn.range_join(alarms, complaints, key="conn", start="start", ts="reported", category="category", wanted=("fr", "de"))
