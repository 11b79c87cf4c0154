"""The test tables seen as metered-service tables, for Spark and as SQL CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import spread

CUTOFF = "2001-01-01"
DOMESTIC = ("ECONOMY", "SMALL", "MEDIUM")
SWITCH = "1998-07"
QUARTERS = (("2026-T2", "1.00"), ("2026-T3", "1.05"))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents spread over the cores: text work is heavy and a small file is one task.

    A table of more scan tasks than cores is left as it lies.
    """
    return spread(table(spark, sf, "documents"), "doc_id")


def connections(spark, sf) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        k.alias("conn_id"), F.col("c_nationkey").alias("area"), F.col("c_mktsegment").alias("tariff"),
        (k % 5 == 0).alias("direct_debit"), (k % 2 == 0).alias("sewer"), (k % 3 == 0).alias("treatment"),
        F.date_add(F.lit("1990-01-01").cast("date"), (k % 1800).cast("int")).alias("since"),
    )


CONNECTIONS = """connections AS (
  SELECT c_custkey AS conn_id, c_nationkey AS area, c_mktsegment AS tariff, c_custkey % 5 = 0 AS direct_debit,
         c_custkey % 2 = 0 AS sewer, c_custkey % 3 = 0 AS treatment,
         DATE '1990-01-01' + CAST(c_custkey % 1800 AS INTEGER) AS since
  FROM customer)"""


def bills_raw(spark, sf) -> DataFrame:
    issued = F.to_date("o_orderdate")
    due = F.date_add(issued, 30)
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    paid_on = (
        F.when((status == "F") & (k % 17 != 0), F.date_sub(due, (k % 10).cast("int")))
        .when((status == "P") & (k % 17 != 0), F.date_add(due, (1 + k % 40).cast("int")))
    )
    return table(spark, sf, "orders").select(
        k.alias("bill_id"), F.col("o_custkey").alias("conn_id"), F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        issued.alias("issued"), due.alias("due"), status.isin("F", "P").alias("paid"), paid_on.alias("paid_on"),
        F.when(status == "F", F.lit(False)).when(status == "P", F.lit(True)).alias("late"),
        F.col("o_totalprice").alias("total"), F.round(F.col("o_totalprice") / 10000, 3).alias("m3"),
        F.col("o_orderpriority").alias("priority"),
    )


BILLS_RAW = """bills_raw AS (
  SELECT o_orderkey AS bill_id, o_custkey AS conn_id, strftime(o_orderdate, '%Y-%m') AS period,
         CAST(o_orderdate AS DATE) AS issued, CAST(o_orderdate AS DATE) + 30 AS due, o_orderstatus IN ('F','P') AS paid,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) + 30 - CAST(o_orderkey % 10 AS INTEGER)
              WHEN o_orderstatus = 'P' AND o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) + 31 + CAST(o_orderkey % 40 AS INTEGER)
         END AS paid_on,
         CASE o_orderstatus WHEN 'F' THEN false WHEN 'P' THEN true END AS late,
         o_totalprice AS total, round(o_totalprice / 10000, 3) AS m3, o_orderpriority AS priority
  FROM orders)"""

BILLS = f"""{BILLS_RAW},
bills AS (SELECT * FROM bills_raw
  QUALIFY row_number() OVER (PARTITION BY conn_id, period ORDER BY issued DESC, bill_id DESC) = 1),
censored AS (SELECT * REPLACE (CASE WHEN due <= DATE '{CUTOFF}' THEN coalesce(late, CASE WHEN NOT paid THEN true END) END AS late),
         due <= DATE '{CUTOFF}' AS trainable, late IS NULL AND due <= DATE '{CUTOFF}' AND NOT paid AS overdue_unpaid,
         paid AND paid_on IS NULL AS paid_without_date
  FROM bills)"""


def bills(spark, sf) -> DataFrame:
    """One bill per connection and period, so a connection's history is bounded by the calendar."""
    from rivulet.operators.cleaning import dedupe_keep_latest

    return dedupe_keep_latest(bills_raw(spark, sf), ["conn_id", "period"], ["issued", "bill_id"])


def censored(spark, sf) -> DataFrame:
    from rivulet.operators.cleaning import censor_labels

    return censor_labels(bills(spark, sf), CUTOFF)


def readings_raw(spark, sf) -> DataFrame:
    sign = F.when(F.col("l_discount") == 0.1, F.lit(-1.0)).otherwise(F.lit(1.0))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("conn_id"), F.col("l_linenumber").alias("period_no"), F.to_date("l_shipdate").alias("read_on"),
        F.col("l_extendedprice").alias("initial"),
        F.when(F.col("l_tax") != 0.0, F.col("l_extendedprice") + F.col("l_quantity") * sign).alias("final"),
        F.col("l_quantity").alias("m3"), (F.col("l_returnflag") == "R").alias("silent"),
        F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id"),
    )


READINGS_RAW = """readings_raw AS (
  SELECT l_orderkey AS conn_id, l_linenumber AS period_no, CAST(l_shipdate AS DATE) AS read_on, l_extendedprice AS initial,
         CASE WHEN l_tax <> 0.0 THEN l_extendedprice + l_quantity * CASE WHEN l_discount = 0.1 THEN -1.0 ELSE 1.0 END END AS final,
         l_quantity AS m3, l_returnflag = 'R' AS silent, l_partkey AS part_id, l_suppkey AS supplier_id
  FROM lineitem)"""

READINGS = f"""{READINGS_RAW},
readings AS (
  SELECT *, final IS NULL AS null_reading, coalesce(final < initial, false) AS backward,
         final IS NULL OR coalesce(final < initial, false) AS inconsistent
  FROM readings_raw
  QUALIFY row_number() OVER (PARTITION BY conn_id, period_no
    ORDER BY read_on DESC, initial DESC, coalesce(final, -1e300) DESC, m3 DESC, silent DESC, part_id DESC, supplier_id DESC) = 1)"""


def readings(spark, sf) -> DataFrame:
    from rivulet.operators.cleaning import dedupe_keep_latest, flag_readings

    return flag_readings(dedupe_keep_latest(readings_raw(spark, sf), ["conn_id", "period_no"], ["read_on"]), "initial", "final")


def tariff_table(spark, sf) -> DataFrame:
    """Amount per (quarter, tariff, whole m3), aggregated from the parts list: types x sizes x quarters rows."""
    base = table(spark, sf, "part").groupBy(F.col("p_type").alias("tariff"), F.col("p_size").alias("m3")).agg(
        F.min("p_retailprice").cast("decimal(12,2)").alias("base"))
    quarters = F.array(*[F.struct(F.lit(q).alias("quarter"), F.lit(f).cast("decimal(3,2)").alias("f")) for q, f in QUARTERS])
    return base.select("*", F.inline(quarters)).select(
        "quarter", "tariff", "m3", F.round(F.col("base") * F.col("f"), 2).cast("decimal(12,2)").alias("amount"))


TARIFF = """tariff_table AS (
  SELECT quarter, tariff, m3, CAST(round(base * f, 2) AS DECIMAL(12,2)) AS amount
  FROM (SELECT p_type AS tariff, p_size AS m3, CAST(min(p_retailprice) AS DECIMAL(12,2)) AS base FROM part GROUP BY 1, 2),
       (VALUES ('2026-T2', CAST(1.00 AS DECIMAL(3,2))), ('2026-T3', CAST(1.05 AS DECIMAL(3,2)))) q(quarter, f))"""


def line_bills(spark, sf) -> DataFrame:
    """Line items as bills to price: tariff from the part, consumption from the quantity."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("tariff"))
    return table(spark, sf, "lineitem").join(part, "l_partkey").select(
        F.col("l_orderkey").alias("bill_id"), F.col("l_linenumber").alias("line"), "tariff",
        F.date_format("l_shipdate", "yyyy-MM").alias("period"), F.col("l_quantity").alias("m3"),
        (F.col("l_returnflag") == "R").alias("sewer"), (F.col("l_linestatus") == "O").alias("treatment"),
        F.col("l_extendedprice").alias("old_total"))


LINE_BILLS = f"""{TARIFF},
line_bills AS (
  SELECT l_orderkey AS bill_id, l_linenumber AS line, p_type AS tariff, strftime(l_shipdate, '%Y-%m') AS period, l_quantity AS m3,
         l_returnflag = 'R' AS sewer, l_linestatus = 'O' AS treatment, l_extendedprice AS old_total,
         CASE WHEN strftime(l_shipdate, '%Y-%m') >= '{SWITCH}' THEN '2026-T3' ELSE '2026-T2' END AS quarter,
         CAST(floor(l_quantity + 0.5) AS INTEGER) AS billed_m3
  FROM lineitem JOIN part ON l_partkey = p_partkey),
priced AS (
  SELECT b.*, coalesce(t.amount, m.amount) AS water
  FROM line_bills b LEFT JOIN tariff_table t ON t.quarter = b.quarter AND t.tariff = b.tariff AND t.m3 = b.billed_m3
  LEFT JOIN (SELECT quarter, tariff, max_by(amount, m3) AS amount FROM tariff_table GROUP BY 1, 2) m
    ON m.quarter = b.quarter AND m.tariff = b.tariff),
parts AS (
  SELECT *, CASE WHEN sewer THEN water * CAST(0.10 AS DECIMAL(3,2)) ELSE CAST(0 AS DECIMAL(15,4)) END AS s,
         CASE WHEN treatment THEN water * CAST(0.12 AS DECIMAL(3,2)) ELSE CAST(0 AS DECIMAL(15,4)) END AS t FROM priced),
charged AS (
  SELECT *, CAST(round(s, 2) AS DECIMAL(12,2)) AS sewer_amount, CAST(round(t, 2) AS DECIMAL(12,2)) AS treatment_amount,
         CAST(round(water + s + t, 2) AS DECIMAL(12,2)) AS subtotal FROM parts),
broken_down AS (
  SELECT *, CASE WHEN tariff IN {DOMESTIC} THEN CAST(0 AS DECIMAL(12,2))
                 ELSE CAST(round(subtotal * CAST(0.16 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) END AS vat FROM charged)"""


def telemetry(spark, sf) -> DataFrame:
    """Raw pulses: metering zone, time, volume and the validation label."""
    return table(spark, sf, "events").select(
        (F.col("user_id") % 8).alias("series"), F.col("ts"), F.col("value").alias("volume"),
        ((F.col("event_type") == "error") & (F.col("user_id") % 8 < 3)
         & (F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz"))).alias("leak"))


TELEMETRY = """telemetry AS (
  SELECT user_id % 8 AS series, ts, value AS volume,
         event_type = 'error' AND user_id % 8 < 3 AND ts >= TIMESTAMP '2024-01-24' AS leak FROM events)"""


def complaints(spark, sf) -> DataFrame:
    k = F.col("doc_id")
    return table(spark, sf, "documents").select(
        k.alias("complaint_id"), "text", F.col("lang").alias("category"), F.col("source").alias("channel"),
        (k % 8).alias("series"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(doc_id % 30 as int))").alias("reported"))


COMPLAINTS = """complaints AS (
  SELECT doc_id AS complaint_id, text, lang AS category, source AS channel, doc_id % 8 AS series,
         TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 30 AS INTEGER)) AS reported FROM documents)"""
