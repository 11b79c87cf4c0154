"""Queries of the sinks: payloads, upserts, views, writers and constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators import publish as pb
from rivulet.plans import bindings as b
from rivulet.plans.bindings import BILLS_RAW
from rivulet.plans.evaluation import AGENT_LOG, agent_log
from rivulet.plans.registry import ORACLES, query, with_ctes
from rivulet.plans.summaries import r6
from rivulet.session import shared_folder
from rivulet.sources.readers import read_csv_tables as read_tables
from rivulet.sources.stored import StoredTable

MODULE_LIST = list(pb.MODULES)


def payload_rows(spark, sf):
    """One line chart per order priority: billed total per period (one value per month)."""
    months = b.bills_raw(spark, sf).groupBy("priority", "period").agg(F.round(F.sum("total"), 2).alias("v"))
    rows = months.groupBy("priority").agg(F.array_sort(F.collect_list(F.struct("period", "v"))).alias("_p"))
    return rows.select("priority", F.transform("_p", lambda r: r["period"]).alias("periods"), F.transform("_p", lambda r: r["v"]).alias("values"))


def published(spark, sf):
    rows = pb.clean_numbers(payload_rows(spark, sf))
    payload = F.struct(
        F.lit("linea").alias("tipo"), F.concat(F.lit("Facturado "), "priority").alias("titulo"), F.lit("suma por periodo").alias("conclusion"),
        F.lit("orders").alias("fuente"), F.struct(F.col("periods").alias("valores")).alias("x"),
        F.array(F.struct(F.col("priority").alias("nombre"), F.col("values").alias("valores"))).alias("series"))
    return pb.publish_results(rows, "eda", F.concat(F.lit("facturado_"), "priority"), payload)


PAYLOADS = f"""{BILLS_RAW},
pm AS (SELECT priority, period, CAST(format('{{:.6g}}', round(sum(total), 2)) AS DOUBLE) AS v FROM bills_raw GROUP BY 1, 2)"""


@query("publish_results", with_ctes(PAYLOADS) + """
  SELECT 'eda' AS modulo, 'facturado_' || priority AS clave, 'v1' AS version, 'linea' AS tipo, CAST(count(*) AS INTEGER) AS n, round(sum(v), 2) AS total,
         min(period) AS first FROM pm GROUP BY priority""")
def publish_results(spark, sf):
    shape = "tipo string, x struct<valores: array<string>>, series array<struct<nombre: string, valores: array<double>>>"
    rows = published(spark, sf).withColumn("p", F.from_json("payload", shape))
    return rows.select("modulo", "clave", "version", "p.tipo", F.size("p.x.valores").alias("n"),
                       r6(F.aggregate(F.col("p.series")[0]["valores"], F.lit(0.0), lambda s, x: s + x), 2).alias("total"),
                       F.col("p.x.valores")[0].alias("first"))


@query("validate_payload", with_ctes(BILLS_RAW) + """, k AS (SELECT DISTINCT conn_id FROM bills_raw)
  SELECT conn_id, reason IS NULL AS ok, reason FROM (SELECT conn_id, CASE conn_id % 11 WHEN 0 THEN 'tipo desconocido' WHEN 1 THEN 'falta «fuente»'
    WHEN 2 THEN 'x y valores de distinto largo' WHEN 3 THEN 'valores no numéricos' WHEN 4 THEN 'la tabla no trae «filas»'
    WHEN 5 THEN 'cada fila necesita «indicador» y «valor»' WHEN 6 THEN 'sin cuartiles ni valores' WHEN 7 THEN 'el payload no es un objeto' END AS reason FROM k)""")
def validate_payload(spark, sf):
    """Payload texts built from the bills of every connection, each kind broken in its own way."""
    totals = b.bills_raw(spark, sf).groupBy("conn_id").agg(F.round(F.max("total"), 2).alias("v"))
    v, base = F.col("v").cast("string"), '"titulo": "t", "conclusion": "c", "fuente": "f"'
    texts = [
        F.lit('{"tipo": "mapa", ' + base + "}"), F.lit('{"tipo": "texto", "titulo": "t", "conclusion": "c"}'),
        F.concat(F.lit('{"tipo": "linea", ' + base + ', "x": {"valores": ["a", "b"]}, "series": [{"nombre": "s", "valores": ['), v, F.lit("]}]}")),
        F.concat(F.lit('{"tipo": "barras", ' + base + ', "x": {"valores": ["a"]}, "series": [{"nombre": "s", "valores": ["'), v, F.lit('"]}]}')),
        F.lit('{"tipo": "tabla", ' + base + ', "filas": []}'), F.lit('{"tipo": "metrica", ' + base + ', "filas": [{"indicador": "n"}]}'),
        F.lit('{"tipo": "caja", ' + base + ', "series": [{"nombre": "s", "min": 1}]}'), F.lit("[1, 2]"),
        F.concat(F.lit('{"tipo": "dispersion", ' + base + ', "series": [{"nombre": "s", "x": [1, 2], "valores": [1, '), v, F.lit("]}]}")),
        F.concat(F.lit('{"tipo": "histograma", ' + base + ', "x": {"valores": [1, 2]}, "series": [{"nombre": "s", "valores": [null, '), v, F.lit("]}]}")),
        F.concat(F.lit('{"tipo": "metrica", ' + base + ', "valor": '), v, F.lit("}")),
    ]
    rows = totals.withColumn("payload", F.array(*texts)[(F.col("conn_id") % len(texts)).cast("int")])
    return pb.validate_payload(rows, "payload").select("conn_id", "ok", "reason")


def _versions(spark, sf):
    """Published rows of several versions per key, from the bills."""
    k = F.col("bill_id")
    modules = F.array(*[F.lit(m) for m in MODULE_LIST])
    return b.bills_raw(spark, sf).select(
        modules[(k % len(MODULE_LIST)).cast("int")].alias("modulo"), (F.col("conn_id") % 97).cast("string").alias("clave"),
        F.concat(F.lit("v"), (k % 3).cast("string")).alias("version"), F.concat(F.lit("p"), k.cast("string")).alias("payload"),
        F.col("issued").alias("creado_en"))


VERSIONS = f"""{BILLS_RAW},
versions AS (SELECT {MODULE_LIST!r}[CAST(bill_id % {len(MODULE_LIST)} AS INTEGER) + 1] AS modulo, CAST(conn_id % 97 AS VARCHAR) AS clave, 'v' || bill_id % 3 AS version,
   'p' || bill_id AS payload, issued AS creado_en FROM bills_raw)"""


@query("upsert", with_ctes(VERSIONS) + """,
  b AS (SELECT *, CAST(version = 'v2' AS INTEGER) AS side FROM versions)
  SELECT modulo, clave, payload, creado_en FROM b QUALIFY row_number() OVER (PARTITION BY modulo, clave ORDER BY creado_en DESC, side DESC, payload DESC) = 1""")
def upsert(spark, sf):
    rows = _versions(spark, sf)
    old, new = rows.where("version <> 'v2'").drop("version"), rows.where("version = 'v2'").drop("version")
    return pb.upsert(old, new, ["modulo", "clave"], "creado_en")


@query("insert_ignore", with_ctes(VERSIONS) + """,
  o AS (SELECT modulo, clave, min(payload) AS payload FROM versions WHERE version = 'v0' GROUP BY 1, 2),
  n AS (SELECT modulo, clave, min(payload) AS payload FROM versions WHERE version <> 'v0' GROUP BY 1, 2)
  SELECT * FROM o UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.modulo = n.modulo AND o.clave = n.clave)""")
def insert_ignore(spark, sf):
    rows = _versions(spark, sf).select("modulo", "clave", "version", "payload")
    old = rows.where("version = 'v0'").groupBy("modulo", "clave").agg(F.min("payload").alias("payload"))
    return pb.insert_ignore(old, rows.where("version <> 'v0'").drop("version"), ["modulo", "clave"])


@query("stored_upsert", ORACLES["upsert"])
def stored_upsert(spark, sf):
    """The upsert on a stored table, of which only the buckets of incoming keys are written anew."""
    rows = _versions(spark, sf)
    old = pb.upsert(rows.where("version = 'v0'").drop("version"), rows.where("version = 'v1'").drop("version"), ["modulo", "clave"], "creado_en")
    table = StoredTable.create(old, shared_folder(spark), ["modulo", "clave"])
    table.upsert(rows.where("version = 'v2'").drop("version"), "creado_en")
    return table.read()


@query("stored_insert_ignore", ORACLES["insert_ignore"])
def stored_insert_ignore(spark, sf):
    rows = _versions(spark, sf).select("modulo", "clave", "version", "payload")
    old = rows.where("version = 'v0'").groupBy("modulo", "clave").agg(F.min("payload").alias("payload"))
    table = StoredTable.create(old, shared_folder(spark), ["modulo", "clave"])
    table.insert_ignore(rows.where("version <> 'v0'").drop("version"))
    return table.read()


@query("current_results", with_ctes(VERSIONS) + """
  SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY modulo, clave ORDER BY creado_en DESC, version DESC, payload DESC) = 1""")
def current_results(spark, sf):
    return pb.current_results(_versions(spark, sf))


@query("latest_per_key", with_ctes(VERSIONS) + """
  SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY modulo ORDER BY creado_en DESC, payload) = 1""")
def latest_per_key(spark, sf):
    from rivulet.operators.windows import latest_per_key as latest

    return latest(_versions(spark, sf), ["modulo"], [F.col("creado_en").desc(), F.col("payload")])


@query("results_by_module", with_ctes(VERSIONS) + """
  SELECT * FROM versions WHERE modulo IN ('eda', 'ml') QUALIFY row_number() OVER (PARTITION BY modulo, clave ORDER BY creado_en DESC, version DESC, payload DESC) = 1""")
def results_by_module(spark, sf):
    return pb.results_by_module(_versions(spark, sf), ["eda", "ml"])


@query("series_findings", with_ctes(PAYLOADS) + """
  SELECT 'facturado_' || priority AS clave, 'Facturado ' || priority AS titulo, 'suma por periodo' AS conclusion FROM (SELECT DISTINCT priority FROM pm)""")
def series_findings(spark, sf):
    from rivulet.operators.evaluation import series_findings as findings

    return findings(published(spark, sf).withColumn("modulo", F.lit("series")), "tendencia")


LOAD_COLUMNS = ["bill_id", "conn_id", "period", "total", "paid"]


@query("project_for_load", with_ctes(BILLS_RAW) + f"SELECT {', '.join(LOAD_COLUMNS)} FROM bills_raw")
def project_for_load(spark, sf):
    return pb.project_for_load(b.bills_raw(spark, sf), LOAD_COLUMNS)


@query("replace_version", with_ctes(BILLS_RAW) + """
  SELECT conn_id % 3 AS version, CASE WHEN conn_id % 3 = 1 THEN 'new' ELSE 'old' END AS label, count(*) AS n, round(sum(total), 2) AS total FROM bills_raw GROUP BY 1, 2""")
def replace_version(spark, sf):
    """All versions are written, then one of them is replaced; the others keep their rows."""
    rows = b.bills_raw(spark, sf).select((F.col("conn_id") % 3).alias("version"), "bill_id", "total", F.lit("old").alias("label"))
    path = shared_folder(spark)
    pb.replace_version(rows, path, "version")
    pb.replace_version(rows.where("version = 1").withColumn("label", F.lit("new")), path, "version")
    back = spark.read.schema(rows.schema).parquet(path)
    return back.groupBy("version", "label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("stored_replace_version", ORACLES["replace_version"])
def stored_replace_version(spark, sf):
    """One version of a stored table is replaced; only the buckets that hold it are written anew."""
    rows = b.bills_raw(spark, sf).select("bill_id", (F.col("conn_id") % 3).alias("version"), "total", F.lit("old").alias("label")).dropDuplicates(["bill_id"])
    table = StoredTable.create(rows, shared_folder(spark), ["bill_id"])
    table.replace_version(rows.where("version = 1").withColumn("label", F.lit("new")), "version")
    return table.read().groupBy("version", "label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("read_csv_tables", """
  SELECT 'customer' AS table_name, count(*) FILTER (c_custkey % 50 <> 0) AS n, count(*) FILTER (c_custkey % 50 = 0) AS rejected,
         round(sum(c_acctbal) FILTER (c_custkey % 50 <> 0), 2) AS total FROM customer
  UNION ALL SELECT 'part', count(*), 0, round(sum(p_retailprice), 2) FROM part""")
def read_csv_tables(spark, sf):
    """Customers and parts written as CSV, every fiftieth customer with a balance that is no number, and read back."""
    sums, folder = {"customer": "c_acctbal", "part": "p_retailprice"}, shared_folder(spark)
    schemas = {}
    for name, c in sums.items():
        rows = b.table(spark, sf, name)
        schemas[name] = rows.schema
        spoiled = F.when(F.col("c_custkey") % 50 == 0, F.lit("n/a")).otherwise(F.col(c).cast("string")) if name == "customer" else F.col(c)
        rows.withColumn(c, spoiled).write.csv(f"{folder}/{name}.csv", header=True)
    tables, rejected = read_tables(spark, folder, schemas)
    broken = rejected.groupBy("table_name").agg(F.count(F.lit(1)).alias("rejected"))
    found = reduce(DataFrame.unionByName, [
        tables[n].agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n"), F.round(F.sum(c), 2).alias("total")) for n, c in sums.items()])
    return found.join(broken, "table_name", "left").select("table_name", "n", F.coalesce("rejected", F.lit(0)).cast("bigint").alias("rejected"), "total")


@query("write_tables", """
  SELECT 'customer' AS table_name, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer
  UNION ALL SELECT 'part', count(*), round(sum(p_retailprice), 2) FROM part""")
def write_tables(spark, sf):
    sums = {"customer": "c_acctbal", "part": "p_retailprice"}
    tables = {name: b.table(spark, sf, name) for name in sums}
    paths = pb.write_tables(tables, shared_folder(spark), "csv")
    parts = [spark.read.schema(tables[n].schema).csv(paths[n], header=True).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(c), 2).alias("total")).select(
        F.lit(n).alias("table_name"), "n", "total") for n, c in sums.items()]
    return pb.check_constraints(parts)


@query("read_results", with_ctes(PAYLOADS) + """
  SELECT 'eda' AS modulo, 'facturado_' || priority AS clave, 'v1' AS version, 'Facturado ' || priority AS titulo FROM (SELECT DISTINCT priority FROM pm)""")
def read_results(spark, sf):
    path = shared_folder(spark)
    pb.write_results(published(spark, sf), path)
    return pb.read_results(spark, path).select("modulo", "clave", "version", F.get_json_object("payload", "$.titulo").alias("titulo"))


@query("check_constraints", with_ctes(AGENT_LOG) + """
  SELECT 'log: step 1..5' AS rule, count(*) FILTER (NOT step BETWEEN 1 AND 5) AS violations FROM agent_log
  UNION ALL SELECT 'log: result or error', count(*) FILTER (error IS NULL AND step = 3) FROM agent_log
  UNION ALL SELECT 'log: ms >= 0', count(*) FILTER (ms < 0) FROM agent_log
  UNION ALL SELECT 'log: tool known', count(*) FILTER (tool NOT IN ('user', 'assistant')) FROM agent_log
  UNION ALL SELECT 'log: answer and check together', count(*) FILTER ((error IS NULL) <> (step = 1)) FROM agent_log
  UNION ALL SELECT 'readings: unique key', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL SELECT 'labels: document exists', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'es')""")
def check_constraints(spark, sf):
    log = agent_log(spark, sf)
    result = F.when(F.col("step") != 3, "ok")
    checked = F.when(F.col("step") == 1, F.col("step"))
    rules = pb.check_rules(log, {
        "log: step 1..5": F.col("step").between(1, 5), "log: result or error": result.isNotNull() | F.col("error").isNotNull(),
        "log: ms >= 0": F.col("ms") >= 0, "log: tool known": F.col("tool").isin("user", "assistant"),
        "log: answer and check together": pb.both_or_neither(F.col("error"), F.when(checked.isNull(), "x"))})
    return pb.check_constraints([
        rules, pb.check_unique(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "readings: unique key"),
        pb.check_foreign_key(b.table(spark, sf, "labels"), "doc_id", b.table(spark, sf, "documents").where("lang <> 'es'"), "doc_id",
                             "labels: document exists")])
