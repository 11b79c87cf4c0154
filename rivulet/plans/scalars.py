"""Queries of the scalar functions and the statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions import scalars as sc
from rivulet.functions import text as tx
from rivulet.functions.text import WHITE
from rivulet.operators import aggregates as ag
from rivulet.operators import stats as st
from rivulet.plans import bindings as b
from rivulet.plans.bindings import BILLS, CONNECTIONS
from rivulet.plans.cleaning import ANALYSIS, analysis_table
from rivulet.plans.registry import query, with_ctes
from rivulet.plans.summaries import r6

# ñ is protected while DuckDB strips accents; its code points survive as chr(1)
SQL_STRIP = "replace(strip_accents(replace({0}, 'ñ', chr(1))), chr(1), 'ñ')"
SQL_NORM = ("CASE WHEN coalesce(trim(lower({0}), '" + WHITE + "'), '') IN ('', 'nan') THEN '' ELSE trim(regexp_replace("
            + SQL_STRIP.format("lower({0})") + ", '[^a-z0-9ñ]+', ' ', 'g')) END")
STOPS = "[" + ", ".join(f"'{w}'" for w in tx.STOP_WORDS) + "]"
SQL_TOKENS = "list_filter(string_split({0}, ' '), lambda w: length(w) > 1 AND NOT list_contains(" + STOPS + ", w))"
TOKENS = f"""normed AS (SELECT doc_id, lang, source, text, {SQL_NORM.format('text')} AS norm FROM documents),
tokens AS (SELECT *, {SQL_TOKENS.format('norm')} AS toks FROM normed)"""


def docs(spark, sf):
    return b.documents(spark, sf)


@query("strip_accents", f"SELECT doc_id, md5({SQL_STRIP.format('text')}) AS plain_md5 FROM documents")
def strip_accents(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(tx.strip_accents(F.col("text"))).alias("plain_md5"))


@query("normalize_text", with_ctes(TOKENS) + "SELECT doc_id, md5(norm) AS norm_md5, length(norm) AS n FROM normed")
def normalize_text(spark, sf):
    norm = tx.normalize_text(F.col("text"))
    return docs(spark, sf).select("doc_id", F.md5(norm).alias("norm_md5"), F.length(norm).cast("bigint").alias("n"))


@query("tokenize", with_ctes(TOKENS) + "SELECT doc_id, len(toks) AS n, md5(array_to_string(toks, ' ')) AS tokens_md5 FROM tokens")
def tokenize(spark, sf):
    return docs(spark, sf).select("doc_id", tx.tokenize(F.col("text")).alias("t")).select(
        "doc_id", F.size("t").cast("bigint").alias("n"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


@query("ngrams", with_ctes(TOKENS) + """, g AS (
  SELECT doc_id, list_concat(toks, list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])) AS grams FROM tokens)
  SELECT doc_id, len(grams) AS n, md5(array_to_string(grams, '|')) AS grams_md5 FROM g""")
def ngrams(spark, sf):
    return docs(spark, sf).select("doc_id", tx.tokenize(F.col("text")).alias("t")).select("doc_id", tx.ngrams(F.col("t"), 2).alias("g")).select(
        "doc_id", F.size("g").cast("bigint").alias("n"), F.md5(F.array_join("g", "|")).alias("grams_md5"))


@query("contains_phrase", with_ctes(TOKENS) + """
  SELECT lang, count(*) FILTER (contains(' ' || norm || ' ', ' the of ')) AS the_of, count(*) FILTER (contains(' ' || norm || ' ', ' de la ')) AS de_la
  FROM normed GROUP BY 1""")
def contains_phrase(spark, sf):
    norm = docs(spark, sf).select("lang", tx.normalize_text(F.col("text")).alias("t"))
    return norm.groupBy("lang").agg(F.count_if(tx.contains_phrase(F.col("t"), "the of")).alias("the_of"),
                                    F.count_if(tx.contains_phrase(F.col("t"), "de la")).alias("de_la"))


# words of the test texts stand in for the Spanish ones: the text is rewritten before the rule sees it
SQL_WATER = "regexp_replace(regexp_replace(norm, '\\b(the|que|une|der)\\b', 'sale', 'g'), '\\b(and|los|est|und)\\b', 'agua', 'g')"


def water_text(spark, sf):
    norm = tx.normalize_text(F.col("text"))
    text = F.regexp_replace(F.regexp_replace(norm, r"\b(the|que|une|der)\b", "sale"), r"\b(and|los|est|und)\b", "agua")
    return docs(spark, sf).select("doc_id", "lang", text.alias("t"))


@query("leaking_water_regex", with_ctes(TOKENS) + f"""
  SELECT doc_id, nullif(regexp_extract({SQL_WATER}, '(?:^| )((?:sale|salen|brota|brotan|tira|tiran|escurre)(?: [a-z0-9ñ]+){{0,3}} agua)(?: |$)', 1), '') AS found
  FROM normed""")
def leaking_water_regex(spark, sf):
    return water_text(spark, sf).select("doc_id", tx.leaking_water(F.col("t")).alias("found"))


# RE2 knows word characters and edges only in ASCII, so the classes are spelled out; the edges of a tax id stay ASCII
SQL_MASK = (r"trim(regexp_replace(regexp_replace(regexp_replace({0}, '[\p{{L}}\p{{N}}_.+-]+@[\p{{L}}\p{{N}}_-]+\.[\p{{L}}\p{{N}}_.-]+', '[correo omitido]', 'g'), "
            r"'(?i)\b[A-ZÑ&]{{3,4}}\d{{6}}[A-Z0-9]{{2,8}}\b', '[identificador omitido]', 'g'), '(?:\d[\s-]?){{8,}}', '[número omitido] ', 'g'), ' ' || chr(10) || chr(9) || chr(13))")


@query("mask_pii", f"SELECT doc_id, {SQL_MASK.format('text')} <> text AS changed, md5({SQL_MASK.format('text')}) AS masked_md5 FROM documents")
def mask_pii(spark, sf):
    masked = tx.mask_pii(F.col("text"))
    return docs(spark, sf).select("doc_id", (masked != F.col("text")).alias("changed"), F.md5(masked).alias("masked_md5"))


@query("truncate_ellipsis", r"""
  WITH s AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)
  SELECT doc_id, CASE WHEN length(t) <= 200 THEN t ELSE rtrim(substring(t, 1, 199)) || '…' END AS summary FROM s""")
def truncate_ellipsis(spark, sf):
    return docs(spark, sf).select("doc_id", tx.truncate_ellipsis(tx.squeeze_spaces(F.col("text"))).alias("summary"))


NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"  # RFC 4122 URL namespace


@query("uuid5", """
  WITH h AS (SELECT page_id, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(url)) AS d FROM pages)
  SELECT page_id, d[1:8] || '-' || d[9:12] || '-5' || d[14:16] || '-' || translate(d[17:17], '0123456789abcdef', '89ab89ab89ab89ab')
         || d[18:20] || '-' || d[21:32] AS id FROM h""")
def uuid5(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", tx.uuid5(NAMESPACE, F.col("url")).alias("id"))


@query("l2_normalize", """
  WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
  SELECT vec_id, list_transform(e, lambda x: round(x / sqrt(list_inner_product(e, e)), 9)) AS unit FROM v""")
def l2_normalize(spark, sf):
    unit = sc.l2_normalize(F.col("embedding"))
    return b.table(spark, sf, "embeddings").select("vec_id", F.transform(unit, lambda x: F.round(x, 9)).alias("unit"))


@query("cosine_similarity", """
  WITH c AS (SELECT label, list(m ORDER BY i) AS centre FROM (
         SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1)
  SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre), 9) AS similarity FROM embeddings JOIN c USING (label)""")
def cosine_similarity(spark, sf):
    vectors = b.table(spark, sf, "embeddings")
    centres = vectors.groupBy("label").agg(F.array(*[F.avg(F.col("embedding")[i].cast("double")) for i in range(64)]).alias("centre"))
    return vectors.join(centres, "label").select(
        "vec_id", F.round(sc.cosine_similarity(F.col("embedding"), F.col("centre")), 9).alias("similarity"))


@query("validate_args", """
  WITH a AS (SELECT o_orderkey, substring(md5(CAST(o_orderkey AS VARCHAR)), 1, CAST(o_orderkey % 30 AS INTEGER)) AS ident,
                    strftime(o_orderdate, '%Y-') || CAST(o_orderkey % 14 AS VARCHAR) AS period, ' ' || lower(o_orderpriority) AS tariff,
                    o_totalprice - 100000 AS m3 FROM orders)
  SELECT o_orderkey, CASE WHEN NOT regexp_full_match(ident, '[A-Za-z0-9]{6,24}') THEN 'id'
    WHEN NOT regexp_full_match(period, '\\d{4}-(0[1-9]|1[0-2])') THEN 'period'
    WHEN replace(lower(trim(tariff, '""" + WHITE + """')), ' ', '_') NOT IN ('1-urgent', '4-not_specified', '5-low') THEN 'tariff'
    WHEN NOT m3 BETWEEN 0 AND 100000 THEN 'm3' END AS problem FROM a""")
def validate_args(spark, sf):
    k = F.col("o_orderkey")
    ident = F.substring(F.md5(k.cast("string")), F.lit(1), (k % 30).cast("int"))
    period = F.concat(F.date_format("o_orderdate", "yyyy-"), (k % 14).cast("string"))
    tariff = F.concat(F.lit(" "), F.lower("o_orderpriority"))
    return b.table(spark, sf, "orders").select("o_orderkey", sc.argument_problem(
        ident, period, tariff, F.col("o_totalprice") - 100000, ["1-urgent", "4-not_specified", "5-low"]).alias("problem"))


@query("six_significant", "SELECT o_orderkey, CAST(format('{:.6g}', o_totalprice / 7) AS DOUBLE) AS x FROM orders")
def six_significant(spark, sf):
    return b.table(spark, sf, "orders").select("o_orderkey", sc.six_significant(F.col("o_totalprice") / 7).alias("x"))


@query("json_codec", """
  SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_exists(props, '$.k') AS has_k, json_exists(props, '$.z') AS has_z FROM events""")
def json_codec(spark, sf):
    keys = F.json_object_keys("props")
    return b.table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.array_contains(keys, "k").alias("has_k"),
        F.array_contains(keys, "z").alias("has_z"))


@query("format_thousands", "SELECT o_orderkey, format('{:,.1f}', o_totalprice) AS shown FROM orders")
def format_thousands(spark, sf):
    return b.table(spark, sf, "orders").select("o_orderkey", sc.format_thousands(F.col("o_totalprice"), 1).alias("shown"))


@query("money_round", """
  WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(3,2)) AS x FROM lineitem)
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(x, 2) AS DECIMAL(12,2)) AS half_up, CAST(round_even(x, 2) AS DECIMAL(12,2)) AS half_even FROM c""")
def money_round(spark, sf):
    x = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(3,2)")
    return b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 sc.money_half_up(x).cast("decimal(12,2)").alias("half_up"),
                                                 sc.money_half_even(x).cast("decimal(12,2)").alias("half_even"))


@query("date_parts", """
  SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(date_trunc('day', ts) AS DATE) AS day, strftime(ts, '%Y-%m') AS period,
         hour(ts) IN (2, 3, 4) AS night FROM events""")
def date_parts(spark, sf):
    return b.table(spark, sf, "events").select("event_id", F.hour("ts").alias("hour"), F.to_date("ts").alias("day"),
                                               sc.period_of(F.col("ts")).alias("period"), sc.night_hour(F.col("ts")).alias("night"))


# ---------------------------------------------------------------- statistics
KW = """, per_conn AS (SELECT conn_id, any_value(area) AS area, round(avg(m3), 7) AS v FROM bills JOIN connections USING (conn_id) GROUP BY 1),
kept AS (SELECT area, v FROM per_conn QUALIFY count(*) OVER (PARTITION BY area) >= 5),
ranked AS (SELECT area, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS r FROM kept),
s AS (SELECT area, sum(r)::DOUBLE AS r, count(*) AS n FROM ranked GROUP BY 1),
t AS (SELECT sum(c * c * c - c)::DOUBLE AS ties FROM (SELECT count(*)::DOUBLE AS c FROM kept GROUP BY v)),
h AS (SELECT count(*) AS groups, sum(n)::BIGINT AS n, sum(r * r / n) AS spread FROM s),
k AS (SELECT groups, n, (12 / (n::DOUBLE * (n + 1)) * spread - 3 * (n + 1)) / (1 - ties / (n::DOUBLE * n * n - n)) AS h FROM h, t)"""


def _kruskal(spark, sf):
    per_conn = b.bills(spark, sf).groupBy("conn_id").agg(F.round(F.avg("m3"), 7).alias("v")).join(b.connections(spark, sf), "conn_id")
    return st.kruskal_wallis(per_conn, "area", "v")


@query("kruskal_wallis", with_ctes(BILLS, CONNECTIONS) + KW + """
  SELECT groups, n, groups - 1 AS df, round(h, 6) AS h, round((h - groups + 1) / (n - groups), 6) AS epsilon2 FROM k""")
def kruskal_wallis(spark, sf):
    return _kruskal(spark, sf).withColumns({"h": r6("h"), "epsilon2": r6("epsilon2")})


CROSS = """, x AS (SELECT direct_debit AS d, count(*) FILTER (NOT late)::DOUBLE AS a, count(*) FILTER (late)::DOUBLE AS b
  FROM censored JOIN connections USING (conn_id) WHERE trainable GROUP BY 1),
  m AS (SELECT sum(a) AS ca, sum(b) AS cb, sum(a + b) AS n FROM x),
  e AS (SELECT unnest([a, b]) AS o, unnest([(a + b) * ca / n, (a + b) * cb / n]) AS e, n FROM x, m),
  c AS (SELECT any_value(n) AS n, sum(pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e) AS chi2 FROM e)"""


def _chi2(spark, sf):
    rows = b.censored(spark, sf).where("trainable").join(b.connections(spark, sf), "conn_id")
    table = ag.crosstab(rows, "direct_debit", "late", [False, True])
    return st.chi2_independence(table.select(F.col("`false`").alias("a"), F.col("`true`").alias("b")), "a", "b")


@query("chi2_independence", with_ctes(BILLS, CONNECTIONS) + CROSS + """
  SELECT CAST(n AS BIGINT) AS n, 1 AS df, round(chi2, 6) AS chi2, round(sqrt(chi2 / n), 6) AS cramers_v FROM c""")
def chi2_independence(spark, sf):
    return _chi2(spark, sf).withColumns({"chi2": r6("chi2"), "cramers_v": r6("cramers_v")})


@query("wilson_interval", with_ctes(BILLS, CONNECTIONS) + """,
  j AS (SELECT CAST(late AS INTEGER) AS y, tariff, CAST(direct_debit AS VARCHAR) AS direct_debit FROM censored JOIN connections USING (conn_id) WHERE trainable),
  s AS (SELECT 'tariff' AS variable, tariff AS value, sum(y)::DOUBLE AS x, count(*)::DOUBLE AS n FROM j GROUP BY 2
        UNION ALL SELECT 'direct_debit', direct_debit, sum(y), count(*) FROM j GROUP BY 2),
  w AS (SELECT *, x / n AS p, 1.959964::DOUBLE AS z FROM s),
  c AS (SELECT variable, value, n, p, (p + z * z / (2 * n)) / (1 + z * z / n) AS c, z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n) AS m FROM w)
  SELECT variable, value, CAST(n AS BIGINT) AS n, round(p, 6) AS rate, round(c - m, 6) AS low, round(c + m, 6) AS high, round(2 * m, 6) AS width FROM c""")
def wilson_interval(spark, sf):
    rows = b.censored(spark, sf).where("trainable").join(b.connections(spark, sf), "conn_id")
    out = st.wilson_by_segments(ag.rate_by_segments(rows, "late", ["tariff", "direct_debit"]))
    return out.withColumns({c: r6(c) for c in ("rate", "low", "high", "width")})


CORR = ["mean_m3", "mean_total", "tenure_months", "pct_inconsistent", "late_rate"]
CORR_ROWS = f"""{ANALYSIS},
corr_rows AS (SELECT conn_id, round(avg(m3), 7) AS mean_m3, round(avg(total), 4) AS mean_total, max(tenure_months) AS tenure_months,
    round(avg(CAST(coalesce(inconsistent, false) AS INTEGER)), 7) AS pct_inconsistent, round(avg(CAST(late AS INTEGER)), 7) AS late_rate
  FROM analysis WHERE trainable GROUP BY 1),
ranks AS (SELECT conn_id, """ + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in CORR) + """
  FROM corr_rows WHERE """ + " AND ".join(f"{c} IS NOT NULL" for c in CORR) + ")"


def _spearman(spark, sf):
    per_conn = analysis_table(spark, sf).where("trainable").groupBy("conn_id").agg(
        F.round(F.avg("m3"), 7).alias("mean_m3"), F.round(F.avg("total"), 4).alias("mean_total"), F.max("tenure_months").alias("tenure_months"),
        F.round(F.avg(F.coalesce("inconsistent", F.lit(False)).cast("int")), 7).alias("pct_inconsistent"),
        F.round(F.avg(F.col("late").cast("int")), 7).alias("late_rate"))
    return st.spearman_matrix(per_conn, "conn_id", CORR)


PAIRS = [(a, c) for i, a in enumerate(CORR) for c in CORR[i + 1:]]


@query("spearman_matrix", with_ctes(CORR_ROWS) + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{c}' AS b, count(*) AS n, round(corr({a}, {c}), 6) AS rho FROM ranks" for a, c in PAIRS))
def spearman_matrix(spark, sf):
    return _spearman(spark, sf).withColumn("rho", r6("rho"))


@query("strongest_correlation", with_ctes(CORR_ROWS) + """SELECT variable, rho FROM (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS variable, round(corr({a}, {c}), 6) AS rho FROM ranks" for a, c in PAIRS if c == "late_rate")
    + ") ORDER BY abs(rho) DESC, variable LIMIT 1")
def strongest_correlation(spark, sf):
    return st.strongest_with(_spearman(spark, sf).withColumn("rho", r6("rho")), "late_rate")


def _welch(spark, sf):
    rows = b.bills(spark, sf).join(b.connections(spark, sf), "conn_id")
    return st.welch_t(rows, "m3", F.col("direct_debit"))


@query("welch_t", with_ctes(BILLS, CONNECTIONS) + """,
  s AS (SELECT count(m3) FILTER (direct_debit)::DOUBLE AS n1, avg(m3) FILTER (direct_debit) AS m1, var_samp(m3) FILTER (direct_debit) AS v1,
               count(m3) FILTER (NOT direct_debit)::DOUBLE AS n2, avg(m3) FILTER (NOT direct_debit) AS m2, var_samp(m3) FILTER (NOT direct_debit) AS v2
        FROM bills JOIN connections USING (conn_id))
  SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS t,
         round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), 4) AS df FROM s""")
def welch_t(spark, sf):
    return _welch(spark, sf).withColumns({"t": r6("t"), "df": r6("df", 4)})


@query("hypothesis_tests")
def hypothesis_tests(spark, sf):
    """The three tests with p-value and decision."""
    kw = st.with_chi2_p(_kruskal(spark, sf), "h").select(F.lit("kruskal_wallis").alias("test"), F.col("h").alias("statistic"),
                                                         F.col("df").cast("double").alias("df"), "p_value", "decision")
    chi = st.with_chi2_p(_chi2(spark, sf), "chi2").select(F.lit("chi2").alias("test"), F.col("chi2").alias("statistic"),
                                                          F.col("df").cast("double").alias("df"), "p_value", "decision")
    wel = st.with_t_p(_welch(spark, sf)).select(F.lit("welch_t").alias("test"), F.col("t").alias("statistic"), "df", "p_value", "decision")
    return kw.unionByName(chi).unionByName(wel)


@query("spearman_p_values")
def spearman_p_values(spark, sf):
    return st.spearman_p(_spearman(spark, sf))
