"""Queries of the metric, calibration, log-evaluation and account operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions.text import WHITE
from rivulet.operators import evaluation as ev
from rivulet.operators import metrics as mt
from rivulet.operators import windows as wn
from rivulet.plans import bindings as b
from rivulet.plans.bindings import BILLS, CONNECTIONS
from rivulet.plans.registry import query, with_ctes
from rivulet.plans.summaries import r6


def scored(spark, sf):
    """Labelled bills with a score that follows the label only in part."""
    y = F.col("late").cast("int")
    p = (200 + (F.col("bill_id") * 7919) % 1000 + 500 * y) / 2000
    rows = b.censored(spark, sf).where("trainable").withColumns({"y": y, "p": p})
    return rows.join(b.connections(spark, sf).select("conn_id", "tariff", "direct_debit"), "conn_id")


SCORED = f"""{BILLS}, {CONNECTIONS},
scored AS (SELECT c.*, CAST(late AS INTEGER) AS y, (200 + (bill_id * 7919) % 1000 + 500 * CAST(late AS INTEGER)) / 2000 AS p,
    n.tariff, n.direct_debit FROM censored c JOIN connections n USING (conn_id) WHERE trainable)"""
RANKED = f"""{SCORED},
v AS (SELECT p, sum(y)::BIGINT AS pos, count(*) AS n FROM scored GROUP BY 1),
cum AS (SELECT p, pos, n, (sum(pos) OVER w)::BIGINT AS tp, (sum(n - pos) OVER w)::BIGINT AS fp, (sum(pos) OVER ())::BIGINT AS pos_all, (sum(n) OVER ())::BIGINT AS n_all,
   (sum(n - pos) OVER () - sum(n - pos) OVER w)::BIGINT AS neg_below FROM v WINDOW w AS (ORDER BY p DESC)),
rk AS (SELECT sum(pos / pos_all * tp / (tp + fp)) AS average_precision, sum(pos * (neg_below + (n - pos) / 2)) / any_value(pos_all::DOUBLE * (n_all - pos_all)) AS roc_auc FROM cum)"""


def _grid_sql(grid) -> str:
    values = ", ".join(f"{g!r}::DOUBLE" for g in grid)
    return f"""g AS (SELECT unnest([{values}]) AS threshold),
m AS (SELECT threshold, count(*) FILTER (p >= threshold AND y = 1) AS tp, count(*) FILTER (p >= threshold AND y = 0) AS fp,
        count(*) FILTER (p < threshold AND y = 1) AS fn, count(*) FILTER (p >= threshold) AS flagged FROM scored, g GROUP BY 1),
curve AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS "precision", coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
        coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM m)"""


@query("cumulative_by_score", with_ctes(RANKED) + "SELECT * FROM cum")
def cumulative_by_score(spark, sf):
    return mt.cumulative_by_score(scored(spark, sf), "y", "p")


@query("classification_metrics", with_ctes(RANKED) + """,
  m AS (SELECT count(*) FILTER (p >= 0.5 AND y = 1) AS tp, count(*) FILTER (p >= 0.5 AND y = 0) AS fp, count(*) FILTER (p < 0.5 AND y = 1) AS fn,
               avg((p - y) * (p - y)) AS brier FROM scored)
  SELECT round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(tp / (tp + fp), 6) AS "precision", round(tp / (tp + fn), 6) AS recall, round(brier, 6) AS brier,
         round(average_precision, 6) AS average_precision, round(roc_auc, 6) AS roc_auc FROM m, rk""")
def classification_metrics(spark, sf):
    out = mt.classification_metrics(scored(spark, sf), "y", "p", 0.5)
    return out.select(*[r6(c).alias(c) for c in out.columns])


@query("best_threshold", with_ctes(SCORED, _grid_sql(mt.BEST_GRID)) + """
  SELECT threshold, round(f1, 6) AS f1 FROM curve ORDER BY curve.f1 DESC, threshold LIMIT 1""")
def best_threshold(spark, sf):
    return mt.best_threshold(scored(spark, sf), "y", "p").withColumn("f1", r6("f1"))


@query("threshold_curve", with_ctes(SCORED, _grid_sql(mt.CURVE_GRID)) + """
  SELECT threshold, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, flagged FROM curve""")
def threshold_curve(spark, sf):
    out = mt.threshold_table(scored(spark, sf), "y", "p", mt.CURVE_GRID)
    return out.select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"), "flagged")


@query("confusion_matrix", with_ctes(SCORED) + """
  SELECT y AS actual, count(*) FILTER (p < 0.5) AS predicted_0, count(*) FILTER (p >= 0.5) AS predicted_1 FROM scored GROUP BY 1""")
def confusion_matrix(spark, sf):
    rows = scored(spark, sf).select(F.col("y").alias("actual"), (F.col("p") >= 0.5).cast("int").alias("predicted"))
    out = mt.confusion_matrix(rows, "actual", "predicted", [0, 1])
    return out.select(F.col("actual").cast("int").alias("actual"), F.col("`0`").alias("predicted_0"), F.col("`1`").alias("predicted_1"))


@query("errors_by_segment", with_ctes(SCORED) + """
  SELECT tariff, count(*) AS n, round(avg(y), 6) AS rate,
         round(coalesce(count(*) FILTER (y = 1 AND p >= 0.5) / nullif(count(*) FILTER (y = 1), 0), 0), 6) AS recall,
         round(coalesce(count(*) FILTER (y = 1 AND p >= 0.5) / nullif(count(*) FILTER (p >= 0.5), 0), 0), 6) AS "precision" FROM scored GROUP BY 1""")
def errors_by_segment(spark, sf):
    return mt.errors_by_segment(scored(spark, sf), "tariff", "y", "p", 0.5).withColumns({c: r6(c) for c in ("rate", "recall", "precision")})


@query("calibration_deciles", with_ctes(SCORED) + """,
  e AS (SELECT list_distinct(list_sort(quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS e FROM scored),
  k AS (SELECT 1 + len(list_filter(e, lambda x: x < p)) AS bin, p, y FROM scored, e),
  c AS (SELECT bin, avg(p) AS predicted, avg(y) AS actual, count(*) AS n FROM k GROUP BY 1)
  SELECT CAST(bin AS INTEGER) AS bin, round(predicted, 6) AS predicted, round(actual, 6) AS actual, n, round(avg(predicted - actual) OVER (), 6) AS bias FROM c""")
def calibration_deciles(spark, sf):
    return mt.calibration(scored(spark, sf), "y", "p").withColumns({c: r6(c) for c in ("predicted", "actual", "bias")})


@query("error_profile", with_ctes(SCORED) + """
  SELECT CASE WHEN y = 1 AND p >= 0.5 THEN 'late found' WHEN y = 1 THEN 'late missed' WHEN p >= 0.5 THEN 'false alarm' ELSE 'on time' END AS outcome,
         count(*) AS n, round(avg(CAST(direct_debit AS INTEGER)), 6) AS direct_debit, round(avg(total), 4) AS total FROM scored GROUP BY 1""")
def error_profile(spark, sf):
    out = mt.error_profile(scored(spark, sf), "y", "p", 0.5, ["direct_debit", "total"])
    return out.withColumns({"direct_debit": r6("direct_debit"), "total": r6("total", 4)})


PERIODS = f"""{BILLS},
pn AS (SELECT period, row_number() OVER (ORDER BY period) AS no, count(*) OVER () AS n FROM (SELECT DISTINCT period FROM censored WHERE trainable))"""


@query("temporal_split", with_ctes(PERIODS) + """
  SELECT bill_id, no > n - 4 AS is_test FROM censored JOIN pn USING (period) WHERE trainable""")
def temporal_split(spark, sf):
    return mt.temporal_split(b.censored(spark, sf).where("trainable"), "period").select("bill_id", "is_test")


@query("time_series_folds", with_ctes(PERIODS) + """,
  f AS (SELECT CAST(k AS INTEGER) AS fold, period, no, n - (5 - k + 1) * (n // 6) AS start, n // 6 AS size FROM pn, range(1, 6) t(k))
  SELECT fold, period, no > start AS is_validation FROM f WHERE no <= start + size""")
def time_series_folds(spark, sf):
    return mt.time_series_folds(b.censored(spark, sf).where("trainable"), "period")


@query("baselines", with_ctes(PERIODS) + """,
  h AS (SELECT *, last_value(CAST(late AS INTEGER) IGNORE NULLS) OVER (PARTITION BY conn_id ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM censored),
  r AS (SELECT avg(CAST(late AS INTEGER)) AS rate FROM h JOIN pn USING (period) WHERE trainable AND no <= n - 4)
  SELECT bill_id, round(rate, 6) AS constant, round(coalesce(previous, rate), 6) AS previous_rule FROM h JOIN pn USING (period), r WHERE trainable AND no > n - 4""")
def baselines(spark, sf):
    rows = mt.temporal_split(wn.payment_history(b.censored(spark, sf)).where("trainable"), "period")
    return mt.baselines(rows, "is_test", "late", "previous_label").select(
        "bill_id", r6("constant").alias("constant"), r6("previous_rule").alias("previous_rule"))


# ---------------------------------------------------------------- several classes
def judged(spark, sf):
    """Complaints with a predicted class that is wrong for some documents."""
    k = F.col("doc_id")
    guess = F.when(k % 7 == 0, "en").when(k % 11 == 0, "fr").otherwise(F.col("lang"))
    return b.table(spark, sf, "documents").select("doc_id", "text", "lang", guess.alias("guess"), "n_chars")


JUDGED = """judged AS (SELECT doc_id, text, lang, CASE WHEN doc_id % 7 = 0 THEN 'en' WHEN doc_id % 11 = 0 THEN 'fr' ELSE lang END AS guess, n_chars FROM documents)"""
PER_CLASS = f"""{JUDGED},
cl AS (SELECT DISTINCT lang AS category FROM judged UNION SELECT DISTINCT guess FROM judged),
pc AS (SELECT category, count(*) FILTER (lang = category AND guess = category) AS tp, count(*) FILTER (lang = category) AS support,
         count(*) FILTER (guess = category) AS predicted FROM judged, cl GROUP BY 1),
per_class AS (SELECT category, coalesce(tp / nullif(predicted, 0), 0) AS "precision", coalesce(tp / nullif(support, 0), 0) AS recall,
         coalesce(2 * tp / nullif(predicted + support, 0), 0) AS f1, support, tp FROM pc)"""


@query("per_class_prf", with_ctes(PER_CLASS) + """
  SELECT category, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM per_class""")
def per_class_prf(spark, sf):
    out = mt.per_class(judged(spark, sf), "lang", "guess")
    return out.select("category", r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"), "support")


@query("accuracy_macro_f1", with_ctes(PER_CLASS) + """
  SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS f1_macro FROM per_class""")
def accuracy_macro_f1(spark, sf):
    return mt.accuracy_macro_f1(judged(spark, sf), "lang", "guess").select("n", r6("accuracy").alias("accuracy"), r6("f1_macro").alias("f1_macro"))


@query("confusion_matrix_k", with_ctes(JUDGED) + "SELECT lang AS actual, " + ", ".join(
    f"count(*) FILTER (guess = '{c}') AS {c}" for c in ("de", "en", "es", "fr")) + " FROM judged GROUP BY 1")
def confusion_matrix_k(spark, sf):
    return mt.confusion_matrix(judged(spark, sf).withColumnRenamed("lang", "actual"), "actual", "guess", ["de", "en", "es", "fr"])


@query("confusions_list", with_ctes(JUDGED) + """,
  c AS (SELECT lang || ' -> ' || guess || ' (' || count(*) || ')' AS t, count(*) AS n FROM judged WHERE lang <> guess GROUP BY lang, guess)
  SELECT string_agg(t, ', ' ORDER BY n DESC, t) AS confusions FROM c""")
def confusions_list(spark, sf):
    return mt.confusions_list(judged(spark, sf), "lang", "guess")


# ---------------------------------------------------------------- logged runs
def llm_log(spark, sf):
    k = F.col("doc_id")
    answer = F.when(k % 11 != 0, F.when(k % 5 == 0, "en").otherwise(F.col("lang")))
    system = F.when(k % 7 == 0, "en").otherwise(F.col("lang"))
    return b.table(spark, sf, "documents").select(
        k, F.col("lang").alias("actual"), system.alias("system"), answer.alias("answer"), (k % 3).alias("attempts"),
        (answer == system).alias("agrees"), ((answer == system) & (k % 13 != 0)).alias("valid"),
        F.concat(F.lit("p"), (k % 2).cast("string")).alias("provider"), F.col("n_chars").alias("ms"))


LLM_LOG = """llm_log AS (
  SELECT *, answer = system AS agrees, answer = system AND doc_id % 13 <> 0 AS valid FROM (
    SELECT doc_id, lang AS actual, CASE WHEN doc_id % 7 = 0 THEN 'en' ELSE lang END AS system,
      CASE WHEN doc_id % 11 <> 0 THEN CASE WHEN doc_id % 5 = 0 THEN 'en' ELSE lang END END AS answer, doc_id % 3 AS attempts,
      'p' || doc_id % 2 AS provider, n_chars AS ms FROM documents))"""


@query("llm_eval", with_ctes(LLM_LOG) + """,
  ok AS (SELECT * FROM llm_log WHERE answer IS NOT NULL), a AS (SELECT count(*) AS n FROM llm_log)
  SELECT any_value(n) AS texts, round(count(*) / any_value(n), 6) AS valid_format, round(avg(greatest(0, attempts - 1)), 6) AS mean_retries,
    round(avg(CAST(agrees AS INTEGER)), 6) AS agreement, round(avg(CAST(answer = actual AS INTEGER)), 6) AS answer_accuracy,
    (SELECT round(avg(CAST(system = actual AS INTEGER)), 6) FROM llm_log) AS system_accuracy,
    (SELECT round(count(*) FILTER (valid) / count(*), 6) FROM llm_log) AS marked_valid,
    (SELECT '{' || string_agg('"' || provider || '":' || c, ',' ORDER BY provider) || '}' FROM (SELECT provider, count(*) AS c FROM ok GROUP BY 1)) AS providers
  FROM ok, a""")
def llm_eval(spark, sf):
    out = ev.llm_eval(llm_log(spark, sf), actual="actual", system="system", answer="answer", attempts="attempts", agrees="agrees",
                      valid="valid", provider="provider")
    return out.withColumns({c: r6(c) for c in out.columns if c not in ("texts", "providers")})


@query("latency_percentile", with_ctes(LLM_LOG) + """,
  s AS (SELECT ms, row_number() OVER (ORDER BY ms) - 1 AS i, count(*) OVER () AS n FROM llm_log)
  SELECT any_value(n) AS n, max(ms) FILTER (i = least(n - 1, CAST(round_even(0.5::DOUBLE * (n - 1), 0) AS BIGINT))) AS p50,
         max(ms) FILTER (i = least(n - 1, CAST(round_even(0.95::DOUBLE * (n - 1), 0) AS BIGINT))) AS p95 FROM s""")
def latency_percentile(spark, sf):
    return ev.latency_percentiles(llm_log(spark, sf), "ms", {"p50": 0.5, "p95": 0.95})


def agent_log(spark, sf):
    size = F.length("text")
    return b.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("session"), (F.col("turn") + 1).cast("int").alias("step"), F.col("role").alias("tool"),
        F.when(size % 7 == 0, "dato no disponible").alias("error"), (size * 3).alias("ms"))


AGENT_LOG = """agent_log AS (SELECT conv_id AS session, CAST(turn + 1 AS INTEGER) AS step, role AS tool,
  CASE WHEN length(text) % 7 = 0 THEN 'dato no disponible' END AS error, length(text) * 3 AS ms FROM conversations)"""


def raw_cases(spark, sf):
    """One case per session, its tool list as the pipe text the evaluation file would hold."""
    k = F.col("session")
    tools = agent_log(spark, sf).groupBy("session").agg(F.array_join(F.array_sort(F.collect_set("tool")), "|").alias("tools"), F.count(F.lit(1)).alias("n"))
    expected = F.when(k % 5 == 0, "system|user").when(k % 4 == 0, F.concat("tools", F.lit("||"), "tools")).otherwise(F.col("tools"))
    answer = F.when(k % 9 == 0, "Alcancé el límite de 5 pasos").when(k % 8 == 0, "").otherwise(F.lit("listo"))
    return tools.select("session", expected.alias("expected"), F.when(F.col("n") > 3, " TRUE ").otherwise("false").alias("multistep"),
                        F.when(k % 3 != 0, " ana ").otherwise(" ").alias("validator"), answer.alias("answer"))


RAW_CASES = f"""{AGENT_LOG},
tl AS (SELECT session, string_agg(DISTINCT tool, '|' ORDER BY tool) AS tools, count(*) AS n FROM agent_log GROUP BY 1),
raw_cases AS (SELECT session, CASE WHEN session % 5 = 0 THEN 'system|user' WHEN session % 4 = 0 THEN tools || '||' || tools ELSE tools END AS expected,
  CASE WHEN n > 3 THEN ' TRUE ' ELSE 'false' END AS multistep, CASE WHEN session % 3 <> 0 THEN ' ana ' ELSE ' ' END AS validator,
  CASE WHEN session % 9 = 0 THEN 'Alcancé el límite de 5 pasos' WHEN session % 8 = 0 THEN '' ELSE 'listo' END AS answer FROM tl),
cases AS (SELECT session, list_filter(string_split(expected, '|'), lambda t: t <> '') AS expected, lower(trim(multistep, '{WHITE}')) IN ('true', 'si') AS multistep,
  trim(validator, '{WHITE}') AS validator, answer FROM raw_cases WHERE trim(validator, '{WHITE}') <> '')"""


def cases(spark, sf):
    return ev.load_eval_cases(raw_cases(spark, sf), expected="expected", flag="multistep", validator="validator")


@query("load_eval_cases", with_ctes(RAW_CASES) + "SELECT * FROM cases")
def load_eval_cases(spark, sf):
    return cases(spark, sf)


@query("expected_tool_counts", with_ctes(RAW_CASES) + "SELECT tool, count(*) AS n FROM (SELECT unnest(expected) AS tool FROM cases) GROUP BY 1")
def expected_tool_counts(spark, sf):
    return ev.expected_tool_counts(cases(spark, sf), "expected")


@query("same_set", with_ctes(RAW_CASES) + """
  SELECT session, list_sort(list_distinct(expected)) = ['assistant', 'user'] AS both, len(list_intersect(list_distinct(expected), ['system', 'tool'])) AS shared FROM cases""")
def same_set(spark, sf):
    return cases(spark, sf).select(
        "session", ev.same_set(F.col("expected"), F.array(F.lit("user"), F.lit("assistant"))).alias("both"),
        F.size(F.array_intersect("expected", F.array(F.lit("system"), F.lit("tool")))).cast("bigint").alias("shared"))


@query("distinct_in_order", with_ctes(RAW_CASES) + """
  SELECT session, list_transform(list_filter(list_transform(range(1, len(expected) + 1), lambda i: {'i': i, 't': expected[i]}),
     lambda s: list_position(expected, s.t) = s.i), lambda s: s.t) AS tools FROM cases""")
def distinct_in_order(spark, sf):
    return cases(spark, sf).select("session", F.array_distinct("expected").alias("tools"))


GRADED = f"""{RAW_CASES},
us AS (SELECT session, list_sort(list_distinct(list(tool))) AS used, min_by(tool, step) AS first_tool, count(*) AS steps, count(error) > 0 AS failed FROM agent_log GROUP BY 1),
graded AS (SELECT session, multistep, list_sort(list_distinct(expected)) = used AS selection_ok, list_contains(expected, first_tool) AS first_ok,
   list_sort(list_distinct(expected)) = used AND NOT failed AND NOT contains(answer, 'límite de') AND length(answer) > 0 AS success, steps
 FROM cases LEFT JOIN us USING (session))"""


def graded(spark, sf):
    return ev.grade_agent_cases(agent_log(spark, sf), cases(spark, sf), "session")


@query("grade_agent_case", with_ctes(GRADED) + "SELECT * FROM graded")
def grade_agent_case(spark, sf):
    return graded(spark, sf)


@query("agent_summary", with_ctes(GRADED) + """
  SELECT count(*) AS cases, round(avg(CAST(selection_ok AS INTEGER)), 6) AS tool_selection, round(avg(CAST(first_ok AS INTEGER)), 6) AS first_tool,
    round(avg(CAST(success AS INTEGER)), 6) AS success, round(avg(CAST(success AS INTEGER)) FILTER (multistep), 6) AS multistep_success,
    round(avg(steps), 6) AS mean_steps FROM graded""")
def agent_summary(spark, sf):
    out = ev.agent_summary(graded(spark, sf))
    return out.withColumns({c: r6(c) for c in out.columns if c != "cases"})


@query("agent_log_stats", with_ctes(AGENT_LOG) + """
  SELECT tool, count(*) AS calls, count(error) AS errors, round(avg(ms), 6) AS mean_ms, count(*) FILTER (step NOT BETWEEN 1 AND 5) AS beyond_limit,
         count(*) FILTER (step = 5) AS at_limit FROM agent_log GROUP BY 1""")
def agent_log_stats(spark, sf):
    return ev.agent_log_stats(agent_log(spark, sf), "session", "step", "tool", "error", "ms").withColumn("mean_ms", r6("mean_ms"))


@query("agent_sessions", with_ctes(AGENT_LOG) + """,
  s AS (SELECT session, max(step) AS l, count(*) AS n, count(error) AS e FROM agent_log GROUP BY 1)
  SELECT count(*) AS sessions, count(*) FILTER (l >= 5) AS at_limit, count(*) FILTER (l > 5) AS beyond_limit, count(*) FILTER (e > 0) AS with_errors,
         round(avg(n), 6) AS mean_steps FROM s""")
def agent_sessions(spark, sf):
    return ev.agent_sessions(agent_log(spark, sf), "session", "step", "error").withColumn("mean_steps", r6("mean_steps"))


# ---------------------------------------------------------------- accounts
@query("account_status", with_ctes(BILLS) + """,
  l AS (SELECT * FROM bills QUALIFY row_number() OVER (PARTITION BY conn_id ORDER BY period DESC) <= 6)
  SELECT conn_id, count(*) AS bills, round(coalesce(sum(total) FILTER (NOT paid), 0), 2) AS unpaid_total, count(*) FILTER (NOT paid) AS unpaid_bills,
         max(period) AS last_period FROM l GROUP BY 1""")
def account_status(spark, sf):
    return ev.account_status(b.bills(spark, sf), "conn_id", "period", "total", "paid")


@query("prediction_lookup", with_ctes(SCORED) + """,
  w AS (SELECT c_custkey AS conn_id, CASE WHEN c_custkey % 2 = 0 THEN '1999-0' || (1 + c_custkey % 9) END AS period FROM customer WHERE c_acctbal < 0)
  SELECT s.conn_id, s.period, s.p FROM scored s WHERE EXISTS (SELECT 1 FROM w WHERE w.conn_id = s.conn_id AND (w.period IS NULL OR w.period = s.period))""")
def prediction_lookup(spark, sf):
    k = F.col("c_custkey")
    wanted = b.table(spark, sf, "customer").where("c_acctbal < 0").select(
        k.alias("conn_id"), F.when(k % 2 == 0, F.concat(F.lit("1999-0"), (1 + k % 9).cast("string"))).alias("period"))
    return ev.prediction_lookup(scored(spark, sf).select("conn_id", "period", "p"), wanted, "conn_id", "period")
