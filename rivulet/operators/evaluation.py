"""Scores of logged language-model, agent and retrieval runs, and account queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.text import strip_white
from rivulet.operators.ranks import value_counts
from rivulet.operators.windows import top_n

# Step limit of an agent, retrieval cut-offs, similarity thresholds to try.
MAX_STEPS = 5
RECALL_AT = (1, 3, 5)
SIMILARITY_GRID = tuple(round(0.30 + 0.01 * i, 2) for i in range(61))
# Module that holds the findings of each analysis.
MODULE_OF_ANALYSIS = {"tendencia": "series", "fourier": "fourier", "wavelets": "wavelets"}


def load_eval_cases(df: DataFrame, *, expected: str, flag: str, validator: str, include_unvalidated: bool = False) -> DataFrame:
    """Split the pipe list, read the yes/no flag, and keep validated rows unless told otherwise."""
    out = df.withColumns({
        expected: F.filter(F.split(F.col(expected), r"\|"), lambda t: t != ""),
        flag: F.lower(strip_white(F.col(flag))).isin("true", "si"),
        validator: F.coalesce(strip_white(F.col(validator)), F.lit("")),
    })
    return out if include_unvalidated else out.where(F.col(validator) != "")


def same_set(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def expected_tool_counts(df: DataFrame, expected: str) -> DataFrame:
    return df.select(F.explode(expected).alias("tool")).groupBy("tool").agg(F.count(F.lit(1)).alias("n"))


def llm_eval(df: DataFrame, *, actual: str, system: str, answer: str, attempts: str, agrees: str, valid: str, provider: str) -> DataFrame:
    """Rates of valid format, retries, agreement, accuracy; counts per provider as a map."""
    ok = F.col(answer).isNotNull()
    n_ok = F.count_if(ok)
    share = lambda c: F.count_if(ok & F.coalesce(c, F.lit(False))) / F.nullif(n_ok, F.lit(0))
    providers = df.where(ok).groupBy(provider).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(provider, "_n")))).alias("p"))  # one entry per provider
    out = df.agg(
        F.count(F.lit(1)).alias("texts"), (n_ok / F.count(F.lit(1))).alias("valid_format"),
        (F.sum(F.when(ok, F.greatest(F.lit(0), F.col(attempts) - 1))) / F.nullif(n_ok, F.lit(0))).alias("mean_retries"),
        share(F.col(agrees)).alias("agreement"), share(F.col(answer) == F.col(actual)).alias("answer_accuracy"),
        (F.count_if(F.col(system) == F.col(actual)) / F.count(F.lit(1))).alias("system_accuracy"),
        (F.count_if(F.col(valid)) / F.count(F.lit(1))).alias("marked_valid"))
    return out.withColumn("providers", F.to_json(providers.select("p").scalar()))


def latency_percentiles(df: DataFrame, ms: str, qs: dict[str, float], groups=()) -> DataFrame:
    """Nearest-rank percentiles: position round-half-even(q (n - 1)) of the sorted values."""
    ranked = value_counts(df, ms, groups)
    picks = []
    for name, q in qs.items():
        at = F.least(F.col("n_all") - 1, F.rint(q * (F.col("n_all") - 1)).cast("bigint"))
        picks.append(F.max(F.when((F.col("n_before") <= at) & (at < F.col("n_before") + F.col("n")), F.col(ms))).alias(name))
    return ranked.groupBy(*groups).agg(F.max("n_all").alias("n"), *picks)


def grade_agent_cases(steps: DataFrame, cases: DataFrame, case: str) -> DataFrame:
    """Per case: right tool set, first tool expected, success, steps.

    ``steps``: case, step, tool, error. ``cases``: case, expected, multistep, answer.
    Only the set of distinct tools of a case is gathered.
    """
    used = steps.groupBy(case).agg(
        F.array_sort(F.collect_set("tool")).alias("used"), F.min_by("tool", "step").alias("first_tool"),
        F.count(F.lit(1)).alias("steps"), F.max(F.col("error").isNotNull()).alias("failed"))
    rows = cases.join(used, case, "left").withColumns({
        "used": F.coalesce("used", F.array().cast("array<string>")), "steps": F.coalesce("steps", F.lit(0)),
        "failed": F.coalesce("failed", F.lit(False))})
    selection = same_set(F.col("used"), F.col("expected"))
    answered = F.coalesce(F.length("answer") > 0, F.lit(False))
    limited = F.coalesce(F.col("answer").contains("límite de"), F.lit(False))
    return rows.select(
        case, "multistep", selection.alias("selection_ok"),
        F.coalesce(F.array_contains("expected", F.col("first_tool")), F.lit(False)).alias("first_ok"),
        (selection & ~F.col("failed") & ~limited & answered).alias("success"), F.col("steps").cast("bigint").alias("steps"))


def agent_summary(graded: DataFrame) -> DataFrame:
    rate = lambda c: F.avg(F.col(c).cast("int"))
    return graded.agg(
        F.count(F.lit(1)).alias("cases"), rate("selection_ok").alias("tool_selection"), rate("first_ok").alias("first_tool"),
        rate("success").alias("success"), F.avg(F.when(F.col("multistep"), F.col("success").cast("int"))).alias("multistep_success"),
        F.avg("steps").alias("mean_steps"))


def agent_log_stats(log: DataFrame, session: str, step: str, tool: str, error: str, ms: str) -> DataFrame:
    """Per tool: calls, errors, mean ms, calls outside steps 1..5, and calls at the step limit."""
    return log.groupBy(tool).agg(
        F.count(F.lit(1)).alias("calls"), F.count(error).alias("errors"), F.avg(ms).alias("mean_ms"),
        F.count_if(~F.col(step).between(1, MAX_STEPS)).alias("beyond_limit"), F.count_if(F.col(step) == MAX_STEPS).alias("at_limit"))


def agent_sessions(log: DataFrame, session: str, step: str, error: str) -> DataFrame:
    """One row: sessions, those that reach the step limit, those beyond it, and those with an error; and the mean number of steps."""
    each = log.groupBy(session).agg(F.max(step).alias("last"), F.count(F.lit(1)).alias("steps"), F.count(error).alias("errors"))
    return each.agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("last") >= MAX_STEPS).alias("at_limit"), F.count_if(F.col("last") > MAX_STEPS).alias("beyond_limit"),
        F.count_if(F.col("errors") > 0).alias("with_errors"), F.avg("steps").alias("mean_steps"))


def account_status(bills: DataFrame, key: str, period: str, total: str, paid: str, n: int = 6) -> DataFrame:
    """Unpaid sum and count among the last ``n`` bills of every connection."""
    last = top_n(bills, [key], [F.col(period).desc()], n)
    due = F.when(~F.col(paid), F.col(total))
    return last.groupBy(key).agg(
        F.count(F.lit(1)).alias("bills"), F.round(F.coalesce(F.sum(due), F.lit(0.0)), 2).alias("unpaid_total"),
        F.count_if(~F.col(paid)).alias("unpaid_bills"), F.max(period).alias("last_period"))


def prediction_lookup(predictions: DataFrame, wanted: DataFrame, key: str, period: str) -> DataFrame:
    """Predictions of the wanted (key, period); a null period asks for all of the key."""
    ask = wanted.select(F.col(key).alias("_k"), F.col(period).alias("_p")).distinct()
    same = (F.col(key) == F.col("_k")) & (F.col("_p").isNull() | (F.col(period) == F.col("_p")))
    return predictions.join(ask, same, "left_semi").orderBy(key, period)


def series_findings(results: DataFrame, analysis: str) -> DataFrame:
    """Key, title and conclusion of the published results behind an analysis name."""
    if analysis not in MODULE_OF_ANALYSIS:
        raise ValueError(f"unknown analysis: {analysis}")
    rows = results.where(F.col("modulo") == MODULE_OF_ANALYSIS[analysis])
    return rows.select("clave", F.get_json_object("payload", "$.titulo").alias("titulo"),
                       F.get_json_object("payload", "$.conclusion").alias("conclusion")).orderBy("clave")


# ---------------------------------------------------------------- retrieval
def retrieval_positions(retrieved: DataFrame, questions: DataFrame, question: str, document: str, expected: str,
                        has_evidence: str, threshold: float) -> DataFrame:
    """Per question: first place of the expected document, best similarity, abstention.

    ``retrieved`` holds place and similarity; questions without results keep similarity 0.
    """
    rows = questions.join(retrieved, question, "left")
    place = F.min(F.when(F.col(has_evidence) & (F.col(document) == F.col(expected)), F.col("place")))
    best = F.coalesce(F.max("similarity"), F.lit(0.0))
    out = rows.groupBy(question, has_evidence).agg(place.alias("position"), best.alias("_best"))
    return out.select(question, has_evidence, "position", F.round("_best", 4).alias("best_similarity"),
                      (F.col("_best") < threshold).alias("abstains"))


def retrieval_eval(detail: DataFrame, has_evidence: str) -> DataFrame:
    """recall@1/3/5, MRR, correct and false abstention."""
    yes = F.col(has_evidence)
    n_yes, n_no = F.nullif(F.count_if(yes), F.lit(0)), F.nullif(F.count_if(~yes), F.lit(0))
    return detail.agg(
        F.count_if(yes).alias("with_evidence"), F.count_if(~yes).alias("without_evidence"),
        *[(F.count_if(yes & F.coalesce(F.col("position") <= k, F.lit(False))) / n_yes).alias(f"recall_{k}") for k in RECALL_AT],
        (F.coalesce(F.sum(F.when(yes, 1 / F.col("position"))), F.lit(0.0)) / n_yes).alias("mrr"),
        (F.count_if(~yes & F.col("abstains")) / n_no).alias("correct_abstention"),
        (F.count_if(yes & F.col("abstains")) / n_yes).alias("false_abstention"))


def _balanced(sin_ok: Column, n_sin: Column, con_bad: Column, n_con: Column) -> dict[str, Column]:
    correct = F.coalesce(sin_ok / F.nullif(n_sin, F.lit(0)), F.lit(0.0))
    false = F.coalesce(con_bad / F.nullif(n_con, F.lit(0)), F.lit(0.0))
    return {"correct_abstention": F.round(correct, 4), "false_abstention": F.round(false, 4),
            "balanced": F.round((correct + 1 - false) / 2, 4)}


def threshold_sweep(detail: DataFrame, has_evidence: str, similarity: str, grid=SIMILARITY_GRID) -> DataFrame:
    """Counts and balanced accuracy of abstaining below each threshold of the grid."""
    grid = [float(g) for g in grid]
    below = F.size(F.filter(F.lit(grid), lambda g: g <= F.col(similarity)))  # thresholds that keep the question
    counts = detail.groupBy(F.col(has_evidence).alias("_yes"), below.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    levels = F.array(*[F.struct(F.lit(i + 1).alias("_i"), F.lit(g).alias("threshold")) for i, g in enumerate(grid)])
    spread = counts.select("*", F.inline(levels))
    out, yes = F.col("_b") < F.col("_i"), F.col("_yes")
    some = lambda c: F.sum(F.when(c, F.col("_n")).otherwise(0))
    rows = spread.groupBy("threshold").agg(some(~yes & out).alias("sin_ok"), some(~yes).alias("n_sin"),
                                           some(yes & out).alias("con_bad"), some(yes).alias("n_con"))
    return rows.withColumns(_balanced(*[F.col(c) for c in ("sin_ok", "n_sin", "con_bad", "n_con")]))


def middle_best(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Per group: the middle threshold among those with the greatest balanced accuracy."""
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))  # one row per grid value
    tied = rows.withColumn("_best", F.max("balanced").over(whole)).where(F.col("balanced") == F.col("_best"))
    listed = tied.groupBy(*groups).agg(F.array_sort(F.collect_list("threshold")).alias("_t"))
    return listed.select(*groups, F.element_at("_t", F.floor(F.size("_t") / 2).cast("int") + 1).alias("threshold"))


def leave_one_out(detail: DataFrame, question: str, has_evidence: str, similarity: str, grid=SIMILARITY_GRID) -> DataFrame:
    """Accuracy when each question is judged by the threshold chosen without it.

    Leaving a question out only depends on its kind and on how many thresholds it passes,
    so the grid is re-scored once per such class instead of once per question.
    """
    levels = [float(g) for g in grid]
    passed = F.size(F.filter(F.lit(levels), lambda g: g <= F.col(similarity)))
    classes = detail.groupBy(F.col(has_evidence).alias("_yes"), passed.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    sweep = threshold_sweep(detail, has_evidence, similarity, grid)
    table = sweep.agg(F.collect_list(F.struct("threshold", "sin_ok", "n_sin", "con_bad", "n_con")).alias("_rows"))
    rows = classes.withColumn("_rows", table.scalar()).select("_yes", "_b", "_n", F.inline("_rows"))
    index = F.size(F.filter(F.lit(levels), lambda g: g <= F.col("threshold")))
    out = (F.col("_b") < index).cast("bigint")
    yes = F.col("_yes").cast("bigint")
    less = _balanced(F.col("sin_ok") - (1 - yes) * out, F.col("n_sin") - (1 - yes), F.col("con_bad") - yes * out, F.col("n_con") - yes)
    chosen = middle_best(rows.withColumns(less), ["_yes", "_b", "_n"])
    index_of = F.size(F.filter(F.lit(levels), lambda g: g <= F.col("threshold")))
    kept = F.col("_b") >= index_of
    hit = F.when(F.col("_yes"), kept).otherwise(~kept)
    return chosen.agg((F.sum(F.when(hit, F.col("_n")).otherwise(0)) / F.sum("_n")).alias("accuracy"), F.sum("_n").alias("questions"))
