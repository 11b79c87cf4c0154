"""Complaint triage by rules: category correction, priority, input checks, and the final table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import first_phrase, leaking_water, mask_pii, normalize_text, squeeze_spaces, strip_white, truncate_ellipsis

# Categories with their base priority, names of priorities, urgent words.
BASE_PRIORITY = {
    "sin_agua": 2, "fuga_calle": 2, "drenaje": 2, "calidad_agua": 2,
    "fuga_toma": 1, "baja_presion": 1, "medidor": 1, "facturacion": 1, "atencion": 1,
}
UNKNOWN_BASE = 1
PRIORITY_NAMES = {0: "baja", 1: "normal", 2: "alta", 3: "urgente"}
URGENT_WORDS = ("hospital", "clinica", "escuela", "guarderia", "enfermo", "enferma", "enfermos", "bebe", "bebes", "embarazada",
                "inunda", "inundado", "inundada", "inundacion", "socavon", "hundimiento", "hundio")

# Phrases of the category rules.
PUBLIC_WAY = ("banqueta", "calle", "via publica", "avenida", "esquina", "camellon", "pavimento", "asfalto")
WATER_OUT = ("fuga", "sale agua", "brota", "tira agua", "charco", "escurre", "chorro", "se desperdicia")
NO_WATER = ("no hay agua", "sin agua", "no llega agua", "no llega el agua", "no tengo agua", "no tenemos agua",
            "sin servicio de agua", "no sale agua")
INSIDE = ("dentro de mi casa", "dentro de la casa", "mi toma", "mi medidor", "mi tuberia")
LEAK_CLASSES = ("fuga_calle", "fuga_toma", "baja_presion")

# Length limits.
TEXT_MIN, TEXT_MAX, SUMMARY_MIN, SUMMARY_MAX = 5, 2000, 5, 200


# The reasons in correct_category and priority are worded as the published results have them.
def correct_category(category: Column, normalized: Column) -> Column:
    """struct(category, reason): leak on the public way, or no water without a leak; reason null when unchanged."""
    way = first_phrase(normalized, PUBLIC_WAY)
    water = F.coalesce(first_phrase(normalized, WATER_OUT), leaking_water(normalized))
    dry = first_phrase(normalized, NO_WATER)
    inside = first_phrase(normalized, INSIDE)
    said = F.concat(F.lit(" (el modelo dijo "), category, F.lit(")"))
    in_street = (category == "fuga_toma") & way.isNotNull() & water.isNotNull() & inside.isNull()
    no_service = category.isin(*LEAK_CLASSES) & dry.isNotNull() & water.isNull()
    return (
        F.when(in_street, F.struct(F.lit("fuga_calle").alias("category"), F.concat(
            F.lit("regla vía pública: "), way, F.lit(" + "), water, F.lit(" → fuga_calle"), said).alias("reason")))
        .when(no_service, F.struct(F.lit("sin_agua").alias("category"), F.concat(
            F.lit("regla sin servicio: «"), dry, F.lit("» sin mención de fuga → sin_agua"), said).alias("reason")))
        .otherwise(F.struct(category.alias("category"), F.lit(None).cast("string").alias("reason")))
    )


def priority(category: Column, normalized: Column, risk: Column) -> Column:
    """struct(priority, reasons): base of the category, 3 with an urgent word, one more (up to 3) with a risk flag."""
    base_of = F.create_map(*[F.lit(x) for kv in BASE_PRIORITY.items() for x in kv])
    name_of = F.create_map(*[F.lit(x) for kv in PRIORITY_NAMES.items() for x in kv])
    base = F.coalesce(base_of[category], F.lit(UNKNOWN_BASE))
    urgent = F.array_sort(F.array_intersect(F.split(normalized, " "), F.array(*[F.lit(w) for w in URGENT_WORDS])))
    level = F.when(F.size(urgent) > 0, F.lit(3)).otherwise(base)
    raised = F.coalesce(risk, F.lit(False)) & (level < 3)
    reasons = F.array(
        F.concat(F.lit("base por categoría "), category, F.lit(": "), name_of[base]),
        F.when(F.size(urgent) > 0, F.concat(F.lit("términos de urgencia: "), F.array_join(urgent, ", "))),
        F.when(raised, F.lit("el LLM señaló riesgo: +1")))
    return F.struct((level + raised.cast("int")).alias("priority"), F.array_compact(reasons).alias("reasons"))


def input_problem(text: Column) -> Column:
    """Why a text is rejected, or null."""
    n = F.length(strip_white(text))
    return F.when(text.isNull() | (n < TEXT_MIN), "too short").when(F.length(text) > TEXT_MAX, "too long")


def answer_problem(summary: Column, category: Column, level: Column, categories) -> Column:
    """Why a logged model answer is rejected, or null."""
    return (
        F.when(~F.coalesce(F.length(summary).between(SUMMARY_MIN, SUMMARY_MAX), F.lit(False)), "summary")
        .when(~F.coalesce(category.isin(*categories), F.lit(False)), "category")
        .when(~F.coalesce(level.between(0, 3), F.lit(False)), "priority")
    )


def triage_table(rows: DataFrame, *, text: str, category: str, known: str, llm_category: str, llm_summary: str, llm_risk: str) -> DataFrame:
    """Rows classified by the text model to final category, priority, summary and validity.

    The logged language-model answer is optional per row: it gives the summary and may
    raise the priority; without it the summary is the masked text, cut to length.
    """
    rows = rows.withColumn("_norm", normalize_text(F.col(text)))
    rows = rows.withColumn("_fixed", correct_category(F.col(category), F.col("_norm")))
    final = F.col("_fixed")["category"]
    answered = F.col(llm_category).isNotNull()
    rows = rows.withColumn("_prio", priority(final, F.col("_norm"), answered & F.col(llm_risk)))
    agrees = answered & (F.col(llm_category) == final)
    fallback = truncate_ellipsis(squeeze_spaces(mask_pii(strip_white(F.col(text)))), SUMMARY_MAX)
    return rows.withColumns({
        "final_category": final, "rule": F.col("_fixed")["reason"], "priority": F.col("_prio")["priority"],
        "reasons": F.col("_prio")["reasons"], "agreement": F.when(answered, agrees),
        "valid": agrees & F.col(known), "summary": F.when(answered, F.col(llm_summary)).otherwise(fallback),
    }).drop("_norm", "_fixed", "_prio")
