"""Tariff lookup and bill breakdown, in decimal arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Tariff names, rates and quarter switch the results depend on.
TARIFF_OF_CUSTOMER = {
    "domestico": "domestico_medio",
    "comercial": "comercial",
    "publico": "publico_oficial",
    "industrial": "industrial",
}
DOMESTIC_TARIFFS = ("domestico_apoyo", "domestico_economico", "domestico_medio", "domestico_alto", "domestico_rural")
SEWER_RATE, TREATMENT_RATE, VAT_RATE = "0.10", "0.12", "0.16"
QUARTER_SWITCH, QUARTER_BEFORE, QUARTER_AFTER = "2026-07", "2026-T2", "2026-T3"

MONEY = "decimal(12,2)"


def _rate(value: str) -> Column:
    return F.lit(value).cast("decimal(3,2)")


def money(c: Column) -> Column:
    return F.round(c, 2).cast(MONEY)


def tariff_quarter(
    period: Column, switch: str = QUARTER_SWITCH, before: str = QUARTER_BEFORE, after: str = QUARTER_AFTER
) -> Column:
    return F.when(period >= switch, F.lit(after)).otherwise(F.lit(before))


def round_half_up_int(x: Column) -> Column:
    return F.floor(F.coalesce(x, F.lit(0.0)) + F.lit(0.5)).cast("int")


def tariff_types(table: DataFrame, quarter: str) -> DataFrame:
    return table.where(F.col("quarter") == quarter).select("tariff").distinct().orderBy("tariff")


def water_amount(bills: DataFrame, table: DataFrame, *, tariff: str, m3: str, quarter: str, out: str = "water") -> DataFrame:
    """Amount for (quarter, tariff, whole m3); a missing m3 takes the amount of the largest one.

    ``table`` has quarter, tariff, m3, amount. A (quarter, tariff) outside the table is an error.
    """
    exact = table.select(F.col("quarter").alias(quarter), F.col("tariff").alias(tariff), F.col("m3").alias("_m3"),
                         F.col("amount").alias("_exact"))
    top = table.groupBy(F.col("quarter").alias(quarter), F.col("tariff").alias(tariff)).agg(
        F.max_by("amount", "m3").alias("_top"))
    unknown = F.raise_error(F.concat(F.lit("no tariff "), F.col(tariff), F.lit(" in "), F.col(quarter)))
    return (
        bills.withColumn("_m3", round_half_up_int(F.col(m3)))
        .join(exact, [quarter, tariff, "_m3"], "left")
        .join(top, [quarter, tariff], "left")
        .withColumn(out, F.coalesce("_exact", "_top", unknown.cast(MONEY)))
        .withColumnRenamed("_m3", "billed_m3")
        .drop("_exact", "_top")
    )


def bill_breakdown(df: DataFrame, *, water: str, m3: str, tariff: str, sewer: str, treatment: str,
                   domestic=DOMESTIC_TARIFFS) -> DataFrame:
    """Sewer, treatment, subtotal (the whole charge, rounded once), VAT and total.

    The subtotal may differ by a cent from the sum of the rounded parts. Negative or
    missing consumption is an error.
    """
    negative = F.raise_error(F.lit("consumption must be a number of at least 0"))
    base = F.when(F.coalesce(F.col(m3) >= 0, F.lit(False)), money(F.col(water))).otherwise(negative.cast(MONEY))
    df = df.withColumn(water, base)
    w, zero = F.col(water), F.lit(0).cast(MONEY)
    sewer_part = F.when(F.col(sewer), w * _rate(SEWER_RATE)).otherwise(F.lit(0).cast("decimal(16,4)"))
    treat_part = F.when(F.col(treatment), w * _rate(TREATMENT_RATE)).otherwise(F.lit(0).cast("decimal(16,4)"))
    df = df.withColumns({
        "sewer_amount": money(sewer_part),
        "treatment_amount": money(treat_part),
        "subtotal": money(w + sewer_part + treat_part),
    })
    vat = F.when(F.col(tariff).isin(*domestic), zero).otherwise(money(F.col("subtotal") * _rate(VAT_RATE)))
    return df.withColumn("vat", vat).withColumn("total", (F.col("subtotal") + F.col("vat")).cast(MONEY))


def recompute_bills(bills: DataFrame, table: DataFrame, *, period: str, tariff: str, m3: str, sewer: str,
                    treatment: str, domestic=DOMESTIC_TARIFFS, switch: str = QUARTER_SWITCH) -> DataFrame:
    """Quarter, water amount and breakdown for every bill."""
    priced = water_amount(bills.withColumn("quarter", tariff_quarter(F.col(period), switch)), table,
                          tariff=tariff, m3=m3, quarter="quarter")
    return bill_breakdown(priced, water="water", m3=m3, tariff=tariff, sewer=sewer, treatment=treatment, domestic=domestic)


def tariff_documents(table: DataFrame, quarter: str, names: dict[str, str] | None = None, block: int = 10) -> DataFrame:
    """One text per tariff of a quarter: blocks of ``block`` rows and a sentence on the maximum.

    A tariff has one row per whole m3, so its list is bounded by the tariff table.
    """
    label = F.col("tariff")
    if names:
        lookup = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
        label = F.coalesce(lookup[F.col("tariff")], F.col("tariff"))
    rows = (
        table.where(F.col("quarter") == quarter)
        .groupBy("tariff")
        .agg(F.array_sort(F.collect_list(F.struct("m3", "amount"))).alias("rows"))
        .withColumn("name", label)
    )
    price = lambda r: F.concat(r["m3"].cast("string"), F.lit(" m³ = $"), F.format_number(r["amount"], 2))

    def paragraph(i):
        part = F.slice(F.col("rows"), i * block + 1, block)
        return F.concat(
            F.lit("Tarifa "), F.col("name"), F.lit(" ("), F.col("tariff"), F.lit(f"), periodo {quarter}, importe de agua de "),
            F.element_at(part, 1)["m3"].cast("string"), F.lit(" a "), F.element_at(part, -1)["m3"].cast("string"),
            F.lit(" m³: "), F.array_join(F.transform(part, price), "; "), F.lit("."))

    last = F.element_at("rows", -1)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("rows") - 1) / block).cast("int")), paragraph)
    above = F.concat(F.lit("Si el consumo de la tarifa "), F.col("name"), F.lit(" supera "), last["m3"].cast("string"),
                     F.lit(" m³ se cobra el importe de "), last["m3"].cast("string"), F.lit(" m³ ($"),
                     F.format_number(last["amount"], 2), F.lit(")."))
    return rows.select(
        "tariff", F.concat(F.lit(f"Tarifario {quarter}: "), F.col("name")).alias("title"),
        F.array_join(F.concat(blocks, F.array(above)), "\n\n").alias("text"))
