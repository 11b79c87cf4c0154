"""Cleaning of readings and bills: de-duplication, flags, censoring, calendar columns, quality report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.text import strip_white

#: Columns that only the data generator knows and that never leave cleaning.
HIDDEN_COLUMNS = ("consumo_base", "propension_mora")


def load_tables(spark, folder: str, schemas: dict[str, T.StructType], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read the named tables of a folder with declared schemas; nothing is inferred."""
    reader = spark.read
    out = {}
    for name, schema in schemas.items():
        r = reader.schema(schema)
        out[name] = r.csv(f"{folder}/{name}.csv", header=True) if fmt == "csv" else r.parquet(f"{folder}/{name}.parquet")
    return out


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """One row: table name, rows, columns and null cells, from one scan."""
    nulls = reduce(lambda a, b: a + b, [F.count(F.lit(1)) - F.count(F.col(c)) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.alias("null_cells")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), "null_cells"
    )


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile_table(df, name) for name, df in tables.items()])


def require_columns(df: DataFrame, columns) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def load_complaints(df: DataFrame, text: str, category: str, extra=()) -> DataFrame:
    """Fail when a needed column is missing; drop rows without text or category; text as string."""
    require_columns(df, [text, category, *extra])
    return df.dropna(subset=[text, category]).withColumn(text, F.col(text).cast("string"))


def dedupe_keep_latest(df: DataFrame, keys: list[str], latest: list[str]) -> DataFrame:
    """Keep, per key, the row that is greatest by ``latest`` and then by the remaining columns.

    An aggregate, not a window: map tasks reduce a hot key to one row before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest]
    best = F.max(F.struct(*latest, *rest)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*[F.col(k) if k in keys else F.col("_row")[k].alias(k) for k in df.columns])


def flag_readings(df: DataFrame, initial: str, final: str) -> DataFrame:
    """Mark null and backward readings; values stay as they are."""
    null_reading = F.col(final).isNull()
    backward = F.coalesce(F.col(final) < F.col(initial), F.lit(False))
    return df.withColumns(
        {"null_reading": null_reading, "backward": backward, "inconsistent": null_reading | backward}
    )


def map_values(df: DataFrame, column: str, mapping: dict[str, str], out: str, strict: bool = True) -> DataFrame:
    """Translate a column through a dictionary; an unknown value is an error when ``strict``."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = pairs[F.col(column)]
    if strict:
        unknown = F.raise_error(F.concat(F.lit(f"unknown {column}: "), F.coalesce(F.col(column), F.lit("null"))))
        hit = F.coalesce(hit, unknown.cast("string"))
    return df.withColumn(out, hit)


def censor_labels(
    df: DataFrame, cutoff: str, *, label: str = "late", due: str = "due", paid: str = "paid", paid_on: str = "paid_on"
) -> DataFrame:
    """Label with censoring at ``cutoff``.

    Unpaid and due by the cutoff counts as late. Bills due after it carry no label
    and ``trainable`` is false. ``paid_without_date`` and ``overdue_unpaid`` mark the
    rows the quality report counts.
    """
    known_due = F.coalesce(F.col(due) <= F.lit(cutoff).cast("date"), F.lit(False))
    is_paid = F.coalesce(F.col(paid), F.lit(False))
    overdue = F.col(label).isNull() & known_due & ~is_paid
    return df.withColumns(
        {
            "overdue_unpaid": overdue,
            "paid_without_date": is_paid & F.col(paid_on).isNull(),
            "trainable": known_due,
            label: F.when(known_due, F.when(overdue, F.lit(True)).otherwise(F.col(label))),
        }
    )


def calendar_features(
    df: DataFrame, *, period: str = "period", since: str = "since", due: str = "due", paid_on: str = "paid_on"
) -> DataFrame:
    """Period date, year, month, tenure in months of 30.44 days and days late (null while unpaid)."""
    month = F.to_date(F.concat(F.col(period), F.lit("-01")))
    late_days = F.datediff(F.col(paid_on), F.col(due))
    return df.withColumns(
        {
            "period_date": month,
            "year": F.year(month),
            "month": F.month(month),
            "tenure_months": F.round(F.datediff(month, F.col(since)) / F.lit(30.44), 1),
            "days_late": F.when(late_days.isNotNull(), F.greatest(late_days, F.lit(0))),
        }
    )


def drop_hidden(df: DataFrame, hidden=HIDDEN_COLUMNS) -> DataFrame:
    return df.drop(*hidden)


def count_step(step: str, result: Column) -> Column:
    """One (step, result) entry of a quality report, to be used inside an aggregate."""
    return F.struct(F.lit(step).alias("step"), result.cast("bigint").alias("result"))


def quality_report(parts: list[tuple[DataFrame, list[tuple[str, Column]]]]) -> DataFrame:
    """Ordered (step_order, step, result) rows; every table is aggregated once."""
    frames, order = [], 0
    for df, checks in parts:
        steps = F.array(*[
            F.struct(F.lit(order + i).alias("step_order"), F.lit(name).alias("step"), expr.cast("bigint").alias("result"))
            for i, (name, expr) in enumerate(checks)
        ])
        frames.append(df.agg(steps.alias("steps")).select(F.inline("steps")))
        order += len(checks)
    return reduce(DataFrame.unionByName, frames)


def recent_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """Rows of the ``n`` greatest distinct periods."""
    newest = df.select(period).distinct().orderBy(F.col(period).desc()).limit(n)
    return df.join(F.broadcast(newest), period, "left_semi")


def drop_short_text(df: DataFrame, text: str, least: int = 10) -> DataFrame:
    return df.where(F.length(strip_white(F.col(text))) >= least)


def min_examples(df: DataFrame, category: str, least: int = 20) -> DataFrame:
    """Rows per class and whether the class has enough of them."""
    return df.groupBy(category).agg(F.count(F.lit(1)).alias("n")).withColumn("enough", F.col("n") >= least)
