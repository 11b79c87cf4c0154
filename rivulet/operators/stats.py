"""Hypothesis tests and intervals from aggregates; the p-value is computed on the one result row."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.pvalues import chi2_sf, t_sf2
from rivulet.operators.ranks import average_ranks
from rivulet.session import materialize

Z95 = 1.959964  # fixed value: the normal quantile of the published intervals
ALPHA = 0.05


def decision(p: Column, alpha: float = ALPHA) -> Column:
    return F.when(p < alpha, "se rechaza H0").otherwise("no se rechaza H0")


def kruskal_wallis(df: DataFrame, group: str, value: str, least: int = 5) -> DataFrame:
    """H with tie correction over groups of at least ``least`` rows; one row."""
    pairs = materialize(df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_c")))
    big = pairs.groupBy(group).agg(F.sum("_c").alias("_size")).where(F.col("_size") >= least).select(group)
    kept = pairs.join(big, group, "left_semi")
    ranks = average_ranks(kept, value, weight="_c", out="_rank")
    rank_sums = kept.join(ranks.select(value, "_rank"), value).groupBy(group).agg(
        F.sum(F.col("_c") * F.col("_rank")).alias("r"), F.sum("_c").alias("n"))
    ties = ranks.agg(F.sum(F.pow(F.col("n"), 3.0) - F.col("n")).alias("ties")).select("ties").scalar()
    n, k = F.col("n").cast("double"), F.col("groups")
    raw = 12 / (n * (n + 1)) * F.col("spread") - 3 * (n + 1)
    out = rank_sums.agg(F.sum(F.col("r") * F.col("r") / F.col("n")).alias("spread"), F.sum("n").alias("n"),
                        F.count(F.lit(1)).alias("groups"))
    out = out.withColumn("h", raw / (1 - ties / (n * n * n - n)))
    return out.select("groups", "n", (k - 1).alias("df"), "h", ((F.col("h") - k + 1) / (n - k)).alias("epsilon2"))


def chi2_independence(table: DataFrame, a: str, b: str) -> DataFrame:
    """2x2 chi-square with Yates correction and Cramer's V from a two-row crosstab with columns a and b."""
    cells = table.agg(*[f.alias(n) for n, f in (
        ("n", F.sum(F.col(a) + F.col(b))), ("ca", F.sum(a)), ("cb", F.sum(b)),
        ("rows", F.collect_list(F.struct(F.col(a).alias("a"), F.col(b).alias("b")))))])  # a crosstab has two rows
    total = F.col("n").cast("double")

    def term(i: int, cell: str, col_total: str) -> Column:
        row = F.element_at("rows", i)
        expected = (row["a"] + row["b"]) * F.col(col_total) / total
        gap = F.abs(row[cell] - expected)
        return F.pow(gap - F.least(F.lit(0.5), gap), 2.0) / expected

    chi2 = term(1, "a", "ca") + term(1, "b", "cb") + term(2, "a", "ca") + term(2, "b", "cb")
    return cells.select("n", F.lit(1).alias("df"), chi2.alias("chi2"), F.sqrt(chi2 / total).alias("cramers_v"))


def wilson_interval(successes: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """Lower and upper bound; NaN for n = 0."""
    some = F.when(n > 0, n.cast("double"))
    p = successes / some
    den = 1 + z * z / some
    centre = (p + z * z / (2 * some)) / den
    margin = z * F.sqrt(p * (1 - p) / some + z * z / (4 * some * some)) / den
    nan = F.lit(float("nan"))
    return F.coalesce(centre - margin, nan), F.coalesce(centre + margin, nan)


def wilson_by_segments(rates: DataFrame) -> DataFrame:
    """``rate_by_segments`` rows with their interval and its width."""
    low, high = wilson_interval(F.round(F.col("rate") * F.col("n")), F.col("n"))
    return rates.withColumns({"low": low, "high": high, "width": high - low})


def spearman_matrix(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """rho and n of every pair of columns, ties averaged; rows with a null in any column are left out."""
    rows = df.dropna(subset=columns)
    long = rows.select(key, F.inline(F.array(*[
        F.struct(F.lit(c).alias("_var"), F.col(c).cast("double").alias("_x")) for c in columns])))
    ranks = average_ranks(long, "_x", ["_var"], out="_rank").select("_var", "_x", "_rank")
    wide = long.join(ranks, ["_var", "_x"]).groupBy(key).pivot("_var", columns).agg(F.max("_rank"))
    pairs = list(combinations(columns, 2))
    stats = wide.agg(F.count(F.lit(1)).alias("n"), *[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    return stats.select("n", F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("rho")) for i, (a, b) in enumerate(pairs)])))


def spearman_p(out: DataFrame) -> DataFrame:
    """Add ``p_value``; a perfect rank correlation has 0, and up to two rows have none."""
    free = (F.col("n") - 2).cast("double")
    rest = F.nullif(F.greatest(F.lit(0.0), 1 - F.col("rho") * F.col("rho")), F.lit(0.0))
    t = F.when(free > 0, F.col("rho") * F.sqrt(free / rest))
    p = t_sf2(F.coalesce(t, F.lit(0.0)), F.greatest(free, F.lit(1.0)))
    return out.withColumn("p_value", F.when(free <= 0, F.lit(None).cast("double")).when(rest.isNull(), 0.0).otherwise(p))


def strongest_with(out: DataFrame, target: str) -> DataFrame:
    """The other variable of the pair with the greatest |rho| that holds ``target``."""
    pairs = out.where((F.col("a") == target) | (F.col("b") == target))
    other = F.when(F.col("a") == target, F.col("b")).otherwise(F.col("a"))
    return pairs.select(other.alias("variable"), "rho").orderBy(F.abs("rho").desc(), "variable").limit(1)


def welch(n1: Column, m1: Column, v1: Column, n2: Column, m2: Column, v2: Column) -> tuple[Column, Column]:
    """t and degrees of freedom for two samples with unequal variances (sample variances given)."""
    a, b = v1 / n1, v2 / n2
    return (m1 - m2) / F.sqrt(a + b), (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1))


def welch_t(df: DataFrame, value: str, flag: Column) -> DataFrame:
    """Welch test of ``value`` between rows where ``flag`` is true and false; one row."""
    yes, no = F.when(flag, F.col(value)), F.when(~flag, F.col(value))
    out = df.agg(*[f.alias(n) for n, f in (
        ("n1", F.count(yes)), ("m1", F.avg(yes)), ("v1", F.var_samp(yes)), ("n2", F.count(no)), ("m2", F.avg(no)), ("v2", F.var_samp(no)))])
    t, dof = welch(*[F.col(c) for c in ("n1", "m1", "v1", "n2", "m2", "v2")])
    return out.select("n1", "n2", t.alias("t"), dof.alias("df"))


def with_chi2_p(df: DataFrame, statistic: str, dof: str = "df") -> DataFrame:
    out = df.withColumn("p_value", chi2_sf(F.col(statistic).cast("double"), F.col(dof).cast("double")))
    return out.withColumn("decision", decision(F.col("p_value")))


def with_t_p(df: DataFrame) -> DataFrame:
    out = df.withColumn("p_value", t_sf2(F.col("t"), F.col("df").cast("double")))
    return out.withColumn("decision", decision(F.col("p_value")))
