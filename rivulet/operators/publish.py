"""Result payloads, upserts, current view, constraints, and table writers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.scalars import six_significant
from rivulet.functions.text import strip_white

# Payload kinds, their required texts, the modules, and the keys a box needs.
KINDS = ("linea", "barras", "dispersion", "histograma", "caja", "tabla", "texto", "metrica")
REQUIRED = ("titulo", "conclusion", "fuente")
MODULES = ("pipeline", "eda", "estadistica", "series", "fourier", "wavelets", "ml", "clustering", "dl", "nlp", "embeddings",
           "llm", "rag_eval", "agente_eval")
BOX_KEYS = ("min", "q1", "mediana", "q3", "max")


def clean_numbers(df: DataFrame) -> DataFrame:
    """Every double, also inside arrays, to six significant digits; NaN and infinities to null."""

    def clean(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return six_significant(F.col(f.name).cast("double")).alias(f.name)
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.DoubleType, T.FloatType)):
            return F.transform(F.col(f.name), lambda x: six_significant(x.cast("double"))).alias(f.name)
        return F.col(f.name)

    return df.select(*[clean(f) for f in df.schema.fields])


def publish_results(df: DataFrame, module: str, key: Column, payload: Column, version: str = "v1") -> DataFrame:
    """(modulo, clave, version, payload) with the payload as JSON; one without its required parts is an error."""
    if module not in MODULES:
        raise ValueError(f"unknown module: {module}")
    rows = df.select(key.alias("clave"), payload.alias("_p"))
    broken = F.lit(False)
    for name in ("tipo", *REQUIRED):
        broken = broken | F.col("_p")[name].isNull()
    broken = broken | ~F.col("_p")["tipo"].isin(*KINDS)
    text = F.when(~broken, F.to_json("_p", {"ignoreNullFields": "false"})).otherwise(
        F.raise_error(F.concat(F.lit("invalid payload: "), F.col("clave"))).cast("string"))
    return rows.select(F.lit(module).alias("modulo"), "clave", F.lit(version).alias("version"), text.alias("payload"))


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """Rows of both sides, the latest arrival per key; incoming rows win a tie."""
    both = existing.withColumn("_side", F.lit(0)).unionByName(incoming.withColumn("_side", F.lit(1)))
    rest = [c for c in existing.columns if c not in (*keys, arrival)]
    best = F.max(F.struct(arrival, "_side", *rest)).alias("_r")
    return both.groupBy(*keys).agg(best).select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in existing.columns])


def insert_ignore(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows plus incoming rows of new keys, one per key (the smallest row)."""
    rest = [c for c in incoming.columns if c not in keys]
    one = incoming.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
    return existing.unionByName(one.join(existing, keys, "left_anti"))


def current_results(results: DataFrame) -> DataFrame:
    """Latest row per (modulo, clave)."""
    rest = [c for c in results.columns if c not in ("modulo", "clave", "creado_en")]
    return results.groupBy("modulo", "clave").agg(F.max(F.struct("creado_en", *rest)).alias("_r")).select("modulo", "clave", "_r.*")


def results_by_module(results: DataFrame, modules: list[str]) -> DataFrame:
    return current_results(results.where(F.col("modulo").isin(*modules))).orderBy("modulo", "clave")


def write_results(results: DataFrame, path: str) -> None:
    """JSON files, an entry per line, in a folder per module."""
    entry = F.struct("modulo", "clave", "version", F.try_parse_json("payload").alias("payload"))
    results.select(F.col("modulo").alias("m"), F.to_json(entry).alias("value")).write.partitionBy("m").text(path)


def read_results(spark: SparkSession, path: str, lists: bool = False) -> DataFrame:
    """Result files: {modulo, clave, version, payload} per line, or one JSON ``list`` of them per file; the payload stays JSON text."""
    found = spark.read.schema("modulo string, clave string, version string, payload string").json(path, multiLine=lists)
    return found.select("modulo", "clave", "version", "payload")


def replace_version(df: DataFrame, path: str, version: str) -> None:
    """Overwrite only the partitions of the versions in ``df``."""
    df.write.partitionBy(version).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def project_for_load(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each table under ``folder``; returns the paths."""
    paths = {name: f"{folder}/{name}" for name in tables}
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        writer.csv(paths[name], header=True) if fmt == "csv" else writer.format(fmt).save(paths[name])
    return paths


# ---------------------------------------------------------------- payload shape
def _kind_of(v: Column) -> Column:
    """First word of a JSON value's type: OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, VOID ..."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _is(v: Column, *kinds: str) -> Column:
    return F.coalesce(_kind_of(v).isin(*kinds), F.lit(False))


def _number(v: Column) -> Column:
    return _is(v, "BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def _at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _items(v: Column, path: str) -> Column:
    """Array elements as variants, null when there is no array."""
    return F.try_variant_get(v, path, "array<variant>")


def validate_payload(df: DataFrame, payload: str) -> DataFrame:
    """Add ``ok`` and ``reason``: the first shape rule the JSON payload breaks."""
    v = F.try_parse_json(F.col(payload))
    df = df.withColumn("_v", v)
    p = F.col("_v")
    kind = F.try_variant_get(p, "$.tipo", "string")
    texts = [F.when(~_is(_at(p, f"$.{f}"), "STRING") | (strip_white(F.try_variant_get(p, f"$.{f}", "string")) == ""), f"falta «{f}»") for f in REQUIRED]
    rows, series, xs = _items(p, "$.filas"), _items(p, "$.series"), _items(p, "$.x.valores")
    has_rows = F.coalesce(F.size(rows) > 0, F.lit(False))
    rows_bad = _at(p, "$.filas").isNotNull() & ~F.coalesce(F.forall(rows, lambda r: _is(r, "OBJECT")), F.lit(False))
    no_series = ~F.coalesce(F.size(series) > 0, F.lit(False))
    values = lambda s: _items(s, "$.valores")
    any_series = lambda test: F.coalesce(F.exists(series, test), F.lit(False))
    missing_values = any_series(lambda s: values(s).isNull())
    own_x = lambda s: F.coalesce(_items(s, "$.x"), xs)
    numeric = lambda a: F.forall(a, _number)
    scatter = (
        F.when(no_series, "falta «series»").when(missing_values, "cada serie necesita «valores»")
        .when(any_series(lambda s: own_x(s).isNull()), "una serie no trae «x»")
        .when(any_series(lambda s: F.size(own_x(s)) != F.size(values(s))), "x y valores de distinto largo")
        .when(any_series(lambda s: ~numeric(own_x(s)) | ~numeric(values(s))), "valores no numéricos"))
    lines = (
        F.when(~F.coalesce(F.size(xs) > 0, F.lit(False)), "falta x.valores").when(no_series, "falta «series»")
        .when(missing_values, "cada serie necesita «valores»")
        .when(any_series(lambda s: F.size(values(s)) != F.size(xs)), "x y valores de distinto largo")
        .when(any_series(lambda s: ~F.forall(values(s), lambda x: _number(x) | _is(x, "VOID"))), "valores no numéricos"))

    def boxed(s: Column) -> Column:
        quartiles = reduce(lambda a, c: a & c, [_number(_at(s, f"$.{k}")) for k in BOX_KEYS])
        return quartiles | F.coalesce(F.exists(values(s), _number), F.lit(False))

    box = F.when(no_series, "falta «series»").when(any_series(lambda s: ~_is(s, "OBJECT") | ~boxed(s)), "sin cuartiles ni valores")
    metric_rows = F.coalesce(F.forall(rows, lambda r: (F.coalesce(strip_white(F.try_variant_get(r, "$.indicador", "string")), F.lit("")) != "")
                                      & _at(r, "$.valor").isNotNull()), F.lit(False))
    metric = F.when(has_rows & ~metric_rows, "cada fila necesita «indicador» y «valor»").when(
        ~has_rows & _at(p, "$.valor").isNull(), "la métrica no trae «valor» ni «filas»")
    reason = F.coalesce(
        F.when(~_is(p, "OBJECT"), "el payload no es un objeto"),
        F.when(~F.coalesce(kind.isin(*KINDS), F.lit(False)), "tipo desconocido"), *texts,
        F.when(rows_bad, "«filas» debe ser una lista de objetos"),
        F.when(kind == "dispersion", scatter), F.when(kind.isin("linea", "barras", "histograma"), lines),
        F.when(kind == "caja", box), F.when((kind == "tabla") & ~has_rows, "la tabla no trae «filas»"), F.when(kind == "metrica", metric))
    return df.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull()).drop("_v")


# ---------------------------------------------------------------- constraints
def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations): rows on which a rule is false; one scan for all rules. Unknown passes, as in SQL CHECK."""
    counts = df.agg(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.count_if(~rule).alias("violations")) for name, rule in rules.items()]).alias("_c"))
    return counts.select(F.inline("_c"))


def check_unique(df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """Keys that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def check_foreign_key(df: DataFrame, key: str, parent: DataFrame, parent_key: str, rule: str) -> DataFrame:
    """Rows whose key has no parent; a null key passes."""
    orphans = df.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def both_or_neither(a: Column, b: Column) -> Column:
    return a.isNull() == b.isNull()


def check_constraints(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
