"""Readers that set broken input aside, with its file and a reason, and keep the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators.retrieval import read_header_documents
from rivulet.session import materialize


@dataclass(frozen=True)
class Loaded:
    """Rows of the declared columns, and (file, line, reason) of the lines that are none."""

    rows: DataFrame
    rejected: DataFrame


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **options) -> Loaded:
    """CSV files with a header line and declared columns.

    A line with another number of fields, or with a field that is no value of its column's type, is rejected whole;
    an empty field is null. The header must name the declared columns in their order. Other ``options`` go to the reader.
    """
    broken, names = "_line", [f.name for f in schema.fields]
    if broken in names:
        raise ValueError(f"a column may not be called {broken}")
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(broken, T.StringType())])).options(
        header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=broken, **options)
    read = materialize(reader.csv(path).select("*", F.col("_metadata.file_path").alias("_file")))
    texts = F.from_csv(broken, ", ".join(f"`{n}` string" for n in names))
    wrong = F.array_compact(F.array(*[
        F.when(texts[f.name].isNotNull() & texts[f.name].try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema.fields]))
    rejected = read.where(F.col(broken).isNotNull()).select(F.col("_file").alias("file"), F.col(broken).alias("line"), wrong.alias("_wrong")).select(
        "file", "line", F.when(F.size("_wrong") > 0, F.concat(F.lit("no value of its type: "), F.array_join("_wrong", ", "))).otherwise("wrong number of fields").alias("reason"))
    return Loaded(read.where(F.col(broken).isNull()).select(*names), rejected)


def read_csv_tables(spark: SparkSession, folder: str, schemas: dict[str, T.StructType]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The named tables of a folder, and the rejected lines of all of them: (table_name, file, line, reason)."""
    loaded = {name: read_csv(spark, f"{folder}/{name}.csv", schema) for name, schema in schemas.items()}
    rejected = spark.createDataFrame([], "table_name string, file string, line string, reason string")
    for name, one in loaded.items():
        rejected = rejected.unionByName(one.rejected.withColumn("table_name", F.lit(name)))
    return {name: one.rows for name, one in loaded.items()}, rejected


def read_document_folder(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """One row per file of a folder: file, title, kind, source, url, body, and ``problem`` where the header is not complete.

    Files are read whole, a file per row; other names than ``pattern`` are left out. Spark lists no file of
    length 0, so such a one has no row.
    """
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=pattern).select(F.col("_metadata.file_name").alias("file"), "value")
    return read_header_documents(files).select("file", "title", "kind", "source", "url", "body", "problem")
