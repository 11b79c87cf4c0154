"""Query of the benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import leaks
from rivulet.llm.registry import query, table


@query("op7_decontaminate")
def op7_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """One row per document and benchmark item found in it; clean documents have none."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    benchmark = table(spark, sf, "benchmark")
    found = leaks.mark(documents, benchmark).select("doc_id", F.explode("leak_hits").alias("h"))
    kind = benchmark.schema["item_id"].dataType
    return found.groupBy("doc_id", F.col("h.item").cast(kind).alias("item_id")).agg(F.min("h.distance").cast("bigint").alias("distance"))
