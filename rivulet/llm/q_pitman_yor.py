"""Query of the language model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import pitman_yor
from rivulet.llm.registry import fold, query, table


@query("op4_language_model")
def op4_language_model(spark: SparkSession, sf: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf, "documents"), fold("doc_id") == 1)
