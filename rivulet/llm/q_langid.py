"""Query of the language identifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import langid
from rivulet.llm.registry import fold, query, table


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = langid.fit(documents.where(fold("doc_id") != 0))
    read = documents.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "text")
    found = langid.predict(read, model)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), "lang_accepted")
