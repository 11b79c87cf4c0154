"""Query of the toxicity model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import toxicity
from rivulet.llm.registry import fold, query, table


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    model = toxicity.fit(documents, labels.where(fold("doc_id") != 0))
    found = toxicity.predict(documents.withColumn("held_out", fold("doc_id") == 0), model)
    return found.select("doc_id", "held_out", F.col("toxic_score").alias("score"), F.col("toxic_predicted").alias("predicted"))
