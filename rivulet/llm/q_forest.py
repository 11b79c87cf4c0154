"""Query of the nearest-neighbour forest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import forest
from rivulet.llm.registry import query, table


@query("op1_nearest")
def op1_nearest(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return forest.nearest(rows, F.col("vec_id") % 20 == 0, 20)
