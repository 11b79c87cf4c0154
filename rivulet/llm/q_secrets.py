"""Query of the secret scanner."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import secrets
from rivulet.llm.registry import query, table

#: Documents from which the labelled samples of the Markov models are taken.
SAMPLE_ROWS = 2_000


def fitted(documents: DataFrame) -> secrets.MarkovModel:
    sample = secrets.hash_sample(documents.select("doc_id", "text"), "doc_id", SAMPLE_ROWS)
    return secrets.train(secrets.labelled_samples(sample, "doc_id", "text"), "value", "label")


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    found = secrets.scan(documents, fitted(documents))
    return found.select(
        "doc_id", *[secrets.count_kind("base", k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.describe("base"), 256).alias("base_sha256"), secrets.describe("spans").alias("spans"))
