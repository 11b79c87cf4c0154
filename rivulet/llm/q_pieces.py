"""Query of the SentencePiece encoder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import pieces
from rivulet.llm.registry import query, table

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


@query("op9_sentencepiece")
def op9_sentencepiece(spark: SparkSession, sf: str, model_file: str = MODEL_FILE) -> DataFrame:
    vocabulary = pieces.Vocabulary.load(model_file)
    documents = table(spark, sf, "documents").select("doc_id", "text")
    found = pieces.encode_and_decode(documents, vocabulary)
    return found.select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.coalesce("ids", F.array().cast("array<int>")).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))
