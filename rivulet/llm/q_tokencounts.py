"""Query of the token counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import tokencounts
from rivulet.llm.registry import query, table

#: Tokens above which a text is over the limit.
LIMIT = 1024


@query("op12_token_counts")
def op12_token_counts(spark: SparkSession, sf: str, vocabulary_file: str | None = None) -> DataFrame:
    if vocabulary_file is None:
        import public_tokenizers

        vocabulary_file = public_tokenizers.path("byte_bpe_50k.json")
    vocabulary = tokencounts.Vocabulary.load(vocabulary_file)
    found = tokencounts.measured(table(spark, sf, "documents").select("doc_id", "text"), vocabulary, LIMIT)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "kept_chars", "kept_tokens")
