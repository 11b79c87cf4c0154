"""Corpus pipeline: language, near duplicates, benchmark leaks, secrets, piece ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. ``run`` writes each stage's result as Parquet and rereads it as the next one's input.

Defined results, for every stage: an empty table gives an empty one; columns that a stage does not read may
hold nulls and have any name, those of the operators' own included, and come through unchanged. What a stage
does with null and empty texts, repeated rows and ties is in its docstring. Texts of any length are whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import jaccard, langid, leaks, pieces, secrets
from rivulet.llm.q_pieces import MODEL_FILE
from rivulet.llm.q_secrets import fitted
from rivulet.llm.registry import table
from rivulet.llm.textblocks import unused
from rivulet.session import materialize

#: Models and random choices cannot be stated in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the identifier accepts; null texts and texts without a letter go, repeated rows stay."""
    prefix = unused(docs.columns, "lang_")
    found = langid.predict(docs, langid.fit(docs), prefix=prefix)
    return found.where(F.col(f"{prefix}accepted")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, the one with the least id, of equal rows one.

    A null id is the greatest; texts with equal ids are told apart by a hash. Null texts and texts without a word all stay.
    """
    return jaccard.keep_one(docs).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, and no quote of ``leaks.QUOTE`` (87) or more characters of one.

    Null and empty texts hold none and stay, as do repeated rows.
    """
    hits = unused(docs.columns, "hits")
    found = leaks.mark(docs, table(spark, sf_dir, "benchmark"), hits=hits)
    return found.where(F.size(hits) == 0).select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark; null texts stay null, with n_chars null."""
    safe = secrets.redacted(docs, fitted(docs))
    return safe.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, and whether the ids decode to the very text.

    A null text has null ids, 0 tokens and a true round trip. Columns beside those named are left behind.
    """
    vocabulary = pieces.Vocabulary.load(MODEL_FILE)
    found = pieces.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), vocabulary)
    return found.select("doc_id", "lang", "source", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_tokens"),
                        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("SentencePiece encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
