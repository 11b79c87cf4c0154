"""Text vectors, splits by distinct text, and the linear text model kept as tables."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.text import bind, ngrams, tokenize
from rivulet.operators.joins import hot_keys, salted_join
from rivulet.operators.ranks import value_counts
from rivulet.operators.termblocks import tfidf_blocks
from rivulet.operators.textgram import TextGram
from rivulet.operators.windows import top_n
from rivulet.session import materialize

HASH_BITS = 52


def text_hash(text: Column, seed: int = 42) -> Column:
    """52-bit integer from the MD5 of text and seed: a random order anyone can repeat."""
    return F.conv(F.substring(F.md5(F.concat(text, F.lit(f"#{seed}"))), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def term_counts(df: DataFrame, key: str, text: str, n: int = 2) -> DataFrame:
    """(key, term, tf) for the n-grams of sizes 1..n of each text."""
    terms = df.select(key, F.explode(ngrams(tokenize(F.col(text)), n)).alias("term"))
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(counts: DataFrame, n_texts: Column) -> DataFrame:
    """(term, df, idf) with idf = ln((1 + n) / (1 + df)) + 1."""
    freq = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return freq.withColumn("idf", F.log((1 + n_texts) / (1 + F.col("df"))) + 1)


def weigh(counts: DataFrame, idf: DataFrame, key: str, item: str = "term") -> DataFrame:
    """(key, terms, weights): sublinear tf times idf, L2 norm 1, in order of ``item``. One row per text."""
    lookup = idf.select("term", "idf", F.col(item).alias("_item"))
    rows = salted_join(counts, lookup, "term", hot_keys(idf, "term", "df"), F.col(key))
    rows = rows.withColumn("_w", (1 + F.log(F.col("tf").cast("double"))) * F.col("idf"))
    packed = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("_item").alias("term"), "_w"))).alias("_v"))
    norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda s, v: s + v["_w"] * v["_w"]))
    return packed.select(key, F.transform("_v", lambda v: v["term"]).alias("terms"),
                         bind(norm, lambda n: F.transform("_v", lambda v: v["_w"] / n)).alias("weights"))


def tfidf(df: DataFrame, key: str, text: str, n: int = 2) -> DataFrame:
    """TF-IDF vectors of the texts of ``df``; a text without tokens has no row."""
    return tfidf_blocks(df, key, text, n).select(key, "terms", "weights")


def counted(df: DataFrame, key: str, text: str, n: int = 2) -> tuple[DataFrame, DataFrame]:
    """Term counts and idf table of the texts, each written once because several steps read them."""
    counts = materialize(term_counts(df, key, text, n))
    return counts, materialize(document_frequencies(counts, df.agg(F.count(F.lit(1)).alias("n")).scalar()))


# ---------------------------------------------------------------- splits
def class_ranks(df: DataFrame, category: str, order: Column) -> DataFrame:
    """Add ``rank`` (from 0) of each row in its class by a hash order, and the class size ``size``."""
    rows = materialize(df.withColumn("_h", order))
    ranks = value_counts(rows, "_h", [category]).select(
        category, "_h", F.col("n_before").alias("rank"), F.col("n_all").alias("size"))
    return rows.join(ranks, [category, "_h"]).drop("_h")


def split_by_text(unique: DataFrame, text: str, category: str, share: float = 0.25, seed: int = 42) -> DataFrame:
    """Distinct texts with ``is_test``: the first ``share`` of each class in hash order, at least one.

    Only hashes are ranked; a text is compared with the last one its class takes, and stays where it lies.
    """
    rows = materialize(unique.withColumn("_h", text_hash(F.col(text), seed)))
    ranks = value_counts(rows, "_h", [category])
    wanted = F.greatest(F.lit(1), F.floor(F.col("n_all") * share + 0.5))
    last = materialize(ranks.where(F.col("n_before") < wanted).groupBy(category).agg(F.max("_h").alias("_last")))
    return rows.where(F.col("_h").isNotNull()).join(F.broadcast(last), category).withColumn(  # one row per class
        "is_test", F.col("_h") <= F.col("_last")).drop("_h", "_last")


def grouped_folds(unique: DataFrame, text: str, category: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Distinct texts with a fold, balanced per class; joining on the text keeps equal texts together."""
    ranked = class_ranks(unique, category, text_hash(F.col(text), seed))
    return ranked.withColumn("fold", (F.col("rank") % folds).cast("int")).drop("rank", "size")


def leaky_split_share(df: DataFrame, key: str, text: str, category: str, share: float = 0.25, seed: int = 42) -> DataFrame:
    """Row split that ignores repeated texts: how many test rows have their text in training."""
    ranked = class_ranks(df.select(key, text, category), category, text_hash(F.col(key).cast("string"), seed))
    marked = ranked.withColumn("_test", F.col("rank") < F.greatest(F.lit(1), F.floor(F.col("size") * share + 0.5)))
    per_text = marked.groupBy(text).agg(F.count_if("_test").alias("_t"), F.count_if(~F.col("_test")).alias("_r"))
    seen = F.sum(F.when(F.col("_r") > 0, F.col("_t")).otherwise(0))
    return per_text.agg(F.sum("_t").alias("test_rows"), seen.alias("seen_rows"), (seen / F.sum("_t")).alias("seen_share"))


def majority_baseline(train: DataFrame, category: str) -> DataFrame:
    """Most frequent class, the first by name on ties."""
    counts = train.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), category).limit(1)


def stratified_random(df: DataFrame, key: str, category: str, out: str, seed: int = 42) -> DataFrame:
    """Draw a class per row by class share, from a hash of the key."""
    one = Window.partitionBy(F.lit(0))  # one row per class
    shares = df.groupBy(category).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_upto", F.sum("_n").over(one.orderBy(category)) / F.sum("_n").over(one))
    table = shares.agg(F.array_sort(F.collect_list(F.struct("_upto", F.col(category).alias("_c")))).alias("t"))
    u = text_hash(F.col(key).cast("string"), seed) / F.lit(float(1 << HASH_BITS))
    return df.withColumn("_t", table.scalar()).withColumn("_u", u).withColumn(
        out, F.element_at(F.filter("_t", lambda s: s["_upto"] > F.col("_u")), 1)["_c"]).drop("_t", "_u")


# ---------------------------------------------------------------- linear model as tables
def centroid_model(vectors: DataFrame, labels: DataFrame, key: str, category: str) -> dict[str, DataFrame]:
    """A linear model from class means: weight = mean TF-IDF weight, intercept = ln(class share).

    ``vectors`` are joined with their class, unless they have it already.
    """
    classes = labels.groupBy(category).agg(F.count(F.lit(1)).alias("_n"))
    total = labels.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = vectors if category in vectors.columns else vectors.join(labels.select(key, category), key)
    flat = rows.select(category, F.inline(F.arrays_zip("terms", "weights")))
    sums = flat.groupBy(category, F.col("terms").alias("term")).agg(F.sum("weights").alias("_s"))
    weights = sums.join(F.broadcast(classes), category).select(category, "term", (F.col("_s") / F.col("_n")).alias("weight"))
    return {"weights": weights, "intercepts": classes.select(category, F.log(F.col("_n") / total).alias("intercept"))}


def score_with_model(df: DataFrame, key: str, text: str, idf: DataFrame, weights: DataFrame, intercepts: DataFrame,
                     category: str = "category", n: int = 2) -> DataFrame:
    """Class, probability and whether any term is known, from (term, df, idf), (class, term, weight), (class, intercept).

    A text without a known term is answered by the intercepts alone.
    """
    first, wide = _by_term(weights, intercepts, category)
    lookup = idf.select("term", "idf").join(wide, "term", "left")
    terms = salted_join(term_counts(df, key, text, n), lookup, "term", hot_keys(idf, "term", "df"), F.col(key))
    v = (1 + F.log(F.col("tf").cast("double"))) * F.col("idf")
    sums = terms.groupBy(key).agg(
        F.sqrt(F.sum(v * v)).alias("_norm"), *[F.sum(v * F.coalesce(F.col("_w")[i], F.lit(0.0))).alias(f"_s{i}") for i in range(len(first))])
    return _answers(df.select(key).join(sums, key, "left"), key, first, category)


def score_vectors(ids: DataFrame, key: str, vectors: DataFrame, weights: DataFrame, intercepts: DataFrame, category: str = "category") -> DataFrame:
    """``score_with_model`` of texts whose unit vectors are there: (key, terms, weights), one row per key with known terms."""
    first, wide = _by_term(weights, intercepts, category)
    entries = vectors.select(key, F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("weights").alias("_v"))))
    hot = materialize(hot_keys(entries.groupBy("term").agg(F.count(F.lit(1)).alias("_n")), "term", "_n"))
    sums = salted_join(entries, wide, "term", hot, F.col(key)).groupBy(key).agg(
        *[F.sum(F.col("_v") * F.col("_w")[i]).alias(f"_s{i}") for i in range(len(first))])
    known = vectors.where(F.size("terms") > 0).select(key, F.lit(1.0).alias("_norm"))
    return _answers(ids.select(key).join(known, key, "left").join(sums, key, "left"), key, first, category)


def score_texts(df: DataFrame, key: str, text: str, fitted: Column, category: str, n: int = 1) -> DataFrame:
    """``centroid_model`` of the fitted texts, and ``score_with_model`` of the others, one row per row.

    A score is the sum over fitted texts of a class of their products with the text, divided by their number; these
    sums meet per term and block (see ``textgram``), so neither entries nor weights are shuffled.
    """
    sizes = df.where(fitted).groupBy(category).agg(F.count(F.lit(1)).alias("n")).orderBy(category).collect()  # one row per class
    total = sum(r["n"] for r in sizes)
    first = {r[category]: math.log(r["n"] / total) for r in sizes}
    gram = TextGram.of_texts(df, key, text, fitted, category, n)
    sums = gram.times(gram.marked(list(first), [1 / r["n"] for r in sizes]), np.eye(len(first)), others=True)
    rows = gram.rows(sums, np.eye(len(first))).where(~F.col("fitted"))
    return _answers(rows.select(key, F.when(F.col("known"), 1.0).alias("_norm"), *[F.col("v")[i].alias(f"_s{i}") for i in range(len(first))]), key, first, category)


def _by_term(weights: DataFrame, intercepts: DataFrame, category: str) -> tuple[dict, DataFrame]:
    """Intercepts by class in order, and (term, _w: weight per class)."""
    first = {r[category]: r["intercept"] for r in intercepts.orderBy(category).collect()}  # one number per class
    wide = weights.groupBy("term").pivot(category, list(first)).agg(F.sum("weight")).na.fill(0.0)
    return first, wide.select("term", F.array(*[F.col(f"`{c}`") for c in first]).alias("_w"))


def _answers(rows: DataFrame, key: str, first: dict, category: str) -> DataFrame:
    """Class and probability from (key, _norm, _s0, _s1, ...), which are null for texts without a known term."""
    classes = list(first)
    z = [F.coalesce(F.col(f"_s{i}") / F.col("_norm"), F.lit(0.0)) + F.lit(float(first[c])) for i, c in enumerate(classes)]
    rows = rows.withColumn("known", F.col("_norm").isNotNull())
    rows = rows.withColumns({f"_z{i}": c for i, c in enumerate(z)})
    top = F.greatest(*[F.col(f"_z{i}") for i in range(len(classes))]) if len(classes) > 1 else F.col("_z0")
    rows = rows.withColumn("_top", top)
    total = sum((F.exp(F.col(f"_z{i}") - F.col("_top")) for i in range(len(classes))), F.lit(0.0))
    winner = F.coalesce(*[F.when(F.col(f"_z{i}") == F.col("_top"), F.lit(c)) for i, c in enumerate(classes)])
    return rows.select(key, winner.alias(category), (1 / total).alias("probability"), "known")


def top_terms(weights: DataFrame, category: str, n: int = 5) -> DataFrame:
    """Terms with the greatest weight per class, with their place."""
    return top_n(weights, [category], [F.col("weight").desc(), F.col("term")], n)
