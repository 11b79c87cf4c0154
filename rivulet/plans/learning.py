"""Queries of the late-payment models, the segmentation and the trained text models."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import aggregates as ag
from rivulet.operators import metrics as mt
from rivulet.operators import models as ml
from rivulet.operators import segments as sg
from rivulet.operators import similarity as sm
from rivulet.operators import textlearn as tl
from rivulet.operators import textmodel as tm
from rivulet.operators.termblocks import block_count, tfidf_blocks
from rivulet.plans import bindings as b
from rivulet.plans.cleaning import ANALYSIS, analysis_table
from rivulet.plans.registry import query, with_ctes
from rivulet.plans.summaries import PROFILE, PROFILE_COLUMNS, r6
from rivulet.session import materialize


def features(spark, sf):
    return ml.payment_features(analysis_table(spark, sf))


PAST = "OVER (PARTITION BY conn_id ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
SIX = "OVER (PARTITION BY conn_id ORDER BY period ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)"
EXACT = [c for c in ml.BINARY + ml.NUMERIC if c not in ("late_rate_so_far", "m3_vs_avg6")]


@query("payment_features", with_ctes(ANALYSIS) + f""",
  f AS (SELECT *, last_value(CAST(late AS INTEGER) IGNORE NULLS) {PAST} AS previous_label, avg(CAST(late AS INTEGER)) {PAST} AS late_rate_so_far,
    sum(CAST(late AS INTEGER)) {SIX} AS late_last_6, count(late) {PAST} AS bills_with_history, avg(m3) {SIX} AS avg6 FROM analysis)
  SELECT bill_id, CAST(late AS INTEGER) AS y, tariff, CAST(area AS VARCHAR) AS area, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in EXACT)},
    round(late_rate_so_far, 9) AS late_rate_so_far, round(m3 / CASE WHEN avg6 > 0 THEN avg6 END, 9) AS m3_vs_avg6 FROM f""")
def payment_features(spark, sf):
    return features(spark, sf).select("bill_id", "y", *ml.CATEGORICAL, *EXACT, *[r6(c, 9).alias(c) for c in ("late_rate_so_far", "m3_vs_avg6")])


def train_test(spark, sf):
    rows = materialize(features(spark, sf))
    marked = mt.temporal_split(rows.where("trainable"), "period")
    return materialize(marked.where(~F.col("is_test")).drop("is_test")), materialize(marked.where("is_test").drop("is_test")), rows


def _scored(spark, sf, fit):
    train, test, _ = train_test(spark, sf)
    return fit(train)(test, "p").select("bill_id", "y", "p")


@query("preprocess")
def preprocess(spark, sf):
    from pyspark.ml.functions import vector_to_array

    train, test, _ = train_test(spark, sf)
    prep = ml.Preprocessor.fit(train, True)
    rows = prep.transform(test).select("bill_id", vector_to_array("features").alias("x"))
    return rows.select("bill_id", F.size("x").alias("n"), F.aggregate("x", F.lit(0.0), lambda s, v: s + v).alias("total"))


@query("logistic")
def logistic(spark, sf):
    return _scored(spark, sf, ml.logistic())


@query("random_forest")
def random_forest(spark, sf):
    return _scored(spark, sf, ml.random_forest())


@query("gradient_boosting")
def gradient_boosting(spark, sf):
    return _scored(spark, sf, ml.gradient_boosting())


@query("soft_vote")
def soft_vote(spark, sf):
    return _scored(spark, sf, ml.soft_vote([ml.logistic(), ml.random_forest(), ml.gradient_boosting()]))


CANDIDATES = {"logistic": ml.logistic(), "random_forest": ml.random_forest(), "gradient_boosting": ml.gradient_boosting()}
VOTE = "soft_vote"


def chosen(spark, sf, train):
    """Name, fit and threshold of the model with the best out-of-fold average precision."""
    name, _, limit = ml.choose_by_cv(train, CANDIDATES, vote=VOTE)[0]
    return name, CANDIDATES.get(name) or ml.soft_vote(list(CANDIDATES.values())), limit


@query("choose_by_cv")
def choose_by_cv(spark, sf):
    train, _, _ = train_test(spark, sf)
    return spark.createDataFrame(ml.choose_by_cv(train, CANDIDATES, vote=VOTE), "model string, cv_average_precision double, threshold double")


@query("permutation_importance")
def permutation_importance(spark, sf):
    train, test, _ = train_test(spark, sf)
    return ml.permutation_importance(test, ml.logistic()(train), ml.NUMERIC + ml.BINARY + ml.CATEGORICAL)


@query("batch_predict_censored")
def batch_predict_censored(spark, sf):
    """The chosen model, fitted anew on all known labels, and its threshold."""
    train, _, rows = train_test(spark, sf)
    name, fit, limit = chosen(spark, sf, train)
    return ml.batch_predict(rows, fit(rows.where("trainable")), limit, name)


@query("prediction_summary")
def prediction_summary(spark, sf):
    return ml.prediction_summary(batch_predict_censored(spark, sf))


def network_parts(spark, sf):
    """Rows to fit, the last training period (to stop by), and the test rows."""
    train, test, _ = train_test(spark, sf)
    last = train.agg(F.max("period").alias("p")).first()["p"]
    return train.where(F.col("period") < last), train.where(F.col("period") == last), test


@query("mlp_vs_gbt")
def mlp_vs_gbt(spark, sf):
    fit_rows, valid, test = network_parts(spark, sf)
    network, history = ml.train_network(fit_rows, valid)
    boosted = ml.gradient_boosting()(fit_rows)
    out = None
    for name, score in (("network", network), ("gradient boosting", boosted)):
        limit = mt.best_threshold(score(valid, "p").select("y", "p"), "y", "p").first()["threshold"]
        row = mt.classification_metrics(materialize(score(test, "p").select("y", "p")), "y", "p", limit).select(
            F.lit(name).alias("model"), "average_precision", "roc_auc", "f1", F.lit(limit).alias("threshold"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("network_rounds", F.lit(len(history)))


@query("network_loss_curve")
def network_loss_curve(spark, sf):
    """Training and validation loss of every epoch of the network."""
    fit_rows, valid, _ = network_parts(spark, sf)
    return spark.createDataFrame(ml.train_network(fit_rows, valid)[1], "epoch int, train_loss double, valid_loss double")


# ---------------------------------------------------------------- segmentation
def profile(spark, sf):
    return ag.per_customer_profile(analysis_table(spark, sf))


@query("standardize", with_ctes(PROFILE) + "SELECT conn_id, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in PROFILE_COLUMNS) + " FROM profile")
def standardize(spark, sf):
    out = sg.standardize(materialize(profile(spark, sf)), PROFILE_COLUMNS)
    return out.select("conn_id", *[r6(c).alias(c) for c in PROFILE_COLUMNS])


@query("segment_profile", with_ctes(PROFILE) + """, o AS (SELECT avg(late_rate) AS lr, avg(mean_m3) AS mm FROM profile),
  s AS (SELECT CAST(conn_id % 10 AS INTEGER) AS segment, count(*) AS customers, """ + ", ".join(f"avg({c}) AS {c}" for c in PROFILE_COLUMNS) + """ FROM profile GROUP BY 1)
  SELECT segment, customers, """ + ", ".join(f"round({c}, 6) AS {c}" for c in PROFILE_COLUMNS) + """,
    coalesce(nullif(array_to_string(list_filter([CASE WHEN late_rate > lr * 1.3 THEN 'atraso alto' WHEN late_rate < lr * 0.7 THEN 'puntual' END,
      CASE WHEN mean_m3 > mm * 1.5 THEN 'consumo alto' WHEN mean_m3 < mm * 0.7 THEN 'consumo bajo' END, CASE WHEN direct_debit > 0.5 THEN 'domiciliado' END],
      lambda x: x IS NOT NULL), ', '), ''), 'comportamiento típico') AS name FROM s, o""")
def segment_profile(spark, sf):
    rows = materialize(profile(spark, sf)).withColumn("segment", (F.col("conn_id") % 10).cast("int"))
    return sg.segment_profile(rows, "segment", PROFILE_COLUMNS).withColumns({c: r6(c) for c in PROFILE_COLUMNS})


@query("kmeans")
def kmeans(spark, sf):
    """Sizes of the segments for the number of segments with the largest silhouette."""
    rows = materialize(profile(spark, sf))
    _, centres = sg.best_k(sg.silhouette_by_k(rows, "conn_id", PROFILE_COLUMNS))
    labelled = sg.assign(sg.vectors(rows, "conn_id", PROFILE_COLUMNS), "x", centres)
    return labelled.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))


@query("silhouette_by_k")
def silhouette_by_k(spark, sf):
    rows = sg.silhouette_by_k(materialize(profile(spark, sf)), "conn_id", PROFILE_COLUMNS)
    return spark.createDataFrame([r[:2] for r in rows], "k int, silhouette double")


@query("silhouette", with_ctes(PROFILE) + """, z AS (SELECT conn_id % 3 AS s, conn_id, """ + ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in PROFILE_COLUMNS) + """ FROM profile),
  c AS (SELECT s AS t, count(*) AS n, """ + ", ".join(f"sum({c}) AS s_{c}, sum({c} * {c}) AS q_{c}" for c in PROFILE_COLUMNS) + """ FROM z GROUP BY 1),
  d AS (SELECT conn_id, s, t, n, """ + " + ".join(f"n * {c} * {c} - 2 * {c} * s_{c} + q_{c}" for c in PROFILE_COLUMNS) + """ AS d FROM z, c),
  m AS (SELECT conn_id, max(d / (n - 1)) FILTER (s = t) AS a, min(d / n) FILTER (s <> t) AS b FROM d GROUP BY 1)
  SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM m""")
def silhouette(spark, sf):
    """Silhouette of a given grouping, with squared distances; a test compares it with all pairs."""
    z = sg.vectors(materialize(profile(spark, sf)), "conn_id", PROFILE_COLUMNS)
    rows = z.withColumn("segment", (F.col("conn_id") % 3).cast("int"))
    return sg.silhouette(rows, "x", "segment").withColumn("silhouette", r6("silhouette"))


@query("pca")
def pca(spark, sf):
    return sg.pca(materialize(profile(spark, sf)), PROFILE_COLUMNS)[0].select("conn_id", "pc1", "pc2")


@query("pca_loadings")
def pca_loadings(spark, sf):
    """Loadings of every variable on the first two components, and the share each component explains."""
    _, loadings, shares = sg.pca(materialize(profile(spark, sf)), PROFILE_COLUMNS)
    rows = [(c, *map(float, row)) for c, row in zip(PROFILE_COLUMNS, loadings)] + [("explained share", *map(float, shares))]
    return spark.createDataFrame(rows, "variable string, pc1 double, pc2 double")


@query("segment_table")
def segment_table(spark, sf):
    return sg.segment_table(materialize(profile(spark, sf)), "conn_id", PROFILE_COLUMNS)


# ---------------------------------------------------------------- trained text models
def text_parts(spark, sf):
    from rivulet.plans.texts import split

    parts = materialize(split(spark, sf).select("doc_id", "text", "lang", "is_test"))
    return parts.where(~F.col("is_test")).drop("is_test"), parts.where("is_test").drop("is_test")


def trained(spark, sf):
    """The classifier the whole grid search chooses, and the test texts."""
    train, test = text_parts(spark, sf)
    return *tl.train_text_classifier(train, "doc_id", "text", "lang"), test


@query("train_text_classifier")
def train_text_classifier(spark, sf):
    """Test texts with the class the chosen model gives them."""
    vectors, model, classes, _, test = trained(spark, sf)
    return tl.predict(model, vectors.transform(test), vectors.size, classes, "guess").select("doc_id", "lang", "guess")


@query("text_classifier_grid")
def text_classifier_grid(spark, sf):
    """Every point of the grid with the mean and the spread of its macro F1 over the folds."""
    return spark.createDataFrame(trained(spark, sf)[3], "ngrams int, c double, mean_f1 double, sd_f1 double")


@query("export_model")
def export_model(spark, sf):
    """The chosen model as tables, and the test texts scored from the tables alone."""
    vectors, model, classes, _, test = trained(spark, sf)
    tables = tl.export_model(vectors, model, classes, "lang")
    return tm.score_with_model(test, "doc_id", "text", tables["idf"], tables["weights"], tables["intercepts"], "lang", vectors.n)


@query("lsa")
def lsa(spark, sf):
    """precision@5 of the latent vectors: test texts against training texts."""
    train, test = text_parts(spark, sf)
    parts = train.withColumn("is_test", F.lit(False)).unionAll(test.withColumn("is_test", F.lit(True)))
    vectors = tfidf_blocks(parts, "doc_id", "text", 1, ~F.col("is_test"), hashed=True, keep=[])
    latent, _, components = tl.latent_vectors(vectors, "doc_id", "fitted", block_count(parts, "text"))
    base = latent.where("fitted").select(F.col("doc_id").alias("base_id"), "unit")
    asked = latent.where("NOT fitted").select(F.col("doc_id").alias("query_id"), "unit")
    found = sm.nearest(asked, base, 5, qid="query_id", bid="base_id", columns=["unit"], stored=True)
    return sm.precision_at_k(found, test.select(F.col("doc_id").alias("query_id"), F.col("lang").alias("q_lang")),
                             train.select(F.col("doc_id").alias("base_id"), F.col("lang").alias("b_lang")),
                             "query_id", "base_id", "q_lang", "b_lang").withColumn("dimensions", F.lit(components))
