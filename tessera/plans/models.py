"""Model queries (F1-F5, G9, D8 on real predictions). Rows-only: a trained
model's outputs are not SQL-expressible, so these have no oracle SQL.

* ``train_head``: label encoder -> stratified 15 % split -> multilayer perceptron
  (64-256-128-64-k, seed 42) on ``embeddings`` -> classification report.
* ``regression_suite``: the per-label centroids are the fixed cases; each must
  be classified as its own label (accuracy + failures).
* ``hybrid_predict``: keyword hard rule first, else a logistic-regression head on
  the built-in text vectors (trained on documents, label = lang).
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import embed as EM
from tessera.operators import evaluate as EV
from tessera.plans.dataset import SEED, VAL_FRACTION_PCT, stratified_split_df
from tessera.plans.registry import register
from tessera.plans.routing import FIXTURE_KEYWORDS, classify
from tessera.plans.vectors import label_queries
from tessera.sources.tables import table

HIDDEN = [256, 128, 64]
# Rows per step of the text head's gradient: each block also costs a pass over a full classes x features table, which
# outweighs the rows of a 1 MB block. It sets the cost only, not the model.
BLOCK_MB = 16.0


def _training_frame(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select(
        F.col("vec_id").alias("seq"), F.col("label").cast("string").alias("label"), array_to_vector("embedding").alias("features")
    )


def fit_head(train, n_features: int, n_classes: int, max_iter: int = 200):
    """label encoder (sorted classes -> 0..k-1) + MLP head."""
    idx = StringIndexer(inputCol="label", outputCol="y", stringOrderType="alphabetAsc").fit(train)
    mlp = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="y", layers=[n_features, *HIDDEN, n_classes], seed=SEED, maxIter=max_iter
    )
    model = mlp.fit(idx.transform(train))
    return idx, model


def predict(idx, model, df):
    """predict and decode the label."""
    p = model.transform(df)
    return IndexToString(inputCol="prediction", outputCol="got", labels=idx.labels).transform(p)


def _trained(spark, sf):
    d = _training_frame(spark, sf)
    split = stratified_split_df(d, VAL_FRACTION_PCT, SEED)
    train, val = split.where(F.col("split") == "train"), split.where(F.col("split") == "val")
    n_features = len(d.select("features").first()[0])
    n_classes = d.select("label").distinct().count()
    idx, model = fit_head(train, n_features, n_classes)
    return idx, model, val


@register("train_head")
def train_head(spark, sf):
    """Split, fit, and report on the validation share."""
    idx, model, val = _trained(spark, sf)
    pairs = predict(idx, model, val).select(F.col("label").alias("expected"), "got")
    return EV.classification_report(pairs)


@register("regression_suite")
def regression_suite(spark, sf):
    """fixed cases (label centroids) -> expected / got / correct."""
    idx, model, _ = _trained(spark, sf)
    cases = label_queries(spark, sf).select(
        F.col("query_id").cast("string").alias("expected"), array_to_vector("embedding").alias("features")
    )
    out = predict(idx, model, cases).select("expected", "got")
    return out.withColumn("correct", F.col("expected") == F.col("got"))


def text_head(spark, sf):
    d = table(spark, sf, "documents").select("text", F.col("lang").alias("label"))
    vec, train = EM.fit_embed(d, "text", as_array=False, out_col="features")
    idx = StringIndexer(inputCol="label", outputCol="y", stringOrderType="alphabetAsc").fit(train)
    head = LogisticRegression(featuresCol="features", labelCol="y", maxIter=50, regParam=0.01, maxBlockSizeInMB=BLOCK_MB)
    lr = head.fit(idx.transform(train))
    return vec, idx, lr


@register("hybrid_predict")
def hybrid_predict(spark, sf):
    """every request scored once; hard rule wins, else the model's label."""
    vec, idx, lr = text_head(spark, sf)
    req = table(spark, sf, "conversations").where(F.col("role") == "user").select("conv_id", "turn", "text")
    scored = predict(idx, lr, EM.embed(vec, req, as_array=False, out_col="features"))
    return classify(scored, F.col("got"), FIXTURE_KEYWORDS).select("conv_id", "turn", "category", "source")


@register("train_metadata")
def train_metadata(spark, sf):
    """G9 tail (M18 via A9): one-row model report — classes and their codes, split
    sizes, regression-suite accuracy text and failures — written as JSON and read
    back. Every field is an aggregate over bounded tables (classes, cases)."""
    from tessera.session import scratch_path
    from tessera.sources.files import write_report

    idx, model, val = _trained(spark, sf)
    d = _training_frame(spark, sf)
    split = stratified_split_df(d, VAL_FRACTION_PCT, SEED)
    sizes = split.groupBy().agg(
        F.count_if(F.col("split") == "train").alias("train_size"), F.count_if(F.col("split") == "val").alias("val_size")
    )
    cases = label_queries(spark, sf).select(
        F.col("query_id").cast("string").alias("expected"), array_to_vector("embedding").alias("features")
    )
    res = predict(idx, model, cases).select("expected", "got")
    acc = EV.accuracy(res).first()  # one row over the bounded case list
    sz = sizes.first()  # one row
    report = spark.createDataFrame(
        [("embeddings table", list(idx.labels), {c: i for i, c in enumerate(idx.labels)},
          sz["train_size"], sz["val_size"], acc["summary"], acc["n_total"] - acc["n_correct"])],
        "embedding_model string, classes array<string>, class_mapping map<string,int>, train_size long, val_size long, "
        "regression_accuracy string, failures long",
    )
    path = scratch_path(spark, "model-metadata")
    write_report(report, path)
    return spark.read.json(path)
