"""Registered Spark ML queries for the title-only learning items (rows-only)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import learning as ml
from tillwise.operators import imputation as imp
from tillwise.sources.fixtures import fx_loans
from tillwise.sources.tables import read_table


@query("sku_embeddings", note="T22: implicit-feedback item factors from order baskets: rows-only")
def q_sku_embeddings(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return ml.basket_embeddings(li, "l_orderkey", "l_partkey")


@query("kmeans_segments", note="T24: k-means over the embedding vectors: rows-only")
def q_kmeans_segments(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return ml.kmeans_segments(e, "embedding", k=10).select("vec_id", "label", "cluster")


@query("tree_scoring", note="T25: decision tree on the loan features: rows-only")
def q_tree_scoring(spark, sf_dir):
    lf = imp.loan_features(fx_loans(spark, sf_dir))
    feats = ["age", "income", "dependents", "has_property", "has_car", "loan_amount", "loan_period"]
    return ml.tree_scoring(lf, feats, "delay_days").select("id", "delay_days", "prediction")


@query("text_classifier", note="T46: TF-IDF + logistic regression on the labelled documents: rows-only")
def q_text_classifier(spark, sf_dir):
    _, scored = ml.text_classifier(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    from pyspark.ml.functions import vector_to_array
    return scored.select("doc_id", "label", "prediction",
                         F.element_at(vector_to_array("probability"), 2).alias("p_positive"))


@query("mmm_regression", note="T50: adstocked channel regression on daily event values: rows-only")
def q_mmm_regression(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    daily = e.groupBy(F.to_date("ts").alias("day")).agg(
        *[F.coalesce(F.sum(F.when(F.col("event_type") == c, F.col("value"))), F.lit(0.0)).alias(c)
          for c in ("view", "click", "signup")],
        F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))), F.lit(0.0)).alias("sales"))
    coefs, _ = ml.mmm_regression(daily, ["view", "click", "signup"], "sales")
    return coefs
