"""Spark ML jobs for the title-only learning items.
Each is a standard distributed estimator; inputs are prepared with built-in
expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.prefix import ordered_prefix_sums
from tillwise.operators.text import tokens
from tillwise.session import checkpoint_dir, reliable_checkpoint, unused_shuffles_removed


def _int_keys(df: DataFrame, key: str, out: str) -> tuple[DataFrame, DataFrame | None]:
    """``df`` with ``key`` as an int ``out``, and the table (key, out) that leads back.
    Keys that are ints already need no table; others are numbered in their order, across ranges."""
    if isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        r = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
        if r["lo"] is None or -(1 << 31) <= r["lo"] and r["hi"] < 1 << 31:
            return df.withColumn(out, F.col(key).cast("int")), None
    ids = ordered_prefix_sums(df.select(key).distinct(), [F.col(key)], {}, row_number=out).withColumn(out, F.col(out).cast("int"))
    ids = reliable_checkpoint(ids)
    return df.join(ids, key), ids


def basket_embeddings(lines: DataFrame, basket: str, item: str, dim: int = 16, seed: int = 42) -> DataFrame:
    """Item vectors learned from baskets: implicit-feedback factors of the
    basket x item counts. Training and factors stay distributed (Word2Vec
    would hold the whole vocabulary on the driver). Keys of any type, up to 2^31
    of each; rows without basket or item take no part. A half-step sends each factor to
    every block that needs it, many times what it reads: item factors are checkpointed in
    each round, so that what was sent before them is given back, and basket factors are kept
    no longer than the next round reads them."""
    from pyspark.ml.recommendation import ALS
    checkpoint_dir(lines.sparkSession)
    rows = lines.select(F.col(basket).alias("basket_key"), F.col(item).alias("item_key")).dropna()
    counts = rows.groupBy("basket_key", "item_key").agg(F.count(F.lit(1)).cast("float").alias("n"))
    counts, _ = _int_keys(counts, "basket_key", "basket")
    counts, items = _int_keys(counts, "item_key", "item")
    blocks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    als = ALS(rank=dim, implicitPrefs=True, maxIter=3, seed=seed, userCol="basket", itemCol="item", ratingCol="n",
              numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1, finalStorageLevel="NONE")
    with unused_shuffles_removed(lines.sparkSession):
        factors = als.fit(counts.select("basket", "item", "n")).itemFactors
    named = factors.withColumn("item_key", F.col("id")) if items is None else factors.join(items, factors.id == items["item"])
    return named.select(F.col("item_key").cast("string").alias(item), F.col("features").alias("vector"))


def kmeans_segments(df: DataFrame, vec: str, k: int = 8, seed: int = 42) -> DataFrame:
    """K-means cluster id per vector."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    x = df.withColumn("_features", array_to_vector(F.transform(vec, lambda v: v.cast("double"))))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(x)
    return model.transform(x).drop("_features")


def tree_scoring(df: DataFrame, features: list[str], label: str, depth: int = 5, seed: int = 42,
                 rows_per_task: int = 250_000) -> DataFrame:
    """Decision-tree regressor fitted on the loan features. The fit keeps its rows by
    partition, several times as large as they were shuffled: partitions of more than
    ``rows_per_task`` rows on average are dealt out for it."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor
    rows = reliable_checkpoint(df.withColumn(label, F.col(label).cast("double")))
    x = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep").transform(rows)
    parts = -(-rows.count() // rows_per_task)
    known = x if parts <= rows.rdd.getNumPartitions() else x.repartition(parts)
    model = DecisionTreeRegressor(featuresCol="_features", labelCol=label, maxDepth=depth, seed=seed).fit(known)
    return model.transform(x).drop("_features")


def text_classifier(docs: DataFrame, labels: DataFrame, label: str = "quality", num_features: int = 1 << 16):
    """TF-IDF + logistic regression fitted on the labelled documents;
    returns (fitted pipeline, all documents scored, label NULL where there is none).
    A null text counts as empty."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, IDF
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", tokens("text").alias("words"))
    data = d.join(labels.select("doc_id", F.col(label).cast("double").alias("label")), "doc_id")
    pipe = Pipeline(stages=[HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features),
                            IDF(inputCol="tf", outputCol="features"),
                            LogisticRegression(maxIter=50, regParam=0.01)])
    model = pipe.fit(data)
    known = labels.select("doc_id", F.col(label).cast("double").alias("label"))
    return model, model.transform(d).join(known, "doc_id", "left")


def adstock(df: DataFrame, key: list[str], order: str, values: list[str], decay: float = 0.5) -> DataFrame:
    """Geometric adstock s_t = x_t + decay * s_(t-1), with its whole memory, as
    ``<value>_adstock``; a null value counts as 0, and ``order`` is unique within ``key``.

    Rows are range-partitioned on (key, order) and each range streams through its task from an
    empty memory. What the ranges before hand on decays with the rows passed since: one row per
    range and key, so a key of any length spans many tasks."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [*key, order]
    names = [f"{v}_adstock" for v in values]
    ranged = df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, *[T.StructField(c, T.DoubleType()) for c in names],
                           T.StructField("_at", T.LongType())])

    def run(batches):
        last, at, memory = None, 0, [0.0] * len(values)
        for b in batches:
            own = list(zip(*[b[k] for k in key])) if key else [()] * len(b)
            xs = [b[v].astype(float).fillna(0.0).tolist() for v in values]
            out, places = [[] for _ in values], []
            for i, k in enumerate(own):
                if k != last:
                    last, at, memory = k, 0, [0.0] * len(values)
                at += 1
                places.append(at)
                for j, x in enumerate(xs):
                    memory[j] = x[i] + decay * memory[j]
                    out[j].append(memory[j])
            yield b.assign(**dict(zip(names, out)), _at=places)

    local = reliable_checkpoint(ranged.mapInPandas(run, schema))
    tails = local.groupBy(*key, "_part").agg(F.max("_at").alias("n"), F.max_by(F.array(*names), "_at").alias("tail"))
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    rate = F.lit(float(decay))

    def handed(j):
        return F.aggregate("_before", F.lit(0.0), lambda acc, r: r["tail"][j] + F.pow(rate, r["n"]) * acc)

    carry = tails.withColumn("_before", F.collect_list(F.struct("n", "tail")).over(before)).select(
        F.struct(*key, "_part").alias("_of"), *[handed(j).alias(f"_carry_{j}") for j in range(len(values))])
    out = local.join(carry, F.struct(*key, "_part").eqNullSafe(F.col("_of")))
    for j, c in enumerate(names):
        out = out.withColumn(c, F.col(c) + F.pow(rate, F.col("_at")) * F.col(f"_carry_{j}"))
    return out.select(*df.columns, *names)


def mmm_regression(daily: DataFrame, channels: list[str], target: str, decay: float = 0.5):
    """Linear regression of the target on adstocked channel spend;
    returns (coefficients table, fitted model)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    x = adstock(daily, [], "day", channels, decay)
    cols = [f"{c}_adstock" for c in channels]
    x = VectorAssembler(inputCols=cols, outputCol="_features").transform(x)
    model = LinearRegression(featuresCol="_features", labelCol=target).fit(x)
    spark = daily.sparkSession
    rows = [(c, float(v)) for c, v in zip(channels, model.coefficients)] + [("intercept", float(model.intercept))]
    return spark.createDataFrame(rows, "term string, coefficient double"), model
