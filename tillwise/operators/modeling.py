"""Models and validation splits.

Per-key model fits run as grouped-map pandas functions (one task per key
group, all keys in parallel); fitted parameters are stored as a coefficient
table and scoring is a join plus JVM-side array arithmetic, so the model
never passes through the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tillwise.functions.prefix import ordered_prefix_sums

from tillwise.operators.metrics import pred_col
from tillwise.session import reliable_checkpoint


# ------------------------------------------------------------------- L1
def mean_baseline_fit(df: DataFrame, y: str = "y") -> float:
    """L1 fit: the mean of the target (one scalar)."""
    v = df.agg(F.avg(F.col(y).cast("double"))).first()[0]
    return float(v) if v is not None else float("nan")


def mean_baseline_predict(df: DataFrame, mean: float, out: str = "pred") -> DataFrame:
    """L1 predict: the constant for every row."""
    return df.withColumn(out, F.lit(float(mean)))


# --------------------------------------------------------------- L2 / L3
def _fold_table(ranked: DataFrame, n_groups: int, n_splits: int, test_size: int, gap: int,
                max_train_size: int | None, starts: list[int]) -> DataFrame:
    """(group rank, fold, role) for every fold; one row per group and fold."""
    spark = ranked.sparkSession
    rows = []
    for f, ts_ in enumerate(starts):
        train_end = ts_ - gap
        train_start = 0
        if max_train_size and max_train_size < train_end:
            train_start = train_end - max_train_size
        rows.append((f, train_start, train_end, ts_, ts_ + test_size))
    folds = spark.createDataFrame(rows, "fold int, tr_lo int, tr_hi int, te_lo int, te_hi int")
    g = F.col("_g")
    role = (F.when((g >= F.col("te_lo")) & (g < F.col("te_hi")), F.lit("test"))
            .when((g >= F.col("tr_lo")) & (g < F.col("tr_hi")), F.lit("train")))
    # the fold table has n_splits rows
    return ranked.join(F.broadcast(folds), (g >= F.col("tr_lo")) & (g < F.col("te_hi"))) \
        .select("_grp", "_g", "fold", role.alias("role")).where(F.col("role").isNotNull())


def group_ts_split(df: DataFrame, group: str, n_splits: int = 5, test_size: int | None = None,
                   gap: int = 0, max_train_size: int | None = None) -> DataFrame:
    """L2: expanding-window CV over sorted distinct groups; returns the input
    rows tagged with (fold, role), a row appearing once per fold it is in."""
    groups = df.select(F.col(group).alias("_grp")).distinct()
    ranked = ordered_prefix_sums(groups, [F.col("_grp")], {}, row_number="_n").select("_grp", (F.col("_n") - 1).alias("_g"))
    n_groups = groups.count()
    n_folds = n_splits + 1
    ts_ = test_size if test_size else n_groups // n_folds
    first = n_groups - n_splits * ts_
    if ts_ <= 0 or first < 0:
        raise ValueError(f"too few groups ({n_groups}) for {n_splits} splits")
    starts = list(range(first, n_groups, ts_))
    ft = _fold_table(ranked, n_groups, n_splits, ts_, gap, max_train_size, starts)
    return df.join(ft, df[group] == ft["_grp"]).drop("_grp", "_g")


def group_ts_split_template(df: DataFrame, group: str, order: list[str], n_splits: int = 5,
                            test_size: int | None = None, gap: int = 0,
                            max_train_size: int | None = None) -> DataFrame:
    """L3: groups ordered by first appearance in ``order``; default test
    size 1; the last ``n_splits * test_size`` groups are the test folds."""
    first = df.groupBy(F.col(group).alias("_grp")).agg(F.min(F.struct(*order)).alias("_first"))
    ranked = ordered_prefix_sums(first, [F.col("_first"), F.col("_grp")], {}, row_number="_n").select("_grp", (F.col("_n") - 1).alias("_g"))
    n_groups = first.count()
    ts_ = test_size if test_size is not None else 1
    starts = [n_groups - (n_splits - 1 - i) * ts_ - ts_ for i in range(n_splits)]
    if starts and (starts[0] - gap) < 0:
        raise ValueError(f"too few groups ({n_groups}) for {n_splits} splits")
    ft = _fold_table(ranked, n_groups, n_splits, ts_, gap, max_train_size, starts)
    return df.join(ft, df[group] == ft["_grp"]).drop("_grp", "_g")


# ----------------------------------------------------------- L8 / L9 / L10
def fit_linear_quantiles(X: np.ndarray, Y: np.ndarray, qs, sets: np.ndarray | None = None, iters: int = 60,
                         eps: float = 1e-6, block: int = 1 << 16) -> np.ndarray:
    """Linear quantile regressions of each column of ``Y`` at its level of ``qs``,
    over all rows or over each of the ``sets`` (a line of flags each): coefficients
    (intercept first) by set and column. Iteratively reweighted least squares on
    the normal equations; converges to the pinball-loss optimum up to ``eps``
    smoothing. All regressions step together: their weighted normal equations
    are one product with the pairwise products of the columns. A column that is
    constant within a set is part of the intercept and has coefficient 0: beside
    it, rounding alone would share out its weight, and decide the predictions.
    Products with a column that is constant within every set are not made."""
    n, m = len(X), Y.shape[1]
    A = np.hstack([np.ones((n, 1)), X])
    k = A.shape[1]
    sets = np.ones((1, n), dtype=bool) if sets is None else sets
    beta = np.concatenate([np.linalg.lstsq(A[rows], Y[rows], rcond=None)[0].T for rows in sets])
    same = np.array([[False, *(X[rows] == X[rows][:1]).all(axis=0)] for rows in sets])
    # weighted rows decide over many a near tie: the sums that remain are taken in the order of the rows
    free = ~same.all(axis=0)
    i, j = np.triu_indices(k)
    i, j = (x[free[i] & free[j]] for x in (i, j))
    # products of at most ``block`` rows are kept, those of more are made again each step
    kept = A[:, i] * A[:, j] if n <= block else None
    fixed = np.repeat(same & free, m, axis=0)
    fixed = fixed if fixed.any() else None
    y = np.tile(np.ascontiguousarray(Y.T), (len(sets), 1))
    # what a row costs on or above the line, and below it; nothing outside the set
    inside, q = np.repeat(sets, m, axis=0), np.tile(np.asarray(qs, dtype=np.float64), len(sets))[:, None]
    above, below = np.where(inside, q, 0.0), np.where(inside, np.abs(q - 1), 0.0)
    ridge = 1e-9 * np.eye(k)
    left = np.arange(len(y))
    r, w = np.empty_like(y), np.empty_like(y)
    for _ in range(iters):
        np.matmul(beta[left], A.T, out=r)
        np.subtract(y, r, out=r)
        cost = np.where(r < 0, below, above)
        np.abs(r, out=r)
        np.maximum(r, eps, out=r)
        np.divide(cost, r, out=w)
        if kept is not None:
            flat = w @ kept
        else:
            flat = sum(w[:, lo:lo + block] @ (A[lo:lo + block, i] * A[lo:lo + block, j]) for lo in range(0, n, block))
        gram = np.zeros((len(left), k, k))
        gram[:, i, j] = gram[:, j, i] = flat
        side = np.multiply(w, y, out=r) @ A
        side[:, ~free] = 0.0
        if fixed is not None:
            gram[fixed[:, :, None] | fixed[:, None, :]] = 0.0
            side[fixed] = 0.0
        gram += ridge
        try:
            nb = np.linalg.solve(gram, side[:, :, None])[:, :, 0]
        except np.linalg.LinAlgError:
            nb = np.array([_solved(g, s) for g, s in zip(gram, side)])
        moved = np.max(np.abs(nb - beta[left]), axis=1)
        beta[left] = nb
        on = ~(moved < 1e-9)
        if not on.all():
            left, y, above, below = left[on], y[on], above[on], below[on]
            fixed = None if fixed is None else fixed[on]
            r, w = np.empty_like(y), np.empty_like(y)
        if not len(left):
            break
    return beta.reshape(len(sets), m, k)


def _solved(gram: np.ndarray, side: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(gram, side)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(gram, side, rcond=None)[0]


def fit_linear_quantile(X: np.ndarray, y: np.ndarray, q: float, iters: int = 60,
                        eps: float = 1e-6) -> np.ndarray:
    """One regression of ``fit_linear_quantiles``."""
    return fit_linear_quantiles(X, y[:, None], [q], None, iters, eps)[0, 0]


COEF_SCHEMA = T.StructType([
    T.StructField("sku_id", T.LongType()), T.StructField("horizon", T.IntegerType()),
    T.StructField("quantile_pct", T.IntegerType()), T.StructField("intercept", T.DoubleType()),
    T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("n_rows", T.LongType())])
FIT_SCHEMA = T.StructType([*COEF_SCHEMA.fields, T.StructField("fit", T.StringType())])


def fit_quantile_models(panel: DataFrame, features: list[str], quantiles=(10, 50, 90),
                        horizons=(7, 14, 21), key: str = "sku_id") -> DataFrame:
    """One linear quantile model per (key, quantile, horizon) on rows
    with all features and targets present -> long coefficient table."""
    return _fit_quantile_sets(panel, features, quantiles, horizons, key, {"all": F.lit(True)}).drop("fit")


def fit_quantile_model_pair(panel: DataFrame, features: list[str], train: Column, quantiles=(10, 50, 90),
                            horizons=(7, 14, 21), key: str = "sku_id") -> tuple[DataFrame, DataFrame]:
    """L8 twice over one pass of the panel: the models of all rows and those of the ``train`` rows."""
    both = reliable_checkpoint(_fit_quantile_sets(panel, features, quantiles, horizons, key,
                                                  {"all": F.lit(True), "train": train}))
    return both.where("fit = 'all'").drop("fit"), both.where("fit = 'train'").drop("fit")


def _fit_quantile_sets(panel: DataFrame, features: list[str], quantiles, horizons, key: str,
                       sets: dict[str, Column]) -> DataFrame:
    """The coefficient table of each named set of rows, told apart by ``fit``."""
    targets = [f"next_{h}d" for h in horizons]
    data = panel.select(F.col(key).cast("long").alias("sku_id"),
                        *[F.col(c).cast("double").alias(c) for c in features + targets],
                        *[F.coalesce(cond, F.lit(False)).alias(f"_in_{name}") for name, cond in sets.items()])
    data = data.dropna(subset=features + targets)
    asked, names = [(h, q) for q in quantiles for h in horizons], list(sets)

    def fit(group: pa.Table) -> pa.Table:
        X, Y = (np.column_stack([group.column(c).to_numpy() for c in cs]) for cs in (features, [f"next_{h}d" for h, _ in asked]))
        sku, out = group.column("sku_id")[0].as_py(), []
        rows = np.array([group.column(f"_in_{name}").to_numpy() for name in names])
        some = rows.any(axis=1)
        names_here, rows = [x for x, any_ in zip(names, some) if any_], rows[some]
        betas = fit_linear_quantiles(X, Y, [q / 100.0 for _, q in asked], rows) if names_here else []
        for name, mine, by in zip(names_here, rows, betas):
            for (h, q), b in zip(asked, by):
                out.append((sku, h, q, float(b[0]), b[1:].tolist(), int(mine.sum()), name))
        return pa.table(list(zip(*out)) or [[] for _ in FIT_SCHEMA.fields], schema=fit_schema)

    fit_schema = to_arrow_schema(FIT_SCHEMA)
    return data.groupBy("sku_id").applyInArrow(fit, FIT_SCHEMA)


def predict_quantiles(panel: DataFrame, coefs: DataFrame, features: list[str], quantiles=(10, 50, 90),
                      horizons=(7, 14, 21), key: str = "sku_id") -> DataFrame:
    """Linear scoring; a key without a model predicts 0.0. Columns are
    ordered horizon-major then quantile. The coefficient table (one row per
    key) joins the panel by key."""
    per_key = coefs.groupBy(F.col("sku_id").alias("_k")).agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws("_", F.col("horizon").cast("string"), F.col("quantile_pct").cast("string")),
        F.struct("intercept", "coef")))).alias("_models"))
    j = panel.join(per_key, panel[key] == per_key["_k"], "left")
    x = F.array(*[F.col(c).cast("double") for c in features])
    cols = []
    for h in horizons:
        for q in quantiles:
            m = F.element_at(F.col("_models"), F.lit(f"{h}_{q}"))
            dot = F.aggregate(F.zip_with(m["coef"], x, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
            cols.append(F.coalesce(m["intercept"] + dot, F.lit(0.0)).alias(pred_col(h, q)))
    return j.select(*panel.columns, *cols)


# ----------------------------------------------------------------- L4 / L5
def gbt_regressor(max_iter: int = 200, step: float = 0.05, depth: int = 4, min_leaf: int = 3,
                  subsample: float = 0.8, seed: int = 42, features: str = "features", label: str = "y"):
    """L4: Spark ML gradient-boosted trees with the reference's settings
    (``min_samples_split`` has no Spark counterpart)."""
    from pyspark.ml.regression import GBTRegressor
    return GBTRegressor(featuresCol=features, labelCol=label, maxIter=max_iter, stepSize=step,
                        maxDepth=depth, minInstancesPerNode=min_leaf, subsamplingRate=subsample, seed=seed)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def cv_report(df: DataFrame, feature_cols: list[str], label: str, group: str, n_splits: int = 5,
              rows_per_task: int = 50_000, **gbt) -> DataFrame:
    """Per fold fit GBT on train, predict test, report MAPE/sMAPE/WAPE/
    bias; one job per fold driven from the driver."""
    from concurrent.futures import ThreadPoolExecutor

    from tillwise.operators.metrics import forecast_errors
    tagged = assemble(group_ts_split(df, group, n_splits), feature_cols).select(
        "fold", "role", "features", F.col(label).cast("double").alias(label))
    # boosting reads its rows once per tree and level, in stages of a task per
    # partition: as many partitions as the rows fill, not as the shuffle had
    tagged = reliable_checkpoint(tagged)
    parts = -(-tagged.count() // rows_per_task)
    tagged = tagged.coalesce(max(1, parts)).cache()

    def run(f: int):
        tr = tagged.where((F.col("fold") == f) & (F.col("role") == "train"))
        te = tagged.where((F.col("fold") == f) & (F.col("role") == "test"))
        model = gbt_regressor(label=label, **gbt).fit(tr)
        pred = model.transform(te)
        # materialise the fold's metrics while the model is at hand
        m = forecast_errors(pred, label, "prediction").withColumn("fold", F.lit(f)).collect()
        return m[0]

    # folds are independent jobs: submit them together so the scheduler
    # overlaps their (small, many-stage) boosting iterations
    with ThreadPoolExecutor(max_workers=min(n_splits, 8)) as pool:
        rows = list(pool.map(run, range(n_splits)))
    tagged.unpersist()
    spark = df.sparkSession
    schema = "mape double, smape double, wape double, bias double, fold int"
    return spark.createDataFrame([(r["mape"], r["smape"], r["wape"], r["bias"], r["fold"]) for r in rows], schema)


# --------------------------------------------------------------------- L11
def _c_factor(n: int) -> float:
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _build_tree(X: np.ndarray, rng: np.random.Generator, max_depth: int) -> list:
    """Nodes as (feature, threshold, left, right, size); leaves have feature -1."""
    nodes: list = []

    def grow(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append(None)
        sub = X[idx]
        if depth >= max_depth or len(idx) <= 1:
            nodes[me] = (-1, 0.0, -1, -1, len(idx))
            return me
        spans = sub.max(axis=0) - sub.min(axis=0)
        cand = np.nonzero(spans > 0)[0]
        if len(cand) == 0:
            nodes[me] = (-1, 0.0, -1, -1, len(idx))
            return me
        f = int(rng.choice(cand))
        lo, hi = sub[:, f].min(), sub[:, f].max()
        t = float(rng.uniform(lo, hi))
        left = idx[sub[:, f] < t]
        right = idx[sub[:, f] >= t]
        li = grow(left, depth + 1)
        ri = grow(right, depth + 1)
        nodes[me] = (f, t, li, ri, len(idx))
        return me

    grow(np.arange(len(X)), 0)
    return nodes


def _flat_forest(forest: list) -> tuple:
    """(sorted thresholds of each feature, trees): a tree is (depth, feature, place of
    the threshold among its feature's, children (left, right), path length at the node)."""
    nodes = [np.array(t, dtype=np.float64).reshape(-1, 5) for t in forest]
    seen = np.concatenate([np.empty((0, 5)), *nodes])
    cuts = {f: np.unique(seen[seen[:, 0] == f, 1]) for f in range(int(seen[:, 0].max(initial=-1)) + 1)}
    trees = []
    for n in nodes:
        feat, inner = n[:, 0].astype(np.intp), n[:, 0] >= 0
        place = np.zeros(len(n), dtype=np.int32)
        for f, c in cuts.items():
            place[feat == f] = np.searchsorted(c, n[feat == f, 1])
        # a leaf leads to itself, so that rows at leaves stay there
        children = np.where(inner[:, None], n[:, 2:4], np.arange(len(n))[:, None]).astype(np.intp)
        depth = np.zeros(len(n), dtype=np.intp)
        for i in np.flatnonzero(inner):  # a node comes before its children
            depth[children[i]] = depth[i] + 1
        path = depth + np.array([_c_factor(int(k)) for k in n[:, 4]])
        trees.append((int(depth.max()), np.where(inner, feat, 0), place, children.ravel(), path))
    return cuts, trees


def _mean_path(X: np.ndarray, flat: tuple, rows: int = 8192) -> np.ndarray:
    """Mean path length of each row. Values become places among the thresholds of all trees
    once (not a number: beyond the last, to the right as ``<`` has it); the rows step down
    a tree together, some at a time so that they stay in the cache."""
    cuts, trees = flat
    out = np.empty(len(X))
    for lo in range(0, len(X), rows):
        part = X[lo:lo + rows]
        size = len(part)
        places = np.zeros((max(1, len(cuts)), size), dtype=np.int32)
        for f, c in cuts.items():
            places[f] = np.searchsorted(c, part[:, f], side="right")
        places, own, total = places.ravel(), np.arange(size), np.zeros(size)
        for depth, feat, place, children, path in trees:
            start = feat * size
            at = np.zeros(size, dtype=np.intp)
            for _ in range(depth):
                right = places.take(start.take(at) + own) > place.take(at)
                at = children.take(2 * at + right)
            total += path.take(at)
        out[lo:lo + rows] = total / max(1, len(trees))
    return out


TREE_SCHEMA = T.StructType([T.StructField("tree", T.IntegerType()), T.StructField("nodes", T.StringType())])


def isolation_forest(train: DataFrame, features: list[str], n_trees: int = 100, max_samples: int = 256,
                     seed: int = 42, id_col: str | None = None) -> tuple[list, int]:
    """L11 fit: each tree draws its own seeded sub-sample (one hash per
    (tree, row)), the sub-samples are grouped by tree id and each tree is
    grown in its own grouped-map task. The forest (n_trees x <= 2*max_samples
    nodes) is returned to the driver: a bounded model, not data."""
    import json
    n = train.count()
    psi = min(max_samples, n)
    rid = F.col(id_col) if id_col else F.monotonically_increasing_id()
    rows = train.select(*[F.col(c).cast("double").alias(c) for c in features], rid.cast("string").alias("_rid"))

    def u(t):
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), t, F.col("_rid")), 11) / F.lit(float(1 << 53))

    # each row joins only the trees whose draw falls under a 2x oversampling
    # rate, so the sample table has ~2 * psi rows per tree, not n per tree; one
    # draw first leaves out the rows that no tree needs
    rate = min(1.0, 2.0 * psi / max(n, 1))
    some = min(1.0, n_trees * rate)
    rows = rows.where(u(F.lit(-1)) < F.lit(some))
    picked = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: u(t) < F.lit(rate / some))
    rows = rows.withColumn("tree", F.explode(picked)).withColumn("_u", u(F.col("tree")))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("_u", "_rid"))
    sample = rows.withColumn("_r", rank).where(F.col("_r") <= psi).drop("_r", "_u")
    depth = int(np.ceil(np.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(seed * 100003 + t)
        nodes = _build_tree(pdf[features].to_numpy(dtype=np.float64), rng, depth)
        return pd.DataFrame({"tree": [t], "nodes": [json.dumps(nodes)]})

    forest = sample.groupBy("tree").applyInPandas(grow, TREE_SCHEMA).collect()
    return [json.loads(r["nodes"]) for r in sorted(forest, key=lambda r: r["tree"])], psi


def isolation_scores(df: DataFrame, features: list[str], forest: list, psi: int, out: str = "score") -> DataFrame:
    """L11 score: ``-score_samples`` = 2^(-mean path / c(psi)), computed by an
    Arrow-batched pandas UDF with the forest broadcast once."""
    from pyspark.sql.functions import pandas_udf
    bc = df.sparkSession.sparkContext.broadcast(_flat_forest(forest))
    c = _c_factor(psi)

    @pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        X = np.column_stack([s.to_numpy(dtype=np.float64) for s in cols])
        return pd.Series(np.power(2.0, -_mean_path(X, bc.value) / c))

    return df.withColumn(out, score(*[F.col(f).cast("double") for f in features]))


# --------------------------------------------------------------------- L6
def _tree_arrays(spark, model, workdir: str) -> list[dict]:
    """Node arrays of a fitted GBT model read back from its saved ``data``
    table (one small row per node; the forest size is bounded by
    maxIter x 2^(depth+1))."""
    import os
    path = os.path.join(workdir, "gbt_model")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data")).select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        "nodeData.split.featureIndex", F.col("nodeData.split.leftCategoriesOrThreshold").alias("thr")).collect()
    trees: dict[int, list] = {}
    for r in nodes:
        trees.setdefault(r["treeID"], []).append(r)
    out = []
    for t in sorted(trees):
        rows = sorted(trees[t], key=lambda r: r["id"])
        out.append({"pred": np.array([r["prediction"] for r in rows]),
                    "left": np.array([r["leftChild"] for r in rows]),
                    "right": np.array([r["rightChild"] for r in rows]),
                    "feat": np.array([r["featureIndex"] for r in rows]),
                    "thr": np.array([(r["thr"][0] if r["thr"] else 0.0) for r in rows])})
    return out


def _tree_predict(tree: dict, X: np.ndarray) -> np.ndarray:
    node = np.zeros(len(X), dtype=np.int64)
    active = tree["left"][node] >= 0
    while active.any():
        idx = np.nonzero(active)[0]
        n = node[idx]
        go_left = X[idx, tree["feat"][n]] <= tree["thr"][n]
        node[idx] = np.where(go_left, tree["left"][n], tree["right"][n])
        active = tree["left"][node] >= 0
    return tree["pred"][node]


def virtual_ensemble(df: DataFrame, model, feature_cols: list[str], workdir: str, k: int = 20,
                     width: float = 3.0) -> DataFrame:
    """Staged predictions of the boosted model at iterations
    ``range(n // 2 - 1, n, k)`` (the prefix sums of weight x tree output),
    their mean, population variance, and ``mean -/+ width * sqrt(var)``.
    An empty stage list yields zeros."""
    from pyspark.sql.functions import pandas_udf
    spark = df.sparkSession
    trees = _tree_arrays(spark, model, workdir)
    weights = list(model.treeWeights)
    n = len(trees)
    stages = list(range(n // 2 - 1, n, k))
    bc = spark.sparkContext.broadcast((trees, weights, stages))

    @pandas_udf("array<double>")
    def staged(*cols: pd.Series) -> pd.Series:
        ts_, ws, st = bc.value
        X = np.column_stack([c.to_numpy(dtype=np.float64) for c in cols])
        acc = np.zeros(len(X))
        picks = []
        want = set(st)
        for i, (t, w) in enumerate(zip(ts_, ws)):
            acc = acc + w * _tree_predict(t, X)
            if i in want:
                picks.append(acc.copy())
        mat = np.column_stack(picks) if picks else np.zeros((len(X), 0))
        return pd.Series([row.tolist() for row in mat])

    out = df.withColumn("pred", staged(*[F.col(c).cast("double") for c in feature_cols]))
    m = F.when(F.size("pred") > 0, F.aggregate("pred", F.lit(0.0), lambda s, x: s + x) / F.size("pred")) \
        .otherwise(F.lit(0.0))
    out = out.withColumn("pred_virt", m)
    var = F.when(F.size("pred") > 0, F.aggregate("pred", F.lit(0.0),
                                                 lambda s, x: s + (x - F.col("pred_virt")) * (x - F.col("pred_virt")))
                 / F.size("pred")).otherwise(F.lit(0.0))
    out = out.withColumn("uncertainty", var)
    sd = F.sqrt("uncertainty")
    return out.withColumn("lcb", F.col("pred_virt") - width * sd).withColumn("ucb", F.col("pred_virt") + width * sd)
