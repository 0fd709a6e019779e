"""Uplift tree (T26): where a treatment works, found by splits that drive the
outcome rates of treated and control rows apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.session import reliable_checkpoint

COUNTS = ("nt", "nc", "yt", "yc")  # rows and outcomes of treated and control


def _cube(df: DataFrame, features: list[str], outcome: str, treated: str) -> DataFrame:
    """Counts of every combination of feature bins: all that the tree reads of the rows."""
    t, y = F.col(treated), F.col(outcome).cast("long")
    rows = df.where(t.isNotNull() & y.isNotNull())
    return rows.groupBy(*[F.col(f).cast("long").alias(f) for f in features]).agg(
        F.count(F.when(t, 1)).alias("nt"), F.count(F.when(~t, 1)).alias("nc"),
        F.coalesce(F.sum(F.when(t, y)), F.lit(0)).alias("yt"), F.coalesce(F.sum(F.when(~t, y)), F.lit(0)).alias("yc"))


def node_of(splits: dict[int, tuple[str, int]]) -> Column:
    """Number of the leaf a row falls in: the root is 1, the children of n are 2n
    (bin at most the split's) and 2n + 1 (above it, or null)."""
    def below(node: int) -> Column:
        if node not in splits:
            return F.lit(node).cast("long")
        feature, last = splits[node]
        return F.when(F.col(feature) <= last, below(2 * node)).otherwise(below(2 * node + 1))
    return below(1)


def _best_splits(cube: DataFrame, node: Column, features: list[str], min_arm: int) -> DataFrame:
    """Per node the split of largest divergence gain; ties go by feature name, then bin.

    The gain is the rise of the squared difference between the two rates, children
    weighted by their rows. A histogram has one row per node, feature and bin."""
    bins = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in sorted(features)]))
    hist = (cube.select(node.alias("node"), *COUNTS, bins.alias("b")).select("node", "b.*", *COUNTS)
            .groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in COUNTS]))
    each = Window.partitionBy("node", "feature")
    run = each.orderBy(F.col("bin").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    x = hist.select("node", "feature", "bin", *[F.sum(c).over(run).alias(f"l_{c}") for c in COUNTS],
                    *[F.sum(c).over(each).alias(f"a_{c}") for c in COUNTS])
    x = x.select("*", *[(F.col(f"a_{c}") - F.col(f"l_{c}")).alias(f"r_{c}") for c in COUNTS])
    enough = F.least("l_nt", "l_nc", "r_nt", "r_nc") >= max(min_arm, 1)
    x = x.where(enough & F.col("bin").isNotNull())

    def diff(p):
        return F.col(f"{p}_yt") / F.col(f"{p}_nt") - F.col(f"{p}_yc") / F.col(f"{p}_nc")

    def share(p):
        return (F.col(f"{p}_nt") + F.col(f"{p}_nc")) / (F.col("a_nt") + F.col("a_nc"))

    gain = (share("l") * (diff("l") * diff("l")) + share("r") * (diff("r") * diff("r"))) - diff("a") * diff("a")
    x = x.withColumn("gain", gain).where("gain > 0")
    return x.groupBy("node").agg(F.min(F.struct((-F.col("gain")).alias("neg"), "feature", "bin")).alias("s")).select(
        "node", "s.feature", "s.bin", (-F.col("s.neg")).alias("gain"))


def fit_uplift_tree(df: DataFrame, features: list[str], outcome: str, treated: str, depth: int = 3,
                    min_arm: int = 50) -> tuple[DataFrame, dict[int, tuple[str, int]]]:
    """(one row per node, splits for ``node_of``).

    ``features`` are small integer bins (a null bin goes to the right), ``outcome``
    is 0 or 1, ``treated`` a boolean; rows without outcome or arm take no part. A
    child keeps at least ``min_arm`` rows of either arm. Each level is one aggregation over the
    checkpointed combinations of bins; only the splits, at most 2^depth, reach the driver.
    An empty input gives no node. Columns: node, feature, last_bin, gain (null for
    leaves), n_treat, n_ctrl, rate_treat, rate_ctrl, uplift.
    """
    cube = reliable_checkpoint(_cube(df, features, outcome, treated))
    splits: dict[int, tuple[str, int]] = {}
    gains: dict[int, float] = {}
    for level in range(depth):
        found = _best_splits(cube.withColumn("_n", node_of(splits)).where(F.col("_n") >= 1 << level), F.col("_n"),
                             features, min_arm).collect()
        if not found:
            break
        for r in found:
            splits[r["node"]], gains[r["node"]] = (r["feature"], r["bin"]), r["gain"]
    ancestors = F.explode(F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda k: F.floor(F.col("_n") / F.pow(F.lit(2), k))))
    sums = (cube.withColumn("_n", node_of(splits)).groupBy("_n").agg(*[F.sum(c).alias(c) for c in COUNTS])
            .select(ancestors.alias("node"), *COUNTS).where("node > 0")
            .groupBy("node").agg(*[F.sum(c).alias(c) for c in COUNTS]))
    table = [(n, f, b, gains[n]) for n, (f, b) in splits.items()]
    named = df.sparkSession.createDataFrame(table, "node long, feature string, last_bin long, gain double")
    rate_t, rate_c = (F.when(F.col(n) > 0, F.col(y) / F.col(n)) for n, y in (("nt", "yt"), ("nc", "yc")))
    nodes = sums.join(F.broadcast(named), "node", "left").select(
        "node", "feature", "last_bin", "gain", F.col("nt").alias("n_treat"), F.col("nc").alias("n_ctrl"),
        rate_t.alias("rate_treat"), rate_c.alias("rate_ctrl"), (rate_t - rate_c).alias("uplift"))
    return nodes, splits


def score_uplift(df: DataFrame, nodes: DataFrame, splits: dict[int, tuple[str, int]]) -> DataFrame:
    """``df`` with the ``node`` of each row and the ``uplift`` measured there; at most 2^depth leaves are joined."""
    return df.drop("node", "uplift").withColumn("node", node_of(splits)).join(
        F.broadcast(nodes.select("node", "uplift")), "node", "left")
