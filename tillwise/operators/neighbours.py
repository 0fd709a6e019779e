"""Exact nearest neighbours by metric partitioning, and what is built on them
(T14 nearest rows, T20 prices of similar items, T21 uniqueness, L12 local outlier factor).

Points belong to their nearest pivot (a bounded list of points of least hash).
The points of a pivot are cut by their distance to it into shells of about
``block`` points; a shell that holds more, because many points lie equally far,
is dealt out by hash. A query first meets the shell that it lies in itself,
which bounds the distance of its k-th neighbour, and then only the shells that
can hold a nearer point by the triangle inequality. Shells and chunks of
queries meet in cells of bounded size, each of which returns k rows for a query
at most; these lists are merged by salted ranks. No pairs are emitted, and only
the pivots (at most ``most_pivots``) reach the driver.

Points of few components (``nearest_in_boxes``) lie in the boxes of a tree instead,
whose number grows with theirs: a query meets the box that it lies in and those
that its bound reaches, so its work does not grow with the table.

Defined results: rows whose vector is null, empty or holds a null or non-finite
component take no part; vectors of different length are never neighbours; among
equal distances the smaller key comes first; rows that share a key are separate
neighbours, but a query has none of its own key; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.cells import runs
from tillwise.functions.topk import top_k_per_group
from tillwise.session import reliable_checkpoint

SLACK = 1e-9


def usable(vec: Column) -> Column:
    """The vector in doubles; null if it takes no part."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when((F.size(vec) > 0) & ~bad, F.transform(vec, lambda x: x.cast("double")))


class Pivots:
    """Pivots by length of vector, numbered through."""

    def __init__(self, vectors: list[list[float]]):
        self.of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for dim in {len(v) for v in vectors}:
            ids = [i for i, v in enumerate(vectors) if len(v) == dim]
            self.of[dim] = np.array(ids), np.array([vectors[i] for i in ids], dtype="f8")

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pivots of this length, and the distance of ``x`` to each."""
        if x.size not in self.of:
            return np.array([-1 - x.size]), np.zeros(1)  # vectors of a length without a pivot share a cell
        ids, p = self.of[x.size]
        return ids, np.sqrt(((p - x) ** 2).sum(axis=1))


def _map(df: DataFrame, make, schema: str) -> DataFrame:
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    types = [{"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[f.strip().split(" ")[1]] for f in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = make(b)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
    return df.mapInArrow(run, schema)


def _vectors(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.asarray(v.values) for v in batch.column("vec")]


def _nearest(rows: DataFrame, pivots: Pivots, key: str) -> DataFrame:
    """(key, cell, d): nearest pivot and the distance to it."""
    def make(batch: pa.RecordBatch) -> list[tuple]:
        out = []
        for k, x in zip(batch.column(key).to_pylist(), _vectors(batch)):
            ids, d = pivots.distances(x)
            at = int(d.argmin())
            out.append((k, int(ids[at]), float(d[at])))
        return out
    return _map(rows.select(key, "vec"), make, f"{key} long, cell int, d double")


def _reached(queries: DataFrame, pivots: Pivots, radius: dict[int, float]) -> DataFrame:
    """(query, cell, d) of all cells whose ball the query's bound meets."""
    def make(batch: pa.RecordBatch) -> list[tuple]:
        out = []
        for k, x, bound in zip(batch.column("query").to_pylist(), _vectors(batch), batch.column("bound").to_pylist()):
            ids, d = pivots.distances(x)
            far = np.array([radius.get(int(i), -1.0) for i in ids])
            meets = (far >= 0) & (d - far <= bound * (1 + SLACK) + SLACK)
            out += [(k, int(i), float(y)) for i, y in zip(ids[meets], d[meets])]
        return out
    return _map(queries.select("query", "vec", "bound"), make, "query long, cell int, d double")


def _closest(table: pa.Table, k: int) -> pa.RecordBatch | None:
    """Of one cell: each query's ``k`` closest points."""
    is_query = np.asarray(table.column("query").is_valid())
    size = np.asarray(table.column("size"))
    out = []
    for dim in np.unique(size[is_query]).tolist():
        q_at, x_at = np.flatnonzero(is_query & (size == dim)), np.flatnonzero(~is_query & (size == dim))
        if not x_at.size:
            continue
        take = lambda at: table.column("vec").combine_chunks().take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)
        q, x = take(q_at), take(x_at)
        whole = lambda name: table.column(name).fill_null(0).to_numpy()  # noqa: E731  (an array with nulls would become one of doubles)
        query, key, bound, weight = whole("query")[q_at], whole("key")[x_at], whole("bound")[q_at], whole("weight")[x_at]
        x2 = (x ** 2).sum(axis=1)
        for lo in range(0, len(q), 256):
            part = q[lo:lo + 256]
            q2 = (part ** 2).sum(axis=1)
            near = q2[:, None] + x2[None, :] - 2 * (part @ x.T)
            near[query[lo:lo + 256][:, None] == key[None, :]] = np.inf
            # rounding of this form; what is kept is measured again by differences
            slack = SLACK * (q2 + x2.max()) + 1e-300
            limit = (bound[lo:lo + 256] * (1 + SLACK)) ** 2 + slack
            many = np.flatnonzero((near <= limit[:, None]).sum(axis=1) > k)  # the bound alone leaves the others k at most
            limit[many] = np.minimum(limit[many], np.partition(near[many], min(k, near.shape[1]) - 1, axis=1)[:, min(k, near.shape[1]) - 1] + slack[many])
            i, j = np.nonzero((near <= limit[:, None]) & np.isfinite(near))
            d = np.sqrt(((part[i] - x[j]) ** 2).sum(axis=1))
            order = np.lexsort((key[j], d, i))
            i, j, d = i[order], j[order], d[order]
            rank = np.arange(i.size) - np.searchsorted(i, i)
            i, j, d = i[rank < k], j[rank < k], d[rank < k]
            out.append((query[lo:lo + 256][i], key[j], weight[j], d))
    if not out:
        return None
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[n] for o in out])) for n in range(4)], names=["query", "key", "weight", "distance"])


FOUND = "query long, key long, weight long, distance double"


def _meet(visits: DataFrame, placed: DataFrame, blocks: DataFrame, chunk: int, answer, schema: str) -> DataFrame:
    """``answer`` of each cell in which a chunk of ``visits`` (query, cell, shell, vec, bound) meets a part of a block of points."""
    load = visits.groupBy("cell", "shell").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    load = load.join(blocks.select("cell", "shell", "parts"), ["cell", "shell"])
    names = ["cell", "shell", "part", "chunk", "query", "key", "weight", "bound", F.size("vec").alias("size"), "vec"]
    each = lambda c: F.explode(F.expr(f"sequence(0, {c} - 1)"))
    mine = (visits.join(load, ["cell", "shell"]).withColumn("chunk", F.expr("cast(pmod(xxhash64(query), chunks) as int)"))
            .withColumn("part", each("parts")).withColumns({"key": F.lit(None).cast("long"), "weight": F.lit(None).cast("long")}))
    theirs = (placed.join(load, ["cell", "shell"]).withColumn("part", F.expr("cast(pmod(xxhash64(key, vec), parts) as int)"))
              .withColumn("chunk", each("chunks")).withColumns({"query": F.lit(None).cast("long"), "bound": F.lit(None).cast("double")}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in runs(batches, ["cell", "shell", "part", "chunk"]):
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                found = answer(table.slice(lo, hi - lo).combine_chunks())
                if found:
                    yield found

    keys = ["cell", "shell", "part", "chunk"]
    return mine.select(*names).unionByName(theirs.select(*names)).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def nearest(queries: DataFrame, points: DataFrame, k: int, block: int = 4096, chunk: int = 1024,
            per_pivot: int = 2048, most_pivots: int = 256) -> DataFrame:
    """(query, rank, key, weight, distance): the ``k`` points nearest to each query.

    ``queries``: (query long, unique; vec array<double>), ``points``: (key long,
    weight long, vec array<double>), vectors as from ``usable`` and not null."""
    points = reliable_checkpoint(points.select(F.col("key").cast("long"), F.col("weight").cast("long"), "vec"))
    queries = reliable_checkpoint(queries.select(F.col("query").cast("long"), "vec"))
    n = points.count()
    number = min(most_pivots, max(1, math.ceil(n / per_pivot)))
    drawn = points.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(number)
    pivots = Pivots([r[0] for r in drawn.collect()])
    at = points.withColumn("cell", F.lit(0)).withColumn("d", F.lit(0.0)).limit(0) if not n else _with(points, pivots)
    cells = at.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("radius"))
    cells = reliable_checkpoint(cells)
    radius = {r["cell"]: r["radius"] for r in cells.collect()}  # a row for each pivot
    most = max(1, math.ceil((cells.agg(F.max("n")).first()[0] or 1) / block))
    grid = [i / most for i in range(1, most)]
    # shells of about ``block`` points: every so many of the quantiles that the largest cell needs
    cuts = (at.groupBy("cell").agg(F.percentile_approx("d", F.array(*[F.lit(g) for g in grid]), 10 * most).alias("cuts")) if grid
            else at.select("cell", F.lit(None).cast("array<double>").alias("cuts")).distinct())
    shells = cells.join(cuts, "cell").select("cell", F.expr(
        f"array_distinct(filter(cuts, (c, i) -> (i + 1) % cast(greatest(1, floor({most} * {block} / n)) as int) = 0))").alias("cuts"))
    shell = F.size(F.filter(F.coalesce("cuts", F.array().cast("array<double>")), lambda c: c < F.col("d"))).alias("shell")
    placed = reliable_checkpoint(at.join(shells, "cell").select("key", "weight", "vec", "cell", "d", shell))
    blocks = (placed.groupBy("cell", "shell").agg(F.min("d").alias("near"), F.max("d").alias("far"), F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts")))
    blocks = reliable_checkpoint(blocks)

    def met(visits: DataFrame) -> DataFrame:
        """``visits``: (query, cell, shell), with vec and bound of the queries."""
        found = _meet(visits, placed, blocks, chunk, lambda cell: _closest(cell, k), FOUND)
        # rows that share key and distance are separate; the salt deals them out
        return top_k_per_group(found, ["query"], [F.asc("distance"), F.asc("key")], k)

    own = _nearest(queries, pivots, "query").join(shells, "cell").select("query", "cell", shell).join(queries, "query")
    # a query beyond the last point of its cell takes the outermost shell
    last = blocks.groupBy("cell").agg(F.max("shell").alias("last"), F.min("shell").alias("first"))
    own = own.join(last, "cell").withColumn("shell", F.greatest(F.least("shell", "last"), "first")).drop("last", "first")
    first = met(own.withColumn("bound", F.lit(float("inf"))))
    bound = first.where(F.col("rank") == k).select("query", F.col("distance").alias("bound"))
    bounded = reliable_checkpoint(queries.join(bound, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf")))))
    reach = _reached(bounded, pivots, radius).join(bounded, "query").join(blocks.drop("parts"), "cell")
    limit = F.col("bound") * (1 + SLACK) + SLACK
    visits = reach.where((F.col("d") - F.col("far") <= limit) & (F.col("near") - F.col("d") <= limit)).select("query", "cell", "shell", "vec", "bound")
    return met(reliable_checkpoint(visits)).select("query", "rank", "key", "weight", "distance")


def _with(points: DataFrame, pivots: Pivots) -> DataFrame:
    """``points`` with cell and distance, without a join."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, dist = [], []
            for x in _vectors(b):
                ids, d = pivots.distances(x)
                at = int(d.argmin())
                cell.append(int(ids[at]))
                dist.append(float(d[at]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(dist, pa.float64())], names=[*b.schema.names, "cell", "d"])
    return reliable_checkpoint(points.mapInArrow(run, "key long, weight long, vec array<double>, cell int, d double"))


# ------------------------------------------------------- few components
#: Vectors of at most so many components are searched in boxes.
BOXED = 8
#: Sampled points to a box of the tree.
DRAWN = 16


class Boxes:
    """A tree of cuts through the widest component of a sample, near its median. A leaf is a cell; the
    box of each node is that of all points in it (``bind``), so a query skips what its bound does not reach."""

    def __init__(self, sample: np.ndarray, leaves: int):
        most = max(1, math.ceil(len(sample) / leaves))
        nodes: list[list] = []  # component, cut, child below the cut, child from the cut on; a leaf is its own child
        todo: list[tuple] = [(sample, None, None)]
        while todo:
            part, above, side = todo.pop()
            node = len(nodes)
            nodes.append([0, 0.0, node, node])
            if above is not None:
                nodes[above][side] = node
            if len(part) <= most or not (spread := np.ptp(part, axis=0)).max() > 0:
                continue
            d = int(spread.argmax())
            v = np.sort(part[:, d])
            at = v[len(v) // 2]
            at = at if at > v[0] else v[v > at][0]
            nodes[node][:2] = d, at
            todo += [(part[part[:, d] < at], node, 2), (part[part[:, d] >= at], node, 3)]
        self.dim, self.cut, self.left, self.right = (np.array(c) for c in zip(*nodes))

    def cells(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype="i8")
        while True:
            down = np.where(x[np.arange(len(x)), self.dim[at]] < self.cut[at], self.left[at], self.right[at])
            if (down == at).all():
                return at
            at = down

    def bind(self, cells: list[int], least: np.ndarray, most: np.ndarray) -> None:
        """Boxes of the leaves ``cells``, and of the nodes above them."""
        self.least = np.full((len(self.dim), least.shape[1]), np.inf)
        self.most = -self.least
        self.least[cells], self.most[cells] = least, most
        for node in reversed(range(len(self.dim))):  # a child comes after its parent
            below = [self.left[node], self.right[node]]
            self.least[node], self.most[node] = self.least[below].min(axis=0), self.most[below].max(axis=0)

    def reached(self, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``x``, cell) of the boxes no farther than the row's bound."""
        rows, cells = [np.zeros(0, dtype="i8")], [np.zeros(0, dtype="i8")]
        limit = bound * (1 + SLACK) + SLACK
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            gap = np.maximum(np.maximum(self.least[node] - x[at], x[at] - self.most[node]), 0)
            at = at[np.sqrt((gap ** 2).sum(axis=1)) <= limit[at]]
            if at.size and self.left[node] == node:
                rows.append(at)
                cells.append(np.full(at.size, node))
            elif at.size:
                todo += [(self.left[node], at), (self.right[node], at)]
        return np.concatenate(rows), np.concatenate(cells)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vec").flatten().to_numpy().reshape(batch.num_rows, -1)


def _in_cells(rows: DataFrame, boxes: Boxes, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(boxes.cells(_matrix(b)), pa.int32())], names=[*b.schema.names, "cell"])
    return rows.mapInArrow(run, f"{schema}, cell int").withColumn("shell", F.lit(0))


def _kth(cell: pa.Table, k: int) -> pa.RecordBatch | None:
    """Of one cell: the distance of the ``k``-th point of each query that has as many."""
    found = _closest(cell, k)
    if not found:
        return None
    query = found.column("query").to_numpy()
    start = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
    full = start[np.diff(np.append(start, query.size)) == k] + k - 1
    return pa.RecordBatch.from_arrays([found.column("query").take(pa.array(full)), found.column("distance").take(pa.array(full))], names=["query", "bound"])


def nearest_in_boxes(queries: DataFrame, points: DataFrame, k: int, block: int = 4096, chunk: int = 8192,
                     per_pivot: int = 1024, most_pivots: int = 16384) -> DataFrame:
    """``nearest`` for vectors that all have the same few components, by boxes of about ``per_pivot`` points.

    The driver holds the tree: ``most_pivots`` boxes at most, cut through ``DRAWN`` sampled points each. The sample
    only decides where the cuts lie; beyond that number the boxes hold more points."""
    points = reliable_checkpoint(points.select(F.col("key").cast("long"), F.col("weight").cast("long"), "vec"))
    n, width = points.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not n:
        return queries.sparkSession.createDataFrame([], f"query long, rank int, {FOUND.removeprefix('query long, ')}")
    number = min(most_pivots, math.ceil(n / per_pivot))
    share = math.ceil(min(1.0, number * DRAWN / n) * 2 ** 30)
    drawn = points.where(F.pmod(F.xxhash64("key", "vec", F.lit("drawn")), F.lit(2 ** 30)) < share).select("vec").collect()
    boxes = Boxes(np.array([r[0] for r in drawn], dtype="f8").reshape(-1, width), number)
    placed = reliable_checkpoint(_in_cells(points, boxes, "key long, weight long, vec array<double>"))
    ends = [f(F.col("vec")[i]) for f in (F.min, F.max) for i in range(width)]
    blocks = reliable_checkpoint(placed.groupBy("cell", "shell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"), F.array(*ends).alias("ends")))
    held = blocks.select("cell", "ends").collect()  # a row for each box
    ends = np.array([r["ends"] for r in held], dtype="f8")
    boxes.bind([r["cell"] for r in held], ends[:, :width], ends[:, width:])
    own = reliable_checkpoint(_in_cells(queries.select(F.col("query").cast("long"), "vec"), boxes, "query long, vec array<double>"))
    # the k-th distance within a part of the own box is a bound, the least over its parts the best one
    first = _meet(own.withColumn("bound", F.lit(float("inf"))), placed, blocks, chunk, lambda cell: _kth(cell, k), "query long, bound double")
    bounded = own.join(first.groupBy("query").agg(F.min("bound").alias("bound")), "query", "left")
    # rows of a box together: a batch then reaches few of the nodes
    bounded = (bounded.select("query", "cell", "vec", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
               .repartitionByRange("cell", "query").sortWithinPartitions("cell"))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rows, cells = boxes.reached(_matrix(b), b.column("bound").to_numpy())
                met = b.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([met.column("query"), pa.array(cells, pa.int32()), met.column("vec"), met.column("bound")], names=["query", "cell", "vec", "bound"])

    visits = reliable_checkpoint(bounded.mapInArrow(reach, "query long, cell int, vec array<double>, bound double").withColumn("shell", F.lit(0)))
    found = _meet(visits, placed, blocks, chunk, lambda cell: _closest(cell, k), FOUND)
    # at most k rows of each part of a box that a query reaches
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "key"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "rank", "key", "weight", "distance")


# ------------------------------------------------------------- T14, T20, T21
def knn_topk(rows: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", **sizes) -> DataFrame:
    """(query_id, rank, neighbour_id, distance) of the rows that ``is_query`` chooses, against all rows.

    Rows without an id take no part; of several queries with one id, that of the least vector counts."""
    good = rows.select(rows[id_col].cast("long").alias("key"), usable(rows[vector_col]).alias("vec"), is_query.alias("asks"))
    good = reliable_checkpoint(good.where("key is not null and vec is not null"))
    queries = good.where("asks").groupBy(F.col("key").alias("query")).agg(F.min("vec").alias("vec"))
    found = nearest(queries, good.select("key", F.lit(1).alias("weight"), "vec"), k, **sizes)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("key").alias("neighbour_id"), "distance")


def similar_item_price(graph: DataFrame, prices: DataFrame, id_col: str, price_col: str) -> DataFrame:
    """Per query item its own price, the mean price of its neighbours that have one, weighted by
    1 / (1 + distance), and the ratio; items without a priced neighbour are left out."""
    priced = prices.select(F.col(id_col).alias("neighbour_id"), F.col(price_col).cast("double").alias("p")).where("p is not null")
    w = 1 / (1 + F.col("distance"))
    near = graph.join(priced, "neighbour_id").groupBy("query_id").agg(
        (F.sum(w * F.col("p")) / F.sum(w)).alias("similar_price"), F.count(F.lit(1)).alias("n_priced"))
    own = priced.select(F.col("neighbour_id").alias("query_id"), F.col("p").alias("price"))
    return near.join(own, "query_id").select("query_id", "price", "similar_price", "n_priced",
                                             F.try_divide("price", "similar_price").alias("price_ratio"))


def sku_uniqueness(graph: DataFrame) -> DataFrame:
    """Mean distance to the neighbours; ``place`` 1 is the most unique item (ties by id)."""
    from tillwise.functions.prefix import ordered_prefix_sums
    mean = graph.groupBy("query_id").agg(F.avg("distance").alias("uniqueness"), F.count(F.lit(1)).alias("n_neighbours"))
    return ordered_prefix_sums(mean, [F.desc("uniqueness"), F.asc("query_id")], {}, row_number="place")


# ------------------------------------------------------------------ L12
#: Added to the mean reachability distance before it is inverted; fixed value.
LRD_FLOOR = 1e-10


def _used(found: DataFrame, k: int) -> DataFrame:
    """Of each query's neighbours, nearest first, as many of their copies as make ``k``."""
    before = F.coalesce(F.sum("weight").over(Window.partitionBy("query").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (found.withColumn("used", F.least(F.col("weight"), F.lit(k) - before)).where("used > 0")
            .select("query", "key", "used", "distance"))


def lof_scores(train: DataFrame, test: DataFrame, features: list[str], k: int = 20, id_col: str = "id", **sizes) -> DataFrame:
    """(id, score) of each row of ``test``: local outlier factor against ``train`` (novelty form).

    Equal train rows are one point with a weight, so many copies cost one row. A neighbour list has
    k rows, or all other rows where there are fewer; a point without any has no density and is left out.
    Rows with a null or non-finite feature take no part."""
    vec = lambda df: usable(F.array(*[df[f].cast("double") + F.lit(0.0) for f in features]))
    points = (train.select(vec(train).alias("vec")).where("vec is not null").groupBy("vec").agg(F.count(F.lit(1)).alias("weight"))
              .select(F.xxhash64("vec").alias("key"), "weight", "vec"))
    points = reliable_checkpoint(points)
    asked = test.select(test[id_col].alias("id"), vec(test).alias("vec")).where("vec is not null")
    # test rows of one vector are one query, whose number is no key of a point: an equal train row is its neighbour
    distinct = reliable_checkpoint(asked.groupBy("vec").agg(F.count(F.lit(1)).alias("rows")).select(F.xxhash64("vec", F.lit("asked")).alias("query"), "vec"))
    search = nearest_in_boxes if len(features) <= BOXED else nearest
    found = search(points.select(F.col("key").alias("query"), "vec").unionByName(distinct), points, k, **sizes)
    used = reliable_checkpoint(_used_with_copies(points, found, k))  # of points and of test rows
    reach = used.groupBy("query").agg(F.max("distance").alias("kdist"))
    density = reliable_checkpoint(_density(used, reach))
    near = used.join(distinct.select("query"), "query", "left_semi")
    around = (near.join(density.select(F.col("query").alias("key"), "lrd"), "key").groupBy("query")
              .agg((F.sum(F.col("used") * F.col("lrd")) / F.sum("used")).alias("around")))
    scores = density.join(around, "query").select("query", (F.col("around") / F.col("lrd")).alias("score"))
    return asked.join(distinct, "vec").join(scores, "query").select("id", "score")


def _used_with_copies(points: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """A point's own further copies come first, at distance 0."""
    copies = points.where("weight > 1").select(F.col("key").alias("query"), F.lit(0).alias("rank"), "key", (F.col("weight") - 1).alias("weight"), F.lit(0.0).alias("distance"))
    return _used(found.select("query", "rank", "key", "weight", "distance").unionByName(copies), k)


def _density(used: DataFrame, reach: DataFrame) -> DataFrame:
    """Local reachability density of each query from its neighbours' k-distances."""
    of = reach.select(F.col("query").alias("key"), "kdist")
    return (used.join(of, "key").groupBy("query")
            .agg((F.sum(F.col("used") * F.greatest("kdist", "distance")) / F.sum("used")).alias("m"))
            .select("query", (1 / (F.col("m") + LRD_FLOOR)).alias("lrd")))
