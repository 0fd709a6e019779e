"""Embedding near duplicates by spherical-cap filters.

The filter directions are a random product code: the components fall into ``blocks``
blocks, each with ``codes`` random unit vectors, and a direction is one of them per
block, so there are codes ** blocks directions and none needs to be stored. A vector
passes the directions whose inner product with it reaches its cap, which is set per
vector so that exactly ``passes`` directions do: with one cap for all, 40 % of random
64-component vectors passed none and some a thousand. The directions are listed by
decoding the code: the best sums can only come from the best sums of its two halves.
Vectors are joined on the directions they both pass, and every pair that meets is
verified by cosine in double precision, whatever its label.

Pairs are counted, not emitted: a pair that meets under several directions counts at
the smallest one both pass. Equal vectors are one class with a weight. A direction
that very many vectors pass is split into bounded cells (``cells``).

The search is probabilistic: a pair is missed only if no direction has both (of pairs
at cosine 0.95 exactly, about 0.4 % with these parameters, and none seen at 0.97).
``codes`` is to grow with the table: a direction is passed by
n * passes / codes ** blocks vectors. Recall is measured against brute force in the tests.

Defined results: vectors that are null, zero, or hold null or non-finite components
link with nothing; vectors of different length are never compared; null ids are
ignored for the component's id (and an unlinked vector's component is its own id);
repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions import cells
from tillwise.functions.components import components
from tillwise.llm.common import checkpointed, stored

BLOCKS, CODES, PASSES, SEED, CELL = 4, 12, 32, 20240, 512


class ProductCode:
    def __init__(self, dim: int, blocks: int = BLOCKS, codes: int = CODES, passes: int = PASSES, seed: int = SEED):
        rng = np.random.default_rng([seed, dim])
        self.parts = np.array_split(np.arange(dim), min(blocks, dim))
        self.books = []
        for p in self.parts:
            c = rng.standard_normal((codes, len(p)))
            self.books.append(c / np.linalg.norm(c, axis=1, keepdims=True))
        self.passes = min(passes, codes ** len(self.parts))

    def _best(self, x: np.ndarray, which: list[int]) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``passes`` best sums over the blocks ``which``, their numbers, and how many there are in all."""
        if len(which) == 1:
            sums = self.books[which[0]] @ x[self.parts[which[0]]]
            numbers, total = np.arange(sums.size), sums.size
        else:
            mid = len(which) // 2
            (head, h, m), (tail, t, n) = self._best(x, which[:mid]), self._best(x, which[mid:])
            sums, numbers, total = np.add.outer(head, tail).ravel(), np.add.outer(h * n, t).ravel(), m * n
        best = np.argsort(-sums, kind="stable")[:self.passes]
        return sums[best], numbers[best], total

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Sorted numbers of all directions that the unit vector ``x`` passes."""
        return np.sort(self._best(x, list(range(len(self.parts))))[1])


def _decoded(classes: DataFrame, blocks: int, codes: int, passes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: dict[int, ProductCode] = {}
        for batch in batches:
            out = []
            for v in batch.column("vector"):
                x = np.asarray(v.values, dtype="f8")
                # scaled first: squares of very large or small components stay finite
                x = x / np.abs(x).max()
                x /= np.linalg.norm(x)
                if x.size not in books:
                    books[x.size] = ProductCode(x.size, blocks, codes, passes)
                out.append(books[x.size].decode(x))
            yield pa.RecordBatch.from_arrays([batch.column("class"), batch.column("copies"), batch.column("vector"),
                                              pa.array(out, pa.list_(pa.int64()))], names=["class", "copies", "vector", "passes"])

    return classes.mapInArrow(run, f"class long, copies long, vector {dict(classes.dtypes)['vector']}, passes array<long>")


def _compare(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Per cell: links counted for each class, and a spanning star of each component."""
    for table, bounds in cells.runs(batches, ["dim", "direction", "lo", "hi"]):
        a, b, links = [], [], []
        ids = table.column("class").to_numpy()
        copies, side = table.column("copies").to_numpy(), table.column("side").to_numpy()
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo < 2:
                continue
            part = table.slice(lo, hi - lo)
            flat = part.column("vector").combine_chunks().flatten()
            x = flat.to_numpy().astype("f8").reshape(hi - lo, -1)
            x /= np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            near = x @ x.T >= least
            np.fill_diagonal(near, False)
            if part.column("lo")[0] != part.column("hi")[0]:
                s = side[lo:hi]
                near &= s[:, None] != s[None, :]
            rows = np.flatnonzero(near.any(axis=1))
            if not rows.size:
                continue
            near, own, weight = near[np.ix_(rows, rows)], ids[lo:hi][rows], copies[lo:hi][rows]
            here = part.column("direction")[0].as_py()
            passes = [np.asarray(part.column("passes")[int(r)].values) for r in rows]
            earlier = [p[:np.searchsorted(p, here)] for p in passes]
            every, at = np.unique(np.concatenate(earlier), return_inverse=True)
            if every.size:
                member = np.zeros((rows.size, every.size), dtype="f4")
                member[np.repeat(np.arange(rows.size), [len(p) for p in earlier]), at] = 1
                member = member[:, member.sum(axis=0) > 1]
                first = near & (member @ member.T == 0)
            else:
                first = near
            count = first @ weight
            a += own[count > 0].tolist()
            b += [None] * int((count > 0).sum())
            links += count[count > 0].tolist()
            free = np.ones(rows.size, dtype=bool)
            for r in range(rows.size):
                if free[r]:
                    free[r], stack = False, [r]
                    while stack:
                        hits = np.flatnonzero(near[stack.pop()] & free)
                        free[hits] = False
                        stack += hits.tolist()
                        a += [int(own[r])] * hits.size
                        b += own[hits].tolist()
                        links += [0] * hits.size
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], names=["a", "b", "links"])


def near_vectors(vectors: DataFrame, least: float, id_col: str = "vec_id", vector_col: str = "embedding",
                 blocks: int = BLOCKS, codes: int = CODES, passes: int = PASSES, cell: int = CELL) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors``."""
    if dict(vectors.dtypes)[vector_col] not in ("array<float>", "array<double>"):
        vectors = vectors.withColumn(vector_col, F.col(vector_col).cast("array<double>"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    finite = ~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.coalesce(finite & F.exists("vector", lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("vector", F.when(usable, F.col("vector")))
    # a class is named by a number given once, when its table is written: null ids have one as well, and no two share it
    named = (rows.where("vector is not null").groupBy("vector")
             .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
             .withColumn("class", F.monotonically_increasing_id()))
    classes = stored(named)
    decoded = stored(_decoded(classes.select("class", "copies", "vector"), blocks, codes, passes))
    passed = (decoded.select("class", F.size("vector").alias("dim"), F.explode("passes").alias("direction"))
              .withColumn("key", F.struct("dim", "direction")))
    dealt = cells.deal(passed, "key", "class", cell).drop("key")
    joined = dealt.join(decoded, "class").select("dim", "direction", "lo", "hi", "side", "class", "copies", "vector", "passes")
    gathered = (joined.repartition("dim", "direction", "lo", "hi")
                .sortWithinPartitions("dim", "direction", "lo", "hi"))
    found = checkpointed(gathered.mapInArrow(lambda x: _compare(x, least), "a long, b long, links long"))
    links = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    labels = components(found.where("b is not null").select("a", "b")).select(F.col("id").alias("class"), "label")
    linked = (classes.join(links, "class", "left").join(labels, "class", "left")
              .withColumn("label", F.coalesce("label", "class")))
    least_id = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    of = linked.join(least_id, "label").select("vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return (rows.join(of, "vector", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
