"""Exact top-k search by inner product with M-trees.

Vectors become integers, equal vectors become one entry, and entries are dealt by hash into blocks, each an M-tree of pages: every
entry of a page has a routing object, a covering radius and its distance to the parent's. One further coordinate makes all vectors of
a tree equally long, so that a larger inner product is a smaller distance and the triangle inequality bounds scores. Pages are taken
best first; stored distances rule out entries before their own distance is computed.
"""

from __future__ import annotations

import heapq
import itertools
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopgauge.llm.common import kept

_RESULT = "query_id long, vec_id long, score long"


@dataclass
class Node:
    """A page. `place` are the vectors with the further coordinate; leaves have exact vectors and ids, others their children."""

    place: np.ndarray
    parent: np.ndarray
    radius: np.ndarray
    children: list[Node] | None = None
    vectors: np.ndarray | None = None
    ids: list[list[int]] | None = None


@dataclass
class Tree:
    root: Node
    length: float  # of every vector with its further coordinate

    @classmethod
    def of(cls, vectors: np.ndarray, ids: list[list[int]], page: int = 48) -> Tree:
        """Load all vectors at once: split by nearest of a page of routing objects until a part fits a page."""
        exact = vectors.astype(np.float64)
        square = (exact**2).sum(1)
        top = float(square.max(initial=0.0))
        place = np.column_stack([exact, np.sqrt(np.maximum(0, top - square))])
        rng = np.random.Generator(np.random.PCG64(len(vectors)))

        def build(rows: np.ndarray, above: np.ndarray | None) -> Node:
            gap = np.zeros(len(rows)) if above is None else np.linalg.norm(place[rows] - above, axis=1)
            if len(rows) <= page:
                return Node(place[rows], gap, np.zeros(len(rows)), vectors=vectors[rows], ids=[ids[i] for i in rows])
            routes = rng.choice(rows, min(page, -(-len(rows) // (page // 2))), replace=False)
            square_gap = (place[rows] ** 2).sum(1)[:, None] + (place[routes] ** 2).sum(1) - 2 * place[rows] @ place[routes].T
            near = square_gap.argmin(1)
            parts = [(rows[near == k], routes[k]) for k in range(len(routes)) if (near == k).any()]
            if len(parts) == 1:  # nothing tells them apart: halves, under the same routing object
                middle = len(rows) // 2
                parts = [(rows[:middle], routes[0]), (rows[middle:], routes[0])]
            at = place[[route for _, route in parts]]
            radius = np.array([np.linalg.norm(place[part] - place[route], axis=1).max() for part, route in parts])
            gap = np.zeros(len(parts)) if above is None else np.linalg.norm(at - above, axis=1)
            return Node(at, gap, radius, children=[build(part, place[route]) for part, route in parts])

        return cls(build(np.arange(len(vectors)), None), math.sqrt(top))

    def search(self, query: np.ndarray, own: int, k: int, bound: int | None = None) -> list[tuple[int, int]]:
        """The k best (score, -id) without id `own`, of those that reach `bound`; equal scores by smaller id."""
        q = np.append(query.astype(np.float64), 0.0)
        total = float(q @ q) + self.length**2
        slack = 1e-9 * (1 + total)
        best: list[tuple[int, int]] = []
        least = bound

        def reach() -> float:
            """Largest distance that can still matter."""
            return math.inf if least is None else math.sqrt(max(0.0, total - 2.0 * least) + slack) + 1e-9 * math.sqrt(total)

        count = itertools.count()
        queue: list[tuple[float, int, float | None, Node]] = [(0.0, 0, None, self.root)]
        limit = reach()
        while queue:
            nearest, _, parent, node = heapq.heappop(queue)
            if nearest > limit:
                break
            alive = np.arange(len(node.place)) if parent is None else np.flatnonzero(np.abs(parent - node.parent) - node.radius <= limit)
            if not len(alive):
                continue
            if node.children is None:
                scores = node.vectors[alive] @ query
                for i in np.argsort(-scores, kind="stable").tolist():
                    score = int(scores[i])
                    if least is not None and score < least:
                        break
                    for vec in node.ids[alive[i]]:
                        if vec != own:
                            item = (score, -vec)
                            if len(best) < k:
                                heapq.heappush(best, item)
                            elif item > best[0]:
                                heapq.heapreplace(best, item)
                    if len(best) == k:
                        least = best[0][0] if least is None else max(least, best[0][0])
                limit = reach()
            else:
                gap = np.linalg.norm(node.place[alive] - q, axis=1)
                low = np.maximum(0, gap - node.radius[alive])
                for i in np.flatnonzero(low <= limit).tolist():
                    heapq.heappush(queue, (float(low[i]), next(count), float(gap[i]), node.children[alive[i]]))
        return best


def whole(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component as a double; NULL for a vector that is NULL or has a NULL or non-finite component."""
    number = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(number, lambda x: F.floor(x * scale).cast("long")))


def _batches(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema])


_TYPES = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, tree_numbers: int = 1 << 19, first: int = 2048, query_numbers: int = 1 << 16) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of `vectors` for each row of `queries`, both (vec_id, vector of longs).

    A query's own vec_id is no candidate, equal scores go by smaller vec_id, and vectors meet only those of their own dimension. Rows
    with a NULL id or vector take no part; a repeated row counts once. Trees hold about `tree_numbers` components and go by hash, so
    no cluster or copy makes one large; of equal vectors the k + 1 smallest ids are enough for any answer. The scores of `first` vectors
    give each query a bound to start with. Queries meet the trees in blocks of about `query_numbers` components.
    """
    spark = vectors.sparkSession
    valid = vectors.where("vec_id is not null and vector is not null").select("vec_id", "vector")
    same = W.partitionBy("vector", "vec_id").orderBy("vec_id")
    by_value = W.partitionBy("vector").orderBy("vec_id")
    once = valid.withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_n")
    few = once.withColumn("_n", F.row_number().over(by_value)).where(F.col("_n") <= k + 1)
    entries = kept(few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = queries.where("vec_id is not null and vector is not null").select("vec_id", "vector").distinct()

    numbers = entries.agg(F.sum(F.size("vector") + 1)).first()[0] or 0
    trees = max(1, -(-numbers // tree_numbers))
    sample = entries.orderBy(F.xxhash64("vector")).limit(first).collect()
    by_size: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
    for size in {len(r["vector"]) for r in sample}:
        rows = [r for r in sample if len(r["vector"]) == size]
        by_size[size] = np.array([r["vector"] for r in rows], np.int64).reshape(len(rows), size), [r["ids"] for r in rows]
    known = spark.sparkContext.broadcast(by_size)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vec, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bound = None
                if len(vector) in known.value:
                    matrix, ids = known.value[len(vector)]
                    scores = matrix @ np.array(vector, np.int64)
                    # Only the k best distinct vectors matter; every id of them is a candidate.
                    top = np.argsort(-scores, kind="stable")[: k + 1].tolist()
                    found = [int(scores[i]) for i in top for x in ids[i] if x != vec]
                    bound = found[k - 1] if len(found) >= k else None
                out.append((vec, vector, bound))
            yield _batches(out, [("vec_id", pa.int64()), ("vector", pa.list_(pa.int64())), ("bound", pa.int64())])

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["vector"].to_pylist(), table["ids"].to_pylist()))
        size = key[1].as_py()
        tree = Tree.of(np.array([v for v, _ in rows], np.int64).reshape(len(rows), size), [i for _, i in rows])
        kinds = [("tree", pa.int64()), ("size", pa.int32()), ("body", pa.binary())]
        return pa.Table.from_batches([_batches([(key[0].as_py(), size, pickle.dumps(tree))], kinds)])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, block in zip(batch.column(0), batch.column(1)):
                tree, out = pickle.loads(body.as_py()), []
                for q in block.as_py():
                    found = tree.search(np.array(q["vector"], np.int64), q["vec_id"], k, q["bound"])
                    out += [(q["vec_id"], -vec, score) for score, vec in found]
                yield _batches(out, _TYPES)

    size = F.size("vector").alias("size")
    forest = kept(
        entries.select("*", F.pmod(F.xxhash64("vector"), F.lit(trees)).alias("tree"), size)
        .groupBy("tree", "size").applyInArrow(grow, "tree long, size int, body binary")
    )
    bounded = kept(asked.mapInArrow(start, "vec_id long, vector array<long>, bound long"))
    wanted = bounded.agg(F.sum(F.size("vector") + 1)).first()[0] or 0
    blocks = max(1, -(-wanted // query_numbers))
    grouped = bounded.select(F.struct("vec_id", "vector", "bound").alias("q"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("_block"), size)
    grouped = grouped.groupBy("_block", "size").agg(F.collect_list("q").alias("block"))
    everywhere = grouped.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).repartition("tree", "_block")
    found = everywhere.join(forest, ["tree", "size"]).select("body", "block").mapInArrow(look, _RESULT)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
