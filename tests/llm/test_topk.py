import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgauge.llm import topk


def brute(rows, ids, k=10):
    """rows: (vec_id, integer vector)."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = []
    for q, v in rows:
        if q in ids:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def floors(vector):
    return [math.floor(1024 * float(np.float32(x))) for x in vector]


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(5)
    for scale, n in ((3, 500), (1000, 2000), (1, 300)):
        vectors = rng.integers(-scale, scale + 1, (n, 6))
        tree = topk.Tree.of(vectors, [[i] for i in range(n)], page=8)
        for q in range(0, n, 29):
            want = sorted(((int(vectors[i] @ vectors[q]), -i) for i in range(n) if i != q), reverse=True)[:10]
            assert sorted(tree.search(vectors[q], q, 10), reverse=True) == want
            assert sorted(tree.search(vectors[q], q, 10, want[-1][0]), reverse=True) == want


def test_bounds_spare_pages():
    rng = np.random.default_rng(6)
    centre = rng.normal(0, 800, (40, 8))
    vectors = np.floor(centre[rng.integers(0, 40, 4000)] + rng.normal(0, 20, (4000, 8))).astype(int)
    tree = topk.Tree.of(vectors, [[i] for i in range(4000)])
    seen = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    def mark(node):
        if node.children is None:
            node.vectors = node.vectors.view(Counted)
        for child in node.children or []:
            mark(child)

    mark(tree.root)
    tree.search(vectors[0], 0, 10)
    assert sum(seen) < 2000


def run(spark, rows, **more):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    whole = frame.select("vec_id", topk.whole(F.col("embedding")).alias("vector"))
    return sorted(map(tuple, topk.search(whole, whole.where("vec_id % 100 = 0"), **more).collect()))


def test_ties_copies_and_bad_rows(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.integers(-2, 3, 4) / 2).tolist(), "x") for i in range(600)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5], None) for i in range(300)] + rows[:5]
    good = [(i, floors(v)) for i, v, _ in rows]
    bad = [(700, None, "x"), (800, [1.0, None, 0.0, 0.0], "x"), (900, [1.0, float("nan"), 0.0, 0.0], "x"), (600, [float("inf")] * 4, "x"), (None, [9.0] * 4, "x")]
    assert run(spark, rows + bad, tree_numbers=700, first=20, query_numbers=12) == brute(good, {i for i, _ in good if i % 100 == 0})


def test_few_rows_and_other_sizes(spark):
    rows = [(0, [1.0, 0.5], ""), (1, [1.0, -1.0], ""), (100, [0.25], ""), (2, [-0.3], ""), (200, [], ""), (3, [], "")]
    assert run(spark, rows) == brute([(i, floors(v)) for i, v, _ in rows], {0, 100, 200})
    assert run(spark, []) == []
    assert run(spark, [(5, [1.0], "")]) == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query(spark, folder):
    from shopgauge.llm.queries import QUERIES

    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in QUERIES["op1_topk"](spark, folder).collect())
    rows = [(r.vec_id, floors(r.embedding)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert got == brute(rows, {i for i, _ in rows if i % 100 == 0})
