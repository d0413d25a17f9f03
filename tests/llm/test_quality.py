import re
import zlib

import numpy as np
import pytest

from shopgauge.llm import quality

FOLDER = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_held_out(spark):
    from shopgauge.llm.queries import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op8_quality"](spark, FOLDER).collect()}
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for k, r in rows.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    held = [r for r in labels if rows[r.doc_id].held_out]
    score = np.array([rows[r.doc_id].score for r in held])
    label = np.array([r.quality for r in held])
    print("auc", auc(score, label), "accuracy", np.mean((score >= 0.3) == label), "kept", np.mean(score[label == 1] >= 0.3))
    assert auc(score, label) > 0.95
    assert np.mean((score >= 0.3) == label) > 0.95


def test_gradient_finds_the_telling_passage():
    rng = np.random.default_rng(1)
    bags = []
    for i in range(200):
        bag = rng.normal(0, 1, (rng.integers(1, 9), quality.FEATURES))
        bag[:, 0] = 0
        if i % 2:
            bag[rng.integers(len(bag)), 0] = 4
        bags.append((bag, i % 2))
    model = quality.fit(bags)
    x = np.concatenate([b for b, _ in bags])
    first = np.concatenate([[0], np.cumsum([len(b) for b, _ in bags])])
    f = model.forward(x, first)
    assert np.mean((f["p"] > 0.5) == [y for _, y in bags]) > 0.95
    top = [k for b in range(1, 200, 2) for k in [first[b] + np.argmax(f["a"][first[b] : first[b + 1]])]]
    assert np.mean(x[top, 0] == 4) > 0.8


def test_passages_cover_whole_texts():
    import pyarrow as pa
    from shopgauge.llm import hashing

    texts = ["w " * 125, "", None, "one two", "x" * 300_000]
    (_, data, offsets), = hashing.blocks(pa.array(texts))
    found, first = quality.passages(data, offsets)
    assert np.diff(first).tolist() == [3, 1, 1, 1, 1]
    assert np.isfinite(found).all()


@pytest.mark.parametrize("labelled", [[], [(1, 1)], [(1, 1), (2, 0), (None, 1), (3, None), (1, 1)]])
def test_edges(spark, labelled):
    docs = spark.createDataFrame([(1, "a b c", 9), (2, None, 9), (3, "", 9), (None, "x " * 50_000, 9), (1, "a b c", 9)], "doc_id long, text string, score int")
    labels = spark.createDataFrame(labelled, "doc_id long, quality int")
    model = quality.learn(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert rows[0] == rows[4] and rows[1].score == rows[2].score
    assert quality.score(docs.limit(0), model).collect() == []


def test_sample_is_cut_before_a_task_has_a_label(spark):
    rows = spark.range(40_000).selectExpr("id as doc_id", "cast(id % 10 = 0 as int) as quality")
    rows = rows.unionByName(spark.createDataFrame([(None, 1), (7, None), (3, 0), (3, 0)], "doc_id long, quality int"))
    got = quality.sampled(rows, 1200, slots=8)
    plan = got._jdf.queryExecution().executedPlan().toString()
    known = rows.where("doc_id is not null and quality is not null").selectExpr("quality", "xxhash64(doc_id) h", "doc_id").collect()
    want = [(r.doc_id, q) for q in (0, 1) for r in sorted((r for r in known if r.quality == q), key=lambda r: (r.h, r.doc_id))[:1200]]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert len(dealt) == 2 and ["_slot" in d for d in dealt] == [False, True]
