import random
import re

import numpy as np
import pytest

from shopgauge.llm import jaccard
from shopgauge.llm.components import components

SCHEMA = "doc_id long, text string, size int, component string"


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def brute(docs):
    sets = {i: shingles(t) for i, t in docs if i is not None}
    above = {i: i for i in sets}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {(i, j) for group in where.values() for i in group for j in group if i < j}
    for i, j in pairs:
        a, b = sets[i], sets[j]
        if 100 * len(a & b) >= 75 * len(a | b):
            x, y = top(i), top(j)
            above[max(x, y)] = min(x, y)
    return sorted((i if i is not None else -1, len(shingles(t)), top(i) if i is not None else -1) for i, t in docs)


def run(spark, docs, **more):
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA)
    rows = jaccard.link(frame, **more).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id if r.component_id is not None else -1) for r in rows)


def corpus(seed, count=200):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)]
    docs = []
    for _ in range(count):
        if docs and rng.random() < 0.7:
            words = rng.choice(docs[-20:])[1].split()
            for _ in range(rng.randint(0, 4)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                words = words[: rng.randint(0, len(words))]
        else:
            words = rng.choices(vocabulary, k=rng.choice([0, 1, 2, 4, 5, 6, 10, 40, 100, 200]))
        docs.append((rng.randint(0, 10**6), rng.choice([str, str.upper])(" ".join(words))))
    docs = list(dict(docs).items())
    return docs + [(None, docs[0][1]), (None, None), (2_000_000, None), (2_000_001, "  \n"), (2_000_002, "É a b c d e"), (2_000_003, "é a b c d e")] + docs[:3]


@pytest.mark.parametrize("seed, more", [(1, {}), (2, {"block_tokens": 300}), (3, {"frequent": 50, "block_tokens": 150})])
def test_against_all_pairs(spark, seed, more):
    docs = corpus(seed)
    assert run(spark, docs, **more) == brute(docs)


def test_tree_against_all_pairs():
    rng = np.random.default_rng(2)
    for share in (75, 50, 90):
        sets = [np.unique(rng.integers(0, 60, rng.integers(0, 60))) for _ in range(150)]
        top = jaccard.linked(sets, list(range(150)), share)
        same = {(i, j): 100 * len(np.intersect1d(a, b)) >= share * len(np.union1d(a, b)) and len(a) > 0 for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j}
        above = list(range(150))
        for _ in range(150):
            for (i, j), yes in same.items():
                if yes:
                    above[i] = above[j] = min(above[i], above[j])
        assert [t for t, s in zip(top, sets) if len(s)] == [t for t, s in zip(above, sets) if len(s)]


def test_screen_keeps_every_similar_set():
    rng = np.random.default_rng(8)
    sets = [rng.choice(10**9, n, replace=False) for n in rng.integers(1, 1500, 150)]
    sets += [np.concatenate([s[: -(-9 * len(s) // 10)], rng.choice(10**9, len(s) // 20)]) for s in sets[:40]] + [np.arange(0, 2048 * 300, 2048)] * 2
    got = jaccard.may_link(np.array([len(s) for s in sets]), [jaccard.sketch(s) for s in sets], 75)
    assert got[-2:].all() and got[:40].mean() > 0.9 and got[150:190].mean() > 0.9 and got[40:150].mean() < 0.3
    for i, a in enumerate(sets):
        if not got[i]:
            assert all(i == j or 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)) for j, b in enumerate(sets))


def test_places_keep_every_similar_set():
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(80, rng.integers(1, 40), replace=False)) for _ in range(80)]
    first = [min((int(np.isin(a, b).argmax()) for j, b in enumerate(sets) if j != i and np.isin(a, b).any()), default=10**6) for i, a in enumerate(sets)]
    got = jaccard.may_share(np.array([len(s) for s in sets]), np.array(first), 75)
    for i, a in enumerate(sets):
        if not got[i]:
            assert all(i == j or 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)) for j, b in enumerate(sets))


def test_chain_across_parts(spark):
    base = [f"w{i}" for i in range(100)]
    docs = []
    for i in range(30):  # each is like the next, the ends are not alike
        docs.append((100 - i, " ".join(base)))
        base = base[2:] + [f"v{i}", f"u{i}"]
    assert run(spark, docs, block_tokens=200) == brute(docs)
    assert run(spark, docs) == brute(docs)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 200), (200, 100), (300, 150), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 100: 100, 200: 100, 150: 150, 300: 150}


def test_query(spark):
    from shopgauge.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op3_jaccard_join"](spark, folder).collect())
    assert got == brute(docs)
    assert len({c for _, _, c in got}) < len(docs)
