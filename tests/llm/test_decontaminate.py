import random
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from shopgauge.llm import decontaminate
from shopgauge.llm.decontaminate import best_match

DOCS, ITEMS = "doc_id long, text string, item_id int", "item_id long, text string"


def split(text):
    return re.findall(r"\w+", (text or "").replace("_", " ").lower())


def distance(item, text):
    """Smallest edit distance of item to any run of text, row by row."""
    if not text:
        return len(item)
    codes = {w: i for i, w in enumerate(dict.fromkeys([*item, *text]))}
    t = np.array([codes[w] for w in text])
    row = np.zeros(len(t) + 1, int)
    j = np.arange(len(t) + 1)
    for w in item:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (t != codes[w]))
        row = np.minimum.accumulate(new - j) + j
    return int(row.min())


def brute(docs, items, rate=0.2):
    out = set()
    for i, item in items:
        item = split(item)
        for d, text in docs:
            if item and (k := distance(item, split(text))) <= int(rate * len(item) + 1e-9):
                out.add((d, i, k))
    return out


@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.lists(st.integers(0, 3), max_size=60))
def test_myers(item, text):
    assert best_match(item, text)[0] == distance(item, text)


def run(spark, docs, items, **more):
    frame = decontaminate.matches(spark.createDataFrame([(*d, 1) for d in docs], DOCS), spark.createDataFrame(items, ITEMS), **more)
    return frame.collect()


def test_planted_edits(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 45)))) for i in range(60)]
    docs = []
    for d in range(300):
        words = rng.choices(vocabulary, k=rng.randint(0, 200))
        if d % 2:
            part = items[rng.randrange(60)][1].split()
            for _ in range(rng.randint(0, len(part) // 4)):
                at = rng.randrange(len(part))
                part[at : at + rng.randint(0, 1)] = rng.choices(vocabulary, k=rng.randint(0, 2))
            words[10:10] = part
        docs.append((d, ", ".join(words).title()))
    rows = run(spark, docs, items, begins=3)
    assert {(r.doc_id, r.item_id, r.distance) for r in rows} == brute(docs, items)
    for r in rows:
        part = split(docs[r.doc_id][1])[r.start_word : r.end_word]
        assert distance(part, split(items[r.item_id][1])) <= r.distance or distance(split(items[r.item_id][1]), part) == r.distance


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "A b,  c\nD!"), (3, "A b,  c\nD!"), (None, "x a b c d y"), (5, "a b c"), (6, "naïve Über " + "z " * 100_000)]
    items = [(1, "a B c. d"), (2, "a b c d"), (None, "naïve über"), (4, None), (5, " !! ")]
    got = sorted((r.doc_id or -1, r.item_id or -1, r.distance, r.start_word, r.end_word) for r in run(spark, docs, items))
    assert got == [(-1, 1, 0, 1, 5), (-1, 2, 0, 1, 5), (3, 1, 0, 0, 4), (3, 1, 0, 0, 4), (3, 2, 0, 0, 4), (3, 2, 0, 0, 4), (6, -1, 0, 0, 2)]
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def test_no_budget(spark):
    """Without edits a piece is a whole item, looked up by its first words; the rest has to be there too."""
    long = " ".join(f"w{i}" for i in range(300))
    docs = [(1, f"x {long} y"), (2, long.replace("w200", "no")), (3, " ".join(f"w{i}" for i in range(299)))]
    got = [(r.doc_id, r.item_id, r.distance, r.start_word, r.end_word) for r in run(spark, docs, [(7, long)], rate=0.0)]
    assert got == [(1, 7, 0, 1, 301)]
    assert {(r.doc_id, r.distance) for r in run(spark, docs, [(7, long)])} == {(1, 0), (2, 1), (3, 1)}


def test_many_hits(spark):
    """Items of one word run, in a text that repeats it; the text is a third of all rows, the item too."""
    docs = [(d, "a b " * 400) for d in range(30)] + [(d, f"c{d} a") for d in range(30, 90)]
    items = [(i, "b a b a b a") for i in range(20)] + [(20, "a"), (21, "b a b a b b"), (22, "c31")]
    rows = run(spark, docs, items, begins=50)
    assert {(r.doc_id, r.item_id, r.distance) for r in rows} == brute(docs, items)
    assert len(rows) == 30 * 22 + 60 + 1


def test_clean(spark):
    docs = [(1, None, 5), (2, "", 5), (3, "x A b c d, y", 5), (3, "x A b c d, y", 6), (4, "a b c", 5), (None, "a b c d", 5), (None, "q", 7)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, key int")
    items = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, None)], ITEMS)
    got = decontaminate.clean(frame, items)
    assert got.columns == frame.columns
    assert sorted(got.collect(), key=str) == sorted(frame.where("text is null or text in ('', 'a b c', 'q')").collect(), key=str)
    assert decontaminate.clean(frame, items.limit(0)).count() == len(docs) and decontaminate.clean(frame.limit(0), items).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    from shopgauge.llm.queries import QUERIES

    got = {(r.doc_id, r.item_id, r.distance) for r in QUERIES["op10_decontaminate"](spark, folder).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert got == brute(docs, items) and got
