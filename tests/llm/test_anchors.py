import hashlib
import random
import re

import pytest
from shopgauge.llm import anchors

SCHEMA = "doc_id long, text string, n_words string, _doc_id int"


def brute(docs, length):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in docs]
    first = {}
    for (i, _), w in zip(docs, words):
        if i is not None:
            for k in range(len(w) - length + 1):
                run = tuple(w[k : k + length])
                first[run] = min(i, first.get(run, i))
    out = []
    for (i, _), w in zip(docs, words):
        gone = set()
        if i is not None:
            for k in range(len(w) - length + 1):
                if first[tuple(w[k : k + length])] < i:
                    gone.update(range(k, k + length))
        left = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i if i is not None else -1, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def run(spark, docs, length):
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA)
    rows = anchors.digest(anchors.strip(frame, anchors.repeats(frame, length), length)).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept_sha256) for r in rows)


def test_cover_has_all_differences():
    found = {(a - b) % anchors.PERIOD for a in anchors.COVER for b in anchors.COVER}
    assert found == set(range(anchors.PERIOD))


@pytest.mark.parametrize("length", [50, 35])
def test_against_every_run(spark, length):
    rng = random.Random(length)
    vocabulary = [f"w{i}" for i in range(500)]
    docs, passages = [], [rng.choices(vocabulary, k=rng.randint(40, 90)) for _ in range(6)]
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randint(0, 150))
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(passages)
            low = rng.randint(0, 20)
            words[rng.randint(0, len(words)) : 0] = part[low:]
        if rng.random() < 0.3 and docs:
            words = rng.choice(docs)[1].split()
            if words and rng.random() < 0.6:
                words[rng.randrange(len(words))] = "new"
        docs.append((rng.randint(0, 10**6), rng.choice([" ", "\n", " \t "]).join(words)))
    docs += [(2_000_000, None), (2_000_001, ""), (2_000_002, "the same " * 300), (2_000_003, "the same " * 200), (2_000_004, " é " * 120)]
    docs += [(None, docs[0][1]), (None, None)] + docs[:3] + docs[-3:]
    assert run(spark, docs, length) == brute(docs, length)


def test_spacing_stays(spark):
    run = " \n".join(f"w{i}" for i in range(60))
    docs = [(1, run), (2, f"\tfirst\n\n{run}\n\n  last  one \n"), (3, "a  b\n\nc \t"), (4, f" {run} \n"), (5, None), (6, " \n")]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA)
    rows = {r.doc_id: r for r in anchors.strip(frame, anchors.repeats(frame), spacing=True).collect()}
    assert rows[1].kept_text == run and rows[3].kept_text == "a  b\n\nc \t"
    assert rows[2].kept_text == "\tfirst\n\nlast  one \n" and rows[2].n_removed == 60
    assert rows[4].kept_text == "" and rows[5].kept_text == "" and rows[6].kept_text == " \n"


def test_empty_table(spark):
    assert run(spark, [], 50) == []


def test_query(spark):
    from shopgauge.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op2_substring_dedup"](spark, folder).collect())
    assert got == brute(docs, 50)
