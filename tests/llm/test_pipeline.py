import re

import test_decontaminate
import test_jaccard
import test_packing

import corpus_pipeline
from shopgauge.llm import language

FOLDER = "/root/testdata/sf0.001"


def brute(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    model = language.learn(frame.where("crc32(string(doc_id)) % 4 <> 2"))
    known = {r.doc_id for r in language.identify(frame, model).where("lang_pred <> 'und'").collect()}
    rows = {d[0]: d[1] for d in docs if d[0] in known}
    first = {i for i, _, c in test_jaccard.brute(list(rows.items())) if i == c}
    rows = {i: t for i, t in rows.items() if i in first}
    yield rows
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in rows.items()}
    seen, left = {}, {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            seen.setdefault(tuple(words[i][k : k + 50]), i)
    for i, w in words.items():
        gone = {x for k in range(len(w) - 49) if seen[tuple(w[k : k + 50])] < i for x in range(k, k + 50)}
        parts = re.split(r"([^\x20\x09-\x0D]+)", rows[i])
        text = parts[0] + "".join(parts[2 * k + 1] + parts[2 * k + 2] for k in range(len(w)) if k not in gone)
        left[i] = text.rstrip(" \t\n\x0b\x0c\r") if len(w) - 1 in gone else text
    left = {i: t for i, t in left.items() if t.strip(" \t\n\x0b\x0c\r")}
    yield left
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {d for d, _, _ in test_decontaminate.brute(list(left.items()), items)}
    yield {i: t for i, t in left.items() if i not in dirty}


def test_against_brute_force(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = [tuple(r) for r in table.select(corpus_pipeline.COLUMNS).collect()]
    docs += [(10_000, "1 2 3 !!", "en", "s", 8), (10_001, docs[5][1] + " more words", "en", "s", 0), (10_002, None, None, None, None)]
    docs.append((10_003, docs[7][1][: len(docs[7][1]) // 2] + " other end " * 400, "en", "s", 0))
    now = spark.createDataFrame(docs, table.schema)
    steps = brute(spark, docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, FOLDER)
        if k in (1, 2, 3):
            assert now.columns == corpus_pipeline.COLUMNS
            want = next(steps)
            now = spark.createDataFrame(now.collect(), table.schema)
            assert {r.doc_id: r.text for r in now.collect()} == want
            assert k == 1 or all(r.n_chars == len(r.text) for r in now.collect())
    test_packing.check(now.collect(), list(want.items()), 2048)


def test_whole_run(spark):
    import __spark_entry__ as contract

    rows = contract.queries()["pipeline"](spark, FOLDER).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_bad_rows_go_through(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(None, "the words of a text", None, None, None), (1, "the words of a text", "en", None, 0), (1, "the words of a text", "en", None, 0), (2, None, "en", "s", 0), (3, "", "en", "s", 0)]
    for docs in (rows, []):
        now = spark.createDataFrame(docs, schema)
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, FOLDER)
        assert sorted((r.doc_id is None, r.doc_tokens > 1) for r in now.collect()) == ([(False, True), (True, True)] if docs else [])
    assert corpus_pipeline.ORACLE_SQL is None


def test_sequences_hold_the_ids(spark):
    docs = [(i, "some words of a text " * (1 + i % 900), "en", "s", 0) for i in range(40)]
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    _, stage = corpus_pipeline.STAGES[-1]
    rows = stage(spark, spark.createDataFrame(docs, schema), FOLDER).collect()
    assert all(len(r.ids) == r.length for r in rows)
    sequences = {}
    for r in sorted(rows, key=lambda r: r.offset):
        sequences.setdefault(r.sequence_id, []).extend(r.ids)
    found = {}
    for r in sorted(rows, key=lambda r: r.start):
        found.setdefault(r.doc_id, []).extend(sequences[r.sequence_id][r.offset : r.offset + r.length])
    assert found == {d[0]: [*test_packing.ids(d[1]), 1] for d in docs}
