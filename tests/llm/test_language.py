import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgauge.llm import language

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


def test_held_out_accuracy(spark, documents):
    from shopgauge.llm.queries import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op9_language"](spark, FOLDER).collect()}
    truth = {r.doc_id: r for r in documents.collect()}
    assert set(rows) == set(truth)
    for k, r in rows.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [k for k, r in rows.items() if r.held_out and r.lang_pred != "und"]
    assert np.mean([rows[k].lang_pred == truth[k].lang for k in held]) > 0.97


def test_nothing_but_text_counts(spark, documents):
    model = language.learn(documents.where("doc_id % 2 = 0"))
    texts = documents.where("doc_id < 40").selectExpr("text", "'xx' lang_pred", "cast(null as string) lang", "-doc_id doc_id")
    a = {(r.text, r.lang_pred, r.score) for r in language.identify(texts, model).collect()}
    b = {(r.text, r.lang_pred, r.score) for r in language.identify(documents.where("doc_id < 40"), model).collect()}
    assert a == b


def test_edges(spark, documents):
    model = language.learn(documents)
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "123 %% \n"), (4, "a"), (None, "the of and " * 20000), (4, "a")], "doc_id long, text string")
    rows = language.identify(frame, model).collect()
    assert [r.lang_pred for r in rows[:3]] == ["und"] * 3
    assert rows[3] == rows[5] and rows[3].lang_pred != "und"
    assert rows[4].lang_pred == "en"
    assert language.identify(frame.limit(0), model).collect() == []


def test_no_teaching_rows_and_one_language(spark):
    none = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language.identify(none, language.learn(none)).collect()] == ["und"]
    one = spark.createDataFrame([(1, "abc def", "xx")], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify(one, language.learn(one)).collect()] == [("xx", 1.0)]


def test_many_families(spark):
    rows = [(f"{w} " * (5 + i % 7), lang) for lang, w in (("en", "the thing"), ("fr", "le chose"), ("es", "el cosa"), ("qq", "zzx qqy")) for i in range(8)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    model = language.learn(frame)
    assert sorted(map(tuple, model.families)) == [("en",), ("es", "fr"), ("qq",)]
    assert all(r.lang == r.lang_pred for r in language.identify(frame, model).collect())


def test_copies_teach_once(spark, documents):
    """A text that comes first by hash, a thousand times, takes one place in the sample and not all."""
    texts = documents.selectExpr("lang", "text", "xxhash64(text) as h").where("lang is not null and text is not null")
    first = {r.lang: r.text for r in texts.groupBy("lang").agg(F.min_by("text", "h").alias("text")).collect()}
    hot = spark.createDataFrame([(lang, text) for lang, text in first.items() for _ in range(1000)], "lang string, text string")
    base = texts.select("lang", "text")
    plain = language.learn(base, per_language=40)
    model = language.learn(base.unionByName(hot), per_language=40)
    assert (model.families, model.pairs) == (plain.families, plain.pairs)
    assert np.array_equal(model.weights, plain.weights)
