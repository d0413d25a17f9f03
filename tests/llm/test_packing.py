import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopgauge.llm import packing, tokens
from shopgauge.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH)
SCHEMA = "doc_id long, text string, length int"


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab'strevmld \n\t é1½.,! \U0001f600日<|endoftext|>"), max_size=6))
def test_same_ids_as_the_tokenizer(texts):
    import pyarrow as pa

    got = [b.tolist() for b in ENCODER.encode(pa.array(texts, pa.string()))]
    assert got == [ids(t) for t in texts]


def test_special_and_contractions():
    import pyarrow as pa

    texts = ["<|endoftext|> a", "don't we'll 'sam I'd've ''s 'S", None, "", "  x  \n\n y ", "a  b\x85c\x1cd"]
    got = [b.tolist() for b in ENCODER.encode(pa.array(texts, pa.string()))]
    assert got == [ids(t) for t in texts]


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=20))
def test_patterns_hold_each_length_once(histogram):
    found = packing.patterns(histogram, 64)
    total = defaultdict(int)
    for count, lengths in found:
        assert sum(lengths) <= 64
        for length in lengths:
            total[length] += count
    assert dict(total) == histogram


def check(rows, docs, size):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in docs:
        whole = [*ids(text), 1]
        at = 0
        for r in sorted(by_doc.pop(doc), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(whole))
            assert r.ids_crc32 == zlib.crc32(np.array(whole[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(whole)
    assert not by_doc
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size


@pytest.mark.parametrize("sent_places", [1000, 0])
def test_round_trip(spark, sent_places):
    docs = [(i, "some words and more " * (i % 37)) for i in range(300)] + [(900, None), (901, ""), (902, "x" * 50_000)]
    docs += [(1000 + i, "same text") for i in range(200)]
    frame = spark.createDataFrame([(*d, 5) for d in docs], SCHEMA)
    rows = packing.packed(packing.pieces(frame, PATH, 64), 64, slot_rows=16, sent_places=sent_places).collect()
    check(rows, docs, 64)
    assert max(Counter(r.length for r in rows).values()) > 10 * 16


def test_names_that_clash(spark):
    parts = packing.pieces(spark.createDataFrame([(1, "a b", 0), (2, "a", 0)], SCHEMA), PATH)
    for name in ("sequence_id", "offset", "_slot", "_length", "_rank", "_of", "_first", "_before", "_row"):
        parts = parts.withColumn(name, F.lit("mine"))
    rows = packing.packed(parts).collect()
    check(rows, [(1, "a b"), (2, "a")], 2048)
    assert {(r._slot, r._length, r._rank, r._of, r._first, r._before, r._row) for r in rows} == {("mine",) * 7}


def test_repeated_rows_and_null_ids(spark):
    frame = spark.createDataFrame([(1, "a b", 0), (1, "a b", 0), (None, "a b", None)], SCHEMA)
    rows = packing.packed(packing.pieces(frame, PATH)).collect()
    assert sorted(r.offset for r in rows) == [0, 3, 6]
    assert {r.sequence_id for r in rows} == {0}


def test_empty_table(spark):
    assert packing.packed(packing.pieces(spark.createDataFrame([], SCHEMA), PATH)).collect() == []


def test_ids_on_request(spark):
    frame = spark.createDataFrame([(1, "one two three", 0)], SCHEMA)
    rows = packing.pieces(frame, PATH, 2, with_ids=True).orderBy("start").collect()
    assert [i for r in rows for i in r.ids] == [*ids("one two three"), 1]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    from shopgauge.llm.queries import QUERIES

    rows = QUERIES["op4_packing"](spark, folder).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check(rows, docs, 2048)
    used = sum(r.length for r in rows)
    assert used / (2048 * len({r.sequence_id for r in rows})) > 0.95


def test_no_second_tokenizer_for_plain_texts():
    """The one for special tokens takes 30 MB of a worker, so only a text that holds one loads it."""
    import pyarrow as pa

    tokens._tokenizer.cache_clear()
    assert [b.tolist() for b in Encoder(PATH).encode(pa.array(["a b", None]))] == [ids("a b"), []]
    assert tokens._tokenizer.cache_info().currsize == 0
    assert [b.tolist() for b in Encoder(PATH).encode(pa.array(["a<|endoftext|>"]))] == [ids("a<|endoftext|>")]
    assert tokens._tokenizer.cache_info().currsize == 1
