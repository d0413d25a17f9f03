import random
from collections import defaultdict
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import sentencepiece
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shopgauge.llm import rollup
from shopgauge.llm.rollup import TokenRollup, counted, revised, signed, word_count
from shopgauge.llm.tokens import piece_counts

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(BYTES)
B = sentencepiece.SentencePieceProcessor(model_file=PIECES)
SCHEMA = "doc_id long, source string, lang string, version string, tokens long"


def seen(store):
    return {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in store.totals().collect()}


def test_batches_in_any_order_with_replays(spark, tmp_path):
    rng = random.Random(4)
    state, batches, want = {}, [], defaultdict(lambda: [0, 0])
    for b in range(6):
        changes = []
        for _ in range(30):
            doc = rng.randrange(40)
            old = state.pop(doc, None)
            new = (doc, rng.choice(["a", "b", None]), rng.choice(["en", None]), f"v{b % 2}", rng.randrange(9)) if rng.random() < 0.7 else None
            if old:
                changes.append((old, -1))
            if new:
                changes.append((new, 1))
                state[doc] = new
        batches.append(changes)
    for row in state.values():
        want[row[1:4]][0] += 1
        want[row[1:4]][1] += row[4]
    store = TokenRollup(spark, str(tmp_path / "rollup"))

    def send(b):
        rows = {s: spark.createDataFrame([r for r, sign in batches[b] if sign == s], SCHEMA) for s in (1, -1)}
        return store.commit(f"batch {b}", revised(rows[-1], rows[1]))

    assert [send(b) for b in (3, 0, 3, 5)] == [True, True, False, True]
    store.compact()
    assert [send(b) for b in (0, 1, 2)] == [False, True, True]
    store.compact()
    assert [send(b) for b in (4, 4, 1)] == [True, False, False]
    assert seen(store) == {k: tuple(v) for k, v in want.items()}


def test_a_batch_that_was_cut_off_is_written_anew(spark, tmp_path):
    store = TokenRollup(spark, str(tmp_path))
    counts = spark.createDataFrame([(1, "s", "en", "v", 5), (None, None, None, "v", None)], SCHEMA)
    store.commit("one", signed(counts, 1))
    (folder,) = (tmp_path / "batches").iterdir()
    Path(folder / "_SUCCESS").unlink()
    assert seen(store) == {}
    assert store.commit("one", signed(counts, 1))
    assert seen(store) == {("s", "en", "v"): (1, 5), (None, None, "v"): (1, 0)}
    store.commit("two", signed(counts, -1))
    assert seen(store) == {}
    assert TokenRollup(spark, str(tmp_path / "none")).totals().collect() == []


def test_counts(spark):
    frame = spark.createDataFrame([(1, " a\tb\n", "s", None, 3), (2, None, None, "en", 3), (3, "", "s", "en", 3)], "doc_id long, text string, source string, lang string, tokens int")
    rows = counted(frame, "v", word_count(rollup.F.col("text"))).collect()
    assert [r.tokens for r in rows] == [2, 0, 0]


def test_query_in_sql(spark):
    from shopgauge.llm.queries import ORACLES, QUERIES

    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES["rollup_words"](spark, folder), connect(folder), ORACLES["rollup_words"]) == ""


def plain(text):
    """(ids by bytes, ids by pieces) straight from the tokenizers."""
    return len(A.encode(text or "", add_special_tokens=False).ids), len(B.encode(text or ""))


def test_query_against_the_tokenizers(spark):
    from shopgauge.llm.queries import QUERIES

    db = connect("/root/testdata/sf0.001")
    toxic = {d for (d,) in db.sql("SELECT doc_id FROM labels WHERE toxic = 1").fetchall()}
    low = {d for (d,) in db.sql("SELECT doc_id FROM labels WHERE quality = 0").fetchall()}
    want = defaultdict(lambda: [0, 0])
    for doc, source, lang, text in db.sql("SELECT doc_id, source, lang, text FROM documents").fetchall():
        if doc in toxic:
            continue
        group = want[source, lang, "piece_bpe_32k" if doc in low else "byte_bpe_50k"]
        group[0] += 1
        group[1] += plain(text)[doc in low]
    got = QUERIES["op6_token_counts"](spark, "/root/testdata/sf0.001").collect()
    assert {(r.source, r.lang, r.version): [r.n_docs, r.n_tokens] for r in got} == dict(want)


def test_encoded_edges(spark):
    texts = [None, "", " ", "   ", "a", " a", "a ", "a  b", "\n\tx y\r\n", "\u2581x \u2581", "\U0001f600 日本 é", "<|endoftext|> z", "<s> </s>", "it's 'sam", "ab " * 400_000, "x" * 50_000, "a", "a"]
    rows = [(i if i else None, t, None if i % 2 else "s", "en", "clash") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string, lang string, byte_tokens string")
    got = rollup.encoded(frame, BYTES, PIECES).collect()
    assert sorted((r.doc_id or 0, r.byte_tokens, r.piece_tokens) for r in got) == [(i, *plain(t)) for i, t in enumerate(texts)]
    assert rollup.encoded(frame.limit(0), BYTES, PIECES).collect() == []


def test_an_empty_batch_and_rows_that_repeat(spark, tmp_path):
    store = TokenRollup(spark, str(tmp_path))
    one = spark.createDataFrame([(1, "s", "en", "v", 5)] * 3, SCHEMA)
    assert store.commit("none", signed(one.limit(0), 1))
    store.compact()
    assert seen(store) == {}
    assert store.commit("three", signed(one, 1))
    assert seen(store) == {("s", "en", "v"): (3, 15)}
    assert store.commit("one goes", signed(one.limit(1), -1)) and not store.commit("none", signed(one, 1))
    assert seen(store) == {("s", "en", "v"): (2, 10)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab' \n\t\u2581é1\U0001f600日<s>\x00"), max_size=6))
def test_piece_counts(texts):
    assert piece_counts(pa.array([*texts, None], pa.string()), PIECES).tolist() == [len(B.encode(t)) for t in texts] + [0]
