import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shopgauge.llm import lockstep, words

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATH_A)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
BYTE = words.byte_level()
SCHEMA = "doc_id long, text string, n_a int"


def tokens(text):
    """(ids A, bytes of each, ids B, bytes of each) straight from the tokenizers; None if a tokenizer doesn't spell the text."""
    if not text:
        return None
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    spelt_a = [bytes(BYTE[c] for c in A.id_to_token(i)) for i in a]
    spelt_b = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    return (a, spelt_a, b, spelt_b) if b"".join(spelt_a) == whole == b"".join(spelt_b) else None


def aligned(text):
    """(numbers of A tokens, B tokens and groups, groups as text, links by pair)."""
    found = tokens(text)
    if not found:
        return 0, 0, 0, "", Counter()
    a, spelt_a, b, spelt_b = found
    ends_a, ends_b = np.cumsum([len(x) for x in spelt_a]).tolist(), np.cumsum([len(x) for x in spelt_b]).tolist()
    groups, links, i, j = [], Counter(), 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        to_i, to_j = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
        groups.append(f"{','.join(map(str, a[i:to_i]))}|{','.join(map(str, b[j:to_j]))}")
        links.update((x, y) for x in a[i:to_i] for y in b[j:to_j])
        i, j = to_i, to_j
    return len(a), len(b), len(groups), ";".join(groups), links


def run(texts):
    """What the operator makes of one Arrow column."""
    column = pa.array([" " + t if t else None for t in texts], pa.string())
    out, part, aligner, ids = [], None, lockstep.Aligner(PATH_A, PATH_B), pa.array(range(len(texts)), pa.int64())
    for row, data, offsets, more in lockstep._blocks(column):
        *found, wrong = aligner.block(data, offsets)
        if more or part:
            part = lockstep._joined(part, aligner, found, wrong)
            if not more:
                out += lockstep._whole(ids.slice(row, 1), part).to_pylist()
                part = None
        else:
            out += lockstep._rows(ids.slice(row, len(offsets) - 1), aligner, found).to_pylist()
    assert [r["doc_id"] for r in out] == list(range(len(texts)))
    return [(r["n_a"], r["n_b"], r["n_groups"], r["groups"], Counter({(p >> 21, p & ((1 << 21) - 1)): n for p, n in zip(r["pairs"], r["times"])})) for r in out]


ODD = [
    "abc ", "  a  b  ", "a\tb\n\nc", "▁x", "plain after ▁", "é ﬁ Å", " <|endoftext|> x <s> </s>", "a\0b", "\xa0x​", "日本 語 テキスト", " ", "  ", "x",
    " \n", "don't we'll 'S", "\U0001f469‍\U0001f469 ok", "<0x41>", None, "", "1" * 300, "a" * 1000, "été naïve œuvre " * 40,
]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab'strevmld \n\t é1½.,!\U0001f600日▁<|>x"), max_size=6))
def test_groups_equal_a_plain_merge(texts):
    assert run(texts) == [aligned(t) for t in texts]


def test_odd_texts():
    assert run(ODD) == [aligned(t) for t in ODD]
    assert run([]) == []


@pytest.mark.parametrize("block, lane", [(200, 32), (5000, 100)])
def test_long_texts_in_blocks_and_lanes(monkeypatch, block, lane):
    monkeypatch.setattr(lockstep, "BLOCK", block)
    monkeypatch.setattr(lockstep, "LANE", lane)
    rng = random.Random(block)
    texts = [" ".join(rng.choice(["some", "words", "été", "x1", "thing,", "\n", "", "日本"]) for _ in range(rng.randrange(1, 4000))) for _ in range(12)]
    texts += ["日" * 5000, "word " * 500 + "▁" + " more words" * 500, *ODD]
    assert run(texts) == [aligned(t) for t in texts]


def test_merge_moves_all_lanes_at_once():
    # Three lanes of 6 bytes: 2+4 against 3+3, 6 against 1+5, 3+3 against 3+3.
    end_a, end_b = np.array([2, 6, 12, 15, 18]), np.array([3, 6, 7, 12, 15, 18])
    cut_a, cut_b, steps = lockstep.merge(end_a, end_b, np.array([0, 2, 3, 5]), np.array([0, 2, 4, 6]))
    assert cut_a.tolist() == [False, True, True, True, True] and cut_b.tolist() == [False, True, False, True, True, True]
    assert steps == 3


def test_word_table_starts_anew_at_its_bound():
    asked = []

    def encode(some):
        asked.append(len(some))
        return words.flattened([[len(x), 7] for x in some])

    table = words.WordTable(encode, bound=50)
    for k in range(30):
        block = [b"%d" % (k + i) for i in range(10)] + [b"long" * 5]
        ids, counts = table.tokens(table.places(block))
        assert ids.tolist() == [x for w in block for x in (len(w), 7)] and set(counts.tolist()) == {2}
        assert table.held <= 50 + sum(map(len, block))
    assert len(asked) > 5


def expected(docs):
    found = [(doc, *aligned(text)) for doc, text in docs]
    count = Counter(pair for *_, links in found for pair in links)
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    return sorted(
        (
            (doc, n_a, n_b, n_groups, sum(links.values()), hashlib.sha256(text.encode()).hexdigest() if text else "",
             sum(n for p, n in links.items() if count[p] == highest[p[0]]), sum(n * count[p] for p, n in links.items()))
            for doc, n_a, n_b, n_groups, text, links in found
        ),
        key=str,
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


@pytest.mark.parametrize("hot", [0, 5, 1 << 19])
def test_counts_over_all_documents(spark, hot):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(["over", "there", "été", "12", "x", "over-there"]) for _ in range(rng.randrange(60)))) for i in range(120)]
    docs += [(500 + i, "the same text again") for i in range(60)] + [(None, "a null id"), (7, "a second row of an id"), (900, None), (901, ""), (902, "▁ is not spelt")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], SCHEMA).repartition(3)
    rows = lockstep.scored(lockstep.numbered(lockstep.align(frame, PATH_A, PATH_B)), hot).select(COLUMNS).collect()
    assert sorted(map(tuple, rows), key=str) == expected(docs)


def test_empty_table(spark):
    empty = lockstep.align(spark.createDataFrame([], SCHEMA), PATH_A, PATH_B)
    assert lockstep.scored(lockstep.numbered(empty)).collect() == []


def test_query(spark):
    from shopgauge.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op11_alignment"](spark, folder).select(COLUMNS).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, rows), key=str) == expected(docs)
