import numpy as np
import pyarrow as pa
import pytest

from shopgauge.llm import anchors, hashing, jaccard
from shopgauge.llm.tokens import Encoder


def thue_morse(n):
    """Two sequences of 0 and 1 whose polynomials are equal modulo 2^64 for every odd base, from 1,024 items on."""
    a = [bin(i).count("1") % 2 for i in range(n)]
    return a, [1 - x for x in a]


@pytest.mark.parametrize("n", [1024, 4096])
@pytest.mark.parametrize("family", [0, 1])
def test_long_runs_are_told_apart(n, family):
    one, two = (np.array(["a", "b"], "S1")[x].tobytes() for x in map(np.array, thue_morse(n)))
    data = np.frombuffer(one + b" " + two, np.uint8)
    start, end, _ = hashing.word_spans(data, np.array([0, len(data)]))
    hashes = hashing.word_hashes(data, start, end, family)
    assert len(hashes) == 2 and hashes[0] != hashes[1]
    items = np.concatenate([np.array([11, 12], np.uint64)[x] for x in map(np.array, thue_morse(n))])
    whole = hashing.spans(items, np.array([0, n]), np.array([n, 2 * n]), family)
    assert whole[0] != whole[1]


def test_hashes_depend_on_the_run_alone(monkeypatch):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    start = rng.integers(0, 4000, 300)
    end = start + rng.integers(0, 300, 300)
    want = hashing.spans(values, start, end)
    alone = [int(hashing.spans(values[a:b].copy(), np.array([0]), np.array([b - a]))[0]) for a, b in zip(start, end)]
    assert want.tolist() == alone
    monkeypatch.setattr(hashing, "STRETCH", 64)
    assert hashing.spans(values, start, end).tolist() == alone


def test_tables_do_not_grow_with_a_text(monkeypatch):
    monkeypatch.setattr(hashing, "STRETCH", 1000)
    monkeypatch.setattr(hashing, "_POWERS", {})
    data = np.frombuffer(b"some words " * 20_000, np.uint8)
    start, end, _ = hashing.word_spans(data, np.array([0, len(data)]))
    assert len(set(hashing.word_hashes(data, start, end).tolist())) == 2
    assert max(map(len, hashing._POWERS.values())) <= 2048


def spread_words(order, words):
    """Words that differ between the two orders at every 18th place, so that no 50 of them are equal in a row."""
    return " ".join(["xy"[order[i // 18]] if i % 18 == 0 else "w" for i in range(words)])


def test_texts_of_equal_polynomials_keep_their_words(spark):
    words = 18 * 1024
    one, two = thue_morse(1024)
    docs = spark.createDataFrame([(1, spread_words(one, words)), (2, spread_words(two, words))], "doc_id long, text string")
    rows = {r.doc_id: r for r in anchors.strip(docs, anchors.repeats(docs)).collect()}

    def grams(order):
        w = spread_words(order, words).split()
        return {tuple(w[i : i + 50]) for i in range(words - 49)}, w

    (first, _), (_, w) = grams(one), grams(two)
    gone = set()
    for i in range(words - 49):
        if tuple(w[i : i + 50]) in first:
            gone.update(range(i, i + 50))
    assert rows[2].n_removed == len(gone) and rows[1].n_removed == 0
    assert rows[2].kept_text == " ".join(x for i, x in enumerate(w) if i not in gone)


def test_words_of_equal_polynomials_in_shingles_and_tokens(spark):
    one, two = ("".join("ab"[x] for x in order) for order in thue_morse(1024))
    docs = spark.createDataFrame([(1, f"{one} b c d e"), (2, f"{two} b c d e")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.link(docs).collect()} == {1: 1, 2: 2}

    from test_packing import PATH, ids

    texts = [f"{one} {two}", two, one]
    assert [x.tolist() for x in Encoder(PATH).encode(pa.array(texts))] == [ids(t) for t in texts]


def test_windows_are_all_runs():
    values = np.random.default_rng(4).integers(0, 2**64, 3 * hashing.STRETCH // 2, dtype=np.uint64)
    for some, length in ((values, 20), (values[:50], 20), (values[:20], 20), (values[:19], 20), (values[:0], 20), (values[:300], 200)):
        starts = np.arange(max(0, len(some) - length + 1))
        assert np.array_equal(hashing.windows(some, length), hashing.runs(some, starts, length))
