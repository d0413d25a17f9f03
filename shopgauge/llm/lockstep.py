"""Alignment of the tokens of two tokenizers by vectorised merging in lockstep.

The tokens of both tokenizers cover the same bytes. All lanes (texts, long ones cut where both tokenizers surely cut) are merged at
the same time: one NumPy vector holds the place of every lane in tokens A, one that in tokens B. A step compares all ends at once,
moves the pointer whose token ends first, and where both end cuts a group. Lanes that are done leave the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgauge.llm import hashing
from shopgauge.llm.common import written
from shopgauge.llm.tokens import word_cuts
from shopgauge.llm.words import byte_vocabulary, piece_vocabulary, slices

#: Bytes of text that are worked on at a time, and of a lane.
BLOCK, LANE = 1 << 20, 1 << 9
#: A pair of ids is one number: the A id times 2^21 and the B id.
_SHIFT = 21
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Pairs whose counts are sent to all executors: the most frequent ones, so many at most.
HOT_PAIRS = 1 << 19


def _borders(data: np.ndarray) -> np.ndarray:
    """Places of blanks between ASCII letters. Both tokenizers begin a token there whatever stands further away."""
    inner = (data[1:-1] == 32) & _LETTER[data[:-2]] & _LETTER[data[2:]] if len(data) > 2 else np.zeros(0, bool)
    return np.flatnonzero(inner) + 1


def _blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(first row, bytes, offsets, whether the last text goes on in the next block). Texts longer than a block are cut at borders."""
    for row, data, offsets in hashing.blocks(column, BLOCK):
        if len(data) <= BLOCK:
            yield row, data, offsets, False
            continue
        at = 0
        while len(data) - at > BLOCK:
            # At the first border after a block; a text without one is not cut.
            cut = next((b + a for a in range(at + BLOCK - 1, len(data), BLOCK) for b in _borders(data[a : a + BLOCK + 2])[:1].tolist()), None)
            if cut is None:
                break
            yield row, data[at:cut], np.array([0, cut - at]), True
            at = cut
        yield row, data[at:], np.array([0, len(data) - at]), False


def _lanes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte places where lanes begin: each text, and a border about every LANE bytes in it."""
    border = _borders(data)
    text = np.searchsorted(offsets, border, "right") - 1
    lane = (text << 32) | (border - offsets[text]) // LANE
    first = np.flatnonzero(np.diff(lane, prepend=-1))
    return np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], border[first]]))


def merge(end_a: np.ndarray, end_b: np.ndarray, lanes_a: np.ndarray, lanes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(marks of the A tokens that end a group, of the B tokens, steps). Ends are byte places; lanes are first tokens, closed by the count.

    Both kinds of tokens end together at the end of every lane.
    """
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    a, b, stop = lanes_a[:-1].copy(), lanes_b[:-1].copy(), lanes_a[1:]
    going = a < stop
    a, b, stop = a[going], b[going], stop[going]
    steps = 0
    while len(a):
        at_a, at_b = end_a[a], end_b[b]
        move_a, move_b = at_a <= at_b, at_b <= at_a
        both = move_a & move_b
        cut_a[a[both]] = True
        cut_b[b[both]] = True
        a += move_a
        b += move_b
        steps += 1
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    return cut_a, cut_b, steps


def _digits(limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. limit - 1, right-aligned, and which of them are written."""
    width = len(str(limit - 1))
    numbers = np.arange(limit)[:, None] // 10 ** np.arange(width - 1, -1, -1)
    used = numbers > 0
    used[:, -1] = True
    return (numbers % 10 + 48).astype(np.uint8), used


class Aligner:
    """Aligned blocks of texts under two vocabulary files: byte-level BPE (A) and pieces (B)."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_vocabulary(path_a), piece_vocabulary(path_b)
        self.digits, self.used = _digits(max(len(self.a.sizes), len(self.b.sizes)))

    def _tokens(self, table, data: bytes, cuts: np.ndarray, offsets: np.ndarray):
        """ids, byte ends, and of each text whether its ids spell it."""
        at = table.places(slices(data, cuts))
        ids, _ = table.tokens(at)
        wrong = np.unique(np.searchsorted(offsets, cuts[~table.spelt[at]], "right") - 1)
        return ids, np.cumsum(table.sizes[ids]), wrong

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple:
        """(A ids, B ids, text of each, marks of the last tokens of groups) of the texts that both tokenizers spell, and the wrong ones.

        Texts begin with the blank that is put before them.
        """
        while True:
            whole = data.tobytes()
            begins = offsets[:-1][np.diff(offsets) > 0]
            blank = data == 32
            after = np.zeros(len(data), bool)
            after[1:] = blank[1:] & ~blank[:-1]
            after[begins] = True
            ids_a, end_a, wrong_a = self._tokens(self.a, whole, word_cuts(data, offsets), offsets)
            ids_b, end_b, wrong_b = self._tokens(self.b, whole, np.flatnonzero(after), offsets)
            wrong = np.union1d(wrong_a, wrong_b)
            if not len(wrong):
                break
            # Texts that are not spelt have no tokens; the others are aligned without them.
            keep = np.ones(len(offsets) - 1, bool)
            keep[wrong] = False
            left, rest, rest_wrong = np.repeat(keep, np.diff(offsets)), np.where(keep, np.diff(offsets), 0), wrong
            found = self.block(data[left], np.concatenate([[0], np.cumsum(rest)]))
            return (*found[:-1], rest_wrong)
        lanes = _lanes(data, offsets)
        last = len(data)
        cut_a, cut_b, _ = merge(end_a, end_b, *[np.append(np.searchsorted(e, lanes, "right"), np.searchsorted(e, last, "right")) for e in (end_a, end_b)])
        return ids_a, ids_b, np.searchsorted(offsets, end_a) - 1, np.searchsorted(offsets, end_b) - 1, cut_a, cut_b, wrong

    def written_groups(self, ids_a, ids_b, cut_a, cut_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of `a1,a2|b1;a3|b2,b3;`, where each A token's text begins in them, groups of the A tokens)."""
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        ends_a, ends_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
        # A tokens of a group stand behind the B tokens of earlier groups, its B tokens behind its A tokens.
        place_a = np.arange(len(ids_a)) + np.concatenate([[0], ends_b])[group_a]
        place_b = np.arange(len(ids_b)) + ends_a[group_b] if len(ends_a) else np.zeros(0, np.int64)
        ids = np.zeros(len(ids_a) + len(ids_b), np.int64)
        sign = np.full(len(ids), 44, np.uint8)
        ids[place_a], ids[place_b] = ids_a, ids_b
        sign[place_a[cut_a]], sign[place_b[cut_b]] = 124, 59
        width = self.digits.shape[1]
        table, used = np.empty((len(ids), width + 1), np.uint8), np.ones((len(ids), width + 1), bool)
        table[:, :width], used[:, :width] = self.digits[ids], self.used[ids]
        table[:, width] = sign
        begin = np.concatenate([[0], np.cumsum(used.sum(1))])
        return table[used], begin[place_a], group_a


def _links(ids_a, ids_b, text_a, cut_a, cut_b) -> tuple[np.ndarray, np.ndarray]:
    """(keys, times): text and pair of every link between ids of one group, each text's pairs once with the number of their links."""
    ends_a, ends_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
    first_a, first_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
    size_b = ends_b - first_b
    group = np.cumsum(cut_a) - cut_a
    # Every A token meets the B tokens of its group; a stretch of A tokens at a time, so that very long groups stay bounded.
    many = size_b[group]
    stretch = np.cumsum(many) // (1 << 23)
    keys, times = [], []
    for part in np.split(np.arange(len(ids_a)), np.flatnonzero(np.diff(stretch)) + 1):
        count = many[part]
        ends = np.cumsum(count)
        b = np.repeat(first_b[group[part]] - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
        key = np.repeat((text_a[part].astype(np.int64) << 2 * _SHIFT) | (ids_a[part].astype(np.int64) << _SHIFT), count) | ids_b[b]
        key, n = np.unique(key, return_counts=True)
        keys.append(key)
        times.append(n)
    if len(keys) == 1:
        return keys[0], times[0]
    return _summed(np.concatenate(keys), np.concatenate(times))


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, of = np.unique(keys, return_inverse=True)
    return keys, np.bincount(of, times, len(keys)).astype(np.int64)


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


def align(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id and, for the tokens A and B of a blank and the text: their numbers, the number of groups between common ends, of links
    (pairs of an A and a B token of one group), the groups written as `a1,a2|b1;a3|b2,b3`, and the different linked pairs of ids
    (A id times 2^21 and B id) with the number of their links in the text.

    NULL and empty texts, and texts that the ids of one tokenizer don't spell, have zeros, an empty text and empty arrays. Rows of one
    doc_id are rows like any other, the doc_id may be NULL; further columns of the input are not read. Texts are whole; very long ones
    go through in blocks that end between words (a text without two ASCII words is one block).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            ids, part = batch.column(0), None
            for row, data, offsets, more in _blocks(batch.column(1)):
                *found, wrong = aligner.block(data, offsets)
                if more or part:
                    part = _joined(part, aligner, found, wrong)
                    if not more:
                        yield _whole(ids.slice(row, 1), part)
                        part = None
                else:
                    yield _rows(ids.slice(row, len(offsets) - 1), aligner, found)
            pa.default_memory_pool().release_unused()

    text = F.when(F.col("text") != "", F.concat(F.lit(" "), F.col("text").cast("string")))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *T.StructType.fromDDL(ALIGNED)])
    return documents.select(F.col("doc_id").cast("long"), text.alias("text")).mapInArrow(run, schema)


def _names() -> list[str]:
    return ["doc_id", *[column.split()[0] for column in ALIGNED.split(", ")]]


def _rows(ids: pa.Array, aligner: Aligner, found: list) -> pa.RecordBatch:
    """The rows of a block of whole texts."""
    ids_a, ids_b, text_a, text_b, cut_a, cut_b = found
    n = len(ids)
    keys, times = _links(ids_a, ids_b, text_a, cut_a, cut_b)
    of = keys >> 2 * _SHIFT
    data, begin, _ = aligner.written_groups(ids_a, ids_b, cut_a, cut_b)
    at = np.searchsorted(text_a, np.arange(n + 1))
    # The sign after the last token of a text is left out.
    start = np.append(begin, len(data))[at]
    keep = np.ones(len(data), bool)
    keep[start[1:][np.diff(start) > 0] - 1] = False
    size = np.diff(start) - (np.diff(start) > 0)
    groups = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(data[keep])])
    border = pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32))
    columns = [
        ids,
        *[pa.array(np.bincount(t, minlength=n).astype(np.int64)) for t in (text_a, text_b, text_a[cut_a])],
        pa.array(np.bincount(of, times, n).astype(np.int64)),
        groups.cast(pa.string()),
        pa.ListArray.from_arrays(border, pa.array(keys & ((1 << 2 * _SHIFT) - 1))),
        pa.ListArray.from_arrays(border, pa.array(times.astype(np.int64))),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_names())


def _joined(part: dict | None, aligner: Aligner, found: list, wrong: np.ndarray) -> dict:
    """A long text so far, with one more block of it."""
    ids_a, ids_b, text_a, _, cut_a, cut_b = found
    part = part or {"n": [0, 0, 0], "groups": [], "keys": np.zeros(0, np.int64), "times": np.zeros(0, np.int64), "wrong": False}
    if len(wrong):
        part["wrong"] = True
    keys, times = _links(ids_a, ids_b, text_a, cut_a, cut_b)
    part["keys"], part["times"] = _summed(np.concatenate([part["keys"], keys]), np.concatenate([part["times"], times]))
    part["n"] = [x + int(y) for x, y in zip(part["n"], (len(ids_a), len(ids_b), cut_a.sum()))]
    part["groups"].append(aligner.written_groups(ids_a, ids_b, cut_a, cut_b)[0].tobytes())
    return part


def _whole(ids: pa.Array, part: dict) -> pa.RecordBatch:
    """The row of a long text."""
    values = [*part["n"], int(part["times"].sum()), b"".join(part["groups"])[:-1].decode(), part["keys"], part["times"]]
    if part["wrong"]:
        values = [0, 0, 0, 0, "", [], []]
    kinds = [*[pa.int64()] * 4, pa.string(), *[pa.list_(pa.int64())] * 2]
    return pa.RecordBatch.from_arrays([ids, *[pa.array([v], k) for v, k in zip(values, kinds)]], names=_names())


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (how many rows of `aligned` hold it linked), best (whether no pair of its A id has a higher count)."""
    counts = written(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))
    first = F.shiftright("pair", _SHIFT).alias("_a")
    # One row per A id: no more than the vocabulary has.
    highest = counts.groupBy(first).agg(F.max("n").alias("_highest"))
    return counts.join(F.broadcast(highest), F.shiftright("pair", _SHIFT) == F.col("_a")).select("pair", "n", (F.col("n") == F.col("_highest")).alias("best"))


def scored(aligned: DataFrame, hot: int = HOT_PAIRS) -> DataFrame:
    """The rows of `aligned` (a table that has been written) with n_best and count_sum: of their links, how many are of a best pair of
    the A id, and the sum of the pairs' counts, both over all rows.

    The most frequent pairs, `hot` at most, meet the texts by a broadcast; the rare ones by a shuffle, in which every pair has fewer
    rows than the least frequent of the others. Texts are numbered by their place in the written table.
    """
    pairs = written(pair_counts(aligned))
    level = F.floor(F.log2("n"))
    levels = sorted(((r["l"], r["c"]) for r in pairs.groupBy(level.alias("l")).agg(F.count("*").alias("c")).collect()), reverse=True)
    lowest, taken = 64, 0
    for at, count in levels:
        taken += count
        if taken > hot:
            break
        lowest = at
    frequent = F.broadcast(pairs.where(level >= lowest))
    links = aligned.select("_row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    found = links.join(frequent, "pair").groupBy("_row").agg(*sums)
    if taken > hot:
        rare = links.join(F.broadcast(pairs.where(level >= lowest).select("pair")), "pair", "left_anti")
        found = found.unionByName(rare.join(pairs.where(level < lowest), "pair").groupBy("_row").agg(*sums))
        found = found.groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    both = aligned.drop("pairs", "times").join(found, "_row", "left").drop("_row")
    return both.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})


def numbered(aligned: DataFrame) -> DataFrame:
    """The aligned texts with their groups as a hash, written with a number for each row."""
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.encode("groups", "UTF-8"), 256))
    return written(aligned.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256").withColumn("_row", F.monotonically_increasing_id()))
