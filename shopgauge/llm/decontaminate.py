"""Finding benchmark items in documents within an edit budget.

An item of n words may differ by k = floor(rate * n) inserted, deleted or changed words. Cut into k + 1 pieces, at least one piece
is left whole in every such passage (pigeonhole). Pieces are a table that is joined with the hashes of the documents' word runs; around
every hit the distance is computed by Myers' bit-parallel algorithm over words. Runs that no piece can equal are ruled out before the join
by a bitmap of fixed size. Words are runs of letters and digits in small form, so punctuation, case and white space make no difference.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgauge.llm import hashing
from shopgauge.llm.common import discard, written

#: Words of a piece that are looked up. A piece that is whole has its first words whole.
LONGEST = 8
#: Bits of a run's hash that choose its place in the bitmap, which so has 8 MB.
DOOR_BITS = 26

_LUT: list[np.ndarray] = []
MATCHES = "doc_id long, item_id long, distance long, item_words long, start_word long, end_word long"


def _folded() -> np.ndarray:
    """Small form of every letter and digit, and marks as they are; 0 for all else."""
    if not _LUT:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if chr(c).isalnum() or unicodedata.category(chr(c))[0] == "M":
                small = chr(c).lower()
                table[c] = ord(small) if len(small) == 1 else c
        _LUT.append(table)
    return _LUT[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, and the index of the first word of each text."""
    points = _folded()[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
    place = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(place, offsets)
    inside = points > 0
    edge = np.zeros(len(points) + 1, bool)
    edge[first] = True
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    finish[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(begin)
    return hashing.spans(hashing.mix(points.astype(np.uint64)), start, np.flatnonzero(finish) + 1), np.searchsorted(start, first)


def best_match(item: list[int], text: list[int]) -> tuple[int, int]:
    """Smallest edit distance of the item to any run of the text, and the end of the first such run (Myers, one bit per item word)."""
    n = len(item)
    where: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        where[w] |= 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, distance = full, 0, n
    best, end = n, 0
    for j, w in enumerate(text):
        same = where.get(w, 0)
        across = same | minus
        x = (((same & plus) + plus) ^ plus) | same
        up = minus | (full & ~(x | plus))
        down = plus & x
        if up & top:
            distance += 1
        if down & top:
            distance -= 1
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | (full & ~(across | up))
        minus = up & across
        if distance < best:
            best, end = distance, j + 1
    return best, end


def _key(value: str) -> Column:
    """128 bits of SHA-256 that stand for a text or for the words of an item."""
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def _table(columns: list, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, words (hashes of the item's words), item (its key): every row of the benchmark that has a word."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in hashing.blocks(batch.column(1)):
                found, at = words(data, offsets)
                bodies = [found[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                ids = batch.column(0).slice(row, len(bodies))
                yield pa.RecordBatch.from_arrays([ids, pa.array(bodies, pa.binary())], names=["item_id", "words"])

    source = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(split, "item_id long, words binary").where("octet_length(words) > 0").withColumn("item", _key("words"))


def _pieces(items: DataFrame, rate: float) -> DataFrame:
    """size, code, item, offset, n, budget: the first words of every piece by hash, and where they stand in an item of n words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.frombuffer(body.as_py(), np.uint64)
                n, budget = len(found), int(rate * len(found) + 1e-9)
                cuts = np.arange(budget + 2) * n // (budget + 1)
                start, size = cuts[:-1], np.minimum(np.diff(cuts), LONGEST)
                for length in np.unique(size).tolist():
                    at = start[size == length]
                    code = hashing.runs(found, at, length).view(np.int64)
                    columns = [np.full(len(at), length), code, [item] * len(at), at, np.full(len(at), n), np.full(len(at), budget)]
                    yield _table(columns, ["size", "code", "item", "offset", "n", "budget"], [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32()])

    return items.select("item", "words").mapInArrow(cut, "size int, code long, item binary, offset int, n int, budget int")


def _door(pieces: DataFrame) -> np.ndarray:
    """The bitmap of the pieces' hashes, 2^DOOR_BITS bits whatever the number of pieces."""
    place = F.shiftrightunsigned("code", 64 - DOOR_BITS) + 1
    parts = pieces.groupBy(F.bitmap_bucket_number(place)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place))).collect()
    door = np.zeros(1 << (DOOR_BITS - 3), np.uint8)
    for bucket, bits in parts:
        low = (bucket - 1) * len(bits)
        door[low : low + len(bits)] = np.frombuffer(bits, np.uint8)
    return door


def _hits(texts: DataFrame, pieces: DataFrame) -> DataFrame:
    """key, size, code, start: the word runs of texts that have the hash of a piece, and few others."""
    sizes = sorted(r[0] for r in pieces.select("size").distinct().collect())  # LONGEST at most
    shared = texts.sparkSession.sparkContext.broadcast(_door(pieces))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        door = shared.value
        for batch in batches:
            for row, data, offsets in hashing.blocks(batch.column(1)):
                found, at = words(data, offsets)
                for size in sizes:
                    start, text = hashing.starts(at, size)
                    code = hashing.runs(found, start, size)
                    place = code >> np.uint64(64 - DOOR_BITS)
                    hit = np.flatnonzero((door[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1)
                    if len(hit):
                        keys = batch.column(0).take(pa.array(row + text[hit]))
                        rest = [np.full(len(hit), size, np.int32), code[hit].view(np.int64), (start[hit] - at[text[hit]]).astype(np.int32)]
                        yield pa.RecordBatch.from_arrays([keys, *map(pa.array, rest)], names=["key", "size", "code", "start"])

    return texts.select("key", "text").mapInArrow(look, "key binary, size int, code long, start int")


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words around the hits of each item in a text. Windows of an item that touch are one."""
    names, kinds = ["key", "item", "budget", "low", "window"], [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]
    for batch in batches:
        for key, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            data = np.frombuffer(text.as_py().encode(), np.uint8)
            found, _ = words(data, np.array([0, len(data)]))
            out: list[tuple] = []
            held = 0
            for item, n, budget, begins in zip(*wanted.values.flatten()):
                n, budget = n.as_py(), budget.as_py()
                begin = np.sort(begins.values.to_numpy())
                low, high = np.maximum(begin - budget, 0), np.minimum(begin + n + budget, len(found))
                first = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]]))
                last = np.append(first[1:], len(low)) - 1
                for a, b in zip(low[first].tolist(), high[last].tolist()):
                    out.append((key, item.as_py(), budget, a, found[a:b].tobytes()))
                    held += 8 * (b - a)
                if held > 1 << 22:
                    yield _table(list(zip(*out)), names, kinds)
                    out, held = [], 0
            if out:
                yield _table(list(zip(*out)), names, kinds)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best passage of every window, if it is within the item's budget."""
    names = ["key", "item", "distance", "item_words", "start_word", "end_word"]
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 4]
    for batch in batches:
        out = []
        for key, item, budget, low, window, body in zip(*(batch.column(c).to_pylist() for c in ("key", "item", "budget", "low", "window", "words"))):
            text, wanted = np.frombuffer(window, np.uint64).tolist(), np.frombuffer(body, np.uint64).tolist()
            distance, end = best_match(wanted, text)
            if distance <= budget:
                # The passage begins where the reversed item ends in the reversed text.
                _, back = best_match(wanted[::-1], text[max(0, end - len(wanted) - distance) : end][::-1])
                out.append((key, item, distance, len(wanted), low + end - back, low + end))
        if out:
            yield _table(list(zip(*out)), names, kinds)


def _passages(texts: DataFrame, items: DataFrame, rate: float, begins: int) -> DataFrame:
    """key, item, distance, item_words, start_word, end_word: the best passage of each item in each different text that has one."""
    if not 0 <= rate < 1:
        raise ValueError("rate has to be at least 0 and below 1")
    one_each = written(items.select("item", "words").dropDuplicates(["item"]))
    pieces = written(_pieces(one_each, rate))
    begin = (F.col("start") - F.col("offset")).alias("begin")
    hits = _hits(texts, pieces).distinct().join(pieces, ["size", "code"]).select("key", "item", "n", "budget", begin)
    candidates = written(hits.groupBy("key", "item", "n", "budget").agg(F.collect_set("begin").alias("begins")))
    discard(pieces)
    parts = candidates.groupBy("key").agg(F.ceil(F.sum(F.size("begins")) / begins).alias("_parts"))
    part = F.pmod(F.xxhash64("item"), F.col("_parts")).alias("_part")
    wanted = candidates.join(parts, "key").groupBy("key", part).agg(F.collect_list(F.struct("item", "n", "budget", "begins")).alias("wanted"))
    # Equal texts are one from here on.
    near = texts.select("key", "text").join(parts.select("key"), "key", "left_semi").dropDuplicates(["key"])
    windows = near.join(wanted, "key").select("key", "text", "wanted").mapInArrow(_windows, "key binary, item binary, budget int, low int, window binary")
    tested = windows.join(one_each, "item").mapInArrow(_verify, "key binary, item binary, distance long, item_words long, start_word long, end_word long")
    best = F.min(F.struct("distance", "start_word", "end_word", "item_words")).alias("best")
    found = written(tested.groupBy("key", "item").agg(best).select("key", "item", "best.*"))
    discard(candidates, one_each)
    return found


def matches(documents: DataFrame, benchmark: DataFrame, rate: float = 0.2, begins: int = 65_536) -> DataFrame:
    """One row per row of documents and item found in it: distance and the words [start_word, end_word) of the best passage.

    Neither table passes through the driver, whatever its size: pieces and runs meet in a join, and so do windows and items. Equal texts and
    equal items are tested once. A text with more than `begins` hits is gone through in parts, by item. NULL or wordless texts and items
    match nothing; equal items and repeated documents each give their rows. Further columns are not read.
    """
    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text is not null").withColumn("key", _key("text"))
    items = written(_items(benchmark))
    found = _passages(source, items, rate, begins)
    named = source.select("doc_id", "key").join(found, "key").join(items.select("item", "item_id"), "item")
    return named.select([part.split()[0] for part in MATCHES.split(", ")])


def clean(documents: DataFrame, benchmark: DataFrame, rate: float = 0.2, begins: int = 65_536) -> DataFrame:
    """The rows of documents in which no item is found, with all their columns; found as by `matches`."""
    text = F.col("text").cast("string")
    source = documents.select(text.alias("text")).where("text is not null").withColumn("key", _key("text"))
    found = _passages(source, written(_items(benchmark)), rate, begins).select(F.col("key").alias("_benchmark_key")).distinct()
    return documents.join(found, _key(text) == F.col("_benchmark_key"), "left_anti")
