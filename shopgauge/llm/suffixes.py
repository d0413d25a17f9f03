"""Removal of byte strings that repeat an earlier document's, by suffix arrays built with the difference-cover algorithm.

Only strings that can repeat are sorted. Every string of `length` bytes is owned by its smallest hashed k-gram, which is the same
wherever the string stands; strings whose owner is in one document only are left out. The others form pieces of text. Equal pieces are
one, by 128 bits, and where an owner has different ones the text of each goes to a bucket by owner, so equal strings meet in one bucket;
where all are equal, every string repeats that is not in the smallest document. A bucket sorts the suffixes of its pieces: triples at two of three positions are sorted and named, names are sorted by recursion, the remaining suffixes
are merged in; then adjacent prefixes are compared. Whole copies of a smaller document are set aside first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgauge.llm import hashing
from shopgauge.llm.common import append, discard, release, written

GRAM = 20
#: Bytes whose owners are found at a time, few enough for a processor's cache.
_SEGMENT = 1 << 16
#: Owners whose pieces are all equal, that have different ones, and that have so many that their strings may have to be spread.
_EQUAL, _MIXED, _HOT = 0, 1, 2
_KINDS = {
    "key": pa.int64(), "two": pa.int64(), "doc_id": pa.int64(), "start": pa.int32(), "size": pa.int32(), "body": pa.binary(), "high": pa.int64(),
}


def _ordered(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of the numbers, which have so many bits, and the numbers in that order; equal ones stay in order.

    Number and position are sorted as one, which takes a fraction of the time of sorting positions by number.
    """
    place = len(key).bit_length()
    if bits + place > 63:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = (key << place) | np.arange(len(key))
    both.sort()
    return both & ((1 << place) - 1), both >> place


def suffix_array(symbols: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Start positions of all suffixes of a sequence of numbers from 1 on, in the order of their first `depth` symbols at least.

    wanted: marks of the positions that are returned; the others are named where the order needs it, but neither ranked nor merged.
    """
    n = len(symbols)
    if wanted is None:
        wanted = np.ones(n, bool)
    if n < 3:
        return np.array(sorted(np.flatnonzero(wanted).tolist(), key=lambda i: symbols[i:].tolist()), np.int64)
    bits = int(symbols.max()).bit_length()
    if depth * bits + n.bit_length() <= 63:
        # So few symbols are one number.
        s = np.concatenate([symbols.astype(np.int64), np.zeros(depth, np.int64)])
        at = np.flatnonzero(wanted)
        key = s[at]
        for k in range(1, depth):
            key = (key << bits) | s[at + k]
        return at[_ordered(key, depth * bits)[0]]
    s = np.concatenate([symbols.astype(np.int64), np.zeros(4, np.int64)])
    # If n is 1 modulo 3, the empty suffix at n is sampled too, so that the first part of the names ends with a smallest one.
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sampled = np.concatenate([ones, twos])
    if 3 * bits <= 63:
        key = np.concatenate([(s[k : k + 3 * len(t) : 3] << (2 * bits)) | (s[k + 1 : k + 1 + 3 * len(t) : 3] << bits) | s[k + 2 : k + 2 + 3 * len(t) : 3] for k, t in ((1, ones), (2, twos))])
        order, found = _ordered(key, 3 * bits)
        fresh = found[1:] != found[:-1]
    else:
        order = np.lexsort((s[sampled + 2], s[sampled + 1], s[sampled]))
        t = sampled[order]
        fresh = (s[t[1:]] != s[t[:-1]]) | (s[t[1:] + 1] != s[t[:-1] + 1]) | (s[t[1:] + 2] != s[t[:-1] + 2])
    # Where a wanted suffix is merged, its own rank or that of one of the two after it is looked up.
    asked = np.concatenate([wanted, np.zeros(2, bool)])
    asked[1:-1] |= wanted
    asked[2:] |= wanted
    asked = asked[sampled]
    if not fresh.all() and depth > 3:
        name = np.empty(len(sampled), np.int64)
        name[order] = np.concatenate([[1], 1 + np.cumsum(fresh)])
        order = suffix_array(name, -(-depth // 3), asked)
    else:
        order = order[asked[order]]
    sampled = sampled[order]
    rank = np.zeros(n + 4, np.int64)
    rank[sampled] = np.arange(1, len(order) + 1)
    places = len(order).bit_length()
    sampled = sampled[sampled < n]
    sampled = sampled[wanted[sampled]]
    zeros = 3 * np.flatnonzero(wanted[::3])
    # A suffix at a multiple of 3 is its first symbol and the rank of the rest.
    by, rest = _ordered((s[zeros] << places) | rank[zeros + 1], bits + places)
    zeros = zeros[by]
    before = np.zeros(len(sampled), np.int64)
    of_one = sampled % 3 == 1
    i = sampled[of_one]
    before[of_one] = np.searchsorted(rest, (s[i] << places) | rank[i + 1])
    i = sampled[~of_one]
    # Against one of the other kind it is two symbols and the rank of the rest.
    if 2 * bits + places <= 63:
        pair, other = (s[zeros] << bits) | s[zeros + 1], (s[i] << bits) | s[i + 1]
    else:
        _, both = np.unique(np.concatenate([(s[zeros] << 32) | s[zeros + 1], (s[i] << 32) | s[i + 1]]), return_inverse=True)
        pair, other = both[: len(zeros)], both[len(zeros) :]
    before[~of_one] = np.searchsorted((pair << places) | rank[zeros + 2], (other << places) | rank[i + 2])
    total = len(zeros) + len(sampled)
    out = np.empty(total, np.int64)
    taken = np.zeros(total, bool)
    # Ties within the depth may come out of order by a place or two; a running maximum keeps the places distinct.
    place = np.arange(len(sampled)) + np.maximum.accumulate(before)
    out[place] = sampled
    taken[place] = True
    out[~taken] = zeros
    return out


def _least(data: np.ndarray, offsets: np.ndarray, lows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(body, start, value) of all strings of `length` bytes, body by body: the smallest of `lows` over all bodies with the same bytes."""
    sizes = np.diff(offsets) + 1
    first = np.cumsum(sizes) - sizes
    text = np.zeros(int(sizes.sum()) + 8, np.uint8)
    symbols = np.ones(int(sizes.sum()), np.int64)
    inner = np.ones(len(symbols), bool)
    inner[first + sizes - 1] = False
    text[: len(symbols)][inner] = data
    symbols[inner] = data.astype(np.int64) + 2
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(symbols)) + length < (first + sizes)[owner]
    order = suffix_array(symbols, length, inside)
    # Neighbours are compared eight bytes at a time.
    step = 8 if length >= 8 else 1
    words = np.ndarray(len(symbols), np.uint64 if step == 8 else np.uint8, text, strides=(1,))
    fresh = np.ones(len(order), bool)
    fresh[1:] = False
    for at in sorted({*range(0, length - step + 1, step), length - step}):
        found = words[order + at]
        fresh[1:] |= found[1:] != found[:-1]
    begin = np.flatnonzero(fresh)
    least = np.minimum.reduceat(lows[owner[order]], begin) if len(begin) else np.zeros(0, np.int64)
    value = np.zeros(len(symbols), np.int64)
    value[order] = least[np.cumsum(fresh) - 1]
    at = np.flatnonzero(inside)
    return owner[at], at - first[owner[at]], value[at]


def smallest(bodies: list[bytes], lows: np.ndarray, length: int) -> list[np.ndarray]:
    """For every start of `length` bytes in each body the smallest of `lows` over all bodies that hold the same bytes anywhere."""
    data, offsets = np.frombuffer(b"".join(bodies), np.uint8), np.cumsum([0, *map(len, bodies)])
    owner, _, value = _least(data, offsets, lows, length)
    return np.split(value, np.searchsorted(owner, np.arange(1, len(bodies))))


def owned(grams: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end, owner) of all runs of strings of `length` bytes with one owner, as the bytes from a run's begin to its end.

    The owner is the place of the first of the smallest k-grams in a string. grams: a hash for every byte.
    """
    span, strings = length - GRAM + 1, int(offsets[-1]) - length + 1
    fresh = np.ones(max(0, strings) + 1, bool)
    owner = np.empty(max(0, strings), np.int64)
    for low in range(0, strings, _SEGMENT):
        high = min(low + _SEGMENT, strings)
        key = (grams[low : high + span - 1] & np.uint64(0xFFFFFFFFFF000000)) | np.arange(high - low + span - 1, dtype=np.uint64)
        have = 1
        while have < span:
            step = min(have, span - have)
            key = np.minimum(key[:-step], key[step:])
            have += step
        owner[low:high] = (key & np.uint64(0xFFFFFF)).view(np.int64) + low
    fresh[1:-1] = owner[1:] != owner[:-1]
    # Strings that reach into the next text are runs of their own, which go.
    over = np.maximum(offsets[1:] - length + 1, offsets[:-1])
    fresh[over[over < strings]] = True
    fresh[offsets[:-1][offsets[:-1] < strings]] = True
    begin = np.flatnonzero(fresh)
    begin, end = begin[:-1], begin[1:] - 1 + length
    text = np.searchsorted(offsets, begin, "right") - 1
    inside = end <= offsets[text + 1]
    text, begin, end = text[inside], begin[inside], end[inside]
    return text, begin, end, owner[begin]


def _changes(*columns: np.ndarray) -> np.ndarray:
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(out)


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[n]) for c, n in zip(columns, names)], names=names)


def _pieces(length: int):
    """Pieces of text around owners: a piece holds the strings of one owner. Those of one `key` in a block of texts are one row.

    `key` is the hash of the owner, `two` an independent hash of the whole piece. A row is a piece of its smallest document; `more` has
    the others of that key, by document, and is mostly NULL.
    """
    names = ["key", "two", "doc_id", "start", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in hashing.blocks(batch.column(1)):
                if len(data) < length:
                    continue
                grams = hashing.windows(hashing.byte_values(data), GRAM)
                text, begin, end, owner = owned(grams, offsets, length)
                two = hashing.spans(hashing.byte_values(data, 1), begin, end, 1).view(np.int64)
                key, doc = grams[owner].view(np.int64), ids[row + text]
                order = np.lexsort((doc, key))
                at = _changes(key[order])
                # In the order of the texts, in which equal ids and near starts follow each other, a shuffle takes half the space.
                order = order[np.argsort(np.repeat(order[at], np.diff(np.append(at, len(order)))), kind="stable")]
                columns = [c[order] for c in (key, two, doc, begin - offsets[text], end - begin)]
                first = np.zeros(len(order), bool)
                first[_changes(columns[0])] = True
                rest = _batch([c[~first] for c in columns[1:]], names[1:])
                counts = np.diff(np.append(np.flatnonzero(first), len(order))) - 1
                border = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32(), mask=np.append(counts == 0, False))
                out = _batch([c[first] for c in columns], names)
                more = pa.ListArray.from_arrays(border, pa.StructArray.from_arrays(rest.columns, names=names[1:]))
                yield out.append_column("more", more)

    return run


def _strings(length: int):
    """The strings of given pieces, each as a piece. `key` tells an owner and the edges of a string, `two` is a hash of the string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for row, data, offsets in hashing.blocks(batch.column(1)):
                border = lists.offsets.to_numpy()[row : row + len(offsets)]
                key, start, size = (c.to_numpy()[border[0] : border[-1]] for c in lists.values.flatten())
                text = np.repeat(np.arange(len(offsets) - 1), np.diff(border))
                counts = size - length + 1
                piece = np.repeat(np.arange(len(counts)), counts)
                start = start[piece].astype(np.int64) + np.arange(len(piece)) - (np.cumsum(counts) - counts)[piece]
                text, begin = text[piece], start + offsets[text[piece]]
                # Equal strings begin and end alike.
                values, other = hashing.byte_values(data), hashing.byte_values(data, 1)
                edge = hashing.runs(values, begin, 12) ^ hashing.runs(values, begin + length - 12, 12, 1)
                key = hashing.mix(key[piece].view(np.uint64) ^ edge).view(np.int64)
                two = hashing.runs(other, begin, length, 1).view(np.int64)
                yield _batch([key, two, ids[row + text], start, np.full(len(start), length)], ["key", "two", "doc_id", "start", "size"])

    return run


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of pieces given, for each document, by start and size."""
    names = ["key", "two", "body", "doc_id", "high"]
    for batch in batches:
        out: list[pa.RecordBatch] = []
        held = 0
        for doc, text, pieces in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            key, two, start, size, high = pieces.values.flatten()
            whole = text.as_py().encode()
            begin = start.to_numpy()
            bodies = [whole[a:b] for a, b in zip(begin.tolist(), (begin + size.to_numpy()).tolist())]
            out.append(_batch([key, two, bodies, np.full(len(key), doc), high], names))
            held += out[-1].nbytes
            if held > 1 << 22:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out, held = [], 0
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()


def _copies(texts: DataFrame, length: int) -> DataFrame:
    """doc_id, starts: documents whose text is that of a document with a smaller id; all their strings repeat."""
    whole = written(texts.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").alias("size")))
    first = whole.groupBy("digest").agg(F.min("doc_id").alias("_first"))
    run = F.struct(F.lit(0).alias("from"), (F.col("size") - length + 1).alias("to"))
    found = written(whole.join(first, "digest").where("doc_id > _first").select("doc_id", F.expr(f"size >= {length}").alias("_long"), F.array(run).alias("starts")).distinct())
    discard(whole)
    return found


def repeats(documents: DataFrame, length: int = 50, bucket_bytes: int = 1 << 21, hot: int = 20_000) -> DataFrame:
    """doc_id, starts: where strings of `length` bytes begin in a document that also begin in one with a smaller id.

    Starts come as runs {from, to}. Rows of one id are one document and must be equal; a NULL id or text holds nothing. Buckets get about
    `bucket_bytes` of different text; an owner of more than `hot` different pieces is spread over many buckets by the strings themselves.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null and text is not null")
    copies = _copies(texts, length)
    release(spark)
    texts = texts.join(copies.select("doc_id"), "doc_id", "left_anti")
    found = texts.mapInArrow(_pieces(length), "key long, two long, doc_id long, start int, size int, more array<struct<two: long, doc_id: long, start: int, size: int>>")
    of_key = Window.partitionBy("key")
    found = found.withColumns({
        "low": F.min("doc_id").over(of_key),
        "high": F.max(F.expr("if(more is null, doc_id, element_at(more, -1).doc_id)")).over(of_key),
        "_n": F.sum(F.expr("if(more is null, 1, 1 + size(more))")).over(of_key),
        "_one": (F.min("two").over(of_key) == F.max("two").over(of_key)) & ~F.max(F.expr("more is not null and exists(more, m -> m.two <> two)")).over(of_key),
    })
    kind = F.when(F.col("_one"), _EQUAL).when(F.col("_n") > hot, _HOT).otherwise(_MIXED).alias("kind")
    each = F.inline(F.expr("concat(array(struct(two, doc_id, start, size)), coalesce(more, array()))"))
    shared = written(found.where("low < high").select("key", "low", kind, each))
    release(spark)
    columns = ["key", "two", "doc_id", "start", "size"]
    pieces = shared.where(F.col("kind") != _EQUAL).select(*columns, "kind")

    # Equal pieces are one: the one of the smallest document, wherever it stands there. All buffers are numbers.
    def different(found: DataFrame) -> DataFrame:
        low = [F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("high"), F.min_by("start", "doc_id").alias("start")]
        return found.groupBy("key", "two").agg(*low, F.min("size").alias("size"), F.min("kind").alias("kind"))

    firsts = written(different(pieces))
    release(spark)
    parts = []
    many = firsts.where(F.col("kind") == _HOT).groupBy("key").count().where(F.col("count") > hot).select("key")
    if not many.isEmpty():
        many = written(many)
        places = pieces.where(F.col("kind") == _HOT).join(many, "key").groupBy("doc_id").agg(F.collect_set(F.struct("key", "start", "size")).alias("places"))
        near = texts.join(places, "doc_id").select("doc_id", "text", "places")
        strings = written(near.mapInArrow(_strings(length), "key long, two long, doc_id long, start int, size int").withColumn("kind", F.lit(_MIXED)))
        parts = [many, firsts, strings]
        pieces = pieces.join(many, "key", "left_anti").unionByName(strings)
        firsts = written(firsts.join(many, "key", "left_anti").unionByName(different(strings)))
        release(spark)
    buckets = max(1, -(-(firsts.agg(F.sum("size")).first()[0] or 0) // bucket_bytes))
    chosen = firsts.groupBy("doc_id").agg(F.collect_list(F.struct("key", "two", "start", "size", "high")).alias("pieces"))
    bodies = written(texts.join(chosen, "doc_id").select("doc_id", "text", "pieces").mapInArrow(_bodies, "key long, two long, body binary, doc_id long, high long"))
    discard(firsts)
    release(spark)

    def sort(table: pa.Table) -> pa.Table:
        bodies = table["body"].cast(pa.large_binary()).combine_chunks()
        # One block, whatever its size, since equal strings have to meet.
        (_, data, offsets), = hashing.blocks(bodies, bodies.nbytes + 1)
        body, start, value = _least(data, offsets, table["doc_id"].to_numpy().astype(np.int64), length)
        # Runs of starts of one value in one body, where that is below a document that has the body.
        at = _changes(body, value) if len(body) else body
        end = start[np.append(at[1:], len(body)) - 1] + 1 if len(at) else at
        use = value[at] < table["high"].to_numpy()[body[at]]
        at, end = at[use], end[use]
        counts = np.bincount(body[at], minlength=table.num_rows)
        run = pa.StructArray.from_arrays([pa.array(start[at], pa.int32()), pa.array(end, pa.int32()), pa.array(value[at], pa.int64())], names=["from", "to", "low"])
        some = counts > 0
        runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts[some])]), pa.int32()), run)
        return table.select(["key", "two"]).filter(pa.array(some)).append_column("runs", runs)

    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")
    ranges = written(bodies.groupBy(bucket).applyInArrow(sort, "key long, two long, runs array<struct<from: int, to: int, low: long>>"))
    discard(bodies)
    release(spark)
    back = pieces.select("key", "two", "doc_id", "start").join(ranges, ["key", "two"])
    runs = F.expr("transform(filter(runs, r -> r.low < doc_id), r -> struct(start + r.from as from, start + r.to as to))")
    back = back.select("doc_id", runs.alias("runs")).where("size(runs) > 0")
    # Where all pieces of an owner are equal there is nothing to sort: what is not in the smallest document repeats.
    equal = shared.where((F.col("kind") == _EQUAL) & (F.col("doc_id") > F.col("low")))
    whole = F.struct(F.col("start").alias("from"), (F.col("start") + F.col("size") - length + 1).alias("to"))
    back = back.unionByName(equal.select("doc_id", F.array(whole).alias("runs")))
    out = written(back.groupBy("doc_id").agg(F.flatten(F.collect_set("runs")).alias("starts")))
    discard(shared, ranges, *parts)
    release(spark)
    return out.unionByName(copies.where("_long").drop("_long"))


def strip(documents: DataFrame, found: DataFrame, length: int = 50) -> DataFrame:
    """All columns of documents and kept (remaining bytes), n_bytes, n_removed, n_spans. A NULL text is empty.

    Columns with the added names are replaced.
    """
    known = found.select(F.col("doc_id").alias("_repeats_id"), F.col("starts").alias("_repeats"))
    joined = documents.join(known, documents["doc_id"] == known["_repeats_id"], "left").drop("_repeats_id")

    def compute(column: pa.Array) -> list[pa.Array]:
        texts, starts = column.field("text"), column.field("starts")
        border = starts.offsets.to_numpy()
        begin, end = (starts.values.field(n).to_numpy() for n in ("from", "to"))
        out: tuple[list, ...] = ([], [], [], [])
        for k, (low, high) in enumerate(zip(border[:-1].tolist(), border[1:].tolist())):
            text = (texts[k].as_py() or "").encode()
            left, removed, spans = text, 0, 0
            if high > low:
                gone = np.bincount(begin[low:high], minlength=len(text) + 1) - np.bincount(end[low:high] - 1 + length, minlength=len(text) + 1)
                away = np.cumsum(gone[:-1]) > 0
                removed = int(away.sum())
                spans = int(away[:1].sum() + (away[1:] & ~away[:-1]).sum())
                left = np.frombuffer(text, np.uint8)[~away].tobytes()
            for values, value in zip(out, (left, len(text), removed, spans)):
                values.append(value)
        return [pa.array(out[0], pa.binary()), *(pa.array(v, pa.int64()) for v in out[1:])]

    inputs = F.struct(F.col("text").cast("string").alias("text"), F.col("_repeats").alias("starts"))
    return append(joined, inputs, "kept binary, n_bytes long, n_removed long, n_spans long", compute).drop("_repeats")


def digest(stripped: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return stripped.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
