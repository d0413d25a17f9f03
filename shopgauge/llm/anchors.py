"""Removal of words that repeat an earlier document's, by difference-cover anchors.

Runs of `length` words are compared without hashing every run: with a difference cover of the numbers modulo `period`, any two equal
runs, wherever they start, share a shorter run that begins at a cover position of both documents. Only those anchors are hashed and
grouped. Around anchors that two documents share, the full runs are extended and compared by 128 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgauge.llm import hashing
from shopgauge.llm.common import append, discard, release, written

PERIOD = 31
#: The differences of these six numbers are all numbers modulo 31 (a perfect difference set).
COVER = (1, 5, 11, 24, 25, 27)


def _table(rows: list[np.ndarray], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=names)


def _word_runs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, word hashes, the same of the other family, word offsets) for blocks of texts."""
    for row, data, offsets in hashing.blocks(column):
        start, end, at = hashing.word_spans(data, offsets)
        yield row, hashing.word_hashes(data, start, end), hashing.word_hashes(data, start, end, 1), at


def _anchors(length: int):
    size = length - PERIOD + 1
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, words, _, at in _word_runs(batch.column(1)):
                start, text = hashing.starts(at, size)
                place = start - at[text]
                use = cover[place % PERIOD] & (np.diff(at) >= length)[text]
                start, text, place = start[use], text[use], place[use]
                yield _table([hashing.runs(words, start, size).view(np.int64), ids[row + text], place], ["anchor", "doc_id", "place"], [pa.int64(), pa.int64(), pa.int32()])

    return run


def _full_runs(length: int):
    """The runs of `length` words around the shared anchors of each document."""
    size = length - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for row, words, more, at in _word_runs(batch.column(1)):
                starts, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for k in range(len(at) - 1):
                    count = at[k + 1] - at[k]
                    near = np.zeros(max(0, count - length + 1) + 1, np.int64)
                    for place in (np.array(places[row + k].as_py(), np.int64),):
                        place = place[place + size <= count]
                        np.add.at(near, np.minimum(np.maximum(0, place + size - length), len(near) - 1), 1)
                        np.add.at(near, np.minimum(place + 1, len(near) - 1), -1)
                    found = np.flatnonzero(np.cumsum(near[:-1]) > 0)
                    starts.append(found + at[k])
                    owners.append(np.full(len(found), k))
                start, owner = np.concatenate(starts), np.concatenate(owners)
                columns = [hashing.runs(words, start, length).view(np.int64), hashing.runs(more, start, length, 1).view(np.int64), ids[row + owner], start - at[owner]]
                yield _table(columns, ["one", "two", "doc_id", "place"], [pa.int64(), pa.int64(), pa.int64(), pa.int32()])

    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for row, words, more, at in _word_runs(batch.column(1)):
            columns = [hashing.spans(words, at[:-1], at[1:]).view(np.int64), hashing.spans(more, at[:-1], at[1:], 1).view(np.int64), ids[row : row + len(at) - 1], np.diff(at)]
            yield _table(columns, ["one", "two", "doc_id", "words"], [pa.int64(), pa.int64(), pa.int64(), pa.int64()])


def _copies(texts: DataFrame) -> DataFrame:
    """Documents whose words are all those of a document with a smaller id."""
    whole = written(texts.mapInArrow(_whole, "one long, two long, doc_id long, words long"))
    first = whole.groupBy("one", "two", "words").agg(F.min("doc_id").alias("_first"))
    found = written(whole.join(first, ["one", "two", "words"]).where("doc_id > _first").select("doc_id").distinct())
    discard(whole)
    return found


def _shared_anchors(texts: DataFrame, copies: DataFrame, length: int) -> DataFrame:
    """Places of the anchors that another document has too, by document."""
    anchors = texts.mapInArrow(_anchors(length), "anchor long, doc_id long, place int")
    groups = anchors.groupBy("anchor").agg(F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high"))
    shared = written(groups.where("_low < _high").select("anchor"))
    release(texts.sparkSession)
    found = anchors.join(shared, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    places = written(found.join(copies, "doc_id", "left_anti"))
    discard(shared)
    return places


def _repeats(texts: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """Where in each document a run starts that also starts in a document with a smaller id."""
    near = texts.join(places, "doc_id").select("doc_id", "text", "places")
    runs = written(near.mapInArrow(_full_runs(length), "one long, two long, doc_id long, place int"))
    release(texts.sparkSession)
    groups = runs.groupBy("one", "two").agg(F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high"))
    first = written(groups.where("_low < _high").drop("_high"))
    release(texts.sparkSession)
    found = runs.join(first, ["one", "two"]).where("doc_id > _low")
    starts = written(found.groupBy("doc_id").agg(F.collect_set("place").alias("starts")))
    discard(runs, first)
    return starts


def repeats(documents: DataFrame, length: int = 50) -> DataFrame:
    """doc_id, copy, starts: documents that hold runs of `length` words which also start in a document with a smaller id.

    `copy` says that the whole document repeats an earlier one; its starts are then not listed. Rows of one id are one document and
    must be equal; rows with a NULL id or text hold nothing. Every text is read whole, copies are set aside before runs are compared,
    and groups of equal anchors or runs are only ever aggregated to their smallest id.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null and text is not null")
    copies = _copies(texts)
    release(spark)
    places = _shared_anchors(texts, copies, length)
    release(spark)
    starts = _repeats(texts, places, length)
    discard(places)
    release(spark)
    return starts.select("doc_id", F.lit(False).alias("copy"), "starts").unionByName(
        copies.select("doc_id", F.lit(True).alias("copy"), F.lit(None).cast("array<int>").alias("starts"))
    )


_WORD = re.compile(rb"[^ \t-\r]+")


def _cut(text: bytes, stay: np.ndarray) -> bytes:
    """The text without the words that don't stay, each with the white space after it; trailing white space goes with the last word."""
    begin = [m.start() for m in _WORD.finditer(text)]
    ends = [*begin[1:], len(text)]
    parts = [text[: begin[0]] if begin else text, *(text[a:b] for a, b, s in zip(begin, ends, stay.tolist()) if s)]
    return b"".join(parts) if stay[-1:].all() else b"".join(parts).rstrip(b" \t\n\x0b\x0c\r")


def strip(documents: DataFrame, found: DataFrame, length: int = 50, spacing: bool = False) -> DataFrame:
    """All columns of documents and kept_text (the words that stay, joined by one blank), n_words, n_removed.

    With `spacing` the white space between words that stay is left as it is, so a text of which nothing is removed is unchanged.
    A NULL text has no words. Columns with the added names are replaced.
    """
    known = found.select(F.col("doc_id").alias("_repeats_id"), F.struct("copy", "starts").alias("_repeats"))
    joined = documents.join(known, documents["doc_id"] == known["_repeats_id"], "left").drop("_repeats_id")

    def compute(column: pa.Array) -> list[pa.Array]:
        texts, copies, starts = column.field("text"), column.field("copy").to_pylist(), column.field("starts")
        kept_texts, words, removed = [], [], []
        for k in range(len(column)):
            whole = (texts[k].as_py() or "").encode()
            text = whole.split()
            n = len(text)
            gone = np.zeros(n + 1, np.int64)
            if copies[k]:
                if n >= length:
                    gone[0] = 1
            elif starts[k].is_valid:
                place = np.array(starts[k].as_py(), np.int64)
                place = place[place + length <= n]
                np.add.at(gone, place, 1)
                np.add.at(gone, place + length, -1)
            stay = np.cumsum(gone[:n]) == 0
            left = int(stay.sum())
            if spacing:
                kept_texts.append((whole if left == n else _cut(whole, stay)).decode())
            else:
                kept_texts.append(b" ".join(text if left == n else [text[i] for i in np.flatnonzero(stay).tolist()]).decode())
            words.append(n)
            removed.append(n - left)
        return [pa.array(kept_texts, pa.string()), pa.array(words, pa.int64()), pa.array(removed, pa.int64())]

    inputs = F.struct(F.col("text").cast("string").alias("text"), F.col("_repeats.copy").alias("copy"), F.col("_repeats.starts").alias("starts"))
    return append(joined, inputs, "kept_text string, n_words long, n_removed long", compute).drop("_repeats")


def digest(stripped: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return stripped.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))
