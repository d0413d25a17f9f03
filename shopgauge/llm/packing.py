"""Packing of token sequences by shortest-pack-first over the length histogram."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgauge.llm.common import give_back, kept
from shopgauge.llm.tokens import Encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(documents: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """The ids of every document, `end_id` after them, cut every `size` ids. One row per piece, with its ids on request.

    A NULL or empty text has the end id alone. Repeated documents and NULL doc_ids are rows like any other; further columns of the
    input are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        end = np.array([end_id], np.int32)
        for batch in batches:
            rows: list[tuple] = []
            parts: list[np.ndarray] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                ids = np.concatenate([ids, end])
                for start in range(0, len(ids), size):
                    part = ids[start : start + size]
                    rows.append((doc, start, len(part), zlib.crc32(part.astype("<u4")), len(ids)))
                    if with_ids:
                        parts.append(part)
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *parts]))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
            del rows, parts, columns
            give_back()

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def patterns(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """(number of packs, lengths in a pack) for all lengths of the histogram.

    Lengths go longest first into the pack that is filled least so far, if they fit, else into new packs, as many of the length as
    fit. Packs of equal content are one entry with a count, so the work follows the number of lengths and patterns, not that of
    sequences.
    """
    open_packs: list[tuple[int, int, int, tuple]] = []  # (-room, tie, count, lengths as a chain)
    tie = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        grown = []
        while left:
            if open_packs and -open_packs[0][0] >= length:
                room, _, count, chain = heapq.heappop(open_packs)
                used = min(count, left)
                if count > used:
                    tie += 1
                    heapq.heappush(open_packs, (room, tie, count - used, chain))
                tie += 1
                heapq.heappush(open_packs, (room + length, tie, used, (chain, length)))
            else:
                each = min(size // length, left)
                used = left // each
                chain = ()
                for _ in range(each):
                    chain = (chain, length)
                tie += 1
                grown.append((each * length - size, tie, used, chain))
                used *= each
            left -= used
        for pack in grown:
            heapq.heappush(open_packs, pack)
    out = []
    for _, _, count, chain in sorted(open_packs, key=lambda p: p[1]):
        lengths: list[int] = []
        while chain:
            chain, length = chain
            lengths.append(length)
        out.append((count, lengths[::-1]))
    return out


def _places(found: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, copies in a pack, offset of the first): where the rank of a length goes."""
    rows, used, sequence = [], {}, 0
    for count, lengths in found:
        offset = 0
        for length in dict.fromkeys(lengths):
            copies = lengths.count(length)
            first = used.get(length, 0)
            used[length] = first + count * copies
            rows.append((length, first, first + count * copies - 1, sequence, copies, offset))
            offset += copies * length
        sequence += count
    return rows


def packed(parts: DataFrame, size: int = 2048, slot_rows: int = 20_000, sent_places: int = 1 << 20) -> DataFrame:
    """Every row of `parts` (doc_id, start, length, ids_crc32, ...) with sequence_id and offset, gapless from 0 in its sequence.

    Only the histogram of lengths, `size` numbers at most, comes to the driver. Ranks within a length are counted in slots of about
    `slot_rows` rows, so a length that most pieces have is shared by as many tasks as it needs. The table of places has a row per
    pattern and length; up to `sent_places` rows of it are broadcast, more of them meet the ranks by a shuffle on length and slot-sized
    stretches of ranks. Columns of `parts` named sequence_id or offset are replaced. No rows in, no rows out.
    """
    parts = kept(parts.drop("sequence_id", "offset"))
    spark = parts.sparkSession
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # A row per length that there is, `size` at most.
    slots = spark.createDataFrame([(length, -(-n // slot_rows)) for length, n in histogram.items()], "_length long, _slots long")
    row = F.struct(*[F.col(f"`{c}`") for c in parts.columns]).alias("_row")
    # The slot and the order inside it come from the row, so that a task that runs again gives the same ranks.
    order = [F.col(f"_row.{c}") for c in ("doc_id", "start", "ids_crc32")]
    slotted = parts.select(row, F.col("length").alias("_length")).join(F.broadcast(slots), "_length")
    slotted = slotted.withColumn("_slot", F.pmod(F.xxhash64(*order), F.col("_slots"))).drop("_slots")
    counts = slotted.groupBy("_length", "_slot").agg(F.count("*").alias("_n"))
    by_slot = W.partitionBy("_length").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("_length", "_slot", F.coalesce(F.sum("_n").over(by_slot), F.lit(0)).alias("_before"))
    own = W.partitionBy("_length", "_slot").orderBy(*order)
    # The join is on the keys of the window, so the rows do not move a second time.
    ranked = slotted.withColumn("_own", F.row_number().over(own) - 1).join(before, ["_length", "_slot"])
    ranked = ranked.select("_row", "_length", (F.col("_own") + F.col("_before")).alias("_rank"))
    ranked = ranked.withColumn("_stretch", F.floor(F.col("_rank") / slot_rows))
    places = _places(patterns(histogram, size))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("_length", "_first", "_last", "_sequence", "_copies", "_offset")])
    place = spark.createDataFrame(places, schema)
    at = F.col("_rank").between(F.col("_first"), F.col("_last"))
    if len(places) <= sent_places:
        placed = ranked.join(F.broadcast(place.withColumnRenamed("_length", "_of")), (F.col("_length") == F.col("_of")) & at)
    else:
        over = F.sequence(F.floor(F.col("_first") / slot_rows), F.floor(F.col("_last") / slot_rows))
        placed = ranked.join(place.withColumn("_stretch", F.explode(over)), ["_length", "_stretch"]).where(at)
    turn = F.col("_rank") - F.col("_first")
    return placed.select(
        "_row.*",
        (F.col("_sequence") + F.floor(turn / F.col("_copies"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(turn, F.col("_copies")) * F.col("_length")).cast("long").alias("offset"),
    )
