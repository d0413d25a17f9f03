"""Repair of the turn order of conversations by Viterbi search with survivor coalescence.

A conversation is read turn by turn. For each of the four places a repaired conversation can be in (nothing yet, after a system turn,
after a user turn, after an assistant turn) the cheapest edits that lead there survive. Their last edits are leaves of one tree of
backpointers; a node that no survivor refers to any more is freed, and as soon as all survivors share an ancestor the edits up to it
are certain and leave the task. Texts never wait for that: rows pass through, edits follow, and a local sort brings them together.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
DELETE, REROLE, INSERT, UNFINISHED = 4, 3, 3, 3

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
#: What it costs at most to do in the first place what can be done in the second one.
_INSTEAD = {
    (_START, _SYSTEM): 0, (_START, _ASSISTANT): 0, (_START, _USER): INSERT,
    (_ASSISTANT, _SYSTEM): 0, (_ASSISTANT, _START): DELETE, (_ASSISTANT, _USER): INSERT,
    (_USER, _ASSISTANT): INSERT, (_USER, _SYSTEM): INSERT, (_USER, _START): INSERT + DELETE,
    (_SYSTEM, _USER): INSERT, (_SYSTEM, _ASSISTANT): 2 * INSERT, (_SYSTEM, _START): 2 * INSERT,
}


def _kept(place: int, initial: str) -> int | None:
    """The place after a kept turn, if the turn may stand there."""
    if initial == "s":
        return _SYSTEM if place == _START else None
    if initial == "u":
        return _USER if place != _USER else None
    return _ASSISTANT if initial == "a" and place == _USER else None


def _next(place: int) -> int:
    """The place after the user or assistant turn that is due."""
    return _ASSISTANT if place == _USER else _USER


@functools.lru_cache(maxsize=1 << 16)
def _step(survivors: tuple[tuple[int, int], ...], initial: str, fault: str) -> tuple[tuple[int, int, int, str], ...]:
    """(place, cost above the least, survivor it comes from, its edits) after one more turn, ordered as their whole edit strings are.

    `survivors` are (place, cost above the least) in the order of their edit strings. All of them end with the edit of the same turn,
    so no string is the beginning of another: which of two tied unresolved strings is less is settled by their order so far, else by
    the new edits. An insertion before a deletion is never least, two before a turn that stays never cheapest.
    """
    best: dict[int, tuple[int, int, str]] = {}

    def offer(place: int, *way) -> None:
        best[place] = min(best.get(place, way), way)

    for rank, (place, cost) in enumerate(survivors):
        offer(place, cost + DELETE, rank, "D")
        if fault in (BLANK, DUPLICATE):
            continue
        cost += UNFINISHED * (fault == TRUNCATED)
        for inserted in ("", "I"):
            if (kept := _kept(place, initial)) is not None:
                offer(kept, cost, rank, inserted + "K")
            offer(_next(place), cost + REROLE, rank, inserted + "R")
            place, cost = _next(place), cost + INSERT
    left = {
        a: x for a, x in best.items()
        if not any((best[b][0] + _INSTEAD[b, a], *best[b][1:]) < x for b in best if b != a)
    }
    least = min(cost for cost, _, _ in left.values())
    return tuple((place, cost - least, rank, edits) for place, (cost, rank, edits) in sorted(left.items(), key=lambda x: x[1][1:]))


class _Node:
    """The edits of one turn. The tree refers to it by `parent` from below; the length of `children` is its reference count."""

    __slots__ = ("parent", "children", "number", "edits")

    def __init__(self, parent: _Node | None, number: int, edits: str):
        self.parent, self.number, self.edits, self.children = parent, number, edits, []


class Survivors:
    """Cheapest edits of one conversation, turn by turn. Every call returns the (turn number, edits) that became certain by it."""

    def __init__(self) -> None:
        self.root = _Node(None, 0, "")
        self.state: tuple[tuple[int, int], ...] = ((_START, 0),)
        self.leaves = [self.root]
        self.number = 0

    def add(self, initial: str, fault: str | None) -> list[tuple[int, str]]:
        self.number += 1
        found = _step(self.state, initial if initial in ("s", "u", "a") else "", fault or "")
        leaves = []
        for _, _, rank, edits in found:
            node = _Node(self.leaves[rank], self.number, edits)
            node.parent.children.append(node)
            leaves.append(node)
        return self._resolved(tuple((place, cost) for place, cost, _, _ in found), leaves)

    def end(self) -> list[tuple[int, str]]:
        """The rest, with the turns inserted after the last one. Of tied strings the least."""
        last = {_START: "", _ASSISTANT: "", _USER: "I", _SYSTEM: "II"}
        _, rank = min((cost + INSERT * len(last[place]), rank) for rank, (place, cost) in enumerate(self.state))
        place = self.state[rank][0]
        found = self._resolved((self.state[rank],), [self.leaves[rank]])
        return found + ([(self.number + 1, last[place])] if last[place] else [])

    def _resolved(self, state: tuple[tuple[int, int], ...], leaves: list[_Node]) -> list[tuple[int, str]]:
        for node in self.leaves:
            while not node.children and node not in leaves and node.parent is not None:
                node.parent.children.remove(node)
                node = node.parent
        self.state, self.leaves, found = state, leaves, []
        while len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            found.append((self.root.number, self.root.edits))
        return found


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns after the damage that a repair is tried on: conv_id, turn, role, text, there.

    crc32 of `conv_id:turn` modulo 20 decides: 0 drops the turn, 1 empties its text, 2 removes `.`, `!` and `?`, 3 repeats it, 4 makes
    it a user turn. NULLs count as one blank, but a NULL turn stays one. A dropped turn leaves a row with `there` false, so that no
    conversation gets lost.
    """
    blank = F.lit(" ")
    code = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("role", "text")], (code % 20).alias("_code"))
    kind = F.col("_code")
    changed = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 0, F.lit("")).when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (kind != 0).alias("there"),
        F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("_copies"),
    )
    return changed.withColumn("_copy", F.explode("_copies")).drop("_copies", "_copy")


def faults(turns: DataFrame) -> DataFrame:
    """The turns with `number` (place in the conversation) and `fault`: the first of blank, duplicate, truncated, or NULL.

    Turns are ordered by turn (NULLs first), then by role and text. Only equal rows are then without order, which tells nothing apart.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    rows = turns.repartition("conv_id")
    same = W.partitionBy("conv_id", "role", "_digest", "there").orderBy("turn")
    order = W.partitionBy("conv_id").orderBy(F.desc("there"), "turn", "role", "text", "_seen")
    fault = (
        F.when(trimmed == "", F.lit(BLANK))
        .when(F.col("_seen") > 1, F.lit(DUPLICATE))
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), F.lit(TRUNCATED))
    )
    seen = rows.withColumn("_digest", F.sha2(F.encode("text", "UTF-8"), 256)).withColumn("_seen", F.row_number().over(same))
    return seen.withColumn("number", F.row_number().over(order).cast("long")).withColumn("fault", F.when(F.col("there"), fault)).select("conv_id", "number", "turn", "role", "text", "there", "fault")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows as they come, part 1, and the edits as they become certain, part 0."""
    now, search, schema = None, None, None

    def edits(found: list[tuple], names: list[str]) -> pa.RecordBatch:
        columns = dict(zip(("conv_id", "number", "edits"), map(list, zip(*found))))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.array([0] * len(found), f.type) if f.name == "part" else pa.nulls(len(found), f.type) for f in schema], schema=schema)

    for batch in batches:
        n = len(batch)
        schema = schema or pa.schema([*batch.schema, pa.field("edits", pa.string()), pa.field("part", pa.int32())])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(n, pa.string()), pa.array([1] * n, pa.int32())], schema=schema)
        found: list[tuple] = []
        initials = [(r or "")[:1] for r in batch.column("role").to_pylist()]
        for conv, there, initial, fault in zip(batch.column("conv_id").to_pylist(), batch.column("there").to_pylist(), initials, batch.column("fault").to_pylist()):
            if search is None or conv != now:
                if search is not None:
                    found += [(now, *x) for x in search.end()]
                now, search = conv, Survivors()
            if there:
                found += [(now, *x) for x in search.add(initial, fault)]
        if found:
            yield edits(found, schema.names)
    if search is not None and (found := [(now, *x) for x in search.end()]):
        yield edits(found, schema.names)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and edits, sorted together, as one row per edit."""
    now, place, waiting, begun = None, _START, "", False
    names = ["conv_id", "number", "edit", "turn", "old_role", "fault", "role", "text"]
    for batch in batches:
        kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4]
        out: list[tuple] = []
        for row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "number", "edits", "part", "turn", "role", "text", "there", "fault")]):
            conv, number, edits, part, turn, role, text, there, fault = row
            if not begun or conv != now:
                now, place, begun, waiting = conv, _START, True, ""
            if part == 0:
                # All but the last are insertions before the turn; insertions after the last turn have none.
                ahead = edits if edits[-1] == "I" else edits[:-1]
                waiting = edits[len(ahead) :]
                for edit in ahead:
                    place = _next(place)
                    out.append((conv, number, edit, None, None, None, _ROLE[place], ""))
            elif not there:
                out.append((conv, None, None, None, None, None, None, None))
            elif waiting == "D":
                out.append((conv, number, "D", turn, role, fault, None, None))
            elif waiting == "K":
                place = _kept(place, role[:1])
                out.append((conv, number, "K", turn, role, fault, role, text))
            else:
                place = _next(place)
                out.append((conv, number, "R", turn, role, fault, _ROLE[place], text))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def repair(turns: DataFrame) -> DataFrame:
    """The cheapest edits that make every conversation an optional system turn and then pairs of user and assistant turns, or nothing.

    One row per edit, those of a conversation together and in order: conv_id, number (of the turn, or of the turn an insertion stands
    before), edit (Keep, Rerole, Delete, Insert by initial), turn, old_role and fault of the turn, role and text after the repair
    (NULL if deleted). Of equally cheap repairs the one whose initials are least in ASCII order is taken. A row without an edit stands
    for turns that are not there.

    `turns` has conv_id, turn, role, text and there (false: the turn is gone). NULL conv_ids are one conversation; the role and text
    must not be NULL; further columns are left out; no rows give no rows. A conversation is one ordered stream through one task, as the
    order of its edits asks for; the task holds edits (not texts) that are not yet certain, at most four for a turn.
    """
    rows = faults(turns).sortWithinPartitions("conv_id", "number")
    key = next(f for f in rows.schema if f.name == "conv_id").dataType.simpleString()
    shared = f"conv_id {key}, number long, turn long, role string, text string, there boolean, fault string, edits string, part int"
    found = rows.mapInArrow(_search, shared).sortWithinPartitions("conv_id", "number", "part")
    return found.mapInArrow(_edited, f"conv_id {key}, number long, edit string, turn long, old_role string, fault string, role string, text string")


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    price = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}
    names = ["conv_id", "gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost", "audit", "repaired_sha256"]
    now, begun = None, False

    def closed() -> tuple:
        gaps = high - low + 1 - distinct if distinct else 0
        return (now, gaps, count[BLANK], count[DUPLICATE], count[TRUNCATED], illegal, cost, "".join(audit), digest.hexdigest())

    kinds = None
    for batch in batches:
        kinds = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
        out = []
        for row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "edit", "turn", "old_role", "fault", "role", "text")]):
            conv, edit, turn, old_role, fault, role, text = row
            if not begun or conv != now:
                if begun:
                    out.append(closed())
                now, begun, digest, audit = conv, True, hashlib.sha256(), []
                low = high = before = None
                distinct = illegal = cost = lines = 0
                count = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
            if edit is None:
                continue
            audit.append(edit)
            cost += price[edit] + UNFINISHED * (fault == TRUNCATED and edit != "D")
            if edit != "I":
                illegal += before is not None and before + old_role[:1] not in ("su", "ua", "au")
                before = old_role[:1]
                if fault:
                    count[fault] += 1
                if turn is not None and turn != high:
                    low, high, distinct = (turn if low is None else low), turn, distinct + 1
            if edit != "D":
                digest.update(("\n" * (lines > 0) + role + ":" + text).encode("utf-8", "surrogatepass"))
                lines += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(closed()), kinds)], names=names)


def audits(edits: DataFrame) -> DataFrame:
    """One row per conversation of `repair`'s result: gaps, blank, duplicate, truncated, illegal (adjacent roles before the repair),
    cost, audit (initials of the edits), repaired_sha256 (of the `role:text` lines).

    Reads the rows in the order `repair` gives them in, so nothing may deal them out in between.
    """
    key = next(f for f in edits.schema if f.name == "conv_id").dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost"))
    return edits.mapInArrow(_audits, f"conv_id {key}, {counts}, audit string, repaired_sha256 string")
