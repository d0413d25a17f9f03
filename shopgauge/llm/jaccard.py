"""Documents linked by the Jaccard similarity of their word n-gram sets, by a prefix-tree join.

All sets have one global order: tokens that are frequent in the corpus last, else by hash. Two similar sets share a token among the
first of each (the prefix bound), so documents that share one go to the block of the smallest document that has it. In a block, the
sets are stored in a prefix tree; each document walks it, counting the overlap of shared paths once, and leaves a subtree when the
tokens that remain cannot reach the similarity. A block gives a star for each group it finds, and stars are joined to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgauge.llm import hashing
from shopgauge.llm.common import discard, kept, release, written
from shopgauge.llm.components import components

_DOOR = 22


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text its set of hashed n-grams of words in small ASCII letters, sorted. Fewer words: the whole sequence as one."""
    for _, data, offsets in hashing.blocks(column):
        data = hashing.LOWER[data]
        start, end, at = hashing.word_spans(data, offsets)
        words = hashing.word_hashes(data, start, end)
        first, text = hashing.starts(at, n)
        grams = hashing.runs(words, first, n).view(np.int64)
        border = np.searchsorted(text, np.arange(len(at)))
        whole = hashing.spans(words, at[:-1], at[1:]).view(np.int64)
        for k in range(len(at) - 1):
            if border[k + 1] > border[k]:
                yield np.unique(grams[border[k] : border[k + 1]])
            else:
                yield whole[k : k + 1] if at[k + 1] > at[k] else whole[:0]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


class Frequent:
    """The tokens that come last in the order."""

    def __init__(self, tokens: np.ndarray):
        self.tokens = np.sort(tokens)
        self.door = np.zeros(1 << _DOOR, bool)
        self.door[tokens.view(np.uint64) >> np.uint64(64 - _DOOR)] = True

    def has(self, tokens: np.ndarray) -> np.ndarray:
        out = self.door[tokens.view(np.uint64) >> np.uint64(64 - _DOOR)]
        maybe = np.flatnonzero(out)
        if len(maybe):
            at = np.minimum(np.searchsorted(self.tokens, tokens[maybe]), len(self.tokens) - 1)
            out[maybe] = self.tokens[at] == tokens[maybe]
        return out


def frequent_tokens(texts: DataFrame, n: int, least: int, most: int) -> np.ndarray:
    """At most `most` tokens that at least `least` documents have, counted where they meet within a batch.

    The order built from them may be any; it decides how much work the join is, never what it finds.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.int64), *shingle_sets(batch.column(1), n)]
            tokens, times = np.unique(np.concatenate(found), return_counts=True)
            often = times > 1
            yield pa.RecordBatch.from_arrays([pa.array(tokens[often]), pa.array(times[often])], names=["token", "times"])

    counts = texts.mapInArrow(count, "token long, times long").groupBy("token").agg(F.sum("times").alias("times")).where(F.col("times") >= least)
    top = counts.orderBy(F.desc("times"), "token").limit(most).select("token").toArrow()
    return top["token"].to_numpy().astype(np.int64)


def _prefixes(n: int, share: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, prefixes, sketches = [], [], [], [], []
            for tokens in shingle_sets(batch.column(1), n):
                size = len(tokens)
                late = shared.value.has(tokens)
                keep = size - -(-share * size // 100) + 1 if size else 0
                rare = tokens[~late]
                prefixes.append(rare[:keep] if len(rare) >= keep else np.concatenate([rare, tokens[late][: keep - len(rare)]]))
                sizes.append(size)
                sketches.append(sketch(tokens))
                mixed = tokens.view(np.uint64)
                one.append(int(hashing.mix(mixed + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)) if size else 0)
                two.append(int(hashing.mix(mixed ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).view(np.int64)) if size else 0)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), _lists(prefixes), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "size", "one", "two", "prefix", "sketch"])

    return run


def sketch(tokens: np.ndarray) -> bytes:
    """Counts of tokens in buckets, about as many buckets as tokens, 256 at least and a power of two. 255 stands for any number."""
    buckets = max(256, 1 << max(0, len(tokens) // 2 - 1).bit_length())
    return np.minimum(255, np.bincount(tokens.view(np.uint64) & np.uint64(buckets - 1), minlength=buckets)).astype(np.uint8).tobytes()


def may_share(sizes: np.ndarray, places: np.ndarray, share: int) -> np.ndarray:
    """Which sets may be similar to another one of these, by size and by the earliest place, in its own order, of a token that a set shares.

    Tokens before that place are shared with none, so the overlap is at most what comes from there on.
    """
    out = np.zeros(len(sizes), bool)
    order = np.argsort(sizes, kind="stable")
    ranked, left = sizes[order], (sizes - places)[order]
    for k in range(len(order)):
        end = int(np.searchsorted(ranked, 100 * ranked[k] // share, "right"))
        near = np.minimum(left[k + 1 : end], left[k]) * (100 + share) >= share * (ranked[k + 1 : end] + ranked[k])
        if near.any():
            out[order[k]] = True
            out[order[k + 1 : end][near]] = True
    return out


def may_link(sizes: np.ndarray, sketches: list[bytes], share: int) -> np.ndarray:
    """Which sets may be similar to another one of these, by their sizes and bucket counts.

    The overlap of two sets is at most the sum of the smaller count of every bucket, the finer sketch folded to the coarser.
    """
    out = np.zeros(len(sizes), bool)
    order = np.argsort(sizes, kind="stable")
    ranked = sizes[order]
    widths = np.array([len(sketches[k]) for k in order])
    tables = {}
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths >= width)
        table = np.zeros((len(rows), width), np.int32)
        for r, k in enumerate(rows):
            counts = np.frombuffer(sketches[order[k]], np.uint8).astype(np.int32)
            counts[counts == 255] = 1 << 16
            table[r] = counts.reshape(-1, width).sum(0)
        tables[width] = rows, table
    for k in range(len(order)):
        # Sizes rise, so each pair is met once, from its smaller side, and the widths of later sets are not below.
        rows, table = tables[int(widths[k])]
        at = int(np.searchsorted(rows, k))
        end = int(np.searchsorted(rows, np.searchsorted(ranked, 100 * ranked[k] // share, "right")))
        for low in range(at + 1, end, 128):
            high = min(low + 128, end)
            bound = np.minimum(np.minimum(table[low:high], table[at]).sum(1), ranked[k])
            near = bound * (100 + share) >= share * (ranked[rows[low:high]] + ranked[k])
            if near.any():
                out[order[k]] = True
                out[order[rows[low:high][near]]] = True
    return out


class _Node:
    __slots__ = ("children", "docs", "largest", "least_size", "most_size", "path")

    def __init__(self, path: np.ndarray):
        self.path = path
        self.children: dict[int, _Node] = {}
        self.docs: list[int] = []
        self.least_size, self.most_size, self.largest = 1 << 60, 0, 0


class PrefixTree:
    """Sets of ranks as paths from the root; paths that begin alike are stored once. Knows which sets belong together so far."""

    def __init__(self, sizes: list[int], groups: list[int], ranks: int, share: int):
        self.root = _Node(np.zeros(0, np.int64))
        self.sizes, self.share = sizes, share
        self.above = list(range(len(sizes)))
        self.inside = np.zeros(ranks, bool)
        first: dict[int, int] = {}
        for k, g in enumerate(groups):
            self.join(first.setdefault(g, k), k)

    def top(self, k: int) -> int:
        while self.above[k] != k:
            self.above[k] = self.above[self.above[k]]
            k = self.above[k]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.top(a), self.top(b)
        self.above[max(a, b)] = min(a, b)

    def insert(self, k: int, ranks: np.ndarray) -> None:
        node, at, size = self.root, 0, self.sizes[k]
        while True:
            node.least_size, node.most_size = min(node.least_size, size), max(node.most_size, size)
            node.largest = max(node.largest, len(ranks))
            if at == len(ranks):
                node.docs.append(k)
                return
            child = node.children.get(int(ranks[at]))
            if child is None:
                child = node.children[int(ranks[at])] = _Node(ranks[at:])
            common = min(len(child.path), len(ranks) - at)
            other = np.flatnonzero(child.path[:common] != ranks[at : at + common])
            common = int(other[0]) if len(other) else common
            if common < len(child.path):
                upper = _Node(child.path[:common])
                upper.least_size, upper.most_size, upper.largest = child.least_size, child.most_size, child.largest
                child.path = child.path[common:]
                upper.children[int(child.path[0])] = child
                node.children[int(ranks[at])] = child = upper
            node = child
            at += common

    def link(self, k: int, ranks: np.ndarray) -> None:
        """Join set k with every set in the tree that is similar to it."""
        size, share = self.sizes[k], self.share
        self.inside[ranks] = True
        stack = [(self.root, 0, 0)]
        while stack:
            node, depth, overlap = stack.pop()
            # The larger of two similar sets is at most 100 / share times the smaller.
            if 100 * size < share * node.least_size or 100 * node.most_size < share * size:
                continue
            if len(node.path):
                overlap += int(np.count_nonzero(self.inside[node.path]))
                depth += len(node.path)
                left = len(ranks) - int(np.searchsorted(ranks, node.path[-1], "right"))
                # What remains on either side cannot reach share / (100 + share) of both sizes.
                if (overlap + min(left, node.largest - depth)) * (100 + share) < share * (size + node.least_size):
                    continue
            for d in node.docs:
                if self.top(d) != self.top(k) and 100 * overlap >= share * (size + self.sizes[d] - overlap):
                    self.join(d, k)
            stack += [(child, depth, overlap) for child in node.children.values()]
        self.inside[ranks] = False


def linked(sets: list[np.ndarray], groups: list[int], share: int) -> list[int]:
    """For each set the index of the first set of its component, given groups known before."""
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    tokens, index, times = np.unique(np.concatenate([np.zeros(0, np.int64), *sets]), return_inverse=True, return_counts=True)
    # Tokens of one set only can't overlap and need no rank; the others come most frequent first, so that paths are shared.
    rank = np.full(len(tokens), -1)
    often = np.flatnonzero(times > 1)
    rank[often[np.argsort(-times[often], kind="stable")]] = np.arange(len(often))
    border = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    tree = PrefixTree([len(s) for s in sets], groups, len(often), share)
    for k in order:
        ranks = rank[index[border[k] : border[k + 1]]]
        ranks = np.sort(ranks[ranks >= 0])
        tree.link(k, ranks)
        tree.insert(k, ranks)
    return [tree.top(k) for k in range(len(sets))]


def _stars(texts: DataFrame, members: DataFrame, n: int, share: int) -> DataFrame:
    """Edges (a, b) found in blocks; members: doc_id, block, part, known (component so far)."""
    wanted = members.groupBy("doc_id").agg(F.collect_list(F.struct("block", "part", "known")).alias("places"))
    near = texts.join(wanted, "doc_id").select("doc_id", "text", "places")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("block", pa.int64()), ("part", pa.int64()), ("known", pa.int64()), ("doc_id", pa.int64()), ("tokens", pa.binary())]
        for batch in batches:
            out, held = [], 0
            for doc, places, tokens in zip(batch.column(0).to_pylist(), batch.column(2), shingle_sets(batch.column(1), n)):
                body = tokens.tobytes()
                for p in places.as_py():
                    out.append((p["block"], p["part"], p["known"], doc, body))
                    held += len(body)
                if held > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), kinds)], names=[x for x, _ in kinds])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), kinds)], names=[x for x, _ in kinds])

    def walk(table: pa.Table) -> pa.Table:
        rows = sorted({(d, g): t for d, g, t in zip(*(table[c].to_pylist() for c in ("doc_id", "known", "tokens")))}.items())
        docs = [d for (d, _), _ in rows]
        tops = linked([np.frombuffer(t, np.int64) for _, t in rows], [g for (_, g), _ in rows], share)
        pairs = [(d, docs[t]) for d, t in zip(docs, tops) if docs[t] != d]
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    found = near.mapInArrow(sets, "block long, part long, known long, doc_id long, tokens binary")
    return found.groupBy("block", "part").applyInArrow(walk, "a long, b long")


def _screened(members: DataFrame, sketches: DataFrame, share: int) -> DataFrame:
    """The members of uncut blocks that may be similar to another member of their block, and all members of blocks that are cut."""

    def screen(table: pa.Table) -> pa.Table:
        return table.filter(pa.array(may_link(table["size"].to_numpy(), table["sketch"].to_pylist(), share))).drop_columns(["sketch"])

    def places(table: pa.Table) -> pa.Table:
        return table.filter(pa.array(may_share(table["size"].to_numpy(), table["place"].to_numpy(), share)))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema)
    near = members.where("parts = 1").groupBy("block").applyInArrow(places, kinds)
    whole = near.join(sketches, "doc_id").select(*members.columns, "sketch")
    return whole.groupBy("block").applyInArrow(screen, kinds).unionByName(members.where("parts > 1"))


def _residue(texts: DataFrame, members: DataFrame, found: DataFrame, n: int, share: int, tokens: int) -> DataFrame:
    """Edges between parts of blocks that were too large for one task.

    Pairs within the component that most of a block belongs to need no test; the others meet every part of their block.
    """
    known = members.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("known", F.coalesce("component", "doc_id")).drop("component")
    counts = known.groupBy("block", "known").count().groupBy("block").agg(F.max_by("known", F.struct("count", "known")).alias("_main"))
    known = known.join(counts, "block")
    other = known.where("known <> _main")
    cuts = other.groupBy("block").agg(F.ceil(F.sum("size") / tokens).alias("_cuts"))
    base = known.join(cuts, "block")
    everyone = base.select("doc_id", "block", "known", F.explode(F.expr("transform(sequence(0L, _cuts - 1), i -> part * _cuts + i)")).alias("part"))
    chosen = base.where("known <> _main").withColumn("_cut", F.pmod(F.xxhash64("doc_id"), F.col("_cuts")))
    chosen = chosen.select("doc_id", "block", "known", F.explode(F.expr("transform(sequence(0L, parts - 1), i -> i * _cuts + _cut)")).alias("part"))
    return _stars(texts, everyone.unionByName(chosen).distinct(), n, share)


def link(documents: DataFrame, n: int = 5, share: int = 75, frequent: int = 100_000, block_tokens: int = 2_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id: documents whose sets overlap by at least `share` percent of their union are linked.

    component_id is the smallest doc_id reachable by links. Texts are read whole; NULL or wordless texts have the empty set and no
    links. Rows of one id are one document and must be equal, each gives a row; a row with a NULL id has no links and a NULL component.
    Equal sets are one class, and only its smallest document is joined. A block above `block_tokens` is cut into parts that are
    joined with each other in a second pass, so no link is lost and no task grows with a group.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    shared = spark.sparkContext.broadcast(Frequent(frequent_tokens(texts, n, 8, frequent)))
    release(spark)
    rows = written(texts.mapInArrow(_prefixes(n, share, shared), "doc_id long, size long, one long, two long, prefix array<long>, sketch binary"))
    sets = rows.where("doc_id is not null and size > 0")
    classes = written(sets.groupBy("size", "one", "two").agg(F.min("doc_id").alias("first")))
    firsts = classes.select(F.col("first").alias("doc_id"), "size").distinct()
    tokens = sets.select("doc_id", F.posexplode("prefix").alias("place", "token"))
    groups = tokens.groupBy("token").agg(F.min("doc_id").alias("block"), F.max("doc_id").alias("_last"))
    leaders = written(groups.where("block < _last").drop("_last"))
    release(spark)
    places = tokens.join(leaders, "token").groupBy("block", "doc_id").agg(F.min("place").alias("place"))
    # A document has the prefix tokens of its copies, so the smallest of a block is never a copy of a smaller one.
    blocks = written(places.join(firsts, "doc_id"))
    discard(leaders)
    release(spark)
    cut = blocks.groupBy("block").agg(F.greatest(F.lit(1), F.ceil(F.sum("size") / block_tokens)).cast("long").alias("parts"))
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("doc_id"), F.col("parts"))).otherwise(F.lit(0).cast("long"))
    sketches = sets.select("doc_id", "sketch").dropDuplicates(["doc_id"])
    members = written(_screened(blocks.join(cut, "block").withColumn("part", part), sketches, share))
    discard(blocks)
    release(spark)
    edges = written(_stars(texts, members.select("doc_id", "block", "part", F.col("doc_id").alias("known")), n, share))
    release(spark)
    found = kept(components(edges))
    large = members.where("parts > 1")
    if not large.isEmpty():
        more = written(_residue(texts, large, found, n, share, block_tokens))
        found = kept(components(edges.unionByName(more)))
    release(spark)
    known = classes.join(found.withColumnRenamed("node", "first"), "first", "left").select("size", "one", "two", F.coalesce("component", "first").alias("component"))
    joined = rows.select("doc_id", "size", "one", "two").join(known, ["size", "one", "two"], "left")
    return joined.select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )
