"""Quality of whole texts by attention-based multiple-instance learning over their passages.

A text is a bag of passages of `PASSAGE` words, all of them. Every passage is encoded, gated attention learned from the labels of
whole documents weighs the passages, and the weighted representation is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopgauge.llm import hashing
from shopgauge.llm.common import append

PASSAGE = 50
_GROUPS = [
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,", ";:", "!?", "'\"`", "()[]{}<>",
    "#$%&*@^~+=", "|/\\_-",
]
_GROUP = np.full(256, len(_GROUPS), np.uint8)  # last group: other bytes, mostly parts of letters beyond ASCII
for _k, _signs in enumerate(_GROUPS):
    _GROUP[[ord(s) for s in _signs]] = _k
_LETTERS = np.isin(_GROUP, [0, 1, len(_GROUPS)])
FEATURES = 2 * (len(_GROUPS) + 1) + 7


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the index of the first passage of each text. A text without words has one, of zeros."""
    start, end, at = hashing.word_spans(data, offsets)
    words = np.diff(at)
    each = np.maximum(1, -(-words // PASSAGE))
    first = np.concatenate([[0], np.cumsum(each)])
    text = np.repeat(np.arange(len(words)), each)
    low = at[text] + (np.arange(len(text)) - first[text]) * PASSAGE
    high = np.minimum(low + PASSAGE, at[text + 1])
    full = high > low
    out = np.zeros((len(text), FEATURES))
    if not full.any():
        return out, first
    low, high = low[full], high[full]
    left, right = start[low], end[high - 1]
    size = (right - left).astype(float)
    count = (high - low).astype(float)
    columns = []

    def between(flags, a, b):
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[b] - total[a]

    group = _GROUP[data]
    last = group[end - 1]
    for k in range(len(_GROUPS) + 1):
        columns.append(between(group == k, left, right) / size)
        columns.append(between(last == k, low, high) / count)
    length = end - start
    hashes = hashing.word_hashes(data, start, end)
    owner = np.repeat(np.arange(len(words)), words).astype(np.uint64)
    _, fresh = np.unique(hashes ^ hashing.mix(owner + np.uint64(1)), return_index=True)
    new = np.zeros(len(start), bool)
    new[fresh] = True
    upper = np.concatenate([[0], np.cumsum(group == 1)])
    letters = np.concatenate([[0], np.cumsum(_LETTERS[data])])
    shouted = (upper[end] - upper[start] == letters[end] - letters[start]) & (upper[end] - upper[start] > 1)
    columns += [
        np.log1p(size / count),
        between(length <= 3, low, high) / count,
        between(length > 12, low, high) / count,
        between(new, low, high) / count,
        between(shouted, low, high) / count,
        between(letters[end] - letters[start] == 0, low, high) / count,
        np.log1p(count),
    ]
    out[full] = np.stack(columns, 1)
    return out, first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, features: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        t, s = np.tanh(h @ w["attend"]), _sigmoid(h @ w["gate"])
        e = (t * s) @ w["weigh"]
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
        a = e / np.add.reduceat(e, first[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
        return {"bag": bag, "x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "p": _sigmoid(z @ w["score"] + w["score_bias"])}


def fit(bags: list[tuple[np.ndarray, int]], hidden: int = 16, attention: int = 8, rounds: int = 300) -> Model:
    """Fit by Adam on all bags (features, label) at once, both labels with the same total weight. One label alone: a constant score."""
    x = np.concatenate([b for b, _ in bags]) if bags else np.zeros((1, FEATURES))
    first = np.concatenate([[0], np.cumsum([len(b) for b, _ in bags])]).astype(np.int64)
    y = np.array([label for _, label in bags], float)
    rng = np.random.Generator(np.random.PCG64(11))
    w = {
        "encode": rng.normal(0, FEATURES**-0.5, (FEATURES, hidden)), "encode_bias": np.zeros(hidden),
        "attend": rng.normal(0, hidden**-0.5, (hidden, attention)), "gate": rng.normal(0, hidden**-0.5, (hidden, attention)),
        "weigh": rng.normal(0, attention**-0.5, attention), "score": np.zeros(hidden), "score_bias": np.zeros(1),
    }
    model = Model(x.mean(0), x.std(0) + 1e-2, w)
    if len(set(y)) < 2:
        w["score_bias"][0] = 0.0 if not len(y) else 5.0 if y[0] else -5.0
        return model
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    one, two = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, rounds + 1):
        f = model.forward(x, first)
        dp = (f["p"] - y) * share
        dz = (dp[:, None] * w["score"])[f["bag"]]
        da = (f["h"] * dz).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, first[:-1])[f["bag"]])
        dts = de[:, None] * w["weigh"]
        dt, ds = dts * f["s"] * (1 - f["t"] ** 2), dts * f["t"] * f["s"] * (1 - f["s"])
        dh = (f["a"][:, None] * dz + dt @ w["attend"].T + ds @ w["gate"].T) * (1 - f["h"] ** 2)
        slope = {
            "encode": f["x"].T @ dh, "encode_bias": dh.sum(0), "attend": f["h"].T @ dt, "gate": f["h"].T @ ds,
            "weigh": (f["t"] * f["s"]).T @ de, "score": f["z"].T @ dp, "score_bias": dp.sum(keepdims=True),
        }
        for k, v in w.items():
            g = slope[k] + 1e-4 * v
            one[k] += 0.1 * (g - one[k])
            two[k] += 0.01 * (g * g - two[k])
            v -= 0.02 * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.99**step)) + 1e-8)
    return model


def sampled(labels: DataFrame, per_label: int, slots: int = 64) -> DataFrame:
    """doc_id, quality: the `per_label` rows of each quality with the smallest hash of their id.

    First cut in each of `slots` parts of a quality, so that no task sorts all rows of one and the last cut has a bound.
    """
    order = [F.xxhash64("doc_id"), "doc_id"]
    known = labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    slotted = known.withColumn("_slot", F.pmod(F.hash("doc_id"), F.lit(slots)))
    for keys in (["quality", "_slot"], ["quality"]):
        slotted = slotted.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= per_label)
    return slotted.select("doc_id", "quality")


def learn(documents: DataFrame, labels: DataFrame, per_label: int = 1200) -> Model:
    """Fit on at most `per_label` documents of each value of labels.quality, those with the smallest hash of their id; whole texts.

    Labels or ids that are NULL teach nothing; a NULL text is an empty one.
    """
    sample = sampled(labels, per_label)
    # At most two times per_label narrow rows, so the broadcast has a bound.
    taught = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")

    def features(batches):
        for batch in batches:
            out = []
            ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, data, offsets in hashing.blocks(batch.column(2)):
                found, first = passages(data, offsets)
                out += [(ids[row + k], labels[row + k], found[first[k] : first[k + 1]].astype(np.float32).tobytes()) for k in range(len(first) - 1)]
            kinds = [("doc_id", pa.int64()), ("quality", pa.int32()), ("bag", pa.binary())]
            columns = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], names=[n for n, _ in kinds])

    typed = taught.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), F.col("text").cast("string"))
    rows = sorted(typed.mapInArrow(features, "doc_id long, quality int, bag binary").collect(), key=lambda r: (r["doc_id"], r["bag"]))
    return fit([(np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES).astype(float), r["quality"]) for r in rows])


def score(documents: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """All columns and score (0 to 1), predicted (1 from the threshold on). NULL and empty texts have the score of an empty bag.

    Columns named score or predicted are replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def compute(column: pa.Array) -> list[pa.Array]:
        parts = [np.zeros(0)]
        for _, data, offsets in hashing.blocks(column):
            parts.append(shared.value.forward(*passages(data, offsets))["p"])
        found = np.concatenate(parts)
        return [pa.array(found), pa.array((found >= threshold).astype(np.int32))]

    return append(documents, text, "score double, predicted int", compute)
