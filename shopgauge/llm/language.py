"""Language of whole texts by hierarchical discrimination: the family first, then one-versus-one linear SVMs inside it."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopgauge.llm import hashing
from shopgauge.llm.common import append

UNKNOWN = "und"
#: Families of common languages; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en is lb nl no nb nn sv".split(),
    "romance": "ca es fr gl it la oc pt ro".split(),
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk".split(),
    "uralic": "et fi hu".split(),
    "indic": "bn gu hi mr ne pa ur".split(),
    "semitic": "ar he mt".split(),
    "turkic": "az kk ky tr uz".split(),
}
_LUT: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Small form of every code point that is a letter, else 0."""
    if not _LUT:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if chr(c).isalpha():
                small = chr(c).lower()
                table[c] = ord(small) if len(small) == 1 else c
        _LUT.append(table)
    return _LUT[0]


def trigrams(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed letter trigrams of texts, the offsets of each text in them, and whether each text has a letter.

    Everything that is no letter counts as one blank, so digits, signs and markup between words say nothing.
    """
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(place, offsets)
    sign = _letters()[points]
    keep = sign > 0
    letters = np.concatenate([[0], np.cumsum(keep)])[first]
    keep[1:] |= sign[:-1] > 0
    at = np.concatenate([[0], np.cumsum(keep)])[first]
    sign = sign[keep].astype(np.uint64)
    start, text = hashing.starts(at, 3)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), np.diff(letters) > 0
    code = (sign[start] << np.uint64(42)) ^ (sign[start + 1] << np.uint64(21)) ^ sign[start + 2]
    feature = (hashing.mix(code) >> np.uint64(64 - bits)).astype(np.int64)
    return feature, np.searchsorted(text, np.arange(len(offsets))), np.diff(letters) > 0


def linear_svm(rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, size: int, cost: float = 10.0, rounds: int = 15) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss by dual coordinate descent; rows are sparse (index, value)."""
    weight = np.zeros(size)
    dual = np.zeros(len(rows))
    norm = np.array([v @ v for _, v in rows]) + 0.5 / cost
    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            index, value = rows[i]
            step = (sign[i] * (weight[index] @ value) - 1 + dual[i] * 0.5 / cost) / norm[i]
            new = max(0.0, dual[i] - step)
            if new != dual[i]:
                weight[index] += (new - dual[i]) * sign[i] * value
                dual[i] = new
    return weight


@dataclass
class Model:
    """Weights by hashed trigram, one column per classifier, and which families or languages each tells apart."""

    bits: int
    weights: np.ndarray
    families: list[list[str]]
    family_columns: list[int]
    pairs: dict[tuple[str, str], int]

    def predict(self, margins: np.ndarray) -> tuple[str, float]:
        """Language and confidence (0 to 1) from the margins of all classifiers."""
        if not self.families:
            return UNKNOWN, 0.0
        trust = 1 / (1 + np.exp(-4 * margins))
        best = max(range(len(self.families)), key=lambda k: margins[self.family_columns[k]] if self.family_columns else 0)
        score = trust[self.family_columns[best]] if self.family_columns else 1.0
        members = self.families[best]
        won = dict.fromkeys(members, 0.0)
        for one, two in itertools.combinations(members, 2):
            k = self.pairs[one, two]
            # A vote counts 1; the margin only breaks ties of votes.
            won[one] += (margins[k] > 0) + 1e-3 * (trust[k] - 0.5)
            won[two] += (margins[k] <= 0) + 1e-3 * (0.5 - trust[k])
        language = max(members, key=won.__getitem__)
        for one, two in itertools.combinations(members, 2):
            if language in (one, two):
                score = min(score, trust[self.pairs[one, two]] if language == one else 1 - trust[self.pairs[one, two]])
        return language, float(score)


def learn(documents: DataFrame, per_language: int = 400, bits: int = 15, families: dict[str, list[str]] | None = None) -> Model:
    """Fit on at most `per_language` different texts of each language, those with the smallest hash; whole texts.

    Copies of a text teach once. Rows without language or letters teach nothing. Without any row the model answers `und`; with one
    language, that language.
    """
    known = documents.select("lang", "text", F.xxhash64("text").alias("_hash")).where("lang is not null and text is not null")
    order = W.partitionBy("lang").orderBy("_hash")
    different = known.groupBy("lang", "_hash").agg(F.count("*").alias("_copies"))
    # At most per_language narrow rows of each language, so the broadcast has a bound.
    chosen = different.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language).select("lang", "_hash")
    copies = known.join(F.broadcast(chosen), ["lang", "_hash"], "left_semi")
    sample = copies.groupBy("lang", "_hash").agg(F.min("text").alias("text")).select("lang", "text")

    def features(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            out = []
            for row, data, offsets in hashing.blocks(batch.column(1)):
                found, at, has = trigrams(data, offsets, bits)
                for k in np.flatnonzero(has & (np.diff(at) > 0)):
                    index, n = np.unique(found[at[k] : at[k + 1]], return_counts=True)
                    out.append((langs[row + k], index.astype(np.int32), n.astype(np.float32) * (10 / n.sum())))
            names = ["lang", "index", "value"]
            kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.float32())]
            columns = zip(*out) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    taught = sample.mapInArrow(features, "lang string, index array<int>, value array<float>").collect()
    taught = sorted(((r["lang"], np.array(r["index"]), np.array(r["value"], float)) for r in taught), key=lambda r: (r[0], r[1].tolist()))
    of = {lang: name for name, members in (FAMILIES if families is None else families).items() for lang in members}
    languages = sorted({r[0] for r in taught})
    groups: dict[str, list[str]] = {}
    for lang in languages:
        groups.setdefault(of.get(lang, lang), []).append(lang)
    columns: list[np.ndarray] = []

    def fit(rows, positive):
        sign = np.array([1.0 if r[0] in positive else -1.0 for r in rows])
        columns.append(linear_svm([r[1:] for r in rows], sign, 1 << bits))
        return len(columns) - 1

    lists = list(groups.values())
    family_columns = [fit(taught, set(members)) for members in lists] if len(lists) > 1 else []
    pairs = {}
    for members in lists:
        for one, two in itertools.combinations(members, 2):
            pairs[one, two] = fit([r for r in taught if r[0] in (one, two)], {one})
    weights = np.stack(columns, 1).astype(np.float32) * 10 if columns else np.zeros((1 << bits, 0), np.float32)
    return Model(bits, weights, lists, family_columns, pairs)


def identify(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns and lang_pred, score. A NULL text, or one without a letter, is `und` with score 0.

    Very short texts without a whole trigram are judged by margins of 0. Columns named lang_pred or score are replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def compute(column: pa.Array) -> list[pa.Array]:
        m = shared.value
        langs, scores = [], []
        for _, data, offsets in hashing.blocks(column, 1 << 19):
            found, at, has = trigrams(data, offsets, m.bits)
            total = np.zeros((len(at), m.weights.shape[1]))
            if len(found):
                used = np.diff(at) > 0
                total[:-1][used] = np.add.reduceat(m.weights[found], at[:-1][used], axis=0, dtype=np.float64)
            margins = total[:-1] / np.maximum(1, np.diff(at))[:, None]
            for k, ok in enumerate(has.tolist()):
                lang, score = m.predict(margins[k]) if ok else (UNKNOWN, 0.0)
                langs.append(lang)
                scores.append(score)
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return append(documents, text, "lang_pred string, score double", compute)
