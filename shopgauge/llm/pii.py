"""Personal data in texts by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Spans that the base rules find always stay. Around them a wider net takes further candidates: addresses written with "at" and "dot",
broken up IP addresses and those of version 6, cards and phones in runs of digits that the base rules give up on, phones without a
plus sign. Labelers (regular expressions, gazetteers, checks, context) vote yes, no or nothing on every candidate and every base span.
No candidate has a label; how reliable each labeler is comes from how the votes go together over all candidates. The spans' estimated
labels train a classifier over shape, context and votes, and what it takes is added.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgauge.llm.common import written

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A number of four parts begins where digits begin, so looking back spares a long number from being tried at each of its digits.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_DIGIT = re.compile("[0-9]")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_AT = re.compile(r" ?[(\[{] ?(?:at|AT) ?[)\]}] ?| (?:at|AT) |@")
_FAR_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.| ?[(\[{] ?(?:dot|DOT|\.) ?[)\]}] ?| (?:dot|DOT) )[A-Za-z0-9-]{1,63}){1,8}")
_FAR_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?[(\[{](?:dot|\.)[)\]}] ?|\.)[0-9]{1,3}(?: ?[(\[{](?:dot|\.)[)\]}] ?|\.)[0-9]{1,3}(?: ?[(\[{](?:dot|\.)[)\]}] ?|\.)[0-9]{1,3}(?![0-9])")
_IP6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_GROUP = re.compile(r"(?<![0-9])[0-9]{14,19}(?![0-9])|(?<![0-9])[0-9]{4}([ ._/-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])|(?<![0-9])3[0-9]{3}([ ._/-])[0-9]{6}\2[0-9]{5}(?![0-9])")
_FAR_PHONE = re.compile(r"(?:\+[0-9]{1,3}[ .-]?|(?<![0-9])00[1-9][0-9]{0,2}[ .-]?|(?<![0-9+(]))(?:\([0-9]{2,5}\)[ .-]?|[0-9]{2,5}[ ./-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])")

# Gazetteers. End domains, calling codes, first digits of issuers, words around personal data in four languages.
_ENDS = frozenset("com org net edu gov mil int info biz io co eu us uk de fr es it nl be at ch pt pl se no dk fi ie ca au nz jp cn in br mx ar cl ru".split())
_CALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 351 352 353 358 420 421".split())
_CUES = {
    "email": "mail email e-mail contact write kontakt schreiben correo contacto courriel contacter",
    "ip": "ip host server address adresse direccion dirección node login",
    "card": "card credit visa mastercard amex karte kreditkarte carte tarjeta",
    "phone": "phone tel telephone telefon téléphone teléfono telefono call fax mobile mobil handy ruf portable móvil",
}
_CUES = {kind: frozenset(words.split()) for kind, words in _CUES.items()}
_COUNTER = frozenset("version v order isbn invoice rechnung factura facture token sha hash key serial nr no id build chapter date datum fecha".split())

LABELERS = ("rule", "shape", "gazetteer", "check", "cue", "border")
FEATURES = 4096


def _ends(part: str, most: int) -> bool:
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= most


def luhn(digits: str) -> bool:
    """Whether the check digit of a number is right."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base rules' spans, by kind: the leftmost matches that don't overlap, without those that fail a check."""
    found = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            found.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    if not _DIGIT.search(text):
        return found
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(_ends(p, 255) for p in m[0].split("."))]
    found += [(2, *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() <= 40 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    found += [(3, *m.span()) for m in _PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return found


def further_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the wider net's candidates that touch no base span; of one kind none overlaps another."""
    found = []
    for at in _AT.finditer(text):
        start = at.start()
        while start > 0 and at.start() - start < 64 and text[start - 1] in _LOCAL:
            start -= 1
        if start < at.start() and (domain := _FAR_DOMAIN.match(text, at.end())):
            found.append((0, start, domain.end()))
    if _DIGIT.search(text):
        found += [(1, *m.span()) for m in _FAR_IP.finditer(text)]
        found += [(2, *m.span()) for m in _GROUP.finditer(text)]
        found += [(3, *m.span()) for m in _FAR_PHONE.finditer(text)]
    if ":" in text:
        found += [(1, *m.span()) for m in _IP6.finditer(text)]
    taken, at = [], 0
    rows = sorted((start, end) for _, start, end in base)
    reach = np.maximum.accumulate(np.array([e for _, e in rows], np.int64)) if rows else None
    last = dict.fromkeys(range(len(KINDS)), 0)
    for kind, start, end in sorted(found, key=lambda s: s[1:]):
        while at < len(rows) and rows[at][0] < end:
            at += 1
        if (at == 0 or reach[at - 1] <= start) and last[kind] <= start:
            taken.append((kind, start, end))
            last[kind] = end
    return taken


_WORD = re.compile(r"[^\W\d_][\w-]*")


def _sign(yes: bool, no: bool = False) -> int:
    return 1 if yes else -1 if no else 0


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, ...]:
    """What each of LABELERS says: 1 personal data, -1 none, 0 nothing."""
    span, digits = text[start:end], _digits(text[start:end])
    name = KINDS[kind]
    if name == "email":
        plain = re.sub(r" ?[(\[{] ?(?:at|AT) ?[)\]}] ?| (?:at|AT) ", "@", re.sub(r" ?[(\[{] ?(?:dot|DOT|\.) ?[)\]}] ?| (?:dot|DOT) ", ".", span))
        local, _, domain = plain.rpartition("@")
        tail = domain.rpartition(".")[2].lower()
        shape = _sign(tail.isalpha() and 2 <= len(tail) <= 24, True)
        known = _sign(tail in _ENDS)
        check = _sign(0 < len(local) <= 64 and ".." not in local and not local.startswith(".") and "-." not in domain and ".-" not in domain, True)
    elif name == "ip":
        parts = re.split(r"[^0-9]+", span) if ":" not in span else []
        shape = _sign(bool(parts) and not any(p != "0" and p.startswith("0") for p in parts) or not parts, True)
        known = _sign(not parts or 1 <= int(parts[0][-3:]) <= 223 and int(parts[0][-3:]) != 127, True)
        check = _sign(all(_ends(p, 255) for p in parts), True)
    elif name == "card":
        groups = [len(g) for g in re.split(r"[^0-9]", span)]
        shape = _sign(len(groups) == 1 or groups in ([4, 4, 4, 4], [4, 6, 5]), True)
        first = int(digits[:4] or 0)
        known = _sign(len(digits) == 16 and (4000 <= first < 6000 or 2221 <= first <= 2720 or 6000 <= first < 7000) or len(digits) == 15 and first // 100 in (34, 37) or len(digits) == 14 and first // 100 in (30, 36, 38))
        check = _sign(luhn(digits), True)
    else:
        groups = re.findall(r"[0-9]+", span)
        date = [len(g) for g in groups] in ([4, 2, 2], [2, 2, 4], [4, 2, 2, 2])
        shape = _sign((span[0] in "+(" or span.startswith("0")) and len(groups) >= 3, date or len(groups) < 3)
        code = groups[0].lstrip("0") if span[0] == "+" or span.startswith("00") else ""
        known = _sign("(" in span or code in _CALLING, len(set(span) - set("0123456789")) > 3 and "(" not in span)
        check = _sign(10 <= len(digits) <= 15, True)
    before = {w.lower() for w in _WORD.findall(text[max(0, start - 24) : start])}
    cue = _sign(bool(before & _CUES[name]), bool(before & _COUNTER))
    left, right = text[start - 1 : start], text[end : end + 1]
    border = _sign(not (left.isalnum() or left in ("_", "/", "=", "#") and left) and not (right.isalnum() or right == "_"), True)
    return (_sign(base), shape, known, check, cue, border)


def _shape(span: str) -> str:
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[A-Za-z]", "a", re.sub(r"[0-9]", "9", span[:64])))


def features(text: str, kind: int, start: int, end: int, vote: tuple[int, ...]) -> list[int]:
    """Hashed features of a span: how it is written, what stands around it, how the labelers vote."""
    span = text[start:end]
    before, after = _WORD.findall(text[max(0, start - 24) : start])[-2:], _WORD.findall(text[end : end + 24])[:1]
    names = [
        "bias",
        f"shape {_shape(span)}",
        f"digits {min(20, len(_digits(span)))}",
        f"size {min(9, (end - start).bit_length())}",
        f"left {text[start - 1 : start] if not text[start - 1 : start].isalnum() else 'x'}" if start else "left",
        f"right {text[end : end + 1] if not text[end : end + 1].isalnum() else 'x'}",
        *[f"before {w.lower()}" for w in before],
        *[f"after {w.lower()}" for w in after],
        *[f"{labeler} {v}" for labeler, v in zip(LABELERS, vote)],
    ]
    return sorted({zlib.crc32(f"{KINDS[kind]} {n}".encode("utf-8", "surrogatepass")) % FEATURES for n in names})


_SPAN = "kind int, start int, end int, base boolean, votes string, features array<int>"


def candidates(documents: DataFrame) -> DataFrame:
    """doc_id and spans: the base rules' spans and the further candidates of every whole text, with votes and features, by start and kind.

    A NULL text has no spans. Rows of one doc_id are rows like any other, the doc_id may be NULL; further columns are not read.
    Places are counted in code points.
    """
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.list_(pa.int32())]
    item = pa.struct([(d.split()[0], k) for d, k in zip(_SPAN.split(", "), kinds)])

    def spans(text: str | None) -> list[dict]:
        base = base_spans(text) if text else []
        rows = [(*s, True) for s in base] + [(*s, False) for s in further_spans(text, base)] if text else []
        out = []
        for kind, start, end, is_base in sorted(rows, key=lambda s: (s[1], s[0])):
            vote = votes(text, kind, start, end, is_base)
            out.append({"kind": kind, "start": start, "end": end, "base": is_base, "votes": "".join("-0+"[v + 1] for v in vote), "features": features(text, kind, start, end, vote)})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([spans(x.as_py()) for x in batch.column(1)], pa.list_(item))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "spans"])

    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    fields = ", ".join(": ".join(column.split()) for column in _SPAN.split(", "))
    return texts.mapInArrow(run, f"doc_id long, spans array<struct<{fields}>>")


@dataclass
class Model:
    """reliability[kind][labeler][label][vote]: how often a labeler votes no, nothing or yes on spans of a label (0 or 1);
    share[kind]: part of the candidates that are personal data; weights: those of the classifier."""

    reliability: dict[int, np.ndarray] = field(default_factory=dict)
    share: dict[int, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))

    def label(self, kind: int, vote: str) -> float:
        """Probability that a span with these votes is personal data."""
        at = ["-0+".index(v) for v in vote]
        logs = np.log(self.reliability[kind][np.arange(len(at)), :, at]).sum(0) + np.log([1 - self.share[kind], self.share[kind]])
        return float(1 / (1 + np.exp(logs[0] - logs[1])))

    def score(self, features: list[int]) -> float:
        return float(1 / (1 + np.exp(-self.weights[features].sum())))


#: Beliefs about a labeler before any candidate is seen, as shares: it votes no, nothing, yes on a span of label 0, of label 1. That
#: the base rules say yes to nothing of label 0 is fixed, which keeps the two labels from changing places.
_BELIEF = np.tile(np.array([[0.5, 0.4, 0.1], [0.1, 0.4, 0.5]]), (len(LABELERS), 1, 1))
_BELIEF[0] = [[0.001, 0.998, 0.001], [0.001, 0.5, 0.499]]
#: A span of label 1 hardly ever fails the check of its kind (check digit, size of the parts). That belief weighs as much as all spans.
_BELIEF[3, 1] = [0.01, 0.3, 0.69]
_WEIGHT = np.ones((len(LABELERS), 2, 1))
_WEIGHT[3, 1] = 10


def reliabilities(counts: dict[tuple[int, str], int], rounds: int = 100, prior: float = 0.1) -> Model:
    """Expectation-maximisation over the numbers of candidates by (kind, votes). `prior` is the weight of the beliefs, as a share of
    the candidates of a kind."""
    model = Model()
    for kind in sorted({k for k, _ in counts}):
        rows = sorted((vote, n) for (k, vote), n in counts.items() if k == kind)
        at = np.array([["-0+".index(v) for v in vote] for vote, _ in rows])
        n = np.array([c for _, c in rows], float)
        weight = prior * n.sum() + 1
        table, share = _BELIEF.copy(), 0.5
        seen = (at[:, :, None] == np.arange(3)).astype(float)
        before = None
        for _ in range(rounds):
            logs = np.stack([np.einsum("rlv,lv->r", seen, np.log(table[:, y])) for y in (0, 1)]) + np.log([[1 - share], [share]])
            label = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
            if before is not None and np.abs(label - before).max() < 1e-9:
                break
            before = label
            for y, part in enumerate((1 - label, label)):
                table[:, y] = np.einsum("r,rlv->lv", n * part, seen) + weight * _WEIGHT[:, y] * _BELIEF[:, y]
                table[:, y] /= table[:, y].sum(1, keepdims=True)
            table[0, 0] = _BELIEF[0, 0]
            share = float((n @ label + weight / 2) / (n.sum() + weight))
        model.reliability[kind], model.share[kind] = table, share
    return model


def _train(model: Model, rows: list[tuple[list[int], float]], rounds: int = 300, decay: float = 1e-4) -> None:
    """Logistic regression on (features, label between 0 and 1), by gradient steps with a rate for each weight."""
    at = np.concatenate([np.array(f, np.int64) for f, _ in rows])
    row = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    label = np.array([y for _, y in rows])
    weights, squares = np.zeros(FEATURES), np.full(FEATURES, 1e-8)
    for _ in range(rounds):
        score = 1 / (1 + np.exp(-np.bincount(row, weights[at], len(rows))))
        slope = np.bincount(at, (score - label)[row], FEATURES) / len(rows) + decay * weights
        squares += slope * slope
        weights -= 0.5 * slope / np.sqrt(squares)
    model.weights = weights


def learn(found: DataFrame, sample: int = 8192, per_votes: int = 256) -> Model:
    """The model of `candidates`' result (a written table). The reliabilities come from all candidates; the classifier is trained on
    at most `sample` spans, about `per_votes` of each kind and votes, chosen by a hash of their place.

    What comes to the driver is a count for each kind and votes (4 x 3^6 at most) and the sample. Without candidates nothing is added.
    """
    spans = found.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")
    counts = {(r["kind"], r["votes"]): r["n"] for r in spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model()
    model = reliabilities(counts)
    share = spans.sparkSession.createDataFrame([(k, v, per_votes / n) for (k, v), n in counts.items()], "kind int, votes string, _share double")
    order = F.xxhash64("doc_id", "kind", "start")
    chosen = spans.join(F.broadcast(share), ["kind", "votes"]).where(F.pmod(order, F.lit(1 << 20)) < F.col("_share") * (1 << 20))
    rows = chosen.select("kind", "votes", "features", order.alias("_order"), "start").orderBy("_order", "kind", "start").limit(sample).collect()
    if rows:
        _train(model, [(r["features"], model.label(r["kind"], r["votes"])) for r in rows])
    return model


def decide(found: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id and spans (kind, start, end, base, score) of personal data, by start and kind: the base spans, and of the other
    candidates those that the classifier gives `least` or more, the likelier first where two overlap."""

    def chosen(spans: list[dict]) -> list[dict]:
        scored = [{**{c: s[c] for c in ("kind", "start", "end", "base")}, "score": 1.0 if s["base"] else model.score(s["features"])} for s in spans]
        taken, starts = [], []
        for s in sorted((s for s in scored if not s["base"] and s["score"] >= least), key=lambda s: (-s["score"], s["start"], s["kind"])):
            at = bisect.bisect(starts, s["start"])
            if (at == 0 or taken[at - 1]["end"] <= s["start"]) and (at == len(taken) or s["end"] <= starts[at]):
                starts.insert(at, s["start"])
                taken.insert(at, s)
        return sorted([s for s in scored if s["base"]] + taken, key=lambda s: (s["start"], s["kind"]))

    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{**s, "kind": KINDS[s["kind"]]} for s in chosen(x)] for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(item))], names=["doc_id", "spans"])

    return found.select("doc_id", "spans").mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: int, end: int, base: boolean, score: double>>")


def find(documents: DataFrame) -> DataFrame:
    """Personal data of all documents, by a model learned from their own candidates. Documents are read once."""
    found = written(candidates(documents))
    return decide(found, learn(found))
