"""Token ids of whole texts with a byte-level BPE vocabulary file, fast enough for a whole corpus.

Byte-level BPE first cuts a text into words by the pattern of the vocabulary and then encodes every word on its own. The cuts are
found here for many texts at once with NumPy; only words not seen before go through the tokenizer.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shopgauge.llm import hashing
from shopgauge.llm.common import give_back
from shopgauge.llm.words import byte_vocabulary, piece_vocabulary, slices

_SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_CLASS: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Class of every code point: white space, letter, number, other."""
    if not _CLASS:
        kinds = {"L": _LETTER, "N": _NUMBER}
        found = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        found[_SPACES] = _SPACE
        _CLASS.append(found)
    return _CLASS[0]


def word_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where words of the byte-level pattern begin: contractions, then letters, numbers or other signs with at most one
    leading blank, then white space, of which the last character stays with (or before) the next word."""
    if not len(data):
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    place = np.flatnonzero((data & 0xC0) != 0x80)
    kind = _classes()[points]
    first = np.zeros(len(points) + 1, bool)
    first[np.searchsorted(place, offsets)] = True
    n = len(points)
    change = first[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    after_blank = np.zeros(n, bool)
    after_blank[1:] = (points[:-1] == 32) & ~first[1:n]
    begin = change & (space | ~after_blank)
    begin[:-1] |= space[:-1] & ~space[1:] & ~first[1:n]
    for i in np.flatnonzero(begin[:-1] & (points[:-1] == 39) & ~first[1:n]).tolist():
        one, two = points[i + 1], points[i + 2] if i + 2 < n and not first[i + 2] else 0
        size = 1 if chr(one) in "stmd" else 2 if (chr(one), chr(two)) in {("r", "e"), ("v", "e"), ("l", "l")} else 0
        if size:
            begin[i + 1] = False
            if size == 2:
                begin[i + 2] = False
            if i + 1 + size < n:
                begin[i + 1 + size] = True
    return place[begin]


@functools.lru_cache(maxsize=2)
def _special(path: str) -> list[bytes]:
    """Strings of the special tokens of a vocabulary file."""
    with open(path, encoding="utf-8") as file:
        return [t["content"].encode() for t in json.load(file)["added_tokens"]]


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The file's own tokenizer, for texts that hold the string of a special token; it takes 30 MB."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of texts; strings of special tokens in a text become those tokens. Words are remembered per process, up to a bound in bytes."""

    def __init__(self, path: str):
        give_back()
        self.path, self.table, self.special = path, byte_vocabulary(path), _special(path)
        give_back()

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """For each text in order, its ids as 32-bit numbers; NULL has none."""
        for _, data, offsets in hashing.blocks(column, 1 << 18):
            text = data.tobytes()
            cuts = word_cuts(data, offsets)
            ids, counts = self.table.tokens(self.table.places(slices(text, cuts)))
            border = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(cuts, offsets)]
            special = any(s in text for s in self.special)
            for k in range(len(offsets) - 1):
                whole = text[offsets[k] : offsets[k + 1]] if special else b""
                if special and any(s in whole for s in self.special):
                    yield np.array(_tokenizer(self.path).encode(whole.decode(), add_special_tokens=False).ids, np.int32)
                else:
                    yield ids[border[k] : border[k + 1]]


@functools.lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_counts(column: pa.Array, path: str) -> np.ndarray:
    """Number of ids of every text under a piece vocabulary file; 0 for NULL.

    Words are counted with the blanks before them. A text with a word that its ids don't spell goes through the file's own processor.
    """
    table, out = piece_vocabulary(path), np.zeros(len(column), np.int64)
    for row, data, offsets in hashing.blocks(column, 1 << 20):
        some = np.diff(offsets) > 0
        blanked = np.insert(data, offsets[:-1][some], 32)
        begins = offsets + np.concatenate([[0], np.cumsum(some)])
        blank = blanked == 32
        first = np.zeros(len(blanked), bool)
        first[1:] = blank[1:] & ~blank[:-1]
        first[begins[:-1][some]] = True
        cuts = np.flatnonzero(first)
        at = table.places(slices(blanked.tobytes(), cuts))
        counts, spelt = table.count[at], table.spelt[at]
        texts = len(offsets) - 1
        of = np.searchsorted(begins, cuts, "right") - 1
        out[row : row + texts] = np.bincount(of, counts, texts)[:texts]
        for k in np.unique(of[~spelt]).tolist():
            out[row + k] = len(_pieces(path).encode(data[offsets[k] : offsets[k + 1]].tobytes().decode()))
    return out
