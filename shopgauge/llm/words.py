"""Token ids of words that come again and again: each different word goes through a tokenizer once, texts are put together by NumPy."""

from __future__ import annotations

import functools
import itertools
import json
import os
from collections.abc import Callable

import numpy as np


class _Index(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


class WordTable:
    """Ids of words by the words' own bytes, in one flat array. `bound` limits the bytes of the words that are remembered; beyond it the
    table starts anew, so a process that lives long holds no more than that and one block's words."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], sizes: np.ndarray | None = None, text: Callable[[int], bytes] | None = None, bound: int = 2 << 20):
        """`encode` gives all ids of the words and how many each word has. With `sizes` (bytes of each id) and `text` (bytes of an id),
        words whose ids don't spell them are marked as such."""
        self.encode, self.sizes, self.text, self.bound = encode, sizes, text, bound
        self._clear()

    def _clear(self) -> None:
        self.index = _Index()
        self.ids = np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.spelt = np.zeros(0, bool)
        self.held = 0

    def _learn(self, words: list[bytes]) -> None:
        flat, counts = self.encode(words)
        ends = np.cumsum(counts)
        self.first = np.concatenate([self.first, ends - counts + len(self.ids)])
        self.ids, self.count = np.concatenate([self.ids, flat.astype(np.int32)]), np.concatenate([self.count, counts])
        if self.text:
            # All at once, since as good as always all are spelt; the sizes make sure that no word borrows from its neighbour.
            sizes = np.concatenate([[0], np.cumsum(self.sizes[flat])])[ends]
            if np.array_equal(sizes, np.cumsum([*map(len, words)])) and b"".join(map(self.text, flat.tolist())) == b"".join(words):
                spelt = np.ones(len(words), bool)
            else:
                of = np.split(flat, ends[:-1])
                spelt = np.fromiter((b"".join(map(self.text, ids.tolist())) == w for w, ids in zip(words, of)), bool, len(words))
            self.spelt = np.concatenate([self.spelt, spelt])
        self.held += sum(map(len, words))

    def places(self, words: list[bytes]) -> np.ndarray:
        """Index of every word. Valid until the next call."""
        if self.held > self.bound:
            self._clear()
        known = len(self.index)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if len(self.index) > known:
            self._learn(list(itertools.islice(reversed(self.index), len(self.index) - known))[::-1])
        return at

    def tokens(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words one after another, number of ids of each word)."""
        counts = self.count[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.first[at] - (ends - counts), counts) + np.arange(total)], counts


def slices(data: bytes, cuts: np.ndarray) -> list[bytes]:
    """The bytes from each cut to the next."""
    at = [*cuts.tolist(), len(data)]
    return [data[a:b] for a, b in zip(at, at[1:])]


def byte_level() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def flattened(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after another, and how many each list has."""
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(itertools.chain.from_iterable(found), np.int64, int(counts.sum())), counts


#: Words up to this many bytes are encoded in one go; the time that takes grows with the square of a word.
SHORT = 200


@functools.lru_cache(maxsize=2)
def byte_vocabulary(path: str) -> WordTable:
    """Words of a byte-level BPE vocabulary file (JSON); strings of special tokens are plain text. One table per process.

    In vocabularies whose merges stand in the order of their ids, short words are merged by those ranks, many in one call; longer ones,
    and those of other vocabularies, go through the file's own tokenizer. Both give the same ids.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    byte = byte_level()
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    spelling = [b""] * tokenizer.get_vocab_size()
    for entry, i in vocabulary.items():
        spelling[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
    sizes = np.fromiter(map(len, spelling), np.int64, len(spelling))
    merges = [m.split(" ") if isinstance(m, str) else m for m in json.loads(tokenizer.to_str())["model"]["merges"]]
    merged = [vocabulary["".join(m)] for m in merges]
    quick = None
    if merged == sorted(set(merged)):
        ranks = {spelling[i]: i for i in [*merged, *(vocabulary[c] for c in byte if c in vocabulary)]}
        if len(ranks) == len(merged) + 256:
            quick = tiktoken.Encoding("words", pat_str="[^\0]+", mergeable_ranks=ranks, special_tokens={})

    def slowly(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return flattened([e.ids for e in tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)])

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        short = np.fromiter((len(w) <= SHORT and 0 not in w for w in words), bool, len(words))
        if quick is None or not short.any():
            return slowly(words)
        some = list(itertools.compress(words, short))
        ids = quick.encode_to_numpy(b"\0".join(some).decode()).astype(np.int64)
        borders = np.searchsorted(np.cumsum(sizes[ids]), np.cumsum([*map(len, some)])) + 1
        counts = np.diff(borders, prepend=0)
        if short.all():
            return ids, counts
        # The others are put between them.
        rest, rest_counts = slowly(list(itertools.compress(words, ~short)))
        both = np.zeros(len(words), np.int64)
        both[short], both[~short] = counts, rest_counts
        out = np.empty(int(both.sum()), np.int64)
        own = np.repeat(short, both)
        out[own], out[~own] = ids, rest
        return out, both

    return WordTable(encode, sizes, spelling.__getitem__)


@functools.lru_cache(maxsize=2)
def piece_vocabulary(path: str) -> WordTable:
    """Words, each with the blanks before it, of a piece vocabulary file that puts a blank before a text. One table per process.

    The words are encoded one by one, which is exact because no piece has a blank after another character.
    """
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    if any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError(f"{path}: pieces go over word borders")
    spelling = [bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    sizes = np.fromiter(map(len, spelling), np.int64, len(spelling))
    blank = processor.piece_to_id("▁")

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # The processor puts back the blank that is cut off here, but gives nothing at all for an empty text.
        return flattened([ids or [blank] for ids in processor.encode([w[1:].decode() for w in words], num_threads=1)])

    return WordTable(encode, sizes, spelling.__getitem__)
