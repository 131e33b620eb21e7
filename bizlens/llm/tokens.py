"""Token ids of whole texts by a tokenizers file; each distinct piece of text is encoded once per worker."""

from __future__ import annotations

import gc
import re
from contextlib import contextmanager
from itertools import islice

import numpy as np

MAX_PIECES = 300_000
#: The same for tokenizers whose pieces the library splits again: learning one costs more there.
MAX_SPLIT_PIECES = 1_000_000
#: The pieces into which the two public tokenizers split a text before merging, for plain Latin text.
BYTE_LEVEL = r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\s\w]|_)+"
#: Beyond these characters, and where a special token might be spelled, the library encodes the whole text itself.
ODD = re.compile(r"[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿŒœ]|<\|")

#: White space that the two libraries may see differently; pieces of the word pattern don't show it.
ODD_SPACE = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u3000\ufeff]")

_encoders: dict[tuple, Encoder] = {}


def byte_letters() -> dict[int, int]:
    """The characters by which byte-level tokenizers spell bytes: visible ones stand for themselves, the others follow from 256."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(visible)]
    return {b: b for b in visible} | {b: 256 + k for k, b in enumerate(others)}


class Numbers(dict):
    """Numbers for pieces, in the order in which they are first asked for."""

    def __missing__(self, piece):
        number = self[piece] = len(self)
        return number


@contextmanager
def uncollected():
    """Without Python's collector of cycles: many small objects and no cycles are made here, and it would walk all known pieces each time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Encoder:
    """Ids of texts, equal to the library's own, from remembered ids of their pieces.

    Merges never cross pieces, so a text's ids are those of its pieces one after the other. Beyond ``MAX_PIECES`` pieces (``MAX_SPLIT_PIECES``)
    the later half is forgotten: frequent pieces are met early. What was forgotten is learned again when it is met.
    """

    def __init__(self, path: str, pattern: str, lower: bool) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.find, self.lower = re.compile(pattern).findall, lower
        plain = self.tokenizer.normalizer is None and type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel"
        self.letters = byte_letters() if plain else None
        self.forget()

    def forget(self) -> None:
        self.known = Numbers()
        self.odd, self.size = np.zeros(1024, bool), np.zeros(1024, np.int32)
        self.begin, self.flat, self.used = np.zeros(1024, np.int64), np.zeros(4096, np.uint32), 0

    def shrink(self, most: int) -> None:
        """Forget all pieces but the first ``most``, and give back the memory of the others."""
        self.known = Numbers(islice(self.known.items(), most))
        self.used = int(self.begin[most - 1]) + int(self.size[most - 1])
        self.odd, self.size, self.begin, self.flat = self.odd[:most].copy(), self.size[:most].copy(), self.begin[:most].copy(), self.flat[: self.used].copy()

    def learn(self, new: list[str], first: int) -> None:
        """Encode pieces whose numbers begin at ``first``."""
        if self.letters:  # a piece needs no more splitting: its merges alone give its ids
            merge, letters = self.tokenizer.model.tokenize, self.letters
            ids = [[t.id for t in merge(x.encode().decode("latin-1").translate(letters))] for x in new]
        else:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        last, total = first + len(new), int(sizes.sum())
        if last > len(self.size):
            more = max(last, 2 * len(self.size))
            self.odd, self.size, self.begin = (np.resize(x, more) for x in (self.odd, self.size, self.begin))
        if self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, max(self.used + total, 2 * len(self.flat)))
        self.odd[first:last] = [ODD.search(x) is not None for x in new]
        self.size[first:last] = sizes
        self.begin[first:last] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : self.used + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
        self.used += total

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        with uncollected():
            return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        most = MAX_PIECES if self.letters else MAX_SPLIT_PIECES
        if len(self.known) > most:
            self.shrink(most // 2)
        known, numbers, bounds, first = self.known, [], [0], len(self.known)
        for text in texts:
            pieces = self.find(text.lower() if self.lower else text)
            numbers.append(np.fromiter(map(known.__getitem__, pieces), np.int32, len(pieces)))
            bounds.append(bounds[-1] + len(pieces))
        if len(known) > first:
            self.learn(list(islice(known, first, None)), first)
        number = np.concatenate(numbers) if numbers else np.zeros(0, np.int32)
        sizes = self.size[number]
        ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        flat = self.flat[np.repeat(self.begin[number] - ends[:-1], sizes) + np.arange(ends[-1])]
        odd = np.concatenate(([0], np.cumsum(self.odd[number], dtype=np.int32)))
        out = [flat[ends[a] : ends[b]] for a, b in zip(bounds, bounds[1:], strict=False)]
        # Characters may split pieces elsewhere than here or change under lower-casing.
        again = [i for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if odd[b] > odd[a] or ODD_SPACE.search(texts[i])]
        if again:
            for i, e in zip(again, self.tokenizer.encode_batch([texts[i] for i in again], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, np.uint32)
        return out


def encoder(path: str, pattern: str, lower: bool = False) -> Encoder:
    """The encoder of this worker, kept from task to task."""
    key = (path, pattern, lower)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
