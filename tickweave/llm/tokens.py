"""Token numbers of texts by a public byte-level vocabulary."""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import tiktoken

# Fixed value of the vocabulary: how a text is cut before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEPT_WORDS = 700_000  # words whose numbers a worker remembers
STOPS = ".,;:!?|"  # marks that are cut off a word of letters alone


def _byte_letters() -> dict[str, int]:
    """The letter by which a vocabulary file writes each byte: printable bytes stand for
    themselves, the others take the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _OddSpace(Exception):
    """White space beside a blank, which may be one piece with it."""


class _Words(dict):
    """Numbers of words by their text without the leading blank, as bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.stops = {mark: encode(mark) for mark in STOPS}

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _OddSpace
        if word[-1] in self.stops and word[:-1].isalpha():
            found = self[word[:-1]] + self.stops[word[-1]]
        else:
            found = self.encode(" " + word)
        if len(self) < KEPT_WORDS:
            self[word] = found
        return found


class Encoder:
    """The numbers that the library ``tokenizers`` gives for the vocabulary file at
    ``path``, with no special token added; where a text holds the string of an added
    token, that is one number, and what stands on either side is cut by itself.

    No piece of the cut crosses a blank between two characters that are no white space,
    so words are looked up one by one; texts with other runs of white space are
    encoded whole.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self._added = {t["content"]: t["id"] for t in model["added_tokens"]}
        if any(t[k] for t in model["added_tokens"] for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("added tokens that take in what stands beside them")
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in w): i for w, i in model["model"]["vocab"].items() if w not in self._added}
        self.size = 1 + max([*ranks.values(), *self._added.values()])
        self._code = "H" if self.size <= 1 << 16 else "I"
        self.kind = np.dtype(self._code)
        self._coding = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._words = _Words(self._whole)
        longest = sorted(self._added, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def _whole(self, text: str) -> bytes:
        return array(self._code, self._coding.encode_ordinary(text)).tobytes()

    def __call__(self, text: str) -> bytes:
        """The numbers of ``text``, as bytes of the type ``kind``."""
        if not any(token in text for token in self._added):
            return self._ordinary(text)
        parts = self._cut.split(text)
        parts[1::2] = (array(self._code, [self._added[token]]).tobytes() for token in parts[1::2])
        parts[::2] = map(self._ordinary, parts[::2])
        return b"".join(parts)

    def _ordinary(self, text: str) -> bytes:
        first, *words = text.split(" ")
        try:
            if first[-1:].isspace():
                raise _OddSpace
            return self._whole(first) + b"".join(map(self._words.__getitem__, words))
        except _OddSpace:
            return self._whole(text)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
