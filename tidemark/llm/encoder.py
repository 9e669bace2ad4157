"""Exact token ids at the speed of a dictionary.

A tokenizer whose pre-tokens never span white space gives a text the concatenated ids of its
white-space separated words, so each different word is encoded once per Python worker. This one also
lower-cases, and takes a full stop or comma between an ASCII letter or digit and white space as a
pre-token of its own; so texts are lower-cased and such marks set apart first, which leaves fewer
different words. Texts with the opening of a special token are only split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

_WORDS_PER_CALL = 20_000
_SLICE_BYTES = 4 << 20
_MARK = re.compile(rb"[.,](?<=[a-z0-9][.,])(?=[ \t\n\r\x0b\x0c]|\Z)")


def split_words(text: bytes) -> list[bytes]:
    """Words of a text whose ids, one after another, are those of the text."""
    if b"<|" in text:
        return text.split()
    return _MARK.sub(rb" \g<0>", text.lower()).split()


class Encoder:
    """Encodes UTF-8 texts (None: empty) to little-endian ids of ``dtype``.

    Words seen are remembered in two generations of at most ``remembered`` each; the limit bounds
    memory and cannot change a result. Words over 64 bytes are not remembered.
    """

    def __init__(self, path: str, remembered: int = 600_000):
        self._tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._remembered = remembered
        self._new: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        text = [w.decode("utf-8") for w in words]
        starts = np.cumsum([0] + [len(w) + 1 for w in text])
        found = self._tokenizer.encode(" ".join(text), add_special_tokens=False)
        ids = np.array(found.ids, dtype=self.dtype)
        if not len(ids):
            return [b""] * len(words)
        begins = np.array([o[0] for o in found.offsets])
        cuts = np.searchsorted(begins, starts) * self.dtype.itemsize
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _lookup(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of all the given words; the caller's words are all in the returned dictionary."""
        if len(self._new) > self._remembered:
            self._old, self._new = self._new, {}
        new, old = self._new, self._old
        missing = []
        for word in words.difference(new):
            known = old.get(word)
            if known is None:
                missing.append(word)
            else:
                new[word] = known
        long = {}
        for at in range(0, len(missing), _WORDS_PER_CALL):
            some = missing[at : at + _WORDS_PER_CALL]
            for word, ids in zip(some, self._encode_words(some)):
                (new if len(word) <= 64 else long)[word] = ids
        return {**new, **long} if long else new

    def encode(self, texts: list[bytes | None]) -> Iterator[bytes]:
        """One byte string of ids per text, in order."""
        some: list[list[bytes]] = []
        size = 0
        for text in texts:
            some.append(split_words(text) if text else [])
            size += len(text or b"")
            if size >= _SLICE_BYTES:
                yield from self._slice(some)
                some, size = [], 0
        yield from self._slice(some)

    def _slice(self, some: list[list[bytes]]) -> Iterator[bytes]:
        known = self._lookup(set(chain.from_iterable(some)))
        for words in some:
            yield b"".join(map(known.__getitem__, words))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
