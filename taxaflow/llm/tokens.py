"""Exact token ids of whole texts, word by word, with a bounded cache of words.

Both tokenizer files cut a text at white space before they merge, so a text's ids are its words' ids in
order. A word is encoded once by the tokenizers library and then taken from the cache.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

#: Words kept per generation; two generations live in each Python worker.
CACHE_WORDS = 400_000

_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_CORE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*$%&#]+)")
_SPACES = re.compile(r"\s\s")
_BETWEEN = re.compile(r"(?<=\S)(?= \S)")


class WordCache(dict):
    """word -> value by ``make``; the last ``limit`` to 2 * ``limit`` words asked for are kept."""

    def __init__(self, make: Callable, limit: int = CACHE_WORDS):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, word):
        value = self.old.pop(word, None)
        if value is None:
            value = self.make(word)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


def _byte_letters() -> dict[int, str]:
    """Bytes as the printable letters that byte-level vocabularies use: printable ones stand for themselves,
    the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Encoder:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.letters = _byte_letters()
        self.cache = WordCache(self.word, cache_words)

    def whole(self, text: str) -> bytes:
        ids = self.tok.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def letters_only(self, word: str) -> bytes:
        """Ids of a run of Latin letters, which is one pre-token."""
        ids = [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder(_Encoder):
    """For files that drop white space and lower-case (``word_bpe_49k.json``)."""

    def word(self, word: str) -> bytes:
        if not word:
            return b""
        if _LATIN.fullmatch(word):
            return self.letters_only(word.lower())
        if m := _CORE.fullmatch(word):
            return self.cache[m[1]] + self.cache[m[2]]
        return self.whole(word)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return b"".join(map(self.cache.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))


class ByteEncoder(_Encoder):
    """For byte-level files that keep white space (``byte_bpe_50k.json``)."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        super().__init__(path, cache_words // 4)
        self.spaced = WordCache(self.after_space, cache_words)

    def word(self, word: str) -> bytes:
        return self.letters_only(word) if _LATIN.fullmatch(word) else self.whole(word) if word else b""

    def after_space(self, word: str) -> bytes:
        if _LATIN.fullmatch(word):
            return self.letters_only(" " + word)
        if m := _CORE.fullmatch(word):
            return self.spaced[m[1]] + self.cache[m[2]]
        return self.whole(" " + word)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if _SPACES.search(text):
            return b"".join(map(self.cache.__getitem__, _BETWEEN.split(text)))
        lines, end, get = [], self.cache["\n"], self.spaced.__getitem__
        for line in text.split("\n"):
            words = line.split(" ")
            lines.append(self.cache[words[0]] + b"".join(map(get, words[1:])))
        return end.join(lines)


_ENCODERS: dict[tuple, _Encoder] = {}


def encoder(kind: type, path: str, cache_words: int = CACHE_WORDS):
    """One encoder per file and Python worker."""
    key = (kind, path, cache_words)
    if key not in _ENCODERS:
        _ENCODERS[key] = kind(path, cache_words)
    return _ENCODERS[key]
