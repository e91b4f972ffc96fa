"""License scans: MinHash bands over overlapping windows retrieve templates, shingle containment verifies them.

A template of n words is looked for in windows of n words and a quarter more, a quarter of n apart, so that each
span of n words lies in some window whole. Templates of equal length share their windows. A window has
``BANDS`` bands of one minimum each. A window that holds 0.8 of a template's shingles has a Jaccard similarity of
0.5 at least with it, so it shares one of 32 bands with probability 1 - 0.5 ** 32, all but one in four
thousand million. What shares a band is then verified on the words themselves.

Texts are taken in one pass without a shuffle; the minima of all windows of a chunk of text come from shared running
minima of doubling width.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text
from .decontaminate import _LETTERS, words_of
from .license_templates import TEMPLATES
from .tokens import WordCache

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 32
CHUNK_WORDS = 40_000
RESULT = "doc_id long, template string, license string, containment double, start long, end long"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("template", pa.string()), ("license", pa.string()), ("containment", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
_HASHES = WordCache(zlib.crc32, 300_000)
#: Odd multipliers and offsets of the bands' hash functions, from one generator.
_MULTIPLY, _ADD = (np.random.default_rng(7).integers(0, 2**64, (2, BANDS), np.uint64) | np.uint64(1)).reshape(2, BANDS)


def shingles(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def _shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the shingles that begin at each word; the last few, which would be cut, are left out."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = (out + hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def _band(h: np.ndarray, k: int) -> np.ndarray:
    return ((h * _MULTIPLY[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


class Templates:
    """Templates by length: those of n words share shingle size, window and step."""

    def __init__(self, texts: dict[str, tuple[str, str]], size: int = SHINGLE):
        named = sorted((len(w), name, w) for name, (_, text) in texts.items() if (w := words_of(text)))
        self.classes = []
        for n, group in groupby(named, key=lambda x: x[0]):
            own = min(size, n)
            step = max(1, n // 4)
            found = [(name, shingles(w, own), _shingle_hashes(_word_hashes(w), own)) for _, name, w in group]
            self.classes.append((n, own, step, found))


def _running_minima(values: np.ndarray, widest: int) -> list[np.ndarray]:
    """Least value of 1, 2, 4 ... neighbours from each place on; past the end there is nothing small."""
    runs = [np.concatenate([values, np.full(widest, 2**32 - 1, np.uint32)])]
    while 2 << (len(runs) - 1) <= widest:
        reach = 1 << (len(runs) - 1)
        runs.append(np.minimum(runs[-1][:-reach], runs[-1][reach:]))
    return runs


def candidates(words: list[bytes], bounds: np.ndarray, templates: Templates) -> Iterator[tuple[str, set, int, int, int, int]]:
    """(template, its shingles, shingle size, document, first word, end) of windows that share a band with a template.

    bounds: where documents begin among the words, and the end. Windows step from each document's start; the
    minima of its last ones reach over its end, which adds candidates only.
    """
    hashes = _word_hashes(words)
    lengths = np.diff(bounds)
    for size, group in groupby(sorted(templates.classes, key=lambda c: c[1]), key=lambda c: c[1]):
        h = _shingle_hashes(hashes, size)
        if not len(h):
            continue
        classes = []
        for n, _, step, found in group:
            windows = -(-lengths // step)
            doc = np.repeat(np.arange(len(lengths)), windows)
            starts = bounds[doc] + step * (np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows))
            inside = starts < len(h)
            width = n + step - size + 1
            classes.append((n + step, width, doc[inside], starts[inside], [(name, own, mins, np.zeros(int(inside.sum()), bool)) for name, own, mins in found]))
        widest = max(c[1] for c in classes)
        for k in range(BANDS):
            runs = _running_minima(_band(h, k), widest)
            for _, width, _, starts, found in classes:
                level = width.bit_length() - 1
                least = np.minimum(runs[level][starts], runs[level][starts + width - (1 << level)])
                for _, _, own, marks in found:
                    marks |= least == _band(own, k).min()
        for span, _, doc, starts, found in classes:
            for name, own, _, marks in found:
                for w in np.flatnonzero(marks):
                    d = int(doc[w])
                    yield name, own, size, d, int(starts[w]), min(int(starts[w]) + span, int(bounds[d + 1]))


def scan_licenses(docs: DataFrame, texts: dict[str, tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document and template that a window of the document contains.

    Returns doc_id, template, license, containment (the largest share of the template's distinct shingles in a
    window, ``threshold`` at least), start and end (characters from the first to the last matched word of
    the first such window). Shingles are of five words, A-Z lower-cased, letters, digits and non-ASCII
    characters; a template of fewer words is one shingle. Null and empty texts match nothing; repeated
    rows and null doc_ids are scanned one by one; other columns are not read; an empty table gives an
    empty result.
    """
    templates = Templates(texts)

    def chunk(rows: list[tuple[int | None, str, list[bytes]]]) -> pa.RecordBatch:
        words = [w for _, _, own in rows for w in own]
        bounds = np.cumsum([0, *(len(own) for _, _, own in rows)])
        best: dict[tuple[int, str], tuple[float, int, int]] = {}
        for name, want, size, d, a, b in candidates(words, bounds, templates):
            if at := [i for i in range(a, b - size + 1) if tuple(words[i : i + size]) in want]:
                share = len({tuple(words[i : i + size]) for i in at}) / len(want)
                if share >= threshold and share > best.get((d, name), (0.0,))[0]:
                    best[d, name] = (share, at[0] - int(bounds[d]), at[-1] + size - int(bounds[d]))
        out = []
        for (d, name), (share, a, b) in sorted(best.items()):
            start, end = _characters(rows[d][1], a, b)
            out.append({"doc_id": rows[d][0], "template": name, "license": texts[name][0], "containment": share, "start": start, "end": end})
        return pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                text = text.as_py()
                rows.append((doc_id.as_py(), text, words_of(text)))
                n += len(rows[-1][2])
                if n >= CHUNK_WORDS or len(rows) >= 10_000:
                    yield chunk(rows)
                    rows, n = [], 0
        if rows:
            yield chunk(rows)

    return id_text(docs).mapInArrow(scan, RESULT)


def _characters(text: str, first: int, end: int) -> tuple[int, int]:
    """Characters from the word numbered ``first`` to the end of word ``end`` - 1."""
    data = text.encode()
    plain = data.translate(_LETTERS)
    at, number, start = 0, -1, 0
    while number < end - 1:
        while plain[at] == 32:
            at += 1
        number += 1
        if number == first:
            start = at
        stop = plain.find(b" ", at)
        at = len(plain) if stop < 0 else stop
    return len(data[:start].decode()), len(data[:at].decode())
