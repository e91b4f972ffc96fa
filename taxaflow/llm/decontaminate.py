"""Benchmark decontamination by an FM-index over each shard of training documents.

Documents flow through tasks in shards of some megabytes. Of a shard, runs of words that the benchmark
also has, long enough to hold its shortest phrase, are indexed (no other word can be part of a match); all test
phrases are searched backwards at once, occurrences are located by sampled suffix positions, and overlapping
ones are merged into removal spans. Documents are never shuffled. The benchmark is written to the shared folder in
blocks of bounded size, and each shard is searched for one block after the other.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, new_path
from .fm_index import FMIndex

WINDOW = 13
BLOCK_BYTES = 4_000_000  # of benchmark text in a block
SHARD_BYTES = 6_000_000  # of document text in an index
RESULT = "n_words long, n_hit long, item_ids array<string>, spans array<struct<start:long,end:long>>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())), ("spans", pa.list_(_SPAN))])

#: Bytes of words stay, A-Z as a-z; all others become spaces.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, in UTF-8."""
    return text.encode().translate(_LETTERS).split()


class Phrases:
    """Windows of a block of benchmark items, as ids of the block's own vocabulary."""

    def __init__(self, items: Iterable[tuple[str, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text))
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners[ids[i : i + window]].add(item)
        self.items = [sorted(x) for x in owners.values()]
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.shortest = int(self.lengths.min(initial=window))
        self.matrix = np.zeros((len(owners), window), np.int64)
        for row, p in zip(self.matrix, owners, strict=True):
            row[window - len(p) :] = p

    def mark(self, words: list[list[bytes]], first: np.ndarray, hit: np.ndarray, items: dict[int, set[str]]) -> None:
        """Marks the shard's words inside occurrences, and adds each document's items. first: of each document."""
        if not self.items:
            return
        get = self.vocabulary.get
        ids = np.zeros(len(hit) + len(words), np.int64)  # a 0 after each document
        shift = first[:-1] + np.arange(len(words))
        for at, own in zip(shift, words, strict=True):
            ids[at : at + len(own)] = np.fromiter(map(get, own, repeat(0)), np.int64, len(own))
        edges = np.diff(np.r_[0, (ids > 0).astype(np.int8), 0])
        begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        long = end - begin >= self.shortest
        begin, end = begin[long], end[long]
        if not len(begin):
            return
        size = end - begin + 1  # with the separator that follows
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
        index = FMIndex(ids[place], len(self.vocabulary))
        phrase, low, high = index.search(self.matrix, self.lengths)
        if not len(phrase):
            return
        n = high - low
        rows = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        phrase = np.repeat(phrase, n)
        at = place[index.locate(rows)]
        doc = np.searchsorted(shift, at, "right") - 1
        depth = np.zeros(len(hit) + 1, np.int64)
        at -= doc
        np.add.at(depth, at, 1)
        np.add.at(depth, at + self.lengths[phrase], -1)
        hit |= np.cumsum(depth[:-1]) > 0
        for d, p in np.unique(np.stack([doc, phrase], 1), axis=0):
            items[int(d)].update(self.items[p])


def _spans(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Character ranges of runs of hit words, from a run's first word to its last one's end."""
    data = text.encode()
    bounds = [m.span() for m in re.finditer(rb"[^ ]+", data.translate(_LETTERS))]
    edges = np.diff(np.r_[0, hit.astype(np.int8), 0])
    at = [(bounds[a][0], bounds[b - 1][1]) for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)]
    return [{"start": len(data[:a].decode()), "end": len(data[:b].decode())} for a, b in at]


def phrase_finder(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", item_text_col: str = "text"):
    """A function of a text column (no nulls) that gives n_words, n_hit, item_ids and spans.

    Writes the benchmark's blocks to the shared folder, where the tasks read them.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    blocks = 1 + int((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES)
    path = new_path(spark, "benchmark")
    items.repartition(blocks).write.parquet(path)
    files = sorted(spark.read.schema("item string, text string").parquet(path).inputFiles())
    kept: dict[str, Phrases] = {}  # in the task; one block only, as memory is bounded by a block

    def phrases(file: str) -> Phrases:
        import pyarrow.parquet as pq
        from pyarrow import fs

        if file not in kept:
            kept.clear()
            where, name = fs.FileSystem.from_uri(file)
            with where.open_input_file(name) as f:
                found = pq.read_table(f).to_pydict()
            kept[file] = Phrases(zip(found["item"], found["text"], strict=True), window)
        return kept[file]

    def shard(texts: list[str]) -> pa.StructArray:
        words = [words_of(t) for t in texts]
        first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        hit, found = np.zeros(first[-1], bool), defaultdict(set)
        for file in files:
            phrases(file).mark(words, first, hit, found)
        items_ = [sorted(found[i]) if i in found else [] for i in range(len(texts))]
        spans = [_spans(texts[i], hit[first[i] : first[i + 1]]) if i in found else [] for i in range(len(texts))]
        columns = [np.diff(first), np.diff(np.r_[0, np.cumsum(hit)][first]), items_, spans]
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], fields=list(_FOUND))

    @F.arrow_udf(RESULT)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out, texts, size = [], [], 0
            for text in batch:
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= SHARD_BYTES:
                    out.append(shard(texts))
                    texts, size = [], 0
            yield pa.concat_arrays([*out, shard(texts)])

    return find


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words of documents inside any occurrence of ``window`` consecutive words of a benchmark item.

    Returns for each document: doc_id, n_words, n_hit (words hit), item_ids (sorted strings, of items with
    an occurring window), spans (character ranges to remove, merged). An item of fewer words than a window,
    but not none, is one window. Null texts have no words, in documents and items alike; items without an id are
    named "". Repeated rows are judged one by one; other columns are not read. An empty benchmark hits
    nothing; an empty table gives an empty result.
    """
    find = phrase_finder(benchmark, window)
    return id_text(docs).select("doc_id", find("text").alias("found")).select("doc_id", "found.*")


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """Whether a twentieth of a document's words, at least, and one at least, are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
