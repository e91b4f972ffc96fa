"""Near copies by the shingles that texts share: SimHash links and MinHash bands bring texts together, and sets of shingles
are compared where they meet.

Fingerprints within 4 of 64 bits stand for a similarity of about 0.96 and more, so Golay keys of SimHash fingerprints alone
miss most pairs from 0.8 on. ``BANDS`` bands of ``DEPTH`` minima each find the rest: a pair of similarity 0.8 shares none
with probability (1 - 0.8 ** 5) ** 32, three in a million.

The texts that SimHash links connect, and those that share a band, meet in a cell each. There a forest of links grows: a text
is held against those that no link has reached yet, first by a byte of each minimum (a pair of 0.8 falls below ``POSSIBLE``
with probability two in a million), then by the hashes of its shingles. So a group of copies costs a few comparisons a text, and
no row stands for a pair that is not similar. Of texts with more shingles than ``SAMPLE`` the least hashes are a sample;
pairs that it leaves open are verified on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, id_text, parallelism, small_side, written
from .components import connected_components
from .simhash import fingerprint_links, in_cells, majority, shingle_hashes, shingles

BANDS, DEPTH = 32, 5
MINIMA = BANDS * DEPTH
POSSIBLE = 0.65  # share of equal minima
SAMPLE = 512  # hashes of a text that travel to its cells
CELL = 8_000  # texts of a bucket that meet in one place; larger buckets are split
SPREAD = 4.7  # standard deviations that a sampled similarity may be off
AGAIN = 16  # pairs of a text that are verified after one of its cell was refused
BLOCK = 512  # shingles that are hashed at once
#: Odd multipliers and offsets of the hash functions, from one generator.
_MULTIPLY, _ADD = (np.random.default_rng(11).integers(0, 2**32, (2, MINIMA), np.uint32) | np.uint32(1)).reshape(2, 1, MINIMA)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the shingles."""
    least = np.full(MINIMA, 2**32 - 1, np.uint32)
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(upper), BLOCK):
        least = np.minimum(least, (upper[at : at + BLOCK, None] * _MULTIPLY + _ADD).min(axis=0))
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band: its minima and its number."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for minimum in least.astype(np.uint64).reshape(BANDS, DEPTH).T:
        key = (key ^ minimum) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def jaccard(a: set[bytes], b: set[bytes]) -> float:
    """Shared part of two sets of shingles; texts without words are alike."""
    same = len(a & b)
    return same / (len(a) + len(b) - same) if a or b else 1.0


class Cell:
    """The texts of a cell: the low bytes of their minima, and their least shingle hashes in order."""

    def __init__(self, low: list[bytes], least: list[bytes], sizes: np.ndarray, similarity: float):
        self.low = np.frombuffer(b"".join(low), np.uint8).reshape(-1, MINIMA)
        self.least = [np.frombuffer(x, np.uint64) for x in least]
        self.sizes, self.similarity = sizes, similarity
        top = np.uint64(2**64 - 1)
        self.upto = np.array([x[-1] if n > len(x) else top for x, n in zip(self.least, sizes, strict=True)], np.uint64)  # hashes are known up to here

    def compare(self, i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each of the others is surely similar to text i, and whether it may be."""
        s, sure, may = self.similarity, np.zeros(len(others), bool), np.zeros(len(others), bool)
        able = (s * self.sizes[i] <= self.sizes[others]) & (s * self.sizes[others] <= self.sizes[i])
        able[able] = (self.low[others[able]] == self.low[i]).sum(axis=1) >= POSSIBLE * MINIMA
        for at in np.flatnonzero(able):
            j = others[at]
            a, b, upto = self.least[i], self.least[j], min(self.upto[i], self.upto[j])
            exact = self.upto[i] == self.upto[j] and self.sizes[i] == len(a) and self.sizes[j] == len(b)
            if not exact:
                a, b = a[: np.searchsorted(a, upto, "right")], b[: np.searchsorted(b, upto, "right")]
            both = np.concatenate([a, b])
            both.sort()
            same = int((both[1:] == both[:-1]).sum())
            union = len(both) - same
            share = same / union if union else 1.0
            off = 0.0 if exact else SPREAD * np.sqrt(s * (1 - s) / union)
            sure[at], may[at] = share >= s and exact, s - off <= share and not exact
        return sure, may

    def links(self) -> list[tuple[int, int, bool]]:
        """(i, j, sure): pairs that are links or may be, a forest that connects what all such pairs connect."""
        left, queue, found = np.arange(len(self.sizes)), [], []
        while len(left):
            if not queue:
                queue, left = [left[0]], left[1:]
            i = queue.pop()
            sure, may = self.compare(i, left)
            near = sure | may
            found += [(i, j, s) for j, s in zip(left[near].tolist(), sure[near].tolist(), strict=True)]
            queue += left[near].tolist()
            left = left[~near]
        return found

    def more(self, linked: list[np.ndarray], refused: list[np.ndarray], most: int) -> list[tuple[int, int, bool]]:
        """(i, j, sure): sure links between groups of what is ``linked``, and for each text ``most`` pairs that may link it to
        others, without those that were ``refused``. Where any such pair is left, one at least is found."""
        group, found = np.arange(len(self.sizes)), []
        for i, others in enumerate(linked):
            for j in others.tolist():
                group[group == group[j]] = group[i]
        for i in range(len(group)):
            others = np.flatnonzero(group != group[i])
            others = others[(others > i) & ~np.isin(others, refused[i])]
            sure, may = self.compare(i, others)
            for j in others[sure].tolist():
                if group[j] != group[i]:
                    found.append((i, j, True))
                    group[group == group[j]] = group[i]
            found += [(i, j, False) for j in [j for j in others[may & ~sure].tolist() if group[j] != group[i]][:most]]
        return found


def _cell_links(cells: DataFrame, similarity: float, most: int = 0) -> DataFrame:
    """(cell, a, b, sure) of nodes, from each cell's rows (cell, node, n, minima, least): a forest; or, with ``most``, what can be
    added to what the rows (linked, refused: nodes) tell of their cell so far."""
    names = ["cell", "node", "n", "minima", "least", *(["linked", "refused"] if most else [])]

    def out(table: pa.Table) -> pa.RecordBatch:
        cell, node, n = (table[c].to_numpy() for c in ("cell", "node", "n"))
        low, least = table["minima"].to_pylist(), table["least"].to_pylist()
        edges = np.r_[0, np.flatnonzero(np.diff(cell)) + 1, len(cell)]
        pairs, kinds, places = [], [], []
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            if end - start > 1:
                own = Cell(low[start:end], least[start:end], n[start:end], similarity)
                if most:
                    at = {x: i for i, x in enumerate(node[start:end].tolist())}
                    known = ([np.array([at[x] for x in row or ()], int) for row in table[c].slice(start, end - start).to_pylist()] for c in ("linked", "refused"))
                    links = own.more(*known, most)
                else:
                    links = own.links()
                pairs += [(node[start + i], node[start + j]) for i, j, _ in links]
                kinds += [sure for *_, sure in links]
                places += [cell[start]] * len(links)
        a, b = np.sort(np.array(pairs, np.int64).reshape(-1, 2), axis=1).T
        return pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(a), pa.array(b), pa.array(kinds, pa.bool_())], ["cell", "a", "b", "sure"])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            own = pa.Table.from_batches([batch])
            held = own if held is None else pa.concat_tables([held, own])
            cell = held["cell"].to_numpy()
            if len(cell) and (last := int(np.searchsorted(cell, cell[-1]))):
                yield out(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield out(held)

    dealt = cells.select(*names).repartition(parallelism(cells.sparkSession), "cell").sortWithinPartitions("cell", "node")  # cells of the same texts begin with the same one
    return dealt.mapInArrow(compare, "cell long, a long, b long, sure boolean")


def _found_links(cells: DataFrame, sketches: DataFrame, texts: DataFrame, words: int, similarity: float, broadcast_rows: int) -> DataFrame:
    """(a, b) that connect what all links within cells (cell, node) connect.

    Each cell hands on a forest of pairs that are links or may be; the latter are verified on the words. Cells with a refused pair are
    looked at again and hand on further pairs, up to ``AGAIN`` a text, then that many times as many, until none is refused. So
    long texts that are copies of each other cost a pair each, and others as many as have to be told apart.
    """
    made = known = written(_cell_links(cells.join(sketches, "node"), similarity), "cell-links")
    good: DataFrame | None = None
    judged: DataFrame | None = None
    most = AGAIN
    while not (asked := made.where("NOT sure")).isEmpty():
        pairs = asked.select("a", "b").distinct()
        pairs = written(pairs if judged is None else pairs.join(judged, ["a", "b"], "left_anti"), "open-pairs")
        judged = pairs if judged is None else judged.unionByName(pairs)
        held = _verified(pairs, texts, words, similarity, broadcast_rows)
        good = held if good is None else good.unionByName(held)
        failed = written(asked.join(good, ["a", "b"], "left_anti").select("cell").distinct(), "failed-cells")
        if failed.isEmpty():
            break
        told = known.join(failed, "cell", "left_semi").join(good.distinct().withColumn("held", F.lit(True)), ["a", "b"], "left")
        told = told.select("cell", "a", "b", (F.col("sure") | F.coalesce("held", F.lit(False))).alias("ok"))
        both = told.unionByName(told.select("cell", F.col("b").alias("a"), F.col("a").alias("b"), "ok"))
        sides = [F.collect_list(F.when(c, F.col("b"))).alias(name) for c, name in ((F.col("ok"), "linked"), (~F.col("ok"), "refused"))]
        again = cells.join(failed, "cell", "left_semi").join(both.groupBy("cell", F.col("a").alias("node")).agg(*sides), ["cell", "node"], "left").join(sketches, "node")
        made = written(_cell_links(again, similarity, most), "cell-links")
        known, most = known.unionByName(made), most * AGAIN
    sure = known.where("sure").select("a", "b").distinct()
    return sure if good is None else sure.unionByName(good)


def _verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: float, broadcast_rows: int) -> DataFrame:
    """Those pairs (a, b) of text hashes whose texts have the similarity. No text is sorted: pairs are hashed, texts pass by."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            keep = []
            for a, first, second in zip(batch["a"].to_pylist(), batch["first"], batch["second"], strict=True):
                if a != last:
                    last, own = a, set(shingles(first.as_py(), words))
                keep.append(jaccard(own, set(shingles(second.as_py(), words))) >= similarity)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ids = written(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "open-texts")
    texts = written(texts.join(small_side(ids, broadcast_rows), "node", "left_semi").dropDuplicates(["node"]), "texts")
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("second")).join(pairs.hint("shuffle_hash"), "b")
    both = second.join(texts.select(F.col("node").alias("a"), F.col("text").alias("first")), "a")
    return written(both.select("a", "b", "first", "second").mapInArrow(measure, "a long, b long"), "near-pairs")


def _buckets(in_bands: DataFrame) -> DataFrame:
    """(key, node) of the bands that several texts share; of bands shared by the same texts, one.

    Counted where the rows are first, so a key that very many texts share is a row a task. Sums over the texts tell
    sets apart that agree in size, least and greatest text.
    """
    low, high = F.col("node").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("node", 32)
    sets = in_bands.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("members"), F.sum(low).alias("low"), F.sum(high).alias("high"), F.bit_xor(F.xxhash64("node")).alias("xor"))
    one = sets.where("first != last").groupBy("first", "last", "members", "low", "high", "xor").agg(F.min("key").alias("key"))
    shared = written(one.select("key"), "buckets")
    return in_bands.join(shared.hint("shuffle_hash"), "key", "left_semi").distinct()


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, text_hash (XXH64 of the text), root (the same for all texts that chains of near copies connect).

    Two texts are near copies if the Jaccard similarity of their sets of shingles of ``words`` words is at least
    ``similarity``, which is not to be less than 0.8: lower ones are verified alike, but found less surely. A-Z are lower-cased;
    a text of fewer words is one shingle. Texts without words are alike. Repeated rows and null doc_ids are kept. Texts
    that meet others are found by a broadcast of up to ``broadcast_rows`` hashes, else by a shuffle.
    """

    @F.arrow_udf("struct<fp: long, n: int, bands: array<long>, minima: binary>")
    def sketch(texts: pa.Array) -> pa.Array:
        prints, sizes, bands, low = [], [], [], []
        for text in texts:
            h = shingle_hashes(text.as_py(), words)
            prints.append(majority(h))
            own = np.unique(h)
            sizes.append(len(own))
            least = minima(own)
            bands.append(band_keys(least))
            low.append(least.astype(np.uint8).tobytes())
        keys = np.concatenate([np.zeros(0, np.uint64), *bands]).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, BANDS, np.int32)), pa.array(keys))
        columns = [pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), lists, pa.array(low, pa.binary())]
        return pa.StructArray.from_arrays(columns, ["fp", "n", "bands", "minima"])

    @F.arrow_udf("binary")
    def least_hashes(texts: pa.Array) -> pa.Array:
        return pa.array((np.unique(shingle_hashes(t.as_py(), words))[:SAMPLE].tobytes() for t in texts), pa.binary())

    own = id_text(docs)
    rows = written(own.select("doc_id", F.xxhash64("text").alias("node"), sketch("text").alias("s")).select("doc_id", "node", "s.*"), "sketches")
    texts = own.select(F.xxhash64("text").alias("node"), "text")

    prints = written(rows.groupBy("fp").agg(F.min("node").alias("x"), F.max("node").alias("y")), "fingerprints")
    linked = written(connected_components(fingerprint_links(prints.select("fp")), "a", "b"), "fingerprint-groups")
    groups = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left").where("root IS NOT NULL OR x != y").select("fp", F.xxhash64(F.coalesce("root", "fp")).alias("key"))
    alike = rows.select("fp", "node").join(groups, "fp").select("key", "node").distinct()
    banded = _buckets(rows.select("node", F.explode("bands").alias("key")))
    members = written(alike.unionByName(banded), "members")

    drawn = small_side(written(members.select("node").distinct(), "drawn"), broadcast_rows)
    least = texts.join(drawn, "node", "left_semi").select("node", least_hashes("text").alias("least")).dropDuplicates(["node"])
    low = rows.select("node", "n", "minima").join(drawn, "node", "left_semi").dropDuplicates(["node"])
    cells = written(in_cells(members, "node", CELL).select("cell", "node"), "cells")
    sketches = written(low.join(least, "node"), "drawn-sketches")
    found = _found_links(cells, sketches, texts, words, similarity, broadcast_rows)
    roots = written(connected_components(found, "a", "b"), "roots")
    out = rows.select("doc_id", F.col("node").alias("text_hash")).join(roots.withColumnRenamed("node", "text_hash"), "text_hash", "left")
    return out.select("doc_id", "text_hash", F.coalesce("root", "text_hash").alias("root"))
