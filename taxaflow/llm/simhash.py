"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint falls into three segments of 22, 21 and 21 bits, each taken as a word of the perfect
binary Golay code (23 bits, 12 of message, distance 7). A word within 2 bits of a codeword gets that one's index;
any other gets the indices of all six codewords within 4 bits, whose differing bits split the 23 places among
them. So two words that differ in at most 2 bits share an index, and the nearest codeword of one is among
the other's indices if they differ in at most 1 bit.

Fingerprints that differ in at most 4 bits have two segments that differ in at most 2 bits together: in (0, up to
2), (up to 2, 0) or (1, 1) bits. Keys of a pair of segments are (each index, nearest) and (nearest, each index):
in each of the three cases both fingerprints have a key in common. Buckets of a key are then compared bit
by bit, so that links are exact and none is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, parallelism, written
from .components import connected_components

#: Generator polynomial of the binary Golay code (fixed value).
GOLAY = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
SMALL_BUCKET = 32
CELL = 20_000  # fingerprints of a bucket that are compared in one place; larger buckets are split

_LINK = "a long, b long"


def shingles(text: str, words: int) -> list[bytes]:
    """Runs of ``words`` words, A-Z lower-cased, joined by a space; all words of a shorter text; none without words."""
    parts = text.encode().lower().split()
    if not parts:
        return []
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.r_[0, ends[:-1]]
    n = max(1, len(parts) - words + 1)
    spans = zip(starts[:n].tolist(), (ends[min(words, len(parts)) - 1 :] - 1).tolist(), strict=True)
    return [joined[a:b] for a, b in spans]


def shingle_hashes(text: str, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle."""
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(s, seed) for s in shingles(text, words)], "<u8")


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have; 0 if there are none."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """SimHash of the XXH64 of shingles, each as often as it occurs; A-Z lower-cased; 0 if there are no words."""
    return majority(shingle_hashes(text, words, seed))


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of 23-bit words' upper 12 and lower 11 bits are combined by xor; for each syndrome: the error
    patterns to the codewords meant, nearest first, six at most, and how many there are."""

    def syndrome(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GOLAY << (bit - 11)
        return x

    upper = np.array([syndrome(x << 11) for x in range(4096)], np.int64)
    single = [syndrome(1 << i) for i in range(23)]
    patterns: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for places in combinations(range(23), weight):
            s = 0
            for p in places:
                s ^= single[p]
            if weight < 4 or len(patterns[s]) and patterns[s][0].bit_count() == 3:
                patterns[s].append(sum(1 << p for p in places))
    n = np.array([len(p) for p in patterns])
    table = np.array([p + [p[0]] * (6 - len(p)) for p in patterns], np.int64)
    return upper, table, n


def golay_indices(words: np.ndarray) -> np.ndarray:
    """Six message indices of each 23-bit word, nearest codeword first; words near one codeword repeat it."""
    upper, table, _ = _golay()
    syndromes = upper[words >> 11] ^ (words & 2047)
    return (words[:, None] ^ table[syndromes]) >> 11


def bucket_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) without repeats: 33 keys of a fingerprint at most. fingerprints: unsigned 64-bit."""
    indices = [golay_indices(((fingerprints >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64)) for at, bits in SEGMENTS]
    keys = []
    for number, (x, y) in enumerate(combinations(indices, 2)):
        keys += [(number << 24) | (x << 12) | y[:, :1], (number << 24) | (x[:, :1] << 12) | y]
    keys = np.sort(np.concatenate(keys, axis=1), axis=1)
    new = np.concatenate([np.ones((len(keys), 1), bool), keys[:, 1:] != keys[:, :-1]], axis=1)
    return np.nonzero(new)[0], keys[new]


def forest(members: np.ndarray, errors: int) -> list[tuple[int, int]]:
    """Links of at most ``errors`` bits that connect what all such links connect: numbers of two members each."""
    left, links, queue = np.arange(len(members)), [], []
    while len(left):
        if not queue:
            queue, left = [left[0]], left[1:]
        i = queue.pop()
        near = np.bitwise_count(members[left] ^ members[i]) <= errors
        if near.any():
            found = left[near]
            links += [(i, j) for j in found]
            queue += found.tolist()
            left = left[~near]
    return links


def bucket_links(keys: np.ndarray, values: np.ndarray, errors: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys. Small runs are compared pair by pair, larger ones give a forest."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    size = np.repeat(sizes, sizes)
    a, b = [], []
    rows = np.flatnonzero((size > 1) & (size <= SMALL_BUCKET))
    for shift in range(1, SMALL_BUCKET):
        rows = rows[rows + shift < len(keys)]
        rows = rows[keys[rows] == keys[rows + shift]]
        if not len(rows):
            break
        near = rows[np.bitwise_count(values[rows] ^ values[rows + shift]) <= errors]
        a.append(values[near])
        b.append(values[near + shift])
    for start, n in zip(starts[sizes > SMALL_BUCKET], sizes[sizes > SMALL_BUCKET], strict=True):
        own = values[start : start + n]
        if links := forest(own, errors):
            i, j = np.array(links).T
            a.append(own[i])
            b.append(own[j])
    none = np.zeros(0, values.dtype)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def fingerprint_links(prints: DataFrame, errors: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``, enough to connect all that differ in ``errors`` bits or fewer."""
    if errors > 4:
        raise ValueError("the keys guarantee links of up to 4 bits")

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch["fp"].to_numpy(zero_copy_only=False)
            rows, keys = bucket_keys(fp.astype(np.int64).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(fp[rows])], ["key", "fp"])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def out(k: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            a, b = bucket_links(k, v, errors)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            keys = np.r_[keys, batch["cell"].to_numpy(zero_copy_only=False).astype(np.int64)]
            values = np.r_[values, batch["fp"].to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)]
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if last:
                yield out(keys[:last], values[:last])
                keys, values = keys[last:], values[last:]
        if len(keys):
            yield out(keys, values)

    rows = prints.select("fp").mapInArrow(keyed, "key int, fp long").withColumn("key", F.col("key").cast("long"))
    cells = in_cells(rows, "fp").select("cell", "fp")
    spark = prints.sparkSession
    return cells.repartition(parallelism(spark), "cell").sortWithinPartitions("cell").mapInArrow(compare, _LINK)


def in_cells(rows: DataFrame, node: str, most: int = CELL) -> DataFrame:
    """Adds cell: rows of one key (long) meet in one place, and those of a key of over ``most`` rows in pairs of parts.

    A bucket of n goes to parts p < n / most by a hash of ``node``; each pair of parts meets in a cell of two parts at most.
    """
    hot = written(rows.groupBy("key").count().where(F.col("count") > most), "hot-keys")
    if hot.isEmpty():
        return rows.withColumn("cell", F.col("key"))
    parts = hot.select(F.col("key").alias("hot"), F.ceil(F.col("count") / most).alias("parts"))
    own = rows.join(parts, F.col("key") == F.col("hot"), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = own.withColumn("part", F.pmod(F.xxhash64(node), "parts")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other"))
    return own.select(*rows.columns, F.when(F.col("parts") == 1, F.col("key")).otherwise(cell).alias("cell"))


def near_duplicates(docs: DataFrame, words: int = 4, errors: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id that links of fingerprints reach),
    text_hash (XXH64 of the text, which tells rows of one doc_id apart).

    Fingerprints link at ``errors`` or fewer differing bits (4 at most). Equal fingerprints are one node, so
    copies cost nothing. Texts without words (null, empty, white space) have fingerprint zero and link like any
    other. Repeated rows are kept; a null doc_id keeps its place, and a component of null doc_ids alone has
    a null component_id. Other columns are not read; an empty table gives an empty result.
    """

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        prints = np.fromiter((fingerprint(t.as_py(), words) for t in texts), np.uint64, len(texts))
        return pa.array(prints.view(np.int64))

    rows = written(id_text(docs).select("doc_id", simhash("text").alias("fp"), F.xxhash64("text").alias("text_hash")), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = written(connected_components(fingerprint_links(nodes, errors), "a", "b"), "roots")
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = written(linked.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    of = written(linked.select("fp", "root").join(least, "root").select("fp", "component_id"), "members")
    return rows.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_hash")
