"""Shards of near-equal bytes by histogram sort.

Rows are ordered by (hash of the text, doc_id), so equal texts stand together. Splitters are found without
moving a row: each round counts the exact bytes and rows below candidate boundaries over all partitions, and lays the
next candidates evenly between the nearest keys around each boundary that is still too far off. First
whole hash values are tried; only where one group of equal texts is too large to end near a boundary, it
is cut by doc_id. When every splitter meets the tolerance, rows are exchanged once.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .common import id_text, written

ROW_BYTES = 16
PROBES = 12  # in an interval that is refined
PART_BYTES = 128_000_000
NO_ID = -(2**63)  # a null doc_id sorts first


def _place(bounds: list[int]):
    """Number of boundaries at or below a key."""
    at = np.array([b for b in bounds if b < 2**63], np.int64)  # no key reaches the others

    @F.arrow_udf(IntegerType())
    def place(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(at, keys.to_numpy(zero_copy_only=False).astype(np.int64), "right").astype(np.int32))

    return place


@dataclass
class Counted:
    """Boundaries whose exact bytes and rows below are known. A key k is below a boundary b if k < b."""

    bounds: list[int] = field(default_factory=list)
    below: dict[int, tuple[int, int]] = field(default_factory=dict)

    def add(self, bound: int, bytes_below: int, rows_below: int) -> None:
        if bound not in self.below:
            self.bounds.insert(bisect_left(self.bounds, bound), bound)
            self.below[bound] = (bytes_below, rows_below)

    def around(self, target: float) -> tuple[int, int]:
        """The neighbouring boundaries that have the target between them."""
        i = bisect_right(self.bounds, target, key=lambda b: self.below[b][0])
        return self.bounds[max(0, i - 1)], self.bounds[min(i, len(self.bounds) - 1)]

    def nearest(self, target: float) -> int:
        return min(self.around(target), key=lambda b: abs(self.below[b][0] - target))

    def off(self, target: float) -> float:
        return abs(self.below[self.nearest(target)][0] - target)


def histogram_splitters(keys: DataFrame, key: str, total: tuple[int, int], targets: Iterable[float], tolerance: float) -> Counted:
    """Counts bytes below candidate keys, round by round, until each target is within ``tolerance`` bytes of a
    boundary or no key lies between its neighbours. keys: long column ``key`` and ``size``; what comes to
    the driver in a round is a few numbers for each target."""
    low, high = keys.agg(F.min(key), F.max(key)).first()
    counted = Counted()
    if low is None:
        return counted
    counted.add(low, 0, 0)
    counted.add(high + 1, *total)
    while True:
        open_at = sorted({counted.around(t) for t in targets if counted.off(t) > tolerance})
        open_at = [(a, b) for a, b in open_at if b - a > 1]
        if not open_at:
            return counted
        fine = sorted({a + (b - a) * i // (PROBES + 1) for a, b in open_at for i in range(PROBES + 1)} | {b for _, b in open_at})
        wanted = [bisect_right(fine, f) for f in fine if any(a <= f < b for a, b in open_at)]
        bins = keys.withColumn("bin", _place(fine)(key)).where(F.col("bin").isin(wanted)).groupBy("bin")
        found = {r.bin: r for r in bins.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high")).collect()}
        for a, b in open_at:
            size, rows = counted.below[a]
            for bin_ in range(bisect_right(fine, a), bisect_right(fine, b)):
                if r := found.get(bin_):  # as no key lies outside low and high, nothing does between them and the probes
                    counted.add(r.low, size, rows)
                    size, rows = size + r.bytes, rows + r.rows
                    counted.add(r.high + 1, size, rows)


def shard_documents(docs: DataFrame, shards: int = 40, tolerance: float = 0.005, parts: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deals all rows into ``shards`` of near-equal bytes: UTF-8 bytes of the text plus 16 a row.

    Returns doc_id, text, size, shard (from 0), slot (gapless from 0 in each shard, in key order). A shard's
    bytes differ from an equal share by a fraction ``tolerance`` at most, and by half of the rows that share one text
    and one doc_id if that is more. Rows of equal texts stay in one shard unless a boundary
    within the tolerance would have to cut their group. Each shard is made by ``parts`` tasks of equal size
    (by default of ``PART_BYTES``, four at least), so no task grows with the input. Null texts count as empty in
    size; a null doc_id sorts first; repeated rows are all placed. Other columns are not read; an empty table
    gives an empty result.
    """
    rows = id_text(docs, id_col, text_col)
    keyed = rows.withColumn("size", F.octet_length("text").cast("long") + ROW_BYTES).withColumn("hash", F.xxhash64("text")).withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
    keys = written(keyed.select("hash", "id", "size"), "keys")
    total = tuple(x or 0 for x in keys.agg(F.sum("size"), F.count("*")).first())
    parts = parts or max(4, -(-total[0] // (shards * PART_BYTES)))
    share = total[0] / (shards * parts)
    near = share * parts * tolerance
    targets = [share * i for i in range(1, shards * parts)]
    counted = histogram_splitters(keys, "hash", total, targets, near)

    # Splitters (hash, id, rows below): a row belongs after all splitters at or below its (hash, id).
    splitters: list[tuple[int, int, int]] = []
    if counted.bounds:
        heavy: dict[int, list[float]] = {}
        for t in targets:
            a, b = counted.around(t)
            if counted.off(t) > near and counted.below[b][1] - counted.below[a][1] > 1:
                heavy.setdefault(a, []).append(t)
            else:
                b = counted.nearest(t)
                splitters.append((b, NO_ID, counted.below[b][1]))
        for value, wanted in heavy.items():  # as many as the targets at most
            before, rows_before = counted.below[value]
            own = keys.where(F.col("hash") == F.lit(value))
            size, n = own.agg(F.sum("size"), F.count("*")).first()
            inner = histogram_splitters(own, "id", (size, n), [t - before for t in wanted], near)
            for t in wanted:
                b = inner.nearest(t - before)
                splitters.append((value, b, rows_before + inner.below[b][1]))
    splitters.sort()
    return _exchange(keyed, splitters, parts)


def _exchange(keyed: DataFrame, splitters: list[tuple[int, int, int]], parts: int) -> DataFrame:
    hashes = np.array([s[0] for s in splitters], np.int64)
    ids = np.array([s[1] for s in splitters], np.int64)

    below = np.array([0, *(s[2] for s in splitters)], np.int64)  # rows before each part

    @F.arrow_udf("part int, start long")
    def part_of(hash_: pa.Array, id_: pa.Array) -> pa.Array:
        h, d = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (hash_, id_))
        part = np.searchsorted(hashes, h, "left")
        end = np.searchsorted(hashes, h, "right")
        for i in np.flatnonzero(part < end):  # a splitter has this very hash
            part[i] += np.searchsorted(ids[part[i] : end[i]], d[i], "right")
        start = below[part] - below[part // parts * parts]
        return pa.StructArray.from_arrays([pa.array(part.astype(np.int32)), pa.array(start)], ["part", "start"])

    order = Window.partitionBy("part").orderBy("hash", "id", "size")
    placed = keyed.withColumn("at", part_of("hash", "id")).select("doc_id", "text", "size", "hash", "id", "at.part", "at.start")
    placed = placed.withColumn("slot", F.col("start") + F.row_number().over(order) - 1)
    return placed.select("doc_id", "text", "size", F.floor(F.col("part") / parts).cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))
