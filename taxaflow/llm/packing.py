"""Best-fit packing of token sequences, planned on the histogram of lengths.

1. One pass tokenizes the texts and cuts only those longer than a sequence; the pieces are written once.
2. Best-fit decreasing runs over the counts of each length (1,024 numbers at most, however many documents).
   Its plan says for each length: ranks ``first`` to ``first + count - 1`` go to such sequences, at such an offset.
3. Pieces get a rank within their length and take the planned slot by a join on (length, rank). A task numbers the
   pieces of each length that it writes; the tasks before it are added from the counts. So no piece moves to get its
   rank, and one frequent length doesn't land in one task.
"""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, small_side, written
from .tokens import CACHE_WORDS, ByteEncoder, encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, task int, number long"
PLAN = "length long, first long, count long, each long, sequence long, offset long"


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: the first takes what doesn't fill a whole sequence."""
    first = n % capacity or capacity
    yield from [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n else []


def plan_best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts, as rows of ``PLAN``; as good as piece by piece.

    Open sequences are kept as runs of equal ones by room left. Of a length, ranks ``first`` on fill the run
    from ``sequence`` on, ``each`` in one sequence, side by side from ``offset`` on. The rows depend on the
    capacity and the histogram's shape only: a run is split at most once a length.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> (first sequence, number of sequences)
    plan, used = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = min((r for r, found in runs.items() if found and r >= length), default=None)
            if room is None:
                room, each = capacity, capacity // length
                sequence, n = used, -(-left // each)
                used += n
            else:
                each = room // length
                sequence, n = runs[room].pop()
                need = -(-left // each)
                if need < n:
                    runs[room].append((sequence + need, n - need))
                    n = need
            placed = min(left, n * each)
            plan.append((length, rank, placed, each, sequence, capacity - room))
            whole, rest = divmod(placed, each)
            if whole and room > each * length:
                runs[room - each * length].append((sequence, whole))
            if rest and room > rest * length:
                runs[room - rest * length].append((sequence + whole, 1))
            left, rank = left - placed, rank + placed
    return plan


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, cache_words: int = CACHE_WORDS) -> DataFrame:
    """The pieces of each text's ids and the end id, with the task that made them and their number in it by length."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(ByteEncoder, tokenizer_path, cache_words), struct.pack("<I", end_id)
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "number"]
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids, doc_id = enc.encode(text.as_py()) + end, doc_id.as_py()
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own), own, task, seen[length]))
                    seen[length] += 1
                size += len(ids)
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return id_text(docs).mapInArrow(encode, PIECES)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 1024, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Packs all documents into sequences of at most ``capacity`` tokens by best-fit decreasing.

    Returns a row for each piece: doc_id, piece (from 0), start (its document's ids before it), length,
    ids_crc32, ids (little-endian unsigned 32-bit), sequence_id, offset (place in the sequence, gapless from
    0). Null texts count as empty: the end id alone is a piece. Null and repeated doc_ids are packed row by
    row; of rows alike in every value it doesn't matter which takes which slot. Other columns are not
    read; an empty table gives an empty result. ``cache_words``: how many words a worker keeps encoded, at least.
    """
    spark = docs.sparkSession
    pieces = written(tokenized_pieces(docs, tokenizer_path, end_id, capacity, cache_words), "pieces")

    counts = written(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most

    base = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = written(counts.select("length", "task", F.coalesce(base, F.lit(0)).alias("base")), "bases")
    ranked = pieces.join(small_side(bases), ["length", "task"]).withColumn("rank", F.col("base") + F.col("number"))

    # The plan's rows are bounded by the capacity, not by the data, so it may be broadcast.
    plan = spark.createDataFrame(plan_best_fit(histogram, capacity), PLAN)
    slot = F.col("rank") - F.col("first")
    return ranked.join(F.broadcast(plan), (ranked["length"] == plan["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("count"))).select(
        "doc_id",
        "piece",
        "start",
        ranked["length"],
        "ids_crc32",
        "ids",
        (F.col("sequence") + F.floor(slot / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("offset") + (slot % F.col("each")) * ranked["length"]).cast("long").alias("offset"),
    )
