"""Local search of both strands in long targets: minimizers of target pieces, chained anchors, banded local extension."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.functions.sequences import reverse_complement
from taxaflow.operators.banded import banded_alignments, chains, letters, words
from taxaflow.session import checkpointed

PAF = "query string, query_len int, qstart int, qend int, strand string, target string, target_len int, tstart int, tend int, matches int, alnlen int, score int"
PIECE = 16_000  # bases of a piece of a target
COMMON = 1_000  # occurrences from which a minimizer is used for queries with few others only
ENOUGH = 4  # anchors at rarer minimizers that a query needs to do without frequent ones
CHANCE = 1e-6  # hits of a query that are expected by chance, from which a hit counts no more
_LAMBDA, _K = 0.55, 0.21  # of the statistics of local scores for match 2, mismatch -3 and gap -4 (Karlin and Altschul; fixed values)
_CHAIN = "score int, qlo int, qhi int, tlo int, thi int, dlo int, dhi int"


def hashed_words(seq: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes, whether the forward strand is the canonical one) of the k-mers of A, C, G and T; k is odd."""
    at, forward = words(seq, k)
    back = np.zeros_like(forward)
    rest = forward.copy()
    for _ in range(k):
        back = back << np.uint64(2) | (np.uint64(3) - (rest & np.uint64(3)))
        rest = rest >> np.uint64(2)
    h = np.minimum(forward, back)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # fixed values of a public 64-bit mixer
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return at, (h ^ (h >> np.uint64(31))).view(np.int64), forward <= back


def minimizers(seq: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of ``hashed_words`` that are the least of some w neighbours (of all, if there are fewer)."""
    at, h, forward = hashed_words(seq, k)
    if not len(h):
        return at, h, forward
    windows = np.lib.stride_tricks.sliding_window_view(h, min(w, len(h)))
    keep = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    return at[keep], h[keep], forward[keep]


def target_pieces(targets: DataFrame, overlap: int, length: int = PIECE) -> DataFrame:
    """target, target_len, piece, start, part: overlapping pieces, so that whatever is ``overlap`` long lies in one as a whole.

    targets: target, seq. A sequence is cut where it is read, whatever its length; its pieces then spread over the cluster.
    """
    step = max(1, length - overlap)
    schema = "target string, target_len int, piece int, start int, part string"

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, seq in zip(batch["target"], batch["seq"], strict=True):
                name, seq = name.as_py(), seq.as_py() or ""
                starts = range(0, max(1, len(seq) - overlap), step)
                for first in range(0, len(starts), 256):
                    some = starts[first : first + 256]
                    n = len(some)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array([len(seq)] * n, pa.int32()), pa.array(range(first, first + n), pa.int32()), pa.array(some, pa.int32()), pa.array([seq[s : s + length] for s in some], pa.string())], ["target", "target_len", "piece", "start", "part"])

    return targets.select(F.col("target").cast("string").alias("target"), F.upper("seq").alias("seq")).mapInArrow(cut, schema)


def word_table(rows: DataFrame, ids: str, seq: str, k: int, w: int | None) -> DataFrame:
    """hash, pos, forward of the minimizers (w None: of all k-mers) of a column of sequences, beside the columns ``ids`` (a schema)."""
    names = [c.split()[0] for c in ids.split(", ")]

    def take(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashed_words(letters(s.as_py() or ""), k) if w is None else minimizers(letters(s.as_py() or ""), k, w) for s in batch[seq]]
            row = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            at, h, forward = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, kind) for i, kind in enumerate((np.int64, np.int64, bool)))
            ids_of = [batch[c].take(pa.array(row)) for c in names]
            yield pa.RecordBatch.from_arrays([*ids_of, pa.array(h), pa.array(at.astype(np.int32)), pa.array(forward)], [*names, "hash", "pos", "forward"])

    return rows.select(*names, seq).mapInArrow(take, f"{ids}, hash long, pos int, forward boolean")


def anchors(q: DataFrame, t: DataFrame, k: int, common: int = COMMON, enough: int = ENOUGH) -> DataFrame:
    """query, target, piece, same (strand), qpos (on the target's strand), tpos of words in common.

    q: query, qlen, hash, pos, forward; t: target, piece, hash, pos, forward. Words with over ``common`` places in the targets are left out
    for queries with ``enough`` anchors at others; for all other queries they are joined too, in parts of about ``common`` places.
    """
    # A row of a sequence becomes many rows of words, which Spark's estimates don't see: without the hints here and below it would collect and broadcast them.
    frequent = checkpointed(t.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > common).select("hash", F.ceil(F.col("n") / common).cast("int").alias("parts")))

    def met(q: DataFrame, t: DataFrame, on: list[str]) -> DataFrame:
        both = q.select("query", "qlen", F.col("pos").alias("qpos"), F.col("forward").alias("f"), *on).join(t.select("target", "piece", F.col("pos").alias("tpos"), F.col("forward").alias("g"), *on).hint("merge"), on)
        same = F.col("f") == F.col("g")
        return both.select("query", "target", "piece", same.alias("same"), F.when(same, F.col("qpos")).otherwise(F.col("qlen") - k - F.col("qpos")).alias("qpos"), "tpos")

    rare = checkpointed(met(q, t.join(frequent, "hash", "left_anti"), ["hash"]))
    served = rare.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") >= enough)
    asked = q.join(frequent, "hash").join(served.hint("merge"), "query", "left_anti").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = t.join(frequent, "hash").withColumn("part", F.pmod(F.xxhash64("target", "piece", "pos"), F.col("parts")).cast("int"))
    return rare.unionByName(met(asked, dealt, ["hash", "part"]))


def chance_score(length: int, space: float) -> float:
    """Score that a random query of ``length`` bases reaches ``CHANCE`` times in ``space`` random bases."""
    return math.log(max(1.0, _K * length * space / CHANCE)) / _LAMBDA


def local_hits(queries: DataFrame, targets: DataFrame, k: int = 15, w: int = 10, min_chain: int = 20, min_score: int = 40, most: int = 30, secondary: bool = False, piece: int = PIECE, common: int = COMMON) -> DataFrame:
    """Rows as in PAF files (places from 0 on, end out; qstart and qend on the query's own strand) of local alignments of
    queries (query, seq) on both strands of targets (target, seq) of any length.

    All k-mers of the queries meet the (w, k)-minimizers of overlapping pieces of the targets. Of a query's chains, those that cover ``min_chain``
    bases, the ``most`` best by covered bases, are extended by a local alignment in a band around them (match 2, mismatch -3, gap -4) and
    kept from ``min_score`` on. Without ``secondary``, alignments of query bases half of which a better one of the query aligns are
    left out. Null and empty sequences have no hits. ``min_score`` alone lets chance in where targets are large, so a hit's score must also be one that a
    random query of its length has in targets of this size less than ``CHANCE`` times (E = K m n exp(-lambda score), n: bases of both strands).
    """
    q = queries.select(F.col("query").cast("string").alias("query"), F.upper("seq").alias("seq")).where(F.length("seq") >= k)
    longest = q.agg(F.max(F.length("seq"))).first()[0]
    if longest is None:
        return queries.sparkSession.createDataFrame([], PAF)
    overlap = longest + longest // 4 + 64
    pieces = checkpointed(target_pieces(targets, overlap, max(piece, 3 * overlap)))
    space = 2.0 * (pieces.where("piece = 0").agg(F.sum(F.col("target_len").cast("double"))).first()[0] or 0.0)
    own = word_table(q.withColumn("qlen", F.length("seq")), "query string, qlen int", "seq", k, None)
    places = checkpointed(word_table(pieces, "target string, piece int", "part", k, w))
    grouped = anchors(own, places, k, common).groupBy("query", "target", "piece", "same").agg(F.collect_list(F.struct("qpos", "tpos")).alias("at"))

    names = [c.split()[0] for c in _CHAIN.split(", ")]

    @F.arrow_udf(f"array<struct<{_CHAIN.replace(' ', ':').replace(',:', ',')}>>")
    def chained(lists: pa.Array) -> pa.Array:
        found = []
        for one in lists:
            at = one.values
            found.append(chains(*(at.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("qpos", "tpos")), k, min_chain))
        flat = [c for own in found for c in own]
        rows = pa.StructArray.from_arrays([pa.array([c[i] for c in flat], pa.int32()) for i in range(len(names))], names)
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), rows)

    candidates = grouped.withColumn("c", F.explode(chained("at"))).select("query", "target", "piece", "same", "c.*")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "target", "piece", "same", "tlo")
    candidates = candidates.withColumn("i", F.row_number().over(best)).where(F.col("i") <= most).drop("i", "score")

    # A window of the piece around the chain, and the band of diagonals in it.
    texts = candidates.join(q.hint("merge"), "query").join(pieces.hint("merge"), ["target", "piece"])
    margin = 8 + F.floor(F.length("seq") / 16).cast("int")
    low = F.greatest(F.lit(0), F.col("tlo") - F.col("qlo") - margin)
    high = F.col("thi") + F.length("seq") - F.col("qhi") + margin
    windows = texts.select(
        "query", "target", "same", "target_len", F.when(F.col("same"), F.col("seq")).otherwise(reverse_complement(F.col("seq"))).alias("seq"), (F.col("start") + low).alias("from"),
        F.substring("part", low + 1, high - low).alias("window"), (F.col("dlo") - low - margin).alias("dlo"), (F.col("dhi") - low + margin).alias("dhi"),
    )

    def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [f.split() for f in PAF.split(", ")]
        for batch in batches:
            c = {name: batch[name].to_pylist() for name in batch.schema.names}
            rows = []
            for i, a in enumerate(banded_alignments(c["seq"], c["window"], list(zip(c["dlo"], c["dhi"], strict=True)), local=True)):
                if a is None or a.score < max(min_score, chance_score(len(c["seq"][i]), space)):
                    continue
                n = len(c["seq"][i])
                ends = (a.qstart - 1, a.qend) if c["same"][i] else (n - a.qend, n - a.qstart + 1)
                rows.append((c["query"][i], n, *ends, "+" if c["same"][i] else "-", c["target"][i], c["target_len"][i], c["from"][i] + a.tstart - 1, c["from"][i] + a.tend, a.matches, a.columns, a.score))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if kind == "string" else pa.int32()) for v, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields])

    columns, place = [c.split()[0] for c in PAF.split(", ")], ["query", "target", "strand", "tstart", "tend"]
    once = windows.mapInArrow(extend, PAF).groupBy(place).agg(F.max(F.struct("score", *(c for c in columns if c not in place and c != "score"))).alias("b"))
    hits = checkpointed(once.select(*place, "b.*").select(*columns))
    worse = _cut_by_edges(hits) if secondary else _aligned_better(hits)
    return hits.join(worse.select(*place).distinct().hint("merge"), place, "left_anti").select(*columns)


def _cut_by_edges(hits: DataFrame) -> DataFrame:
    """Hits within the place of a better one of the same query and strand: a piece's edge cut them."""
    other = hits.select("query", "target", "strand", F.col("tstart").alias("s"), F.col("tend").alias("e"), F.col("score").alias("of"))
    return hits.join(other.hint("merge"), ["query", "target", "strand"]).where((F.col("of") > F.col("score")) & (F.col("s") <= F.col("tstart")) & (F.col("e") >= F.col("tend")))


def _aligned_better(hits: DataFrame) -> DataFrame:
    """Hits half of whose query bases a better hit of the query aligns (ties: the target, strand and place)."""
    rank = F.struct(-F.col("score"), "target", "strand", "tstart", "tend")
    other = hits.select("query", F.col("qstart").alias("s"), F.col("qend").alias("e"), rank.alias("of"))
    common = F.least("qend", "e") - F.greatest("qstart", "s")
    return hits.join(other.hint("merge"), "query").where((F.col("of") < rank) & (2 * common >= F.col("qend") - F.col("qstart")))
