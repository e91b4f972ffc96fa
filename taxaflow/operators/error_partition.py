"""Denoising with error rates by base change and quality: rates learned per run, uniques parted by abundance p-values.

After the published model (Callahan et al., 2016): a center of n reads makes a unique sequence with the product of the
rates of its bases, given the qualities; a unique sequence too abundant for what its center makes becomes a center itself. Rates are
learned on a bounded sample of each run, alternating with partitions of the sample; the whole run is then parted on Spark, where
each round every partition may give one new center, so rounds grow with the depth of that tree and not with the number of centers. As in
the published model, gaps have no rates: a sequence that differs from a center by gaps only is read as the center's.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.operators.banded import _CODES, banded_alignments, letters, words
from taxaflow.session import checkpointed

QUALITIES = 94  # 0 to 93
SAMPLE_BASES = 50_000_000  # of a run that rates are learned on, about
NEW_CENTER = 1e-40  # p-value, times the run's uniques, below which a unique is no error
CORRECTED = 1e-40  # p-value below which a unique is in no partition's counts
SCREEN, SCREEN_K = 0.42, 5  # share of 5-mers that differ beyond which a pair is not compared
GAPLESS = 6  # mismatches up to which sequences of one length are compared without gaps
BAND = 16
LEARNING_ROUNDS, SHUFFLES = 10, 10
LEAST_RATE, MOST_RATE = 1e-7, 0.25
NEVER = -1e300  # logarithm of what is not compared


def log_tail(size: int, expected: float, conditional: bool = True) -> float:
    """log P(X >= size) of a Poisson number, given X >= 1 if ``conditional``; 0 where it is not small."""
    if conditional and size <= 1:
        return 0.0
    if expected <= 0:
        return NEVER
    if expected >= size:
        return 0.0
    total, term, i = 1.0, 1.0, size
    while term > 1e-17 * total:
        i += 1
        term *= expected / i
        total += term
    log = size * math.log(expected) - expected - math.lgamma(size + 1) + math.log(total)
    return min(0.0, log - math.log(-math.expm1(-expected)) if conditional else log)


class Uniques:
    """A block of sequences of A, C, G and T with their qualities, held against centers one by one."""

    def __init__(self, seqs: list[str], quals: list):
        self.seqs = seqs
        self.n = np.array([len(s) for s in seqs])
        width = int(self.n.max(initial=1))
        self.bases = np.full((len(seqs), width), 4, np.uint8)
        self.quals = np.zeros((len(seqs), width), np.int16)
        counts = np.zeros((len(seqs), 4**SCREEN_K), np.uint8)
        for i, (s, q) in enumerate(zip(seqs, quals, strict=True)):
            self.bases[i, : len(s)] = _CODES[letters(s)]
            self.quals[i, : len(s)] = np.clip(np.asarray(q)[: len(s)], 0, QUALITIES - 1)
            counts[i] = np.minimum(np.bincount(words(letters(s), SCREEN_K)[1].astype(int), minlength=4**SCREEN_K), 255)
        self.counts = counts

    def compared(self, center: str) -> tuple[np.ndarray, np.ndarray]:
        """Rows that are near enough to the center, and the center's bases under theirs (their own base where there is none)."""
        own = np.minimum(np.bincount(words(letters(center), SCREEN_K)[1].astype(int), minlength=4**SCREEN_K), 255).astype(np.uint8)
        shared = np.minimum(self.counts, own).sum(1, dtype=np.int64)
        rows = np.flatnonzero(shared >= (1 - SCREEN) * np.maximum(1, np.minimum(self.n, len(center)) - SCREEN_K + 1))
        under = self.bases[rows].copy()
        code = _CODES[letters(center)]
        flat = self.n[rows] == len(center)
        flat[flat] = (self.bases[rows[flat], : len(center)] != code).sum(1) <= GAPLESS
        under[np.flatnonzero(flat)[:, None], np.arange(len(center))] = code
        rest = np.flatnonzero(~flat)
        if len(rest):
            places: dict[int, np.ndarray] = {}
            seqs = [self.seqs[rows[i]] for i in rest]
            bands = [(min(0, len(center) - len(s)) - BAND, max(0, len(center) - len(s)) + BAND) for s in seqs]
            banded_alignments(seqs, [center] * len(seqs), bands, match=5, mismatch=-4, gap=-8, places=places)
            for k, i in enumerate(rest):
                at = places.get(k, np.full(len(seqs[k]), -1))
                under[i, np.flatnonzero(at >= 0)] = code[at[at >= 0]]
        return rows, under

    def log_rates(self, center: str, log_errors: np.ndarray) -> np.ndarray:
        """log of the probability that a read of the center is read as each sequence. log_errors: (from * 4 + to, quality)."""
        out = np.full(len(self.seqs), NEVER)
        rows, under = self.compared(center)
        mine, q = self.bases[rows], self.quals[rows]
        real = mine < 4
        rates = log_errors[np.where(real, under * 4 + mine, 0), q]
        out[rows] = np.where(real, rates, 0.0).sum(1)
        return out

    def changes(self, center: str, weights: np.ndarray) -> np.ndarray:
        """Reads by (base of the center * 4 + base, quality) over all sequences near enough to the center."""
        rows, under = self.compared(center)
        mine, q = self.bases[rows], self.quals[rows]
        real = mine < 4
        at = (np.where(real, under * 4 + mine, 0).astype(np.int64) * QUALITIES + q)[real]  # letters are bytes, which the product would overflow
        return np.bincount(at, weights=np.broadcast_to(weights[rows][:, None], mine.shape)[real], minlength=16 * QUALITIES).reshape(16, QUALITIES)


def smoothed_rates(changes: np.ndarray) -> np.ndarray:
    """(16, qualities) rates of changes: for each change of base the logarithm of its share by quality, smoothed by local quadratics
    (the nearest three quarters of the qualities seen, tricube weights times reads), within ``LEAST_RATE`` and ``MOST_RATE``."""
    rates = np.zeros((16, QUALITIES))
    for a in range(4):
        total = changes[4 * a : 4 * a + 4].sum(0)
        seen = np.flatnonzero(total)
        for b in range(4):
            if a == b:
                continue
            if not len(seen):
                rates[4 * a + b] = LEAST_RATE
                continue
            y = np.log10((changes[4 * a + b][seen] + 1) / total[seen])
            fit = np.array([_local(seen, y, total[seen], x) for x in seen])
            rates[4 * a + b] = np.clip(10 ** np.interp(np.arange(QUALITIES), seen, fit), LEAST_RATE, MOST_RATE)
        rates[5 * a] = 1 - rates[[4 * a + b for b in range(4) if b != a]].sum(0)
    return rates


def _local(x: np.ndarray, y: np.ndarray, weights: np.ndarray, at: int) -> float:
    n = max(min(len(x), 3), math.ceil(0.75 * len(x)))
    far = np.sort(np.abs(x - at))[n - 1] * 1.0001 + 1e-9
    w = np.sqrt(np.clip(1 - (np.abs(x - at) / far) ** 3, 0, None) ** 3 * weights)
    powers = np.vander(x - at, min(3, int((w > 0).sum())), increasing=True).astype(float)
    return float(np.linalg.lstsq(powers * w[:, None], y * w, rcond=None)[0][0])


def partition(block: Uniques, sizes: np.ndarray, errors: np.ndarray | None) -> np.ndarray:
    """For each sequence the row of its center. errors None: all around the most abundant one."""
    first = min(range(len(sizes)), key=lambda i: (-sizes[i], block.seqs[i]))
    owner = np.full(len(sizes), first)
    if errors is None:
        return owner
    log_errors = np.log(errors)
    centers = [first]
    table = [block.log_rates(block.seqs[first], log_errors)]
    while True:
        at = {c: k for k, c in enumerate(centers)}
        for _ in range(SHUFFLES):
            reads = np.bincount(owner, weights=sizes, minlength=len(sizes))[centers]
            with np.errstate(divide="ignore"):
                likely = np.array(table) + np.log(reads)[:, None]
            best = np.array(centers)[_first_best(likely, [block.seqs[c] for c in centers])]
            best[likely.max(0) < NEVER / 2] = first
            best[centers] = centers
            if (best == owner).all():
                break
            owner = best
        reads = np.bincount(owner, weights=sizes, minlength=len(sizes))
        found: dict[int, tuple] = {}
        for i in range(len(sizes)):
            if i in at:
                continue
            rate = table[at[owner[i]]][i]
            p = log_tail(int(sizes[i]), math.exp(rate) * reads[owner[i]] if rate > NEVER / 2 else 0.0)
            if p + math.log(len(sizes)) < math.log(NEW_CENTER):
                found[owner[i]] = min(found.get(owner[i], (1.0,)), (p, -sizes[i], block.seqs[i], i))
        if not found:
            return owner
        for *_, i in sorted(found.values()):
            centers.append(i)
            table.append(block.log_rates(block.seqs[i], log_errors))
            owner[i] = i


def _first_best(likely: np.ndarray, names: list[str]) -> np.ndarray:
    """Row of the greatest value in each column; of equal ones that of the first name."""
    order = np.array(sorted(range(len(names)), key=names.__getitem__))
    return order[likely[order].argmax(0)]


def learn_rates(seqs: list[str], quals: list, sizes: list[int]) -> np.ndarray:
    """Rates of changes on a sample's uniques: partition and rates by turns, from all around one center, until rates stay."""
    block, n = Uniques(seqs, quals), np.array(sizes, float)
    errors = None
    for _ in range(LEARNING_ROUNDS):
        owner = partition(block, n, errors)
        changes = np.zeros((16, QUALITIES))
        for c in np.unique(owner):
            changes += block.changes(block.seqs[c], np.where(owner == c, n, 0.0))
        new = smoothed_rates(changes)
        if errors is not None and np.allclose(new, errors, rtol=1e-6, atol=0):
            break
        errors = new
    return errors


HELD = 2_000_000  # places whose sums a task holds at once


def quality_uniques(reads: DataFrame) -> DataFrame:
    """run, unique_id, seq, size, quals (means by place, rounded) of reads (run, seq, quals) of A, C, G and T only.

    Qualities are summed by sequence and place in tasks first, ``HELD`` places at once, so a sequence of any number of reads is a few rows a task; only these sums are opened by place."""
    able = reads.where(F.col("seq").rlike("^[ACGT]+$") & (F.size("quals") > 0)).select("run", "seq", F.transform("quals", lambda q: q.cast("long")).alias("quals"))
    kind = able.schema["run"].dataType.simpleString()

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[np.ndarray]] = {}
        places = 0

        def handed_on() -> pa.RecordBatch:
            runs, seqs = zip(*held, strict=True)
            sums, n = (pa.array([v[i].tolist() for v in held.values()], pa.list_(pa.int64())) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(runs, run_type), pa.array(seqs, pa.string()), sums, n], ["run", "seq", "q", "n"])

        for batch in batches:
            run_type, runs, seqs = batch["run"].type, batch["run"].dictionary_encode(), batch["seq"].dictionary_encode()
            run_names, seq_names = runs.dictionary.to_pylist(), seqs.dictionary.to_pylist()
            both = runs.indices.fill_null(len(run_names)).to_numpy().astype(np.int64) * len(seq_names) + seqs.indices.to_numpy()
            keys, own = np.unique(both, return_inverse=True)
            lengths = batch["quals"].value_lengths().to_numpy().astype(np.int64)
            flat = batch["quals"].flatten().fill_null(0).to_numpy()
            widths = np.zeros(len(keys), np.int64)
            np.maximum.at(widths, own, lengths)
            first = np.cumsum(widths) - widths
            at = np.repeat(first[own] - np.cumsum(lengths) + lengths, lengths) + np.arange(len(flat))
            n = np.bincount(at, minlength=int(widths.sum()))
            sums = np.zeros(len(n), np.int64)
            np.add.at(sums, at, flat)
            for key, start, width in zip(keys.tolist(), first.tolist(), widths.tolist(), strict=True):
                name = ([*run_names, None][key // len(seq_names)], seq_names[key % len(seq_names)])
                new = [sums[start : start + width], n[start : start + width]]
                if (old := held.get(name)) is not None:
                    if len(old[0]) < width:
                        old[:] = [np.pad(x, (0, width - len(x))) for x in old]
                    for x, y in zip(old, new, strict=True):
                        x[:width] += y
                else:
                    held[name] = [x.copy() for x in new]
                    places += width
                if places > HELD:
                    yield handed_on()
                    held, places = {}, 0
        if held:
            yield handed_on()

    sums = able.mapInArrow(summed, f"run {kind}, seq string, q array<bigint>, n array<bigint>")
    places = sums.select("run", "seq", F.posexplode(F.arrays_zip("q", "n")).alias("pos", "s")).groupBy("run", "seq", "pos").agg(F.sum("s.q").alias("q"), F.sum("s.n").alias("n"))
    gathered = places.groupBy("run", "seq").agg(F.max("n").alias("size"), F.array_sort(F.collect_list(F.struct("pos", F.round(F.col("q") / F.col("n")).cast("int").alias("q")))).alias("at"))
    return gathered.select("run", F.sha1("seq").alias("unique_id"), "seq", "size", F.transform("at", lambda x: x["q"]).alias("quals"))


def run_rates(reads: DataFrame, sample_bases: int = SAMPLE_BASES) -> DataFrame:
    """run, rates (16 * qualities numbers) of each run, learned on about ``sample_bases`` bases of it: reads whose hash (read_id, seq) is
    low enough, all of them in smaller runs. A run's sample is one task's. reads: run, read_id, seq, quals."""
    bases = reads.groupBy("run").agg(F.sum(F.length("seq")).alias("bases"))
    share = F.pmod(F.xxhash64("read_id", "seq"), F.lit(1_000_000)) < F.col("sample") * 1_000_000
    sampled = reads.join(F.broadcast(bases.select("run", (F.lit(float(sample_bases)) / F.col("bases")).alias("sample"))), "run").where(share)

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        rates = learn_rates(table["seq"].to_pylist(), table["quals"].to_pylist(), table["size"].to_pylist())
        return pa.table({"run": table["run"][:1], "rates": pa.array([rates.ravel().tolist()], pa.list_(pa.float64()))})

    uniques = quality_uniques(sampled).withColumn("run", F.col("run").cast("string"))
    return uniques.groupBy("run").applyInArrow(learn, "run string, rates array<double>")


def _rates_of(uniques: DataFrame, centers: dict[str, list[tuple[str, str]]], errors: dict[str, np.ndarray]) -> DataFrame:
    """run, unique_id, center, rate of the uniques of each run and its new centers, of pairs near enough."""
    logs = {run: np.log(e) for run, e in errors.items()}

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = np.array(batch["run"].to_pylist(), object)
            for run in sorted(set(runs) & set(centers)):
                rows = batch.take(pa.array(np.flatnonzero(runs == run)))
                block, ids = Uniques(rows["seq"].to_pylist(), rows["quals"].to_pylist()), rows["unique_id"]
                for center, seq in centers[run]:
                    rates = block.log_rates(seq, logs[run])
                    near = np.flatnonzero(rates > NEVER / 2)
                    yield pa.RecordBatch.from_arrays([pa.array([run] * len(near), pa.string()), ids.take(pa.array(near)), pa.array([center] * len(near), pa.string()), pa.array(rates[near])], ["run", "unique_id", "center", "rate"])

    return uniques.select("run", "unique_id", "seq", "quals").mapInArrow(rate, "run string, unique_id string, center string, rate double")


def _log_tails(conditional: bool):
    @F.arrow_udf("double")
    def tails(size: pa.Array, expected: pa.Array) -> pa.Array:
        return pa.array([log_tail(s, e, conditional) for s, e in zip(size.to_pylist(), expected.to_pylist(), strict=True)], pa.float64())

    return tails


def denoised_runs(uniques: DataFrame, rates: DataFrame) -> DataFrame:
    """run, unique_id, size, center (a unique_id), corrected: the partition of each run's uniques (run, unique_id, seq, size, quals).

    Each round, uniques join the center that makes them most likely, and the least likely unique of each partition becomes a center if its p-value times
    the run's uniques is below ``NEW_CENTER``. Not corrected are uniques too abundant for their center in the end, and those that are
    compared with none. What comes to the driver are the rates of the runs and the new centers of a round, features of the result.
    """
    errors = {r["run"]: np.array(r["rates"]).reshape(16, QUALITIES) for r in rates.collect()}
    uniques = checkpointed(uniques.withColumn("run", F.col("run").cast("string")))
    totals = F.broadcast(uniques.groupBy("run").agg(F.count("*").alias("uniques")))
    most = uniques.groupBy("run").agg(F.min_by(F.struct("unique_id", "seq"), F.struct(-F.col("size"), "seq")).alias("c"))
    new = most.select("run", "c.*").collect()
    firsts = F.broadcast(most.select("run", F.col("c.unique_id").alias("first")))
    seqs = uniques.select("run", F.col("unique_id").alias("center"), F.col("seq").alias("center_seq"))
    pairs: DataFrame | None = None
    owner = uniques.join(firsts, "run").select("run", "unique_id", F.col("first").alias("center"))
    while True:
        by_run: dict[str, list[tuple[str, str]]] = {}
        for r in sorted(new):
            by_run.setdefault(r["run"], []).append((r["unique_id"], r["seq"]))
        found = _rates_of(uniques, by_run, errors)
        added = found.join(seqs, ["run", "center"])
        pairs = checkpointed(added if pairs is None else pairs.unionByName(added))
        centers = pairs.select("run", F.col("center").alias("unique_id")).distinct().withColumn("own", F.col("unique_id"))
        owner = owner.join(centers, ["run", "unique_id"], "left").select("run", "unique_id", F.coalesce("own", "center").alias("center"))
        for _ in range(SHUFFLES):
            reads = owner.join(uniques.select("run", "unique_id", "size"), ["run", "unique_id"]).groupBy("run", "center").agg(F.sum("size").alias("reads"))
            likely = pairs.join(reads, ["run", "center"]).withColumn("log", F.col("rate") + F.ln("reads"))
            best = likely.groupBy("run", "unique_id").agg(F.min_by("center", F.struct(-F.col("log"), "center_seq")).alias("best"))
            moved = owner.join(best, ["run", "unique_id"], "left").join(centers, ["run", "unique_id"], "left").join(firsts, "run")
            moved = checkpointed(moved.select("run", "unique_id", F.coalesce("own", "best", "first").alias("center"), F.col("center").alias("was")))
            owner = moved.select("run", "unique_id", "center")
            if moved.where("center <> was").isEmpty():
                break
        reads = owner.join(uniques.select("run", "unique_id", "size"), ["run", "unique_id"]).groupBy("run", "center").agg(F.sum("size").cast("double").alias("reads"))
        state = owner.join(uniques, ["run", "unique_id"]).join(reads, ["run", "center"]).join(pairs.select("run", "unique_id", "center", "rate"), ["run", "unique_id", "center"], "left")
        state = state.withColumn("expected", F.coalesce(F.exp("rate") * F.col("reads"), F.lit(0.0)))
        odd = state.where("unique_id <> center AND size > 1").withColumn("p", _log_tails(True)("size", "expected")).join(totals, "run")
        odd = odd.where(F.col("p") + F.ln("uniques") < math.log(NEW_CENTER))
        place = Window.partitionBy("run", "center").orderBy("p", F.desc("size"), "seq")
        new = odd.withColumn("i", F.row_number().over(place)).where("i = 1").select("run", "unique_id", "seq").collect()
        if not new:
            break
    end = state.withColumn("p", _log_tails(False)("size", "expected"))
    return end.select("run", "unique_id", "seq", "size", "center", ((F.col("unique_id") == F.col("center")) | (F.col("p") >= math.log(CORRECTED))).alias("corrected"))
