"""Partition by learned error rates against a slow version, and rates against those that reads were made with."""

import math
import random

import numpy as np
import pytest

from taxaflow.operators import error_partition as E
from taxaflow.operators.error_partition import QUALITIES, Uniques, denoised_runs, learn_rates, log_tail, partition, quality_uniques, run_rates, smoothed_rates


def run_reads(seed, variants, reads, low=28, high=38):
    """Reads of a few true variants (name, share), with qualities that fall along them and errors as the qualities say."""
    rng, out = random.Random(seed), []
    for i in range(reads):
        seq = rng.choices([v for v, _ in variants], [w for _, w in variants])[0]
        quals = [low + (high - low) * (len(seq) - k) // len(seq) + rng.randrange(-1, 2) for k in range(len(seq))]
        read = "".join(rng.choice("ACGT".replace(c, "")) if rng.random() < 10 ** (-q / 10) else c for c, q in zip(seq, quals, strict=True))
        out.append((f"r{i}", read, quals))
    return out


def variants(seed, n=60):
    """Three variants, two of which differ at one base, and one that lacks a base of another: the model has no rates for gaps, so it is no variant."""
    rng = random.Random(seed)
    a, b = ("".join(rng.choices("ACGT", k=n)) for _ in range(2))
    near = a[:30] + "ACGT"[("ACGT".index(a[30]) + 1) % 4] + a[31:]
    return [(a, 10), (near, 3), (b, 4), (b[:20] + b[21:], 2)]


def test_tails_of_poisson_numbers():
    for size, expected in ((2, 0.5), (5, 1.0), (30, 3.0), (100, 20.0)):
        tail = 1 - sum(math.exp(-expected) * expected**k / math.factorial(k) for k in range(size)) if size < 20 else None
        if tail:
            assert log_tail(size, expected, False) == pytest.approx(math.log(tail), rel=1e-6)
            assert log_tail(size, expected) == pytest.approx(math.log(tail / (1 - math.exp(-expected))), rel=1e-6)
    exact = sum(math.exp(k * math.log(3) - 3 - math.lgamma(k + 1)) for k in range(30, 200))
    assert log_tail(30, 3.0, False) == pytest.approx(math.log(exact), rel=1e-9)
    assert log_tail(1, 1e-9) == 0 and log_tail(5, 9.0) == 0 and log_tail(2, 0.0) == E.NEVER and log_tail(10**6, 10.0) < -1e6


def nominal():
    rates = np.zeros((16, QUALITIES))
    for q in range(QUALITIES):
        e = min(0.25, max(1e-7, 10 ** (-q / 10) / 3))
        for i in range(4):
            for j in range(4):
                rates[4 * i + j, q] = 1 - 3 * e if i == j else e
    return rates


def slow_log_rate(seq, quals, center, errors):
    """Of sequences of one length, or with one base lost, by plain loops."""
    if len(seq) == len(center):
        under = center
    elif len(seq) == len(center) - 1:
        _, under = max((sum(x == y for x, y in zip(seq, center[:i] + center[i + 1 :], strict=True)), center[:i] + center[i + 1 :]) for i in range(len(center)))
    else:
        return None
    return sum(math.log(errors["ACGT".index(c) * 4 + "ACGT".index(s), q]) for s, c, q in zip(seq, under, quals, strict=True))


def test_log_rates_by_plain_loops():
    reads = run_reads(3, variants(1), 60)
    block, errors = Uniques([r[1] for r in reads], [r[2] for r in reads]), nominal()
    for center, _ in variants(1):
        got = block.log_rates(center, np.log(errors))
        seen = 0
        for (_, seq, quals), rate in zip(reads, got, strict=True):
            want = slow_log_rate(seq, quals, center, errors)
            if want is not None and rate > E.NEVER / 2:
                differ = sum(a != b for a, b in zip(seq, center, strict=False))
                if len(seq) != len(center) or differ <= 6:
                    seen += 1
                    assert rate == pytest.approx(want)
        assert seen > 5


def slow_partition(rows, errors):
    """The same rules by plain loops over all pairs (sequences of one length). rows: seq, quals, size."""
    first = min(range(len(rows)), key=lambda i: (-rows[i][2], rows[i][0]))
    owner, centers = {i: first for i in range(len(rows))}, [first]
    block = Uniques([r[0] for r in rows], [r[1] for r in rows])
    rate = {}

    def fill(c):
        for i, x in enumerate(block.log_rates(rows[c][0], np.log(errors)).tolist()):
            rate[i, c] = x

    fill(first)
    while True:
        for _ in range(10):
            reads = {c: sum(rows[i][2] for i in owner if owner[i] == c) for c in centers}
            new = {}
            for i in owner:
                able = [c for c in centers if rate[i, c] > E.NEVER / 2]
                new[i] = i if i in centers else min(able, key=lambda c: (-(rate[i, c] + np.log(reads[c])), rows[c][0])) if able else first
            moved, owner = new != owner, new
            if not moved:
                break
        reads = {c: sum(rows[i][2] for i in owner if owner[i] == c) for c in centers}
        odd = {}
        for i, c in owner.items():
            if i not in centers:
                p = log_tail(rows[i][2], math.exp(rate[i, c]) * reads[c] if rate[i, c] > E.NEVER / 2 else 0.0)
                if p + math.log(len(rows)) < math.log(1e-40):
                    odd.setdefault(c, []).append((p, -rows[i][2], rows[i][0], i))
        if not odd:
            return owner
        for found in odd.values():
            i = min(found)[-1]
            centers.append(i)
            owner[i] = i
            fill(i)


def test_partitions_on_spark_agree_with_slow_ones_and_the_truth(spark):
    runs = {"one": (variants(1), run_reads(1, variants(1), 1500)), "two": (variants(2), run_reads(2, variants(2), 900, 25, 36))}
    rows = [(run, name, seq, quals) for run, (_, reads) in runs.items() for name, seq, quals in reads] + [("one", "n", "ACGTN", [30] * 5), ("one", "e", "", [])]
    frame = spark.createDataFrame(rows, "run string, read_id string, seq string, quals array<int>").repartition(5)
    uniques = quality_uniques(frame).cache()
    rates = run_rates(frame)
    learned = {r["run"]: np.array(r["rates"]).reshape(16, QUALITIES) for r in rates.collect()}
    got = {}
    for r in denoised_runs(uniques, rates).collect():
        got.setdefault(r["run"], {})[r.seq] = (r.center, r["size"], r.corrected)
    for run, (true, reads) in runs.items():
        own = {}
        for _, seq, quals in reads:
            own.setdefault(seq, []).append(quals)
        table = sorted((seq, [int(math.floor(sum(q) / len(q) + 0.5)) for q in zip(*found, strict=True)], len(found)) for seq, found in own.items())
        assert {seq: size for seq, (_, size, _) in got[run].items()} == {seq: size for seq, _, size in table}
        seqs, quals, sizes = map(list, zip(*table, strict=True))
        assert np.allclose(learned[run], learn_rates(seqs, quals, sizes))
        slow = slow_partition(table, learned[run])
        quick = partition(Uniques(seqs, quals), np.array(sizes, float), learned[run])
        assert quick.tolist() == [slow[i] for i in range(len(table))]
        ids = {r.unique_id: r.seq for r in uniques.where(f"run = '{run}'").collect()}
        assert {seq: ids[center] for seq, (center, _, _) in got[run].items()} == {seqs[i]: seqs[c] for i, c in slow.items()}
        assert {seqs[c] for c in slow.values()} == {v for v, _ in true[:3]}  # each true variant, and no error
        assert sum(size for _, size, ok in got[run].values() if ok) > 0.97 * len(reads)
        # rates fall as the qualities say: about 10 ** (-q / 10) / 3 a base, and one read more than was seen
        off = [np.mean([learned[run][4 * i + j, q] for i in range(4) for j in range(4) if i != j]) for q in (28, 36)]
        assert off[0] > off[1] and all(10 ** (-q / 10) / 3 / 5 < x < 8 * 10 ** (-q / 10) / 3 for x, q in zip(off, (28, 36), strict=True))


def test_smoothing():
    changes = np.zeros((16, QUALITIES))
    for q in range(10, 41):
        for i in range(4):
            for j in range(4):
                changes[4 * i + j, q] = 1e6 if i == j else 1e6 * 10 ** (-q / 10)
    rates = smoothed_rates(changes)
    assert np.allclose(rates.reshape(4, 4, -1).sum(1), 1)
    assert rates[1, 25] == pytest.approx(10**-2.5, rel=0.05) and rates[1, 5] == rates[1, 10] and rates[1, 60] == rates[1, 40]
    assert (smoothed_rates(np.zeros((16, QUALITIES)))[1] == E.LEAST_RATE).all()


def test_small_samples_learn_on_a_part(spark):
    reads = run_reads(1, variants(1), 1500)
    frame = spark.createDataFrame([("x", *r) for r in reads], "run string, read_id string, seq string, quals array<int>")
    (row,) = run_rates(frame, 30_000).collect()
    rates = np.array(row.rates).reshape(16, QUALITIES)
    assert np.allclose(rates.reshape(4, 4, -1).sum(1), 1) and rates[1, 29] > rates[1, 36]


def test_a_run_with_learned_errors(spark):
    """As a clusterer of whole runs: variants of two runs meet on their sequences, and a chimera of one run goes."""
    from taxaflow.plans.amplicon import RunOptions, denoise_by_errors

    true = variants(1)[:3]
    chimera = true[0][0][:25] + true[2][0][25:]
    reads = [("one", *r) for r in run_reads(1, [*true, (chimera, 1)], 1200)] + [("two", *r) for r in run_reads(5, true[:2], 600)]
    frame = spark.createDataFrame(reads, "run string, read_id string, seq string, quals array<int>")
    got = {r.seq: r["size"] for r in denoise_by_errors(frame, RunOptions(clusterer="dada")).collect()}
    assert set(got) == {v for v, _ in true}
    assert got[true[0][0]] > 0.97 * sum(10 / 18 if run == "one" else 10 / 13 for run, *_ in reads) * 0.9


def test_quality_sums_in_parts(spark, monkeypatch):
    """Sums by sequence that a task hands on in parts, of lists of several lengths, are those of all reads by place."""
    from taxaflow.operators import error_partition

    monkeypatch.setattr(error_partition, "HELD", 10)
    rows = [(f"r{i % 2}", ("ACGT", "ACGTT", "GGGG")[i % 3], [i % 40] * (4 + (i % 3 == 1) - (i % 7 == 0))) for i in range(60)] + [("r0", "ACGN", [1] * 4), ("r0", "ACGT", None), ("r0", "ACGT", [])]
    got = {(r.run, r.seq): (r["size"], r.quals) for r in error_partition.quality_uniques(spark.createDataFrame(rows, "run string, seq string, quals array<int>").coalesce(1)).collect()}
    own = {}
    for run, seq, quals in rows:
        if quals and "N" not in seq:
            own.setdefault((run, seq), []).append(quals)
    for key, lists in own.items():
        size, quals = got.pop(key)
        assert size == len(lists)
        for place, q in enumerate(quals):
            there = [x[place] for x in lists if len(x) > place]
            assert abs(q - sum(there) / len(there)) <= 0.5
    assert not got


def test_changes_of_all_bases_and_qualities_are_counted_where_they_are():
    """Numbers of changes and qualities go beyond a byte, in which letters are held."""
    center = "ACGT" * 10
    reads = [center[:i] + x + center[i + 1 :] for i in (4, 5, 6, 7) for x in "ACGT"]
    quals = [[(7 * i + p) % 41 for p in range(40)] for i in range(len(reads))]
    weights = np.arange(1.0, len(reads) + 1)
    want = np.zeros((16, QUALITIES))
    for read, own, n in zip(reads, quals, weights, strict=True):
        for x, y, q in zip(center, read, own, strict=True):
            want["ACGT".index(x) * 4 + "ACGT".index(y), q] += n
    assert (Uniques(reads, quals).changes(center, weights) == want).all()
