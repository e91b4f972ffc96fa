"""Local search against planted reads and whole local alignments of both strands."""

import random
from itertools import product

import numpy as np
import pytest

from taxaflow.operators import banded, local_search
from taxaflow.operators.banded import Alignment, band_of, banded_alignments, chains, shared_words, words
from taxaflow.operators.local_search import local_hits, minimizers, target_pieces

TURN = str.maketrans("ACGT", "TGCA")


def turned(s):
    return s[::-1].translate(TURN)


def edited(rng, seq, edits):
    s = list(seq)
    for _ in range(edits):
        if len(s) < 2:
            break
        i = rng.randrange(len(s))
        s[i : i + 1] = rng.choice([[rng.choice("ACGT")], [], [s[i], rng.choice("ACGT")]])
    return "".join(s)


def slow_scores(q, t, local):
    score = [[0] * (len(t) + 1) for _ in range(len(q) + 1)]
    for i, j in product(range(1, len(q) + 1), range(1, len(t) + 1)):
        s = max(score[i - 1][j - 1] + (2 if q[i - 1] == t[j - 1] else -3), score[i - 1][j] - 4, score[i][j - 1] - 4)
        score[i][j] = max(0, s) if local else s
    return max(map(max, score)) if local else max([*score[-1], *(row[-1] for row in score)])


def rescored(a: Alignment):
    gaps = a.columns - a.matches - a.mism
    assert (a.qend - a.qstart + 1) + (a.tend - a.tstart + 1) == 2 * (a.matches + a.mism) + gaps and a.gapopen <= gaps
    return 2 * a.matches - 3 * a.mism - 4 * gaps


@pytest.mark.parametrize("local", [False, True])
def test_alignments_in_the_whole_band(local):
    rng, pairs = random.Random(3), [("A", "A"), ("A", "C"), ("", "A"), ("A", ""), ("AC", "CA")]
    for _ in range(120):
        q = "".join(rng.choices("ACGT", k=rng.randrange(1, 40)))
        pairs.append((q, edited(rng, q, rng.randrange(5)) if rng.random() < 0.6 else "".join(rng.choices("ACGT", k=rng.randrange(0, 40)))))
    q, t = map(list, zip(*pairs, strict=True))
    found = banded_alignments(q, t, [(-len(a), len(b)) for a, b in pairs], local)
    for a, b, one in zip(q, t, found, strict=True):
        best = slow_scores(a, b, local) if a and b else 0
        if one is None:
            assert best <= 0
        else:
            assert one.score == rescored(one) == best
            assert one == banded_alignments([a], [b], [(-len(a), len(b))], local)[0]


def test_a_band_from_shared_words_is_enough():
    """Scores in the narrow band against those of all diagonals, at 3 to 25 % of edits."""
    rng, pairs = random.Random(4), []
    for n, rate in [(80, 0.1), (250, 0.03), (250, 0.25), (600, 0.25)] * 12:
        q = "".join(rng.choices("ACGT", k=n))
        pairs.append((q, "".join(rng.choices("ACGT", k=rng.randrange(40))) + edited(rng, q, int(n * rate))))
    q, t = map(list, zip(*pairs, strict=True))
    bands = [band_of(a, b) for a, b in pairs]
    narrow = banded_alignments(q, t, bands)
    whole = banded_alignments(q, t, [(-len(a), len(b)) for a, b in pairs])
    assert sum(a.score == b.score for a, b in zip(narrow, whole, strict=True)) >= 46
    assert np.mean([high - low for low, high in bands]) < 60


def test_words_and_chains():
    at, codes = words(banded.letters("ACGTNACGTT"), 3)
    assert at.tolist() == [0, 1, 5, 6, 7] and codes[0] == codes[2]
    q, t = banded.letters("ACGTACGTTTGACC"), banded.letters("GGACGTACGTTTGACC")
    chain, = chains(*shared_words(q, t, 6), 6, 6)
    assert (chain.qlo, chain.qhi, chain.tlo, chain.thi, chain.dlo, chain.dhi) == (0, 14, 2, 16, 2, 2)
    assert chains(np.array([], int), np.array([], int), 6) == []
    twice = banded.letters("ACGTACGTTTGACC" + "A" * 40 + "ACGTACGTTTGACC")
    assert [c.dlo for c in chains(*shared_words(q, twice, 6), 6, 14)] == [0, 54]


def test_minimizers_are_of_both_strands():
    rng = random.Random(1)
    s = "".join(rng.choices("ACGT", k=400))
    at, h, forward = minimizers(banded.letters(s), 15, 10)
    at2, h2, forward2 = minimizers(banded.letters(turned(s)), 15, 10)
    assert {(int(a), int(b), bool(f)) for a, b, f in zip(at, h, forward, strict=True)} == {(400 - 15 - int(a), int(b), not f) for a, b, f in zip(at2, h2, forward2, strict=True)}
    assert np.diff(at).max() <= 10
    assert len(minimizers(banded.letters("ACGT"), 15, 10)[0]) == 0
    assert len(minimizers(banded.letters(s[:18]), 15, 10)[0]) == 1


def test_pieces_hold_every_stretch(spark):
    rows = [("a", "".join(random.Random(2).choices("ACGT", k=1234))), ("b", "ACGT"), ("c", ""), ("d", None)]
    found = target_pieces(spark.createDataFrame(rows, "target string, seq string"), 50, 200).collect()
    for name, seq in rows:
        own = sorted((r for r in found if r.target == name), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        for r in own:
            assert (r.target_len, r.part) == (len(seq or ""), (seq or "")[r.start : r.start + 200])
        for i in range(max(0, len(seq or "") - 50)):
            assert any(r.start <= i and i + 50 <= r.start + 200 for r in own)


def plant(seed=5):
    """Long targets with planted reads on both strands, cut at any place, with up to 10 % of edits; and reads of no target."""
    rng = random.Random(seed)
    targets = [(f"t{i}", "".join(rng.choices("ACGT", k=n))) for i, n in enumerate((9000, 30_000, 2500))]
    repeat = "".join(rng.choices("ACGT", k=300))
    for i in (0, 1):
        seq = targets[i][1]
        for at in range(500, 8000, 700):
            seq = seq[:at] + repeat + seq[at + 300 :]
        targets[i] = (targets[i][0], seq)
    queries, truth = [], {}
    for i in range(60):
        name, seq = targets[i % 3]
        n = rng.choice((150, 250, 450))
        at = rng.randrange(0, len(seq) - n)
        read = edited(rng, seq[at : at + n], rng.randrange(n // 10))
        strand = rng.choice("+-")
        queries.append((f"q{i}", read if strand == "+" else turned(read)))
        truth[f"q{i}"] = (name, strand, at, at + n)
    queries += [(f"none{i}", "".join(rng.choices("ACGT", k=250))) for i in range(20)] + [("short", "ACGTA"), ("empty", ""), ("null", None), ("ns", "N" * 100), ("repeat", repeat)]
    return targets, queries, truth


@pytest.mark.parametrize("common, piece", [(1000, 16_000), (3, 1500)])
def test_planted_reads_are_found_where_they_lie(spark, common, piece):
    targets, queries, truth = plant()
    q, t = spark.createDataFrame(queries, "query string, seq string"), spark.createDataFrame(targets, "target string, seq string")
    got = local_hits(q, t, common=common, piece=piece, secondary=True).collect()
    assert {r["query"] for r in got} == {*truth, "repeat"}
    of = dict(queries)
    seqs = dict(targets)
    for name, (target, strand, start, end) in truth.items():
        own = [r for r in got if r["query"] == name and r.target == target and r.strand == strand and abs(r.tstart - start) <= 25 and abs(r.tend - end) <= 25]
        assert own, name
        r = max(own, key=lambda r: r.score)
        read = of[name] if strand == "+" else turned(of[name])
        assert r.score >= 0.97 * slow_scores(read, seqs[target][start:end], True)
        assert r.matches / r.alnlen > 0.87 and r.query_len == len(read) and r.target_len == len(seqs[target])
    places = {(r.target, r.tstart) for r in got if r["query"] == "repeat"}
    assert len(places) == 22  # every copy, though each of its words is frequent


def test_coordinates_are_the_querys_own(spark):
    rng = random.Random(8)
    target = "".join(rng.choices("ACGT", k=3000))
    read = "".join(rng.choices("ACGT", k=60)) + turned(target[1000:1200]) + "".join(rng.choices("ACGT", k=20))
    r, = local_hits(spark.createDataFrame([("q", read)], "query string, seq string"), spark.createDataFrame([("t", target)], "target string, seq string")).collect()
    assert (r.strand, r.matches, r.target) == ("-", 200, "t") or r.matches > 200
    assert abs(r.qstart - 60) <= 6 and abs(r.qend - 260) <= 6 and abs(r.tstart - 1000) <= 6 and abs(r.tend - 1200) <= 6
    assert turned(read[r.qstart : r.qend])[:50] == target[r.tstart : r.tstart + 50]


def test_secondary_hits_and_empty_tables(spark):
    targets, queries, _ = plant()
    q, t = spark.createDataFrame(queries, "query string, seq string"), spark.createDataFrame(targets, "target string, seq string")
    one = local_hits(q.where("query = 'repeat'"), t).collect()
    assert len(one) == 1 and one[0].matches == 300
    assert local_hits(q.limit(0), t).count() == 0
    assert local_hits(q, t.limit(0)).count() == 0
    assert local_search.local_hits(q, t.where("target = 't2'")).columns == [c.split()[0] for c in local_search.PAF.split(", ")]


def test_hits_that_chance_gives_in_large_targets_do_not_count(spark):
    """22 bases in common reach the least score, but are expected by chance in targets of this size."""
    rng = random.Random(21)
    target = "".join(rng.choices("ACGT", k=60_000))
    read = "".join(rng.choices("ACGT", k=50)) + target[5000:5022] + "".join(rng.choices("ACGT", k=56))
    real = "".join(rng.choices("ACGT", k=30)) + target[9000:9060] + "".join(rng.choices("ACGT", k=38))
    got = local_hits(spark.createDataFrame([("chance", read), ("real", real)], "query string, seq string"), spark.createDataFrame([("t", target)], "target string, seq string")).collect()
    assert {r["query"] for r in got} == {"real"}
    assert local_search.chance_score(128, 3e7) > 44 > 40 > local_search.chance_score(20, 20)
