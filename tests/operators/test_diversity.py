"""Diversity and rarefaction against counting by hand."""

import math
from itertools import combinations

import pytest

from taxaflow.operators.diversity import expected_richness, rarefied, sample_diversity

COUNTS = [("a", "s", 4), ("b", "s", 2), ("c", "s", 1), ("a", "t", 9), ("b", "t", 0), ("c", "u", 2), ("d", "u", 2)]


def frame(spark, rows=COUNTS):
    return spark.createDataFrame(rows, "feature_id string, sample_id string, count long")


def test_expected_richness_over_all_draws(spark):
    got = {(r.sample_id, r.depth): r.richness for r in expected_richness(frame(spark), [1, 3, 7, 9]).collect()}
    for sample in "stu":
        reads = [f for f, s, n in COUNTS if s == sample for _ in range(n)]
        for depth in (1, 3, 7, 9):
            if depth > len(reads):
                assert (sample, depth) not in got
            else:
                draws = list(combinations(reads, depth))
                assert got[sample, depth] == pytest.approx(sum(len(set(d)) for d in draws) / len(draws))


def test_rarefied(spark):
    got = {(r.sample_id, r.feature_id): r["count"] for r in rarefied(frame(spark), 4).collect()}
    of = {(s, f): n for f, s, n in COUNTS}
    for sample in "stu":
        assert sum(n for (s, _), n in got.items() if s == sample) == 4
    assert all(0 < n <= of[k] for k, n in got.items())
    assert {k for k in got if k[0] == "u"} == {("u", "c"), ("u", "d")}
    assert {r.sample_id for r in rarefied(frame(spark), 5).collect()} == {"s", "t"}
    assert rarefied(frame(spark).limit(0), 3).count() == 0
    many = frame(spark, [("a", "s", 3000), ("b", "s", 1000)])
    draws = [{r.feature_id: r["count"] for r in rarefied(many, 400, seed).collect()} for seed in (1, 2)]
    assert draws[0] != draws[1] and all(265 <= d["a"] <= 335 for d in draws)


def test_sample_diversity(spark):
    got = {r.sample_id: r for r in sample_diversity(frame(spark)).collect()}
    p = [4 / 7, 2 / 7, 1 / 7]
    h = -sum(x * math.log(x) for x in p)
    assert (got["s"].total, got["s"].richness) == (7, 3)
    assert (got["s"].shannon, got["s"].simpson, got["s"].evenness) == pytest.approx((h, 1 - sum(x * x for x in p), h / math.log(3)))
    assert (got["t"].richness, got["t"].evenness) == (1, None) and got["t"].shannon == pytest.approx(0)
    assert got["u"].evenness == pytest.approx(1)


def test_expected_richness_of_millions_of_reads(spark):
    """Exact products of 10 and 50 factors; logarithms of gamma functions of such totals lose the result."""
    rows = [(str(i), "s", 1 + i % 50) for i in range(2000)] + [("most", "s", 39_999_000)]
    got = {r.depth: r.richness for r in expected_richness(frame(spark, rows), [10, 50]).collect()}
    total = sum(n for *_, n in rows)
    for depth in (10, 50):
        exact = 0.0
        for *_, n in rows:
            log = math.fsum(math.log1p(-n / (total - i)) for i in range(depth)) if n + depth <= total - depth and n < 1e6 else None
            exact += -math.expm1(log) if log is not None else 1 - math.prod((total - n - i) / (total - i) for i in range(depth))
        assert got[depth] == pytest.approx(exact, abs=1e-8) and got[depth] <= depth


def test_few_reads_leave_their_tasks(spark, monkeypatch):
    """Of 50,000 reads somewhat more than 100 are ordered, and the first 100 by hash are drawn."""
    import hashlib
    from collections import Counter

    from taxaflow.operators import diversity

    ordered, whole = [], diversity.numbered
    monkeypatch.setattr(diversity, "numbered", lambda frame, *rest: (ordered.append(frame.count()), whole(frame, *rest))[1])
    got = {r.feature_id: r["count"] for r in rarefied(frame(spark, [("a", "s", 30_000), ("b", "s", 20_000)]), 100).collect()}
    places = sorted((hashlib.md5(f"0|s|{f}|{i}".encode()).hexdigest(), f) for f, n in (("a", 30_000), ("b", 20_000)) for i in range(1, n + 1))
    assert got == Counter(f for _, f in places[:100]) and ordered[0] < 500
