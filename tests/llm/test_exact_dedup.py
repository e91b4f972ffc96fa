import hashlib

import numpy as np
import pytest

from taxaflow.llm import exact_dedup, fuse_filter
from taxaflow.llm.exact_dedup import exact_duplicates


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 100, 5_000, 60_000])
def test_filter_holds_every_key(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**64, n, np.uint64))
    built = fuse_filter.build(keys)
    assert fuse_filter.contains(built, keys).all()
    assert fuse_filter.contains(built, rng.integers(0, 2**64, 20_000, np.uint64)).mean() < 0.02


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@pytest.mark.parametrize("bucket", [100_000, 5])
def test_against_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(exact_dedup, "BUCKET_KEYS", bucket)
    docs = [(i, ["a", "A", "É", "é", "", None, f"only {i}", "long " * 20_000][i % 8]) for i in range(100)]
    docs += [(5, "twice"), (5, "twice"), (6, "TWICE"), (None, "nobody"), (None, "Nobody"), (None, "a")]
    frame = spark.createDataFrame([(d, t, 1, "k") for d, t in docs], "doc_id long, text string, keep_id int, digest string")
    got = exact_duplicates(frame).collect()
    groups = {}
    for d, t in docs:
        groups.setdefault(lower(t), []).append(d)
    want = sorted((repr(d), repr(max((x for x in g if x is not None), default=None)), len(g), hashlib.sha256(lower(t).encode()).hexdigest()) for d, t in docs for g in [groups[lower(t)]])
    assert sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_empty(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
