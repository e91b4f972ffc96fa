import random

import pytest

from taxaflow.llm.sharding import shard_documents


def check(rows, docs, shards, slack):
    size = lambda t: len((t or "").encode()) + 16
    assert sorted((repr(r.doc_id), r.text, r.size) for r in rows) == sorted((repr(d), t or "", size(t)) for d, t in docs)
    total = sum(r.size for r in rows)
    for s in range(shards):
        own = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= slack
    assert all(0 <= r.shard < shards for r in rows)


@pytest.mark.parametrize("parts", [1, 3])
def test_equal_bytes_with_a_hot_text(spark, parts):
    rng = random.Random(1)
    docs = [(i, "hot text") if i % 3 == 0 else (i, f"{i} " * rng.randint(0, 30)) for i in range(6_000)]
    docs += [(None, "null id"), (None, None), (7, ""), (7, ""), (8, "é" * 300)]
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, hash int, part string").repartition(7)
    total = sum(len((t or "").encode()) + 16 for _, t in docs)
    rows = shard_documents(frame, 10, parts=parts).collect()
    check(rows, docs, 10, total / 10 * 0.01 + 700)
    of = {}
    for r in rows:
        of.setdefault(r.text, set()).add(r.shard)
    assert sum(len(s) > 1 for s in of.values()) <= 9  # only groups that a boundary has to cut
    again = shard_documents(frame.repartition(3), 10, parts=parts).collect()
    assert {(r.doc_id, r.text): r.shard for r in rows} == {(r.doc_id, r.text): r.shard for r in again}


def test_one_key_only(spark):
    docs = [(5, "same")] * 100
    rows = shard_documents(spark.createDataFrame(docs, "doc_id long, text string"), 4).collect()
    assert len(rows) == 100
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in range(4))


def test_few_and_none(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert shard_documents(frame, 40).count() == 2
    assert shard_documents(frame.limit(0), 40).count() == 0
