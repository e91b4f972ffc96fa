"""Joins of sides that grow with the input: none is broadcast, however small Spark takes its rows to be."""

from __future__ import annotations

import random
import re

import pytest

from taxaflow.operators import curate, local_search


@pytest.fixture
def broadcasts(monkeypatch):
    """(module, frame) to the keys of the inner, left and anti joins that are broadcast on the way to a frame, also in frames that are written."""

    def of(module, make) -> list[str]:
        plans, write = [], module.checkpointed
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(module, "checkpointed", lambda df: (plans.append(plan(df)), write(df))[1])
        plans.append(plan(make()))
        return [f"{key} {kind}" for p in plans for key, kind in re.findall(r"BroadcastHashJoin \[(\w+)#\d+L?[^\]]*\], \[[^\]]*\], (\w+)", p)]

    return of


def written(spark, folder, name, rows, schema):
    """As read from a file, whose size Spark knows."""
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


def test_words_and_pieces_of_a_local_search_are_not_broadcast(spark, broadcasts, tmp_path):
    rng = random.Random(1)
    text = "".join(rng.choices("ACGT", k=2_000))
    queries = written(spark, tmp_path, "q", [(str(i), text[i * 90 : i * 90 + 80]) for i in range(20)], "query string, seq string")
    targets = written(spark, tmp_path, "t", [("t", text)], "target string, seq string")
    found = broadcasts(local_search, lambda: local_search.local_hits(queries, targets))
    assert set(found) <= {"hash LeftAnti", "hash Inner"} and found.count("hash Inner") <= 2  # words with over COMMON places, a thousandth of all at most


def test_features_of_a_merge_report_are_not_broadcast(spark, broadcasts, tmp_path):
    counts = written(spark, tmp_path, "c", [(f, s, 10 + f % 3 + s) for f in range(30) for s in range(f % 4, 8)], "feature_id long, sample_id long, count long")
    tax = written(spark, tmp_path, "t", [(f, ["a", "b", f"c{f % 2}"]) for f in range(30)], "feature_id long, ranks array<string>")
    features = written(spark, tmp_path, "f", [(f, f % 5, f) for f in range(30)], "feature_id long, g long, value long")
    found = broadcasts(curate, lambda: curate.merge_alike_in_groups(counts, tax, features, ["g"])[1])
    found += broadcasts(curate, lambda: curate.parent_pairs_in_groups(curate.profiles(counts), features, ["g"], lambda a, b: 100 - abs(a - b) % 20))
    found += broadcasts(curate, lambda: curate.cooccurrence_in_groups(counts, features, ["g"]))
    assert not [f for f in found if f.split()[0] in ("feature_id", "node")]


def test_reads_off_target_are_found_without_broadcasts(spark, broadcasts):
    """The whole query, on tables whose files are small beside what is made of them."""
    import __spark_entry__

    found = broadcasts(local_search, lambda: __spark_entry__.queries()["offtarget_reads"](spark, "/root/testdata/sf0.001"))
    assert not [f for f in found if f.split()[0] in ("query", "target")] and found.count("hash Inner") <= 2
