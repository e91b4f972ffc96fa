"""Votes of many hits: tasks hold a bounded number of them, whatever the number of shuffle partitions."""

from __future__ import annotations

from taxaflow.operators import taxonomy as T


def test_hits_are_dealt_over_as_many_tasks_as_they_need(spark, monkeypatch):
    hits = spark.createDataFrame([(q, t, 97.0 + (q + t) % 3, 100, t) for q in range(40) for t in range(5)], "query long, target long, pident double, alnlen int, position int")
    tax = spark.createDataFrame([(t, ["Life", "p", f"c{t % 2}", "o", "f", "?" if t == 3 else "g", f"s{t}"]) for t in range(5)], "ref_id long, ranks array<string>")
    plain = T.usable_hits(hits, tax)
    assert T.tasks_for(hits) == 4  # the session's partitions
    monkeypatch.setattr(T, "HITS_A_TASK", 10)
    tasks = T.tasks_for(hits)
    assert tasks == 20 and T.tasks_for(hits.limit(0)) == 4
    usable = T.usable_hits(hits, tax, tasks=tasks)
    for dealt, whole in ((T.prefix_votes(usable, tasks), T.prefix_votes(plain)), (T.lowest_common_ancestor(usable, tasks=tasks), T.lowest_common_ancestor(plain))):
        assert dealt.rdd.getNumPartitions() == 20  # of a few rows each, not joined into fewer
        assert sorted(map(str, dealt.collect())) == sorted(map(str, whole.collect()))
    found = [T.assign_by_similarity(hits.select("query"), hits, tax, tasks=n) for n in (None, tasks)]
    assert sorted(map(str, found[0].collect())) == sorted(map(str, found[1].collect()))
