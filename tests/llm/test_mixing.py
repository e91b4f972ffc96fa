"""Mixing against its SQL, a slow version of the targets and the sampling law."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from taxaflow.llm.mixing import mix_sources, numbered_sources, source_targets
from taxaflow.llm.queries import ORACLE_SQL

SCHEMA = "doc_id long, text string, source string, size string, target int, range int"


def rows():
    rng = random.Random(5)
    out = [(i, " ".join(["wort", "a<b>", "x1"][rng.randrange(3)] for _ in range(rng.randrange(0, 60))), rng.choice(["hot"] * 4 + ["a", "b", "é", "z", "Z", None, "tiny"])) for i in range(400)]
    out += [(500, "lang " * 5000, "b"), (501, None, "a"), (502, "", "empty"), (503, " \n\t", "empty"), (None, "no id", "a"), (None, "no id", None), (504, "a b c\x0bd\x1ce", "z")]
    return out + [(600, "the same row", "hot")] * 50 + [(601 + i, "copies of one text", "hot") for i in range(50)]


def frame(spark, data):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in data], SCHEMA).repartition(5)


def slow_targets(sizes, weights, share, most):
    """Shares are dealt, what is above the limit is dealt anew among the others, until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while rest > 1e-9 and open_:
        whole, excess = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            target[s] += rest * weight[s] / whole
        for s in list(open_):
            if target[s] > most * sizes[s]:
                excess += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
        rest = excess
    return target


def test_targets_and_amounts(spark):
    got = mix_sources(frame(spark, rows())).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, size(t)) for i, t, s in rows())
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken == r.epochs * r.size + r.part and 0 <= r.taken <= 2 * r.size and 0 <= r.part <= r.size
    want = slow_targets(sizes, (5, 2, 1), 1.5, 2)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    assert taken == {s: round(t) for s, t in want.items()}
    for s in sizes:  # complete epochs, then whole documents but for one
        own = [r for r in got if r.source == s]
        assert len({r.epochs for r in own}) == 1 and sum(0 < r.part < r.size for r in own) <= 1


def test_against_sql(spark):
    documents = spark.createDataFrame(rows(), "doc_id long, text string, source string").toArrow()  # noqa: F841  read by its name
    want = duckdb.sql(ORACLE_SQL["op12_source_mixing"]).fetchall()
    got = mix_sources(frame(spark, rows())).select("doc_id", "size", "source_size", "target", "taken").collect()
    near = lambda r: repr((*r[:3], round(r[3], 6), r[4]))
    assert sorted(map(near, got)) == sorted(map(near, want))


def test_reruns_agree_however_rows_are_dealt(spark):
    once, again = (sorted(map(repr, mix_sources(frame(spark, d)).collect())) for d in (rows(), rows()[::-1]))
    assert once == again


def test_many_ranges_carry_on(spark):
    """Prefix sums over many ranges of one source give what one range gives."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        many = sorted(map(repr, mix_sources(frame(spark, rows())).collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert many == sorted(map(repr, mix_sources(frame(spark, rows())).collect()))


def test_weights_lead_the_selection(spark):
    """Of documents of one size, those of ten times the weight come ten times as often while few are taken; equal weights evenly."""
    data = [(i, f"word{i}", "s") for i in range(4000)]
    docs = frame(spark, data).withColumn("w", F.when(F.col("doc_id") % 2 == 0, 10.0).otherwise(1.0))
    got = mix_sources(docs, weights=(1,), share=0.1, most=1.0, quality=F.col("w")).where("taken > 0").collect()
    heavy = sum(r.doc_id % 2 == 0 for r in got)
    assert len(got) == 400 and 340 <= heavy <= 385  # 363 of 400 are expected
    same = mix_sources(docs.withColumn("w", F.lit(None).cast("double")), weights=(1,), share=0.1, most=1.0, quality=F.col("w")).where("taken > 0").collect()
    assert 160 <= sum(r.doc_id % 2 == 0 for r in same) <= 240


def test_odd_weights_count_as_the_least(spark):
    docs = frame(spark, [(i, "a b c", "s") for i in range(40)]).withColumn("w", F.when(F.col("doc_id") < 10, float("nan")).when(F.col("doc_id") < 20, -1.0).when(F.col("doc_id") < 30, 0.0))
    plain = mix_sources(docs, share=0.5, quality=F.lit(0.05)).collect()
    assert sorted(mix_sources(docs, share=0.5, quality=F.col("w")).collect()) == sorted(plain)


def test_sources_are_numbered_in_code_point_order(spark):
    names = ["b", "a", "Z", "é", "z", None, "\U0001f389", "￮", ""]
    sources = spark.createDataFrame([(n, 10) for n in names], "source string, source_size long")
    assert [r.source for r in numbered_sources(sources).orderBy("number").collect()] == [*sorted(n for n in names if n is not None), None]
    got = {r.source: r.target for r in source_targets(sources, (5, 2, 1), 1.5, 2).collect()}
    assert got == pytest.approx(slow_targets(dict.fromkeys(names, 10), (5, 2, 1), 1.5, 2))


def test_nothing_to_take(spark):
    assert mix_sources(frame(spark, [])).count() == 0
    got = mix_sources(frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_no_python_in_the_plan(spark):
    plan = mix_sources(frame(spark, rows()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
