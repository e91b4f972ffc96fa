import random
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from taxaflow.llm import quality, stages
from taxaflow.llm.quality import held_out, score_quality, train_quality

VOCAB = [a + b for a in ("mo", "ta", "ri", "ke", "su", "né") for b in ("lan", "ber", "tio", "sch", "ven", "qu")]


def good(rng, n=80):
    return " ".join(rng.choices(VOCAB, k=n)) + "."


def junk(rng, n=80):
    return rng.choice([lambda: " ".join(w.upper() + "!!" for w in rng.choices(VOCAB, k=n)), lambda: (rng.choice(VOCAB) + " ") * n, lambda: " | ".join(rng.choices(VOCAB, k=n))])()


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), f"own {i}") for i, (d, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, text_hash string")


def corpus(n=400):
    rng = random.Random(11)
    return [(i, junk(rng) if i % 5 == 0 else good(rng)) for i in range(n)]


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = table(spark, [*rows, (None, None), (1000, ""), (1000, "")])
    labels = spark.createDataFrame([(d, int(d % 5 != 0), 0) for d, _ in rows] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = score_quality(docs, train_quality(docs, labels)).collect()
    assert len(got) == len(rows) + 3
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
    unseen = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert np.mean([r.predicted == int(r.doc_id % 5 != 0) for r in unseen]) > 0.97


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = corpus()
    docs = table(spark, rows)
    schema = "doc_id long, quality int"
    right = spark.createDataFrame([(d, int(d % 5 != 0)) for d, _ in rows], schema)
    wrong = right.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (train_quality(docs, right) == train_quality(docs, wrong)).all()


def test_no_or_one_label(spark):
    docs = table(spark, corpus(20))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in score_quality(docs, train_quality(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id long, quality int")
    assert len({r.score for r in score_quality(docs, train_quality(docs, one)).collect()}) == 1
    assert quality.features("").tolist() == []


def test_stages_keep_and_drop(spark):
    rng = random.Random(12)
    base = good(rng, 300)
    near = base.split()
    near[150] = "changed"
    item = good(rng, 13)
    rows = [(1, base), (2, base.upper().replace("É", "é")), (3, " ".join(near)), (4, good(rng, 300)), (5, good(rng, 100) + " " + item), (6, good(rng, 3000) + " " + item), (7, "same"), (7, "same"), (8, None), (9, None), (None, good(rng))]
    docs = table(spark, rows)
    once = stages.drop_exact_duplicates(docs)
    assert once.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in once.collect()) == sorted(map(repr, [2, 3, 4, 5, 6, 7, 9, None]))
    apart = stages.drop_near_duplicates(once)
    assert apart.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in apart.collect()) == sorted(map(repr, [2, 4, 5, 6, 7, 9, None]))
    bench = spark.createDataFrame([(1, item), (2, None)], "item_id long, text string")
    clean = stages.drop_contaminated(apart, bench)
    assert clean.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in clean.collect()) == sorted(map(repr, [2, 4, 6, 7, 9, None]))
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[6] == dict(rows)[6]


def test_whole_run(spark, tmp_path):
    rows = corpus(150)
    table(spark, rows + [(500, rows[1][1]), (501, rows[1][1] + " ")]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, int(d % 5 != 0), 0) for d, _ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, rows[2][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    good_ids = {d for d, _ in rows if d % 5}
    assert 2 not in kept
    assert not {500, 501} <= kept
    assert len(good_ids - kept) <= 6
    assert len(kept & {d for d, _ in rows if d % 5 == 0}) <= 2
