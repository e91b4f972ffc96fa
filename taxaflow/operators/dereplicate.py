"""Dereplication of reads into unique sequences with a size and counts by sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaflow.functions.sequences import cut_from_motif


def dereplicate(reads: DataFrame) -> DataFrame:
    """seq, size, sample_counts (map) of exact full-length sequences; empty ones are left out.

    Counted by (seq, sample) first, so a sequence that every sample has many times is a row a sample at most
    when the map is built.
    """
    counts = reads.where(F.length("seq") > 0).groupBy("seq", "sample_id").agg(F.count("*").alias("n"))
    return counts.groupBy("seq").agg(F.sum("n").alias("size"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("sample_id", "n")))).alias("sample_counts"))


def parse_minimum(rule: str) -> list[tuple[int, int]]:
    """``8:1,4:2``: at least 8 copies in each of 1 sample, or 4 in each of 2; one number: copies in one sample."""
    return [(int(c), int(s or 1)) for c, _, s in (part.partition(":") for part in rule.split(","))]


def meets_minimum(sample_counts: Column, rule: str) -> Column:
    tests = [F.size(F.map_filter(sample_counts, lambda _, n: n >= copies)) >= samples for copies, samples in parse_minimum(rule)]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def unique_ids(uniques: DataFrame) -> DataFrame:
    """Adds unique_id: a hash of the sequence, so that ids need no global order."""
    return uniques.withColumn("unique_id", F.sha1("seq"))


def representatives(members: DataFrame) -> DataFrame:
    """The read that stands for each feature: best mean quality, then length, then id; else the centroid.

    members: feature_id, centroid, read_id, seq (null without reads), mean_quality.
    """
    best = F.max_by("seq", F.struct("mean_quality", F.length("seq"), "read_id"))
    return members.groupBy("feature_id").agg(F.coalesce(best, F.max("centroid")).alias("seq"))


def later_wins(first: DataFrame, second: DataFrame, key: str = "feature_id") -> DataFrame:
    """Rows of both; where both have a key, those of the second."""
    return first.join(second.select(key).distinct(), key, "left_anti").select(*second.columns).unionByName(second)


def with_references(features: DataFrame, references: DataFrame) -> DataFrame:
    """feature_id, seq of features and, under their own names, of references (ref_id, seq) that stand for features."""
    return features.select("feature_id", "seq").unionByName(references.select(F.col("ref_id").alias("feature_id"), "seq"))


def seed_sequences(merged: DataFrame, first: DataFrame, single: DataFrame, motifs: list[str] | None = None) -> DataFrame:
    """feature_id, seq of features' reads: the merged pairs, first mates of those that did not merge, and single reads.

    Each: read_id, seq. A number after a dot at the end of a name goes; of merged and first mates also what follows a motif.
    """
    cut = (lambda c: cut_from_motif(c, motifs)) if motifs else (lambda c: c)
    name = F.regexp_replace("read_id", r"\.\d$", "").alias("feature_id")
    pairs = merged.select("read_id", "seq").unionByName(first.select("read_id", "seq")).select(name, cut(F.col("seq")).alias("seq"))
    return pairs.unionByName(single.select(name, "seq"))
