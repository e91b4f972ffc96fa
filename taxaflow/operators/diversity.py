"""Richness, diversity and rarefaction of samples, from counts in long form (feature_id, sample_id, count)."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from taxaflow.operators.matrix import numbered
from taxaflow.session import checkpointed


@F.arrow_udf(DoubleType())
def _log_gamma(x: pa.Array) -> pa.Array:
    return pa.array([None if v is None else math.lgamma(v) for v in x.to_pylist()], pa.float64())


def sample_diversity(counts: DataFrame) -> DataFrame:
    """sample_id, total, richness, shannon (natural logarithm), simpson (1 - sum of squared shares), evenness (of Shannon; null for one feature)."""
    rows = counts.where("count > 0").select("sample_id", F.col("count").cast("double").alias("n"))
    sums = rows.groupBy("sample_id").agg(F.sum("n").alias("total"), F.count("*").alias("richness"), F.sum(F.col("n") * F.ln("n")).alias("logs"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    shannon = F.ln("total") - F.col("logs") / F.col("total")
    even = F.when(F.col("richness") > 1, shannon / F.ln("richness"))
    return sums.select("sample_id", F.col("total").cast("bigint").alias("total"), "richness", shannon.alias("shannon"), (1 - F.col("squares") / (F.col("total") * F.col("total"))).alias("simpson"), even.alias("evenness"))


def expected_richness(counts: DataFrame, depths: list[int]) -> DataFrame:
    """sample_id, depth, richness: how many features ``depth`` reads drawn without replacement have on average (hypergeometric, exact).
    Samples with fewer reads than a depth have no row for it."""
    rows = counts.where("count > 0")
    totals = rows.groupBy("sample_id").agg(F.sum("count").alias("total"))
    wide = rows.join(totals, "sample_id").withColumn("depth", F.explode(F.array(*map(F.lit, depths)))).where("depth <= total")
    return wide.groupBy("sample_id", "depth").agg(F.sum(_present(*map(F.col, ("count", "total", "depth")))).alias("richness"))


STIRLING = 32  # reads from which the series below is exact to double precision


def _present(count: Column, total: Column, depth: Column) -> Column:
    """Probability that one of ``depth`` reads of ``total`` at least is among ``count``: 1 - C(total - count, depth) / C(total, depth).

    Logarithms of gamma functions of large numbers cancel (at 40 million reads, seven digits of eight are lost), so their differences are
    taken in Stirling's series: what is left are terms of the size of ``count``."""
    c, t, d = (x.cast("double") for x in (count, total, depth))
    r = t - c
    tail = lambda x: 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    series = (r + 0.5) * F.log1p(-c / t) - (r - d + 0.5) * F.log1p(-c / (t - d)) + c * F.log1p(-d / t) + (tail(r) - tail(t)) - (tail(r - d) - tail(t - d))
    few = [_log_gamma(F.when((r >= d) & (r - d < STIRLING), x)) for x in (r + 1, r - d + 1, t + 1, t - d + 1)]
    log = F.when(r - d >= STIRLING, series).otherwise((few[0] - few[1]) - (few[2] - few[3]))
    return F.when(r < d, 1.0).otherwise(-F.expm1(log))


def rarefied(counts: DataFrame, depth: int, seed: int = 0) -> DataFrame:
    """Counts of ``depth`` reads of each sample, drawn without replacement; samples with fewer are left out.

    Each read has a hash of (seed, sample, feature, its number) as its place, and the first ``depth`` of a sample are taken, so that results repeat.
    Only reads whose place is low enough for somewhat more than ``depth`` of a sample's reads leave their tasks; a sample of which too few did is taken whole.
    Reads are numbered by ranges (``matrix.numbered``): no sample's reads are in one task, whatever its share of all."""
    rows = counts.where("count > 0").select("feature_id", "sample_id", "count")
    share = F.least(F.lit(1.0), F.lit(depth + 10 * math.sqrt(depth) + 50) / F.col("total"))
    able = rows.groupBy("sample_id").agg(F.sum("count").alias("total")).where(F.col("total") >= depth)
    able = checkpointed(able.select("sample_id", F.lpad(F.lower(F.hex(F.floor(share * 0xFFFFFFFF))), 8, "0").alias("most")))
    place = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("sample_id").cast("string"), F.col("feature_id").cast("string"), F.col("turn").cast("string")).cast("binary"))

    def reads(samples: DataFrame) -> DataFrame:
        turns = rows.join(samples, "sample_id").withColumn("turn", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("count").cast("bigint"))))
        placed = turns.select("sample_id", "feature_id", "most", place.alias("place"))
        return placed.where(F.substring("place", 1, 8) <= F.col("most")).select("sample_id", "feature_id", "place")

    low = checkpointed(reads(able))
    few = able.join(low.groupBy("sample_id").agg(F.count("*").alias("n")), "sample_id", "left").where(F.coalesce("n", F.lit(0)) < depth).select("sample_id", F.lit("ffffffff").alias("most"))
    few = checkpointed(few)
    if not few.isEmpty():
        low = low.join(few.select("sample_id"), "sample_id", "left_anti").unionByName(reads(few))
    drawn = numbered(low, [F.col("place"), F.col("feature_id")], "n", ["sample_id"]).where(F.col("n") <= depth)
    return drawn.groupBy("feature_id", "sample_id").agg(F.count("*").alias("count"))
