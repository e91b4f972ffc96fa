"""Count matrices in long form: feature_id, sample_id, count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaflow.functions import lineages as L
from taxaflow.session import checkpointed

NO_HIT = "noHit;"


def build_counts(tiers: list[DataFrame]) -> DataFrame:
    """Sums members' sizes over tiers; each: feature_id, sample_id, count."""
    return reduce(DataFrame.unionByName, tiers).groupBy("feature_id", "sample_id").agg(F.sum("count").alias("count"))


def combine_samples(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Counts by pooled sample: ``combine`` of the sample sheet where it is given, else the sample itself."""
    pooled = F.coalesce(F.col("combine"), F.col("sample_id").cast("string"))
    joined = counts.join(samples.select("sample_id", "combine"), "sample_id", "left").withColumn("pool", pooled)
    return joined.groupBy("feature_id", "pool").agg(F.sum("count").alias("count"))


def combine_runs(tables: DataFrame, prefix: str = "ASV", by: str = "total") -> tuple[DataFrame, DataFrame]:
    """(feature_id, seq, total, samples), (feature_id, sample_id, count) of runs' tables (run, seq, sample_id, count).

    Runs meet on the sequence itself; counts of one sample in several runs are summed. Features are numbered by falling ``total``
    or number of ``samples`` (ties by sequence).
    """
    cells = checkpointed(tables.groupBy("seq", "sample_id").agg(F.sum("count").alias("count")))
    stats = cells.groupBy("seq").agg(F.sum("count").alias("total"), F.count_if(F.col("count") > 0).alias("samples"))
    named = numbered(stats, [F.desc(by), F.asc("seq")], "n").select(F.concat(F.lit(prefix), F.col("n").cast("string")).alias("feature_id"), "seq", "total", "samples")
    return named, cells.join(named.select("feature_id", "seq"), "seq").select("feature_id", "sample_id", "count")


def feature_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("feature_id").agg(F.sum("count").alias("total"))


def numbered(frame: DataFrame, order: list[Column], number: str, by: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Adds a gapless number from 1 in a total order, by group of ``by``, without gathering a group's rows in one task.

    Rows are cut into ranges of the order, which are written once; rows are numbered in each range and shifted by the rows of
    the ranges before. ``parts``: how many ranges, the session's shuffle partitions if not given.
    """
    keys = by or []
    parts = parts or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = frame.repartitionByRange(parts, *map(F.col, keys), *order)
    spans = checkpointed(ranges.withColumn("span of the order", F.spark_partition_id()))
    within = Window.partitionBy("span of the order", *keys).orderBy(*order)
    spans = spans.withColumn("place in the span", F.row_number().over(within))
    sizes = spans.groupBy("span of the order", *keys).agg(F.count("*").alias("rows of the span"))
    earlier = Window.partitionBy(*keys).orderBy("span of the order").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    shifts = sizes.select("span of the order", *keys, F.coalesce(F.sum("rows of the span").over(earlier), F.lit(0)).alias("rows before"))
    joined = spans.join(shifts, ["span of the order", *keys])
    return joined.withColumn(number, (F.col("place in the span") + F.col("rows before")).cast("bigint")).select(*frame.columns, number)


def renamed_features(counts: DataFrame, prefix: str = "OTU") -> DataFrame:
    """feature_id, total, new_id: PREFIX1, PREFIX2 ... by descending total (ties by feature_id); zero totals go."""
    ranked = numbered(feature_totals(counts).where("total > 0"), [F.desc("total"), F.asc("feature_id")], "n")
    return ranked.select("feature_id", "total", F.concat(F.lit(prefix), F.col("n").cast("string")).alias("new_id"))


def flag_labels(flags: DataFrame) -> DataFrame:
    """feature_id, label: the filters that flagged a feature, joined by dots."""
    return flags.groupBy("feature_id").agg(F.concat(F.concat_ws(".", F.array_sort(F.collect_set("filter"))), F.lit(".")).alias("label"))


def clean_matrix(counts: DataFrame, in_fasta: DataFrame, flags: DataFrame, rescued: DataFrame, prefix: str = "OTU") -> DataFrame:
    """Status and new name of each feature of a matrix or FASTA.

    First rule that holds: not in the FASTA: chimera (``Chim.k``); flagged and not rescued: contaminant
    (``PREFIX.label.k``); no counts: empty (no name); else kept (``PREFIXk``). Numbers run by descending total, ties by feature_id.
    """
    features = feature_totals(counts).join(in_fasta.select("feature_id").distinct().withColumn("known", F.lit(True)), "feature_id", "full")
    labels = flag_labels(flags.join(rescued, "feature_id", "left_anti"))
    rows = features.join(labels, "feature_id", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    status = F.when(F.col("known").isNull(), "chimera").when(F.col("label").isNotNull(), "contaminant").when(F.col("total") == 0, "empty").otherwise("kept")
    rows = rows.withColumn("status", status).withColumn("label", F.when(status == "contaminant", F.col("label")).otherwise(""))
    rows = numbered(rows.select("feature_id", "total", "status", "label"), [F.desc("total"), F.asc("feature_id")], "k", ["status", "label"])
    k = F.col("k").cast("string")
    name = (
        F.when(F.col("status") == "chimera", F.concat(F.lit("Chim."), k))
        .when(F.col("status") == "contaminant", F.concat(F.lit(f"{prefix}."), F.col("label"), k))
        .when(F.col("status") == "kept", F.concat(F.lit(prefix), k))
    )
    return rows.select("feature_id", "total", "status", "label", name.alias("new_id"))


def status_totals(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("status", "label").agg(F.count("*").alias("features"), F.sum("total").alias("reads"))


def rank_rollup(counts: DataFrame, taxonomy: DataFrame, keep_unclassified: bool = True, failed: DataFrame | None = None) -> DataFrame:
    """rank (2: phylum to 7: species), path, sample_id, count.

    Features without a lineage count under ``noHit;`` if unclassified ones are kept; else the failed ones go.
    """
    if not keep_unclassified and failed is not None:
        counts = counts.join(failed, "feature_id", "left_anti")
    how = "left" if keep_unclassified else "inner"
    joined = counts.join(taxonomy.select("feature_id", "ranks"), "feature_id", how)
    missing = F.transform(F.sequence(F.lit(2), F.lit(7)), lambda i: F.struct(i.alias("rank"), F.lit(NO_HIT).alias("path")))
    # Counts are summed by lineage first: the six paths are then made of few rows.
    pooled = joined.groupBy("ranks", "sample_id").agg(F.sum("count").alias("count"))
    paths = pooled.withColumn("p", F.explode(F.when(F.col("ranks").isNull(), missing).otherwise(L.prefix_paths(F.col("ranks")))))
    return paths.groupBy(F.col("p.rank").alias("rank"), F.col("p.path").alias("path"), "sample_id").agg(F.sum("count").alias("count"))


def assigned_percent(rolled: DataFrame) -> DataFrame:
    """Percent of reads (of all, noHit included) and of paths (noHit left out) that are assigned, cut to integers."""
    by_path = rolled.groupBy("rank", "path").agg(F.sum("count").alias("count"))
    hit = ~L.unassigned(F.col("path")) & (F.col("path") != NO_HIT)
    real = F.col("path") != NO_HIT
    sums = by_path.groupBy("rank").agg(
        F.sum(F.when(hit, F.col("count")).otherwise(0)).alias("a"), F.sum("count").alias("b"), F.count_if(hit).alias("c"), F.count_if(real).alias("d")
    )
    percent = lambda x, y: F.when(F.col(y) > 0, F.floor(F.col(x) * 100 / F.col(y))).otherwise(0).cast("bigint")
    return sums.select("rank", percent("a", "b").alias("reads_pct"), percent("c", "d").alias("taxa_pct"))


def pseudo_reference(counts: DataFrame, best_hits: DataFrame) -> DataFrame:
    """Counts by best database hit; features without one stay themselves."""
    name = F.coalesce(F.col("ref_id"), F.col("feature_id").cast("string"))
    joined = counts.join(best_hits.select("feature_id", "ref_id"), "feature_id", "left")
    return joined.groupBy(name.alias("name"), "sample_id").agg(F.sum("count").alias("count"))


def lineages_or_unknown(features: DataFrame, taxonomy: DataFrame) -> DataFrame:
    joined = features.join(taxonomy.select("feature_id", "ranks"), "feature_id", "left")
    return joined.withColumn("ranks", F.coalesce("ranks", L.no_lineage()))


def crosstalk_flags(counts: DataFrame, most: float = 0.01) -> DataFrame:
    """Cells that are likely spill-over: a count far below what a share ``most`` of the feature's other counts, spread
    over the samples, would give (after Edgar's UNCROSS2 score)."""
    n = counts.select("sample_id").distinct().agg(F.count("*").alias("samples"))
    totals = feature_totals(counts).crossJoin(F.broadcast(n))  # one row
    joined = counts.join(totals, "feature_id")
    expected = (F.col("total") - F.col("count")) * most / F.col("samples")
    return joined.where((F.col("count") > 0) & (F.col("count") < expected)).select("feature_id", "sample_id", "count", expected.alias("expected"))


def without_crosstalk(counts: DataFrame, most: float = 0.01) -> DataFrame:
    """Counts without the cells that ``crosstalk_flags`` names."""
    return counts.join(crosstalk_flags(counts, most).select("feature_id", "sample_id"), ["feature_id", "sample_id"], "left_anti")


def to_wide(counts: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """The matrix for a sink: one column a sample (all of them in order, if not given), 0 where nothing was counted."""
    samples = samples or [r[0] for r in counts.select("sample_id").distinct().orderBy("sample_id").collect()]  # the columns of the result
    return counts.groupBy("feature_id").pivot("sample_id", samples).agg(F.sum("count")).na.fill(0)


def from_wide(wide: DataFrame, id_col: str = "feature_id") -> DataFrame:
    long = wide.unpivot([id_col], [c for c in wide.columns if c != id_col], "sample_id", "count")
    return long.where(F.col("count") > 0).select(F.col(id_col).alias("feature_id"), "sample_id", F.col("count").cast("bigint").alias("count"))
