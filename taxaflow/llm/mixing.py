"""Mixing sources to target weights: whole epochs first, then a weighted sample of each source.

Efraimidis-Spirakis sampling: a document's key is exponential with its quality weight as rate, and a source's
documents are taken in the order of their keys until the words taken fill the source's budget. Documents are sorted by
(source, key) into ranges of near-equal size, and a prefix sum of the ranges carries from one to the next, so no source is
ever in one task. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_side, written

WORD = r"[^\x20\x09-\x0D]+"
LEAST_WEIGHT = 0.05
_ODD = "0123456789<>{}[]()|=_/#@~^*+$%&"
_BITS = 52  # of the hash that becomes a uniform number


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plain_share(text: Column) -> Column:
    """A quality weight: the share of characters that are neither digits nor marks of markup and code (no text: 1)."""
    plain, length = F.length(F.translate(text, _ODD, "")), F.length(text)
    return F.coalesce(F.try_divide(plain.cast("double"), length.cast("double")), F.lit(1.0))


def uniform(doc_id: Column, text: Column) -> Column:
    """Between 0 and 1, both left out; depends on the row's id and text only."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("double") + 0.5) / float(1 << _BITS)


def numbered_sources(sources: DataFrame) -> DataFrame:
    """Adds ``number`` (from 0) in the order of code points, null last. Ranges are numbered apart and shifted, so that
    many sources need no single task either."""
    ranged = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id())
    ranged = written(ranged, "sources")
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", before.alias("start"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last()))
    return ranged.withColumn("inside", inside).join(starts, "range").withColumn("number", F.col("start") + F.col("inside") - 1).drop("range", "inside", "start")


def source_targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Adds ``target`` to (source, source_size): shares by weight of ``share`` times all words, ``most`` times the source's size at
    most. What a source cannot take is shared anew by weight among the others, until none is above. Only sums come to the driver."""
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("number") % len(weights) + 1).cast("int"))
    weighted = numbered_sources(sources).withColumn("weight", weight).withColumn("most", F.col("source_size") * float(most))
    weighted = written(weighted, "weighted")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = F.col("most") < F.col("weight") * level
        row = weighted.agg(F.count_if(above).alias("full"), F.sum(F.when(above, F.col("most"))).alias("taken"), F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        if row.full == full or not row.open:
            break
        full, level = row.full, (share * total - (row.taken or 0.0)) / row.open
    return written(weighted.select("source", "source_size", F.least("most", F.col("weight") * level).alias("target")), "targets")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0, quality: Column | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size (words), source_size, target (of its source), epochs, part, taken of each row.

    ``taken`` = ``epochs`` * size + ``part``: epochs are complete for the whole source; ``part`` are the words that the fractional
    selection takes, all or none but for the one document at a source's budget, which is cut there, so a source's taken words are its
    target, rounded. ``quality``: a column of ``docs``, the document's weight in the selection (``plain_share`` if not given); null, NaN and
    weights below ``LEAST_WEIGHT`` count as that. Weights repeat over the sources in code-point order, null last as a source of its own.

    Null texts have no words and nothing is taken of them; null and repeated doc_ids are kept, and equal rows share a key, so it does not matter which of
    them comes first. Reruns agree. Other columns are not read; an empty table gives an empty result.
    """
    text = F.col(text_col).cast("string")
    given = F.nanvl((plain_share(text) if quality is None else quality).cast("double"), F.lit(LEAST_WEIGHT))
    rate = F.greatest(F.coalesce(given, F.lit(LEAST_WEIGHT)), F.lit(LEAST_WEIGHT))
    doc_id = F.col(id_col).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(text).alias("size"), (-F.ln(uniform(doc_id, text)) / rate).alias("key"))
    rows = written(rows, "sizes")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)

    ranged = rows.repartitionByRange("source", "key", "doc_id", "size").withColumn("range", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("source", "range").agg(F.sum("size").alias("words")).select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    inside = F.sum("size").over(Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    before = ranged.withColumn("inside", inside).join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    before = before.select("doc_id", "source", "size", (F.col("start") + F.col("inside") - F.col("size")).alias("before"))

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budgets = targets.select(F.col("source").alias("s"), "source_size", "target", whole.cast("int").alias("epochs")).withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    mixed = before.join(small_side(budgets), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    part = F.least(F.greatest(F.col("budget") - F.col("before"), F.lit(0)), F.col("size"))
    mixed = mixed.withColumn("part", part).withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "epochs", "part", "taken")
