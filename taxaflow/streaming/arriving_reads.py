"""Reads that arrive over time, counted batch by batch; totals are sums of the batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def count_arriving_reads(reads: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Starts a query over a stream of sample_id, seq. A batch's counts go to a folder of its number, so that a batch
    that runs twice after a failure writes the same place again."""

    def keep(batch: DataFrame, number: int) -> None:
        counts = batch.where(F.length("seq") > 0).groupBy("seq", "sample_id").agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return reads.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrived_uniques(spark: SparkSession, path: str) -> DataFrame:
    """seq, size, sample_counts over all batches so far."""
    counts = spark.read.parquet(path).groupBy("seq", "sample_id").agg(F.sum("n").alias("n"))
    return counts.groupBy("seq").agg(F.sum("n").alias("size"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("sample_id", "n")))).alias("sample_counts"))
