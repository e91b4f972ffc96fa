"""The driver's tables in the parts that the operators ask for, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.functions import sequences as S


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def dealt(spark: SparkSession, d: str, name: str, key: str) -> DataFrame:
    """A table of short rows of which much is made: a file of a few megabytes is one task's otherwise, also where its rows are dealt without a number of tasks."""
    return table(spark, d, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col(key))


def counts(spark: SparkSession, d: str) -> DataFrame:
    """Parts counted by their suppliers' nations."""
    joined = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity").join(table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy(F.col("l_partkey").alias("feature_id"), F.col("s_nationkey").alias("sample_id")).agg(F.sum("l_quantity").cast("bigint").alias("count"))


COUNTS = """counts AS (SELECT l_partkey AS feature_id, s_nationkey AS sample_id, CAST(sum(l_quantity) AS BIGINT) AS count
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""


def taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """Parts' lineages; the larger a part, the more of its ranks are known, and from 49 on or below 7 all are."""
    p = table(spark, d, "part")
    names = F.array(F.lit("Life"), F.col("p_type"), F.col("p_brand"), F.concat(F.lit("band"), F.floor(F.col("p_size") / 10).cast("string")), F.concat(F.lit("size"), F.col("p_size").cast("string")), F.col("p_name"), F.concat(F.lit("sp"), F.col("p_partkey").cast("string")))
    upto = F.floor(F.col("p_size") / 7)
    return p.select(F.col("p_partkey").alias("feature_id"), F.transform(names, lambda x, i: F.when((upto == 0) | (i < upto), x).otherwise("?")).alias("ranks"))


TAXONOMY = """tax AS (SELECT p_partkey AS feature_id, list_transform(range(1, 8), lambda i: CASE WHEN floor(p_size / 7) = 0 OR i <= floor(p_size / 7)
    THEN ['Life', p_type, p_brand, 'band' || CAST(CAST(floor(p_size / 10) AS INT) AS VARCHAR), 'size' || CAST(p_size AS VARCHAR), p_name, 'sp' || CAST(p_partkey AS VARCHAR)][i]
    ELSE '?' END) AS ranks FROM part)"""


def classified(spark: SparkSession, d: str) -> DataFrame:
    """Lineages without unknown ranks and a confidence for each rank, falling with the rank."""
    p = table(spark, d, "part")
    names = F.array(F.lit("Life"), F.col("p_type"), F.col("p_brand"), F.col("p_name"), F.concat(F.lit("size"), F.col("p_size").cast("string")), F.concat(F.lit("g"), F.col("p_size").cast("string")), F.concat(F.lit("sp"), F.col("p_partkey").cast("string")))
    conf = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: (F.lit(100) - i * F.col("p_size") / 2).cast("double") / 100)
    return p.select(F.col("p_partkey").alias("feature_id"), names.alias("ranks"), conf.alias("confidence"))


CLASSIFIED = """cls AS (SELECT p_partkey AS feature_id, ['Life', p_type, p_brand, p_name, 'size' || CAST(p_size AS VARCHAR), 'g' || CAST(p_size AS VARCHAR), 'sp' || CAST(p_partkey AS VARCHAR)] AS ranks,
    list_transform(range(0, 7), lambda i: CAST(100 - i * p_size / 2 AS DOUBLE) / 100) AS confidence FROM part)"""


def small_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where("p_size <= 5").select(F.col("p_partkey").alias("feature_id"))


def samples(spark: SparkSession, d: str) -> DataFrame:
    """Nations, pooled by region but for those of region 0."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(F.col("n_nationkey").alias("sample_id"), F.when(F.col("n_regionkey") > 0, F.col("r_name")).alias("combine"))


def reads(spark: SparkSession, d: str) -> DataFrame:
    """The letters A, C, G and T of documents, as reads of their sources."""
    return table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("read_id"), F.col("source").alias("sample_id"), S.dna_letters(F.coalesce("text", F.lit(""))).alias("seq"))


READS = "reads AS (SELECT CAST(doc_id AS VARCHAR) AS read_id, source AS sample_id, upper(regexp_replace(coalesce(text, ''), '[^acgtACGT]', '', 'g')) AS seq FROM documents)"


def qualities(spark: SparkSession, d: str) -> DataFrame:
    """Users' event values, cut to 40 and in order of time, as qualities of a read."""
    q = F.least(F.lit(40), F.floor("value")).cast("int")
    ordered = F.array_sort(F.collect_list(F.struct("ts", "event_id", q.alias("q"))))
    return table(spark, d, "events").groupBy("user_id").agg(F.transform(ordered, lambda x: x["q"]).alias("quals"))


QUALITIES = "quals AS (SELECT user_id, list(CAST(least(40, floor(value)) AS INT) ORDER BY ts, event_id) AS quals FROM events GROUP BY user_id)"


def hits(spark: SparkSession, d: str) -> DataFrame:
    """Line items as hits of orders on parts, in order of part, supplier and line."""
    pident = F.lit(69) + (F.col("l_suppkey") * 7 + F.col("l_partkey") * 13 + F.col("l_linenumber") * 5) % 32
    alnlen = F.lit(100) + F.col("l_quantity").cast("int") * 4
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("target"), pident.cast("double").alias("pident"), alnlen.alias("alnlen"),
        F.struct("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice").alias("position"), F.col("l_linenumber").alias("line"),
    )


HITS = """hits AS (SELECT l_orderkey AS query, l_partkey AS target, CAST(69 + (l_suppkey * 7 + l_partkey * 13 + l_linenumber * 5) % 32 AS DOUBLE) AS pident,
    100 + CAST(l_quantity AS INT) * 4 AS alnlen, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice) AS position,
    l_linenumber AS line FROM lineitem)"""


MATCH_GROUP = ["p_brand", "p_size", "p_type"]


def matched_features(spark: SparkSession, d: str) -> DataFrame:
    """Parts with the columns that matching parts have in common, and their prices in cents."""
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("feature_id"), *MATCH_GROUP, F.round(F.col("p_retailprice") * 100).cast("bigint").alias("value"))


def match_percent(a, b):
    """Parts of one brand, size and type match by a percent that falls with the difference of their prices."""
    return 100 - abs(a - b) % 20


MATCHES = """matches AS (SELECT a.p_partkey AS otu, b.p_partkey AS hit, CAST(100 - abs(CAST(round(a.p_retailprice * 100) AS BIGINT) - CAST(round(b.p_retailprice * 100) AS BIGINT)) % 20 AS DOUBLE) AS match
    FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_type = b.p_type AND a.p_partkey <> b.p_partkey)"""


def flags(spark: SparkSession, d: str) -> DataFrame:
    """Parts flagged by two filters."""
    p = table(spark, d, "part")
    return p.where("p_size > 45").select(F.col("p_partkey").alias("feature_id"), F.lit("offTarget").alias("filter")).unionByName(p.where("p_type = 'PROMO' AND p_size > 40").select(F.col("p_partkey").alias("feature_id"), F.lit("phiX").alias("filter")))
