"""Queries that apply each training-data operator to its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_frames import token_frames

    read = token_frames(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"), threshold=0.8)


def op4_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents

    placed = shard_documents(table(spark, sf_dir, "documents"), shards=40)
    law, none = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", F.crc32("text").alias("text_crc32"), law, "shard", "slot", none)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=4, errors=4).drop("text_hash")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality, train_quality

    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated, find_contamination

    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.concat_ws(",", "item_ids"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), listed.alias("items_sha256"), contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .wrappers import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_alignment import align_tokenizers

    return align_tokenizers(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    mixed = mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whitened_components

    white = whitened_components(table(spark, sf_dir, "embeddings"), components=8, scale=1024, shift=100_000)
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_frames": op1_token_frames,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_license_scan": op3_license_scan,
    "op4_histogram_sharding": op4_histogram_sharding,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_html_extraction": op10_html_extraction,
    "op11_token_alignment": op11_token_alignment,
    "op12_source_mixing": op12_source_mixing,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op6_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        g AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
    """,
    "op12_source_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) AS h,
                CASE WHEN length(text) > 0 THEN CAST(length(translate(text, '0123456789<>{}[]()|=_/#@~^*+$%&', '')) AS DOUBLE) / length(text) ELSE 1.0 END AS q FROM documents),
        k AS (SELECT doc_id, source, size, -ln((CAST(h AS DOUBLE) + 0.5) / 4503599627370496.0) / greatest(q, 0.05) AS key FROM d),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)]::DOUBLE AS w FROM k GROUP BY source),
        o AS (SELECT *, sum(2.0::DOUBLE * source_size) OVER a AS full_caps, sum(w) OVER a AS full_w, sum(source_size) OVER () * 1.5::DOUBLE AS budget, sum(w) OVER () AS all_w
            FROM s WINDOW a AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        -- with the sources before this one full, does this one stay under its limit at the level of the rest? The first that does sets the level.
        l AS (SELECT min_by((budget - coalesce(full_caps, 0)) / (all_w - coalesce(full_w, 0)), source_size / w) AS level FROM o
            WHERE 2.0 * source_size >= w * ((budget - coalesce(full_caps, 0)) / (all_w - coalesce(full_w, 0)))),
        t AS (SELECT source, source_size, least(2.0 * source_size, w * level) AS target FROM s, l),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
        p AS (SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS before FROM k)
        SELECT doc_id, size, source_size, target,
            CAST(epochs * size + least(greatest(round(target - epochs * source_size) - before, 0), size) AS BIGINT) AS taken
        FROM p JOIN e ON p.source IS NOT DISTINCT FROM e.source
    """,
}
