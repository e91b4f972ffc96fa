"""Stages of a corpus pipeline: each keeps or drops whole rows of a table of documents, or packs them.

Stages keep all columns of the documents, whatever their names. Rows are told apart by doc_id and text, so rows
that share a doc_id by mistake are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, small_side, written
from .decontaminate import contaminated, phrase_finder
from .exact_dedup import exact_duplicates
from .near_copies import near_copies
from .packing import pack_documents
from .quality import scorer, train_quality

#: Stages follow each other on the same executors, where tables that are broadcast stay for a while (some 200 MB of an executor
#: of 3 GB were measured), so texts are found by shuffles.
BROADCAST = 0
KEY, MARK = "taxaflow stage key", "taxaflow stage mark"  # names that no table of documents has


def _text() -> F.Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _of(docs: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
    """Rows of docs that agree (``left_semi``) or don't agree (``left_anti``) with ``chosen``, a written frame of doc_id and
    text_hash."""
    keys, own = small_side(chosen.toDF(KEY, MARK), BROADCAST), f"{MARK} own"
    marked = docs.withColumn(own, F.xxhash64(_text()))
    return marked.join(keys, marked["doc_id"].eqNullSafe(keys[KEY]) & (marked[own] == keys[MARK]), how).drop(own)


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Documents with a score from the threshold on. The model is trained on the labelled ones among ``docs``.

    A null text is scored as an empty one. Without labels of both kinds all scores are alike, as they are where no
    document is labelled; an empty table stays empty.
    """
    bounded_batches(docs.sparkSession)
    scored = scorer(docs.sparkSession, train_quality(docs, labels))
    return docs.where(scored(_text()) >= threshold)


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest doc_id stays; of rows alike in both, one.

    Null texts count as empty; a null doc_id is less than any other; an empty table stays empty.
    """
    bounded_batches(docs.sparkSession)
    found = exact_duplicates(docs, BROADCAST)
    gone = written(found.where("NOT kept").select("doc_id", "keep_id", "text_hash"), "dropped")
    if gone.where("doc_id <=> keep_id").isEmpty():
        return _of(docs, gone.select("doc_id", "text_hash"), "left_anti")
    kept = written(found.where("kept").select("doc_id", "text_hash"), "kept")
    return _of(docs, kept, "left_semi").dropDuplicates(["doc_id", "text"])


def drop_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """Of each group that near copies (shingles of ``words`` words, Jaccard ``similarity`` or more) connect the document
    with the smallest doc_id stays.

    Rows without a doc_id stay only where their whole group has none; of these the one with the least text hash. Null
    texts count as empty, and all texts without words are one group; an empty table stays empty.
    """
    bounded_batches(docs.sparkSession)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    found = written(near_copies(docs, words, similarity, BROADCAST), "near-groups")
    least = found.groupBy("root").agg(F.min(order).alias("least"), F.max(order).alias("most")).where("least != most")
    own = found.join(least, "root").where(~(F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))))
    return _of(docs, written(own.select("doc_id", "text_hash").distinct(), "dropped"), "left_anti")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents with less than a twentieth of their words in benchmark windows stay, unchanged and where they are.

    Null texts have no words and stay; an empty benchmark drops nothing.
    """
    bounded_batches(docs.sparkSession)
    found = f"{MARK} found"
    marked = docs.withColumn(found, phrase_finder(benchmark)(_text()))
    return marked.where(~contaminated(F.col(found)["n_words"], F.col(found)["n_hit"])).drop(found)


def pack(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Pieces of the documents' ids with their places in sequences of at most 1,024 tokens; a null text is its end id alone."""
    bounded_batches(docs.sparkSession)
    return pack_documents(docs, tokenizer_path, end_id=2, capacity=1024, cache_words=100_000)  # workers of all stages live on one executor
