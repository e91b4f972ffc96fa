"""Exact duplicates of an incoming batch against immutable snapshots, screened by static binary-fuse filters.

A snapshot is the distinct texts seen so far: digest, rows, the row that stays. It is cut into buckets of bounded
size by a hash of the digest, and each bucket gets a static filter. Rows of a new batch are grouped among
themselves first. Their distinct digests pass the bucket's filter; only positives are joined with the exact
bucket, and their texts are compared byte by byte with the snapshot's.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from . import fuse_filter
from .common import BROADCAST_ROWS, id_text, small_side, written

BUCKET_KEYS = 100_000


@F.arrow_udf(BinaryType())
def normalised(texts: pa.Array) -> pa.Array:
    """UTF-8 with A-Z lower-cased, nothing else."""
    return pa.array((t.as_py().encode().lower() for t in texts), pa.binary())


@F.arrow_udf(BinaryType())
def digests(texts: pa.Array) -> pa.Array:
    """SHA-256 of the normalised text."""
    return pa.array((hashlib.sha256(t.as_py().encode().lower()).digest() for t in texts), pa.binary())


def _rows(docs: DataFrame, side: int) -> DataFrame:
    """doc_id, digest and a number that tells rows apart, also from those of the other side."""
    rows = id_text(docs).select("doc_id", digests("text").alias("digest"), F.xxhash64("text").alias("text_hash"))
    return written(rows.withColumn("row", 2 * F.monotonically_increasing_id() + side), "digests")


def _groups(rows: DataFrame) -> DataFrame:
    """A row for each digest, pre-aggregated where the rows are: how many, and the one that stays."""
    groups = rows.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("keep"))
    return written(groups.withColumn("key", F.xxhash64("digest")), "groups")


def in_bucket(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("long"))


def bucket_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """(bucket, filter): the static filter of each bucket of the snapshot's digests."""

    def build(table: pa.Table) -> pa.Table:
        keys = np.unique(table["key"].to_numpy().view(np.uint64))
        return pa.table({"bucket": table["bucket"][:1], "filter": pa.array([fuse_filter.build(keys)], pa.binary())})

    return in_bucket(snapshot, buckets).select("bucket", "key").groupBy("bucket").applyInArrow(build, "bucket long, filter binary")


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The incoming digests that a filter lets through: all that the snapshot holds, and a few more."""

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return left.slice(0, 0).select(["digest"])
        keys = left["key"].to_numpy().view(np.uint64)
        return left.filter(pa.array(fuse_filter.contains(right["filter"][0].as_py(), keys))).select(["digest"])

    own = in_bucket(incoming, buckets).select("bucket", "key", "digest")
    return own.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(probe, "digest binary")


def _texts_of(docs: DataFrame, ids: DataFrame, name: str, broadcast_rows: int) -> DataFrame:
    """(digest, bytes) of the texts that stand for the digests in ``ids`` (digest, doc_id)."""
    found = id_text(docs).join(small_side(ids, broadcast_rows), "doc_id").select("digest", normalised("text").alias(name))
    return found.where(F.unhex(F.sha2(name, 256)) == F.col("digest"))


def deduplicate_batch(snapshot_docs: DataFrame, incoming_docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Groups of equal texts (A-Z lower-cased) over a snapshot and a batch that arrives.

    Returns a row for each row of both: doc_id, keep_id (of equal texts the largest doc_id), group_size,
    kept, text_sha256 (of the normalised text), text_hash (XXH64 of the text as it is). Null texts count as empty. Exactly one row of a group is kept,
    also where rows are equal in doc_id and text; a null doc_id is less than any other. Other columns are not
    read; empty tables give an empty result. The bytes of a digest that both sides have are compared; if
    they differed, the texts would stay two groups. Texts to compare are found by a broadcast of up to ``broadcast_rows`` ids, else by a shuffle.
    """
    sides = [_rows(snapshot_docs, 0), _rows(incoming_docs, 1)]
    snapshot, incoming = (_groups(s) for s in sides)
    buckets = 1 + max(snapshot.count(), incoming.count()) // BUCKET_KEYS

    filters = written(bucket_filters(snapshot, buckets), "filters")
    positive = screen(incoming, filters, buckets)
    exact = snapshot.select("digest", F.col("n").alias("old_n"), F.col("keep").alias("old_keep"))
    pairs = written(positive.join(exact, "digest").join(incoming, "digest"), "pairs")

    # Texts of null doc_ids can't be fetched by doc_id; their digests stand for them.
    new = _texts_of(incoming_docs, pairs.select("digest", "keep.doc_id"), "new", broadcast_rows)
    old = _texts_of(snapshot_docs, pairs.select("digest", "old_keep.doc_id"), "old", broadcast_rows)
    differ = new.join(old, "digest").where("new != old").select("digest").distinct()
    both = pairs.join(differ, "digest", "left_anti")
    total = written(both.select("digest", F.expr("n + old_n as all_n"), F.greatest("keep", "old_keep").alias("all_keep")), "verified")

    out = []
    for rows, groups in zip(sides, (snapshot, incoming), strict=True):
        merged = groups.join(total, "digest", "left").select("digest", F.coalesce("all_n", "n").alias("n"), F.coalesce("all_keep", "keep").alias("keep"))
        joined = rows.join(written(merged, "merged"), "digest")
        out.append(joined.select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "text_hash"))
    return out[0].unionByName(out[1])


def exact_duplicates(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One table as a snapshot and a batch that follows: a hash of the doc_id deals out the rows."""
    later = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    rows = id_text(docs)
    return deduplicate_batch(rows.where(~later), rows.where(later), broadcast_rows)
