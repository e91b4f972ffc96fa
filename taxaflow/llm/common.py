"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Only where that setting is empty on one machine (tests) a temporary folder stands in for it.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        if sc.applicationId not in _LOCAL_DIRS:
            _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="taxaflow-")
        base = _LOCAL_DIRS[sc.applicationId]
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    return str(path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString())


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/taxaflow-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 500_000  # of a few numbers each


def small_side(written_frame: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A frame of narrow rows that is to be joined with texts: broadcast if it is counted to have ``most`` rows at most, else
    hashed where the texts come. Either way no text is sorted."""
    return F.broadcast(written_frame) if written_frame.count() <= most else written_frame.hint("shuffle_hash")


BATCH_BYTES = 4_000_000  # of rows on their way to Python
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Has rows go to Python in batches of ``BATCH_BYTES``, unless the session has a setting of its own. Several
    buffers of a batch live on both sides, so Spark's 64 MB a batch add up where stages follow each other."""
    if int(str(spark.conf.get(_BATCH_SETTING)).rstrip("b")) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that the operators read, as ``doc_id`` and ``text`` (null text: empty)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
