"""FASTA and FASTQ as DataFrames, in Spark's own text reader so that large files split and compressed ones decode."""

from __future__ import annotations

import io
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from taxaflow.functions.sequences import sample_of_read, size_tag, strip_header


COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")
SPLIT_BYTES = 64_000_000
BATCH = 4_096


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """id (without size tag and comment), header, seq of multi-line FASTA."""
    raw = spark.read.option("lineSep", "\n>").text(path).where(F.trim("value") != "")
    record = F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", "")
    header = F.regexp_extract(record, r"^([^\n]*)", 1)
    return raw.select(strip_header(header).alias("id"), header.alias("header"), F.upper(F.regexp_replace(F.regexp_replace(record, r"^[^\n]*\n?", ""), r"\s", "")).alias("seq"))


def first_records(records: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records of files in the order of their lines; each task hands on n at most."""
    return records.withColumn("_place", F.monotonically_increasing_id()).orderBy("_place").limit(n).drop("_place")


def read_qual(spark: SparkSession, path: str) -> DataFrame:
    """id, quals of a .qual file: numbers in place of bases."""
    raw = spark.read.option("lineSep", "\n>").text(path).where(F.trim("value") != "")
    record = F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", "")
    numbers = F.trim(F.regexp_replace(F.regexp_replace(record, r"^[^\n]*\n?", ""), r"\s+", " "))
    return raw.select(strip_header(F.regexp_extract(record, r"^([^\n]*)", 1)).alias("id"), F.split(numbers, " ").cast("array<int>").alias("quals"))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """read_id, seq, qual, file of four-line FASTQ. path: a file, a folder or a glob, in the cluster's default file system
    if it names none, or several of these joined by commas.

    Plain files are split like text; compressed ones are read by one task each, as they can't be.
    """
    hadoop, found = spark._jvm.org.apache.hadoop.fs, []
    conf = spark._jsc.hadoopConfiguration()
    for one in path.split(","):
        where = hadoop.Path(one)
        fs = where.getFileSystem(conf)
        matched = fs.globStatus(where)
        if not matched:
            raise FileNotFoundError(one)
        for status in matched:
            inside = [s for s in fs.listStatus(status.getPath()) if s.isFile() and ".f" in s.getPath().getName()] if status.isDirectory() else [status]
            found += [(s.getPath().toUri().toString(), s.getLen()) for s in inside]
    spark.dataSource.register(FastqSource)
    return spark.read.format("taxaflow_fastq").option("files", json.dumps(sorted(found))).load()


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """file: the names of the files in a folder or glob, for ``sheet_of_files``."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"))


def read_pairs(spark: SparkSession, first: str, second: str) -> DataFrame:
    """read_id, r1, q1, r2, q2 of paired files, joined on the read's name without its mate mark."""
    name = F.regexp_replace("read_id", r"(/[12]|[ _][12](:.*)?)$", "")
    one = read_fastq(spark, first).select(name.alias("read_id"), F.col("seq").alias("r1"), F.col("qual").alias("q1"))
    return one.join(read_fastq(spark, second).select(name.alias("read_id"), F.col("seq").alias("r2"), F.col("qual").alias("q2")), "read_id")


def read_barcodes(spark: SparkSession, reads: DataFrame, path: str) -> DataFrame:
    """Reads with the barcode of an index FASTQ, joined on the read's first word."""
    word = F.substring_index("read_id", " ", 1)
    index = read_fastq(spark, path).select(word.alias("_word"), F.col("seq").alias("barcode_read"))
    return reads.withColumn("_word", word).join(index, "_word").drop("_word")


def read_uniques(spark: SparkSession, path: str) -> DataFrame:
    """unique_id, seq, size of dereplicated FASTA, by size."""
    rows = read_fasta(spark, path)
    return rows.select(F.col("id").alias("unique_id"), "seq", size_tag(F.col("header")).alias("size")).orderBy(F.desc("size"), "unique_id")


def with_samples(reads: DataFrame, separator: str = "___") -> DataFrame:
    return reads.withColumn("sample_id", sample_of_read(F.col("read_id"), separator))


class FastqSource(DataSource):
    """Records of the files in option ``files``: a JSON list of URI and length, which ``read_fastq`` makes."""

    @classmethod
    def name(cls) -> str:
        return "taxaflow_fastq"

    def schema(self) -> str:
        return "read_id string, seq string, qual string, file string"

    def reader(self, schema) -> DataSourceReader:
        return FastqReader(json.loads(self.options["files"]))


class FastqReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files

    def partitions(self) -> list[InputPartition]:
        out = []
        for file, size in self.files:
            step = size if file.endswith(COMPRESSED) else SPLIT_BYTES
            out += [InputPartition((file, at, min(at + step, size))) for at in range(0, size, max(step, 1))]
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        file, start, end = partition.value
        where, path = fs.FileSystem.from_uri(file.replace("file:/", "file:///", 1) if re.match("file:/[^/]", file) else file)
        if file.endswith(COMPRESSED):
            raw, end = where.open_input_stream(path, compression="detect"), None
        else:
            raw = where.open_input_file(path)
            raw.seek(start)
        with raw, io.BufferedReader(raw, 1 << 20) as lines:
            rows: list[tuple[str, str, str, str]] = []
            for record in _records(lines, start, end):
                if not record[0].startswith(b"@") or not record[2].startswith(b"+") or len(record[1]) != len(record[3]):
                    raise ValueError(f"{file}: not a FASTQ record at {record[0]!r}")
                rows.append((record[0][1:].decode(), record[1].upper().decode(), record[3].decode(), path))
                if len(rows) == BATCH:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple[str, str, str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], ["read_id", "seq", "qual", "file"])


def _records(lines: io.BufferedReader, start: int, end: int | None) -> Iterator[list[bytes]]:
    """Records that begin after ``start`` (or at 0) and up to ``end`` of a file whose reader stands at ``start``; all without an end.

    A split may begin within a record: of the next lines the first one is sought that begins with @ while the one after the
    next begins with + and the lines between and after are as long as each other. Quality lines may begin with @, but then
    the line after the next is bases.
    """
    at = start
    queue: list[bytes] = []

    def fill(n: int) -> bool:
        while len(queue) < n:
            line = lines.readline()
            if not line:
                return False
            queue.append(line)
        return True

    def bare(line: bytes) -> bytes:
        return line.rstrip(b"\r\n")

    if start and end is not None:
        at += len(lines.readline())  # the record of a line that begins at ``start`` belongs to the split before
        while fill(4):
            a, seq, plus, qual = queue[:4]
            if a.startswith(b"@") and plus.startswith(b"+") and len(bare(seq)) == len(bare(qual)):
                break
            at += len(queue.pop(0))
        else:
            return
    while (end is None or at <= end) and fill(1):
        fill(4)
        record, queue[:4] = queue[:4], []
        at += sum(map(len, record))
        if any(map(bare, record)):
            yield [bare(x) for x in record] + [b""] * (4 - len(record))
