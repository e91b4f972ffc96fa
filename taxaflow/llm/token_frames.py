"""Token ids in files of independent zstandard frames with a trailing seek table.

File layout (little-endian)::

    frame 0 | frame 1 | ... | skippable frame: document index | skippable frame: seek table

One frame holds the ids (unsigned 32-bit) of one document and carries zstandard's content checksum. The
document index holds the doc_ids in file order (signed 64-bit, zstandard-compressed). The seek table is that
of the public seekable format: for each frame the compressed size, the decompressed size and the low 32 bits of
the XXH64 of its content, then the number of frames, a descriptor byte and a magic number. A reader takes the
tail of a file, and decompresses only the frames of the documents that it was asked for.

Files are written where ``spark.checkpoint.dir`` or the caller says, under a name of the task's attempt, and
count only when the manifest, written last, names them: a repeated or lost task leaves no half file behind.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, new_path
from .tokens import WordEncoder, encoder

#: Fixed values of the zstandard and seekable formats.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC, CHECKSUM_FLAG = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80

MANIFEST = "shard long, file string, first_doc long, last_doc long, n_docs long, n_ids long, n_bytes long"
ROWS = "doc_id long, start long, n_tokens long, ids binary"


class FrameWriter:
    """Appends documents to an open binary file; ``close`` adds the index and the seek table."""

    def __init__(self, out, level: int = 3):
        import zstandard

        self.zstd, self.out = zstandard, out
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.docs, self.table, self.bytes, self.ids = [], [], 0, 0

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        import xxhash

        frame = self.compress(ids)
        self._put(frame)
        self.docs.append(doc_id)
        self.table.append(struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.ids += len(ids) // 4

    def close(self) -> None:
        index = bytes(d is None for d in self.docs) + struct.pack(f"<{len(self.docs)}q", *(d or 0 for d in self.docs))
        index = self.zstd.ZstdCompressor(level=3, write_checksum=True).compress(index)
        self._put(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        body = b"".join(self.table) + struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEK_MAGIC)
        self._put(struct.pack("<II", SKIPPABLE_SEEK, len(body)) + body)


class FrameReader:
    """Reads a file by its tail; only the frames asked for are decompressed and checked."""

    def __init__(self, file, size: int):
        import zstandard

        self.file, self.zstd = file, zstandard
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("not a file of token frames")
        self.table = list(struct.iter_unpack("<III", self._at(size - 9 - 12 * n, 12 * n)))
        end = size - 17 - 12 * n
        frames = sum(t[0] for t in self.table)
        index = zstandard.ZstdDecompressor().decompress(self._at(frames + 8, end - frames - 8))
        self.docs = [None if null else d for null, (d,) in zip(index[:n], struct.iter_unpack("<q", index[n:]), strict=True)]

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def read(self, wanted: set | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, ids before it in this file, its ids) of the wanted documents, of all if None."""
        import xxhash

        unpack, offset, before = self.zstd.ZstdDecompressor(), 0, 0
        for doc_id, (packed, plain, check) in zip(self.docs, self.table, strict=True):
            if wanted is None or doc_id in wanted:
                ids = unpack.decompress(self._at(offset, packed), max_output_size=max(plain, 1))
                if len(ids) != plain or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != check:
                    raise ValueError(f"the frame of document {doc_id} is damaged")
                yield doc_id, before, ids
            offset, before = offset + packed, before + plain // 4


def write_token_frames(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, level: int = 3) -> DataFrame:
    """Encodes whole texts, appends ``end_id`` to each, and writes them in ascending doc_id order.

    Returns the manifest, a row for each file; file k holds smaller doc_ids than file k + 1. Null texts count
    as empty, so each document has ``end_id`` at least. Null doc_ids come first; rows that share a doc_id are
    all kept, next to each other, in the order of a hash of their text. Other columns are not read. An
    empty table gives an empty manifest.
    """
    spark = docs.sparkSession

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        task, enc, end = TaskContext.get(), encoder(WordEncoder, tokenizer_path), struct.pack("<I", end_id)
        where, root = fs.FileSystem.from_uri(path)
        name = f"{root}/shard-{task.partitionId():06d}-{task.taskAttemptId()}.tok"
        writer = out = None
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                if writer is None:
                    where.create_dir(root, recursive=True)
                    out = where.open_output_stream(name)
                    writer = FrameWriter(out, level)
                writer.add(doc_id.as_py(), enc.encode(text.as_py()) + end)
        if writer is not None:
            writer.close()
            out.close()
            ids = [d for d in writer.docs if d is not None]
            row = {"shard": task.partitionId(), "file": name.rpartition("/")[2], "first_doc": min(ids, default=None), "last_doc": max(ids, default=None), "n_docs": len(writer.docs), "n_ids": writer.ids, "n_bytes": writer.bytes}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([(k, pa.string() if k == "file" else pa.int64()) for k in row]))

    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ranged = id_text(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_frames(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """Reads documents back: doc_id, start (ids of all documents before it), n_tokens, ids (binary).

    ``doc_ids``: read only these documents, from only the files whose range holds one of them. The
    manifest has one row per file (thousands at most, as many as there were write tasks), so the driver
    plans with it.
    """
    files, base = [], 0
    wanted = None if doc_ids is None else {int(d) for d in doc_ids}
    for m in spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy("shard").collect():
        if wanted is None or (m.first_doc is not None and any(m.first_doc <= d <= m.last_doc for d in wanted)):
            files.append((m.file, m.n_bytes, base))
        base += m.n_ids

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(path)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for given in batches:
            for r in given.to_pylist():
                with where.open_input_file(f"{root}/{r['file']}") as file:
                    rows, size = [], 0
                    for doc_id, before, ids in FrameReader(file, r["n_bytes"]).read(wanted):
                        rows.append((doc_id, r["base"] + before, len(ids) // 4, ids))
                        size += len(ids)
                        if size > 4_000_000:
                            yield batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch(rows)

    plan = spark.createDataFrame(files, "file string, n_bytes long, base long")
    return plan.repartition(max(1, len(files))).mapInArrow(read, ROWS)


def token_frames(docs: DataFrame, tokenizer_path: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Writes token files (to the shared folder unless ``path`` is given) and reads every document back."""
    path = path or new_path(docs.sparkSession, "tokens")
    write_token_frames(docs, path, tokenizer_path, end_id)
    return read_token_frames(docs.sparkSession, path)
