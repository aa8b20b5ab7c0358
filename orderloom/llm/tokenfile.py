"""Token ids of documents in seekable zstandard files.

A file holds independent zstandard frames, each with the ids of some whole
documents as little-endian unsigned 32-bit numbers. Two skippable frames, which
any zstandard reader passes over, close it: the document index and the seek
table of the public seekable format, with one entry per frame (compressed size,
size, low 32 bits of the xxHash64 of the content) and a footer. A reader takes
the footer, the table and the index from the end and decompresses only the
frames of the documents that it is asked for, checking their checksums.

Documents are range-partitioned by id, so files in order of their number hold
ascending ids. A text is encoded once, in the task that writes it.

Defined cases: a null or empty text has the end id alone; null ids come first;
rows with one id are ordered by text and keep their own entries; an empty table
writes no file. Neighbouring rows with one id may lie in two files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.bpe import TEXT_BYTES, encoder, rest
from orderloom.llm.files import Sink, open_input, own_file
from orderloom.llm.words import bytewise
from orderloom.operators.storage import materialize, new_folder

# Fixed values of the seekable format, and a skippable frame of our own for the index.
SKIPPABLE_SEEK_TABLE, SEEKABLE_MAGIC, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
SKIPPABLE_INDEX, INDEX_MAGIC = 0x184D2A50, 0x58444E49
MOST_READERS = 50_000
FRAME_BYTES = 1 << 18
END_ID = 0


class Writer:
    """Writes one file, one frame at a time."""

    def __init__(self, path: str, level: int = 3):
        self.sink = Sink(path)
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.waiting: list[bytes] = []
        self.held = 0
        self.frames: list[tuple[int, int, int]] = []
        self.documents: list[tuple[int, int, int]] = []  # frame, first id in it, number of ids

    def add(self, ids: bytes) -> None:
        """Append one document; a frame ends after the document that fills it."""
        self.documents.append((len(self.frames), self.held // 4, len(ids) // 4))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if not self.waiting:
            return
        data = b"".join(self.waiting)
        packed = self.compressor.compress(data)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.sink.write(packed)
        self.waiting, self.held = [], 0

    def close(self) -> None:
        self.end_frame()
        index = np.array(self.documents, "<u8").reshape(-1, 3).tobytes()
        index = self.compressor.compress(index) + struct.pack("<II", len(self.documents), INDEX_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)
        self.sink.close()


class Reader:
    """Reads documents of one file by number, frame by frame."""

    def __init__(self, path: str):
        self.path, self.file = path, open_input(path)
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUMS:
            raise ValueError(f"{path}: no seek table with checksums at the end")
        table_at = size - 9 - 12 * frames - 8
        table = np.frombuffer(self._at(table_at + 8, 12 * frames), "<u4").reshape(-1, 3)
        self.sizes, self.checksums = table[:, 1].tolist(), table[:, 2].tolist()
        self.starts = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)]).tolist()
        data_end = self.starts[-1]
        index = self._at(data_end + 8, table_at - data_end - 8)
        n, magic = struct.unpack("<II", index[-8:])
        if magic != INDEX_MAGIC:
            raise ValueError(f"{path}: no document index before the seek table")
        rows = zstandard.ZstdDecompressor().decompress(index[:-8], max_output_size=max(1, 24 * n))
        self.documents = np.frombuffer(rows, "<u8").reshape(n, 3).astype(np.int64)
        self.frames_read = 0

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def frame(self, k: int) -> bytes:
        packed = self._at(self.starts[k], self.starts[k + 1] - self.starts[k])
        data = zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(1, self.sizes[k]))
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checksums[k]:
            raise ValueError(f"{self.path}: frame {k} does not match its checksum")
        self.frames_read += 1
        return data

    def read(self, numbers: Iterable[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """(number, ids) of the documents asked for, in ascending order; of all without numbers."""
        wanted = range(len(self.documents)) if numbers is None else sorted(set(numbers))
        held, data = -1, b""
        for number in wanted:
            frame, first, n = self.documents[number].tolist()
            if frame != held:
                held, data = frame, self.frame(frame)
            yield number, data[4 * first : 4 * (first + n)]

    def close(self) -> None:
        self.file.close()


@dataclass(frozen=True)
class TokenFiles:
    """``index``: per document ``doc_id``, ``file_number``, ``file``, ``number`` in it and ``n_tokens``."""

    folder: str
    index: DataFrame

    def starts(self) -> DataFrame:
        """Ids in all files before each file: one row per file, ordered in one window."""
        totals = self.index.groupBy("file_number", "file").agg(F.sum("n_tokens").alias("ids"))
        before = Window.orderBy("file_number").rowsBetween(Window.unboundedPreceding, -1)
        return totals.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("file_start"))


def _writing(folder: str, path: str, end_id: int, level: int):
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, end, number = None, struct.pack("<I", end_id), 0
        for batch in bytewise(batches, "_text", TEXT_BYTES):
            if writer is None:
                writer = Writer(own_file(folder, ".tokens.zst"), level)
            sizes = []
            for ids in encoder(path).encode(batch.column("_text").to_pylist()):
                writer.add(ids + end)
                sizes.append(len(ids) // 4 + 1)
            n = len(sizes)
            arrays = [
                batch.column("doc_id"),
                pa.array([TaskContext.get().partitionId()] * n, pa.int64()),
                pa.array([writer.sink.path] * n, pa.string()),
                pa.array(range(number, number + n), pa.int64()),
                pa.array(sizes, pa.int64()),
            ]
            number += n
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "file_number", "file", "number", "n_tokens"])
        if writer is not None:
            writer.close()
        rest(path)

    return run


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID, level: int = 3
) -> TokenFiles:
    """Encode ``docs`` (``doc_id, text``) with the vocabulary file ``tokenizer`` into ``folder``."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    spread = texts.withColumn("_tie", F.xxhash64("_text"))
    spread = spread.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "_text")
    kind = dict(texts.dtypes)["doc_id"]
    schema = f"doc_id {kind}, file_number bigint, file string, number bigint, n_tokens bigint"
    written = spread.select("doc_id", "_text").mapInArrow(_writing(folder, tokenizer, end_id, level), schema)
    return TokenFiles(folder, materialize(written, "token-index"))


def _reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive in order of file and number; one file is open, one frame in memory."""
    reader = None
    for batch in batches:
        ids, sums, sizes = [], [], []
        held = (-1, b"")
        for file, number in zip(batch.column("file").to_pylist(), batch.column("number").to_pylist()):
            if reader is None or reader.path != file:
                if reader is not None:
                    reader.close()
                reader, held = Reader(file), (-1, b"")
            frame, first, n = reader.documents[number].tolist()
            if frame != held[0]:
                held = (frame, reader.frame(frame))
            found = held[1][4 * first : 4 * (first + n)]
            ids.append(found)
            sizes.append(n)
            sums.append(zlib.crc32(found))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(ids, pa.binary())],
            names=[*batch.schema.names, "n_read", "ids_crc32", "ids"],
        )
    if reader is not None:
        reader.close()


def read_documents(files: TokenFiles, wanted: DataFrame | None = None) -> DataFrame:
    """``doc_id, file, number, n_tokens, ids_crc32, ids`` read back from the files.

    ``wanted`` (column ``doc_id``) limits what is read to the frames that hold these documents.
    """
    rows = files.index.select("doc_id", "file", "number")
    if wanted is not None:
        rows = rows.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    # A number of its own for each file or so: rows this small would otherwise be read by one task or two.
    tasks = max(1, min(MOST_READERS, files.index.select("file").distinct().count()))
    rows = rows.repartition(tasks, "file").sortWithinPartitions("file", "number")
    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, file string, number bigint, n_read bigint, ids_crc32 bigint, ids binary"
    return rows.mapInArrow(_reading, schema).withColumnRenamed("n_read", "n_tokens")


def document_digests(files: TokenFiles) -> DataFrame:
    """Per document, as read back: ``doc_id, start`` (ids before it), ``n_tokens``, ``ids_crc32``."""
    read = read_documents(files).select("doc_id", "file", "number", "n_tokens", "ids_crc32")
    read = read.join(F.broadcast(files.starts()), "file")
    before = Window.partitionBy("file").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("file_start") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    return read.select("doc_id", start.cast("bigint").alias("start"), "n_tokens", "ids_crc32")
