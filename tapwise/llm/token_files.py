"""Token ids in files of independent zstandard frames, with a trailing seek table.

A file is a run of zstandard frames that any zstandard reader decompresses:

- data frames, each with the ids (little-endian unsigned 32-bit) of one or more whole documents in
  turn, or of a part of one document that is larger than a frame;
- one directory frame: a count, then all doc_ids (signed 64-bit), whether each is null (one byte),
  and all id counts (unsigned 64-bit);
- a skippable frame with the seek table: for each frame its compressed and decompressed size and a
  checksum (the low 32 bits of the XXH64 of its decompressed bytes), then the number of frames, a
  descriptor with the checksum flag, and a magic number.

The layout of the seek table is that of the public zstandard seekable format.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapwise.llm.memory import give_back
from tapwise.llm.scratch import new_path, stored
from tapwise.llm.tokens import encoder

FRAME_BYTES = 1 << 20
LEVEL = 3

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FILE_SCHEMA = "part int, path string, n_docs long, n_tokens long"
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"


def _checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Writes documents to a binary file, holding one frame at a time."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        self.out, self.frame_bytes = out, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)
        self.table: list[tuple[int, int, int]] = []
        self.held = bytearray()
        self.keys: list[int | None] = []
        self.counts: list[int] = []

    def _frame(self, data: bytes) -> None:
        packed = self.zstd.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data), _checksum(data)))

    def _flush(self) -> None:
        if self.held:
            self._frame(bytes(self.held))
            self.held.clear()

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key)
        self.counts.append(len(ids) // 4)
        if len(self.held) + len(ids) > self.frame_bytes:
            self._flush()
        if len(ids) <= self.frame_bytes:
            self.held += ids
            return
        for at in range(0, len(ids), self.frame_bytes):
            self._frame(ids[at : at + self.frame_bytes])

    def close(self) -> None:
        self._flush()
        null = np.array([key is None for key in self.keys], "u1")
        keys = np.array([key or 0 for key in self.keys], "<i8")
        counts = np.array(self.counts, "<u8")
        n = struct.pack("<Q", len(keys))
        self._frame(n + keys.tobytes() + null.tobytes() + counts.tobytes())
        entries = b"".join(struct.pack("<III", *entry) for entry in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEK_TABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)))
        self.out.write(entries + footer)


class FrameReader:
    """Reads documents of a file, decompressing only the frames that hold them."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, io.SEEK_END)
        file.seek(size - 9)
        frames, descriptor, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_TABLE_MAGIC or descriptor != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the file")
        file.seek(size - 9 - 12 * frames)
        entries = np.frombuffer(file.read(12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.sizes, self.sums = entries.T
        self.places = np.cumsum(self.packed) - self.packed
        self.decompressed = 0
        directory = self._frame(frames - 1)
        (n,) = struct.unpack_from("<Q", directory)
        keys = np.frombuffer(directory, "<i8", n, 8)
        null = np.frombuffer(directory, "u1", n, 8 + 8 * n)
        self.counts = np.frombuffer(directory, "<u8", n, 8 + 9 * n).astype(np.int64)
        self.keys = [None if gone else int(key) for key, gone in zip(keys, null)]
        # Documents and data frames both lie one after another over the same run of bytes.
        self.doc_ends = 4 * np.cumsum(self.counts)
        self.frame_ends = np.cumsum(self.sizes[:-1])

    def _frame(self, i: int) -> bytes:
        self.file.seek(int(self.places[i]))
        data = zstandard.ZstdDecompressor().decompress(
            self.file.read(int(self.packed[i])), max_output_size=int(self.sizes[i])
        )
        if len(data) != self.sizes[i] or _checksum(data) != self.sums[i]:
            raise ValueError(f"frame {i} is damaged")
        self.decompressed += 1
        return data

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, ids before it in the file, its ids) of the documents at the positions `wanted`."""
        at, data = -1, b""
        for i in range(len(self.keys)) if wanted is None else wanted:
            end = int(self.doc_ends[i])
            start = end - 4 * int(self.counts[i])
            parts, place = [], start
            frame = int(np.searchsorted(self.frame_ends, start, "right"))
            while place < end:
                if frame != at:
                    at, data = frame, self._frame(frame)
                first = int(self.frame_ends[frame]) - len(data)
                parts.append(data[place - first : end - first])
                place += len(parts[-1])
                frame += 1
            yield self.keys[i], start // 4, b"".join(parts)

    def find(self, doc_id: int | None) -> list[bytes]:
        """The ids of every document of that id."""
        return [ids for _, _, ids in self.documents([i for i, k in enumerate(self.keys) if k == doc_id])]


def write_token_files(
    docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """Writes the ids of all `docs` (doc_id, text) in ascending order of doc_id; returns one row per file.

    Each document is its text's ids by `vocabulary`, then `end_id`. Documents are dealt by ranges of
    doc_id, so the files, in the order of `part`, hold all documents in order. `folder` must be on
    storage that all executors share; by default it is a new one in the session's shared folder.
    A file appears under its final name only when it is whole, so a task that is run again, or
    twice, leaves the same file. `first_token` counts the ids in the files before.

    A null or empty text is the end id alone; null doc_ids come first; of repeated doc_ids each row
    is a document, in a fixed order; an empty table gives no files. Other columns of
    `docs` are not used.
    """
    folder = folder or new_path(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        store, root = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}.zst"
        draft = f"{root}/.{name}-{context.taskAttemptId()}"
        writer, out = None, None
        for batch in batches:
            if batch.num_rows and writer is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(draft)
                writer = FrameWriter(out, frame_bytes)
            keys = batch.column("doc_id").to_pylist()
            for key, ids in zip(keys, encode(batch.column("text"))):
                writer.add(key, ids + end)
        if writer is None:
            return
        writer.close()
        out.close()
        store.move(draft, f"{root}/{name}")
        give_back()
        row = [context.partitionId(), f"{folder}/{name}", len(writer.keys), sum(writer.counts)]
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        names = ["part", "path", "n_docs", "n_tokens"]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # A doc_id that very many rows share is spread over ranges by its texts.
    rows = rows.withColumn("_text", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_text").sortWithinPartitions("doc_id", "_text")
    files = stored(ordered.select("doc_id", "text").mapInArrow(write, FILE_SCHEMA))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_token_files(files: DataFrame) -> DataFrame:
    """All documents of the files of `write_token_files`: doc_id, start, n_tokens and ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(file["path"])
                with store.open_input_file(path) as source:
                    held: list[tuple] = []
                    for key, start, ids in FrameReader(source).documents():
                        held.append((key, file["first_token"] + start, len(ids) // 4, ids))
                        if len(held) == 500:
                            yield _batch(held)
                            held = []
                    if held:
                        yield _batch(held)
        give_back()

    # A row per file is so little that adaptive execution would read all files in one task; a number stays.
    spread = files.repartitionByRange(max(1, files.count()), "part")
    return spread.mapInArrow(read, DOC_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "start", "n_tokens", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)
