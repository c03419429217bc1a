"""Token-id files: independent zstandard frames, a trailing seek table and a checksum per frame.

A file is a valid zstandard stream. It holds the ids of its documents in order, cut into frames of a fixed number of
ids whatever the documents' borders, then one skippable frame with the document table, then the seek table of the
public zstandard seekable format: (compressed size, content size, checksum of the content) per frame. A reader gets
any document by decompressing only the frames that its ids lie in.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from bodega.llm import common
from bodega.llm.tokens import encoder

END_ID = 2
#: Ids in a frame, the unit that a reader decompresses.
FRAME_IDS = 65_536
LEVEL = 3
#: About so many bytes of texts are tokenized together.
PART = 16_000_000
MANIFEST = "file long, path string, n_docs long, n_ids long, n_bytes long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long, file long"

# Fixed values of the public zstandard formats: skippable frames and the seekable format's footer.
TABLE_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80


def checksum(content: bytes) -> int:
    """The low 32 bits of XXH64, as the seekable format has it."""
    import xxhash

    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class Writer:
    """Writes one file; ids arrive as packed unsigned 32-bit numbers, document by document."""

    def __init__(self, out, id_bytes: int, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        import zstandard

        self.out, self.id_bytes, self.frame = out, id_bytes, frame_ids * id_bytes
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.waiting = bytearray()
        self.seek: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int | None, int]] = []
        self.n_ids = self.n_bytes = 0

    def write(self, block: bytes) -> None:
        self.out.write(block)
        self.n_bytes += len(block)

    def add(self, doc_id: int | None, packed: bytes) -> None:
        self.docs.append((doc_id, len(packed) // 4))
        self.n_ids += len(packed) // 4
        self.waiting += packed if self.id_bytes == 4 else np.frombuffer(packed, "<u4").astype("<u2").tobytes()
        at = 0
        while len(self.waiting) - at >= self.frame:
            self.flush(bytes(self.waiting[at:at + self.frame]))
            at += self.frame
        if at:
            del self.waiting[:at]

    def flush(self, content: bytes) -> None:
        block = self.compressor.compress(content)
        self.write(block)
        self.seek.append((len(block), len(content), checksum(content)))

    def close(self) -> None:
        if self.waiting:
            self.flush(bytes(self.waiting))
        known = np.array([d is not None for d, _ in self.docs], "u1")
        table = b"".join([
            struct.pack("<BQQ", self.id_bytes, len(self.docs), self.frame // self.id_bytes),
            np.array([d or 0 for d, _ in self.docs], "<i8").tobytes(), known.tobytes(),
            np.array([n for _, n in self.docs], "<u8").tobytes(),
        ])
        table = self.compressor.compress(table)
        block = struct.pack("<II", TABLE_MAGIC, len(table)) + table
        self.write(block)
        self.seek.append((len(block), 0, 0))
        entries = b"".join(struct.pack("<III", *e) for e in self.seek)
        self.write(struct.pack("<II", SEEK_MAGIC, len(entries) + 9) + entries
                   + struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEKABLE_MAGIC))


@dataclass
class Document:
    doc_id: int | None
    start: int
    length: int


class Reader:
    """Reads one file by its seek table. A damaged frame raises ValueError."""

    def __init__(self, source):
        import zstandard

        self.source, self.decompressor = source, zstandard.ZstdDecompressor()
        source.seek(0, io.SEEK_END)
        end = source.tell()
        source.seek(end - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the file")
        size = 12 * count
        source.seek(end - 9 - size - 8)
        head = struct.unpack("<II", source.read(8))
        if head != (SEEK_MAGIC, size + 9):
            raise ValueError("the seek table is damaged")
        entries = np.frombuffer(source.read(size), "<u4").reshape(count, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(entries[:, 0])])
        self.sizes, self.sums = entries[:, 1], entries[:, 2]
        source.seek(int(self.offsets[-2]) + 8)
        table = self.decompressor.decompress(source.read(int(entries[-1, 0]) - 8))
        self.id_bytes, docs, self.frame_ids = struct.unpack_from("<BQQ", table)
        ids = np.frombuffer(table, "<i8", docs, 17)
        known = np.frombuffer(table, "u1", docs, 17 + 8 * docs)
        lengths = np.frombuffer(table, "<u8", docs, 17 + 9 * docs).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        self.documents = [Document(int(i) if k else None, int(s), int(n))
                          for i, k, s, n in zip(ids, known, starts, lengths, strict=True)]
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, number: int) -> bytes:
        """The packed 32-bit ids of a frame; the last one read is kept."""
        if self._last[0] != number:
            self.source.seek(int(self.offsets[number]))
            block = self.source.read(int(self.offsets[number + 1] - self.offsets[number]))
            content = self.decompressor.decompress(block)
            if len(content) != self.sizes[number] or checksum(content) != self.sums[number]:
                raise ValueError(f"frame {number} is damaged")
            ids = content if self.id_bytes == 4 else np.frombuffer(content, "<u2").astype("<u4").tobytes()
            self._last = (number, ids)
        return self._last[1]

    def blocks(self, doc: Document) -> Iterator[bytes]:
        """A document's packed ids, a block per frame."""
        at, end = doc.start, doc.start + doc.length
        while at < end:
            number, inside = divmod(at, self.frame_ids)
            upto = min(end, (number + 1) * self.frame_ids)
            yield self.frame(number)[4 * inside:4 * (inside + upto - at)]
            at = upto

    def read(self, doc: Document) -> np.ndarray:
        return np.frombuffer(b"".join(self.blocks(doc)), "<u4")


def _open(uri: str):
    """The file system of a URI that every executor reaches, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)


def parts_of(batches: Iterator, size: int) -> Iterator:
    """Batches (doc_id, text) in parts of about `size` bytes of text."""
    import pyarrow.compute as pc

    for batch in batches:
        total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        edges = [0, *(np.flatnonzero(np.diff(total // size)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Tokenize, order by doc_id and write one file per task into `folder` (a new folder that all executors share).

    Returns the settled manifest: file, path, n_docs, n_ids, n_bytes; files ascend with their documents. Null doc_ids
    come first, repeated ones next to each other; null texts are empty. A task writes under a name of its own and
    renames at the end, so a lost executor's work is done again without harm.
    """
    import pyarrow as pa

    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, enc = TaskContext.get(), encoder(tokenizer)
        number = context.partitionId()
        files, base = _open(folder)
        files.create_dir(base, recursive=True)
        path = f"{base}/ids-{number:06d}.zst"
        own = f"{path}.{context.taskAttemptId()}"
        with files.open_output_stream(own, compression=None) as out:
            writer = Writer(out, 2 if max(enc.size, end_id + 1) <= 1 << 16 else 4)
            for part in parts_of(batches, PART):
                for doc_id, packed in zip(part.column(0).to_pylist(), enc.encode_all(part.column(1)), strict=True):
                    writer.add(doc_id, packed + end)
            writer.close()
        if writer.docs:
            files.move(own, path)
            yield pa.RecordBatch.from_pylist([{
                "file": number, "path": f"{folder}/ids-{number:06d}.zst", "n_docs": len(writer.docs),
                "n_ids": writer.n_ids, "n_bytes": writer.n_bytes}])
        else:
            files.delete_file(own)

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "row")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "row")
        .select("doc_id", "text")
    )
    return common.settle(ordered.mapInArrow(run, MANIFEST), "manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 (of 32-bit ids), file.

    `start` is the number of ids of all documents before it: those of the files before, which travel with the manifest's
    rows, and those before it in its file.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, path, before in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                files, place = _open(path)
                with files.open_input_file(place) as source:
                    reader, rows = Reader(source), []
                    for doc in reader.documents:
                        crc = 0
                        for block in reader.blocks(doc):
                            crc = zlib.crc32(block, crc)
                        rows.append((doc.doc_id, before + doc.start, doc.length, crc, number))
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32", "file"])

    # The manifest has a row per file, not per document, so one task can sum it.
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", "path", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)).alias("before"))
    return placed.repartition(F.col("file")).mapInArrow(run, ROWS)


def encode_documents(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write all documents as token files, read the files back, return a row per document."""
    spark: SparkSession = docs.sparkSession
    return read_files(write_files(docs, folder or common.scratch(spark, "token-files"), tokenizer, end_id))
