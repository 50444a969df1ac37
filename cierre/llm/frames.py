"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is in the seekable zstandard format: frames that can be decompressed
apart, then a skippable frame with the seek table (compressed and decompressed
size and checksum of each frame, number of frames, magic number). Decompressed,
a frame holds the ids of one document as little-endian unsigned 32-bit integers;
a document of more than ``FRAME_IDS`` ids has several frames. Another skippable
frame before the seek table lists the documents: ids, frames and tokens of each.
A reader takes a file's tail and then only the frames of the documents asked
for; every frame that is read is checked against its checksum.

Writing: the documents are encoded and compressed where they are read, sorted
by doc_id through a range shuffle of the compressed frames, and appended to
files by the tasks; a task rolls to the next file at ``FILE_BYTES``. A file gets
its name when it is complete, under a name of its own for each attempt of a
task; the catalog, a small table with a row for each file, names the files of
the attempts that succeeded. So a lost executor or a repeated task leaves
nothing wrong behind. The range key goes on after doc_id with a hash of the text
and the row's place, so rows that share one doc_id are spread over all tasks.

The folder must be one that all executors reach through Arrow's file systems.

Defined results: a null or empty text is the end id alone; rows without doc_id
come last; rows that share a doc_id are in the order of a hash of their texts;
an empty table gives an empty catalog; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cierre.llm import byte_ids
from cierre.llm import exchange as X
from cierre.llm.ship import ship
from cierre.session import cut_lineage, ensure_checkpoint_dir

END_ID = 0
FRAME_IDS = 1 << 20
FILE_BYTES = 128 << 20
#: Fixed values of the seekable format, and a skippable frame for the document table.
SEEK_MAGIC, SEEK_FRAME, DOCS_FRAME, CHECKSUMS = 0x8F92EAB1, 0x184D2A5E, 0x184D2A50, 0x80
FRAME = "doc_id long, tie long, seq long, frame int, n_ids long, checksum long, payload binary"
CATALOG = "part int, roll int, path string, n_docs long, n_ids long, n_frames long, first_id long, last_id long"
DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


class DamagedFrame(ValueError):
    """A frame or a table that does not hold what its checksum or size says."""


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system for a folder named as Spark names it."""
    scheme, colon, rest = uri.partition(":")
    if not colon:
        return arrow_fs.LocalFileSystem(), uri
    if scheme == "file":
        return arrow_fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return arrow_fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


def checksum(raw: bytes) -> int:
    """The format's checksum: the low 32 bits of XXH64 of the decompressed bytes."""
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class Writer:
    """Appends documents' frames to one file."""

    def __init__(self, folder: str, name: str):
        self.fs, root = file_system(folder)
        self.fs.create_dir(root, recursive=True)
        self.path, self.open_path = f"{root}/{name}", f"{root}/_open-{name}"
        self.uri = f"{folder.rstrip('/')}/{name}"
        self.out = self.fs.open_output_stream(self.open_path, compression=None)
        self.entries, self.ids, self.frames, self.tokens, self.size = [], [], [], [], 0

    def add(self, doc_id: int | None, new: bool, n_ids: int, check: int, payload: bytes) -> None:
        if new:
            self.ids.append(doc_id), self.frames.append(0), self.tokens.append(0)
        self.frames[-1] += 1
        self.tokens[-1] += n_ids
        self.entries.append((len(payload), 4 * n_ids, check))
        self.out.write(payload)
        self.size += len(payload)

    def close(self) -> tuple[str, int, int, int, int | None, int | None]:
        known = [i for i in self.ids if i is not None]
        table = X.pack(np.array([0 if i is None else i for i in self.ids], np.int64), np.array([i is None for i in self.ids], np.uint8),
                       np.array(self.frames, np.int64), np.array(self.tokens, np.int64))
        entries = np.array(self.entries, "<u4").tobytes()
        footer = struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", DOCS_FRAME, len(table)) + table)
        self.out.write(struct.pack("<II", SEEK_FRAME, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        self.fs.move(self.open_path, self.path)
        return (self.uri, len(self.ids), sum(self.tokens), len(self.entries), min(known, default=None), max(known, default=None))


class Reader:
    """Random access to one file's documents."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.uri, self.file = uri, fs.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_MAGIC or not flags & CHECKSUMS:
            raise DamagedFrame(f"{uri} has no seek table")
        width = 8 + 12 * n + 9
        raw = self.file.read_at(width, size - width)
        if struct.unpack_from("<II", raw) != (SEEK_FRAME, width - 8):
            raise DamagedFrame(f"{uri} has a damaged seek table")
        table = np.frombuffer(raw, "<u4", 3 * n, 8).reshape(n, 3).astype(np.int64)
        self.size, self.raw_size, self.check = table.T
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        kind, length = struct.unpack("<II", self.file.read_at(8, int(self.at[-1])))
        if kind != DOCS_FRAME or int(self.at[-1]) + 8 + length + width != size:
            raise DamagedFrame(f"{uri} has a damaged document table")
        ids, nulls, frames, self.tokens = X.unpack(self.file.read_at(length, int(self.at[-1]) + 8))
        self.ids = [None if gone else i for i, gone in zip(ids.tolist(), nulls.tolist())]
        self.known = len(self.ids) - int(nulls.sum())
        self.frame = np.concatenate([[0], np.cumsum(frames)])

    def frames(self, first: int, last: int) -> Iterator[bytes]:
        """The decompressed frames first..last-1, each checked."""
        for k in range(first, last):
            payload = self.file.read_at(int(self.size[k]), int(self.at[k]))
            try:
                raw = zstandard.ZstdDecompressor().decompress(payload, max_output_size=int(self.raw_size[k]))
            except zstandard.ZstdError as e:
                raise DamagedFrame(f"frame {k} of {self.uri} does not decompress") from e
            if len(raw) != self.raw_size[k] or checksum(raw) != self.check[k]:
                raise DamagedFrame(f"frame {k} of {self.uri} differs from its checksum")
            yield raw

    def document(self, k: int) -> Iterator[bytes]:
        """The ids of the file's k-th document, frame by frame."""
        return self.frames(int(self.frame[k]), int(self.frame[k + 1]))

    def places(self, doc_id: int) -> range:
        """Documents with this id; ids are ascending, those without one last."""
        return range(bisect_left(self.ids, doc_id, 0, self.known), bisect_right(self.ids, doc_id, 0, self.known))


def encoded_frames(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids and the end id as compressed frames (``FRAME``)."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    end, step = struct.pack("<I", END_ID), 4 * FRAME_IDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, squeeze, seq = byte_ids.encoder(definition.value), zstandard.ZstdCompressor(level=3).compress, TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, z in byte_ids.at_once(batch.column(1)):
                part, rows = batch.slice(a, z - a), []
                ids, at = enc.batch(part.column(1))
                at = at.tolist()
                for k, (i, tie) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist())):
                    raw, seq = ids[at[k] : at[k + 1]].tobytes() + end, seq + 1
                    for k, b in enumerate(range(0, len(raw), step)):
                        piece = raw[b : b + step]
                        rows.append((i, tie, seq, k, len(piece) // 4, checksum(piece), squeeze(piece)))
                yield X.record(FRAME, *zip(*rows))
        enc.forget()

    text = F.col(text_col).cast("string")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("tie"))
    return picked.mapInArrow(run, FRAME)


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents' ids below ``folder`` in ascending doc_id order; the
    catalog of the files (``CATALOG``), in the order of (part, roll)."""
    frames = cut_lineage(encoded_frames(docs, tokenizer_path, id_col, text_col))
    order = [F.col("doc_id").asc_nulls_last(), "tie", "seq"]
    run_name, most = uuid.uuid4().hex[:12], FILE_BYTES

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, roll, out, before = TaskContext.get().partitionId(), 0, None, None
        attempt = f"{run_name}-{TaskContext.get().taskAttemptId()}"
        for row in X.each_row(batches):
            new, before = row["seq"] != before, row["seq"]
            if out is not None and new and out.size >= most:
                yield X.record(CATALOG, [part], [roll], *([c] for c in out.close()))
                out, roll = None, roll + 1
            if out is None:
                out = Writer(folder, f"part-{part:06d}-{roll:04d}-{attempt}.ids.zst")
            out.add(row["doc_id"], new, row["n_ids"], row["checksum"], row["payload"])
        if out is not None:
            yield X.record(CATALOG, [part], [roll], *([c] for c in out.close()))

    ordered = frames.repartitionByRange(*order).sortWithinPartitions(*order, "frame")
    return cut_lineage(ordered.mapInArrow(write, CATALOG))


def _based(catalog: DataFrame) -> DataFrame:
    """The catalog with ``base``: the ids in all files before. The parts' totals
    are summed within groups of parts first, so no task sees all files' rows."""
    grouped = catalog.withColumn("group", F.floor(F.col("part") / 512))
    files = Window.partitionBy("group").orderBy("part", "roll").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("group").agg(F.sum("n_ids").alias("of_group"))
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("group", F.coalesce(F.sum("of_group").over(before), F.lit(0)).alias("groups_before"))
    inside = grouped.withColumn("files_before", F.coalesce(F.sum("n_ids").over(files), F.lit(0)))
    return inside.join(groups, "group").withColumn("base", F.col("groups_before") + F.col("files_before")).select(
        *catalog.columns, "base")


def read_digests(catalog: DataFrame) -> DataFrame:
    """Every document of the files, read back frame by frame (``DIGEST``)."""
    ship(catalog.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in X.each_row(batches):
            file, crcs = Reader(row["path"]), []
            for k in range(len(file.ids)):
                crc = 0
                for raw in file.document(k):
                    crc = zlib.crc32(raw, crc)
                crcs.append(crc)
            starts = row["base"] + np.cumsum(file.tokens) - file.tokens
            yield X.record(DIGEST, file.ids, starts, file.tokens, crcs)

    spread = _based(catalog).select("path", "base", "part", "roll")
    n = int(catalog.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spread.repartition(n, "part", "roll").mapInArrow(read, DIGEST)


def fetch(catalog: DataFrame, ids: list[int]) -> DataFrame:
    """(doc_id, ids) of the documents asked for; files whose range holds none of
    them are not opened, and other documents' frames are not read."""
    ship(catalog.sparkSession)
    wanted = catalog.sparkSession.sparkContext.broadcast(sorted(set(ids)))
    kinds = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in X.each_row(batches):
            if row["first_id"] is None:
                continue
            some = wanted.value[bisect_left(wanted.value, row["first_id"]) : bisect_right(wanted.value, row["last_id"])]
            file = Reader(row["path"]) if some else None
            for i in some:
                for k in file.places(i):
                    found = np.frombuffer(b"".join(file.document(k)), "<u4").astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([found], kinds.field(1).type)], schema=kinds)

    return catalog.mapInArrow(read, "doc_id long, ids array<long>")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/ids-{uuid.uuid4().hex}"
