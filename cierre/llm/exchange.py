"""Blocks of documents, and the exchange of keys between all blocks.

Several operators ask the same question: for each of very many 64-bit keys
(n-grams, byte strings) that a document holds, what does the whole corpus say
about this key (a count, the smallest document)? A row per key would shuffle
hundreds of millions of rows. Here documents are gathered into compressed
blocks of about ``BLOCK_BYTES`` text; a block asks once for each of its
distinct keys, as sorted, delta-coded arrays, one per bucket of the key space:

    blocks --requests()--> (bucket, block, keys, values)    shuffled by bucket
           --answer()----> (block, bucket, values)          shuffled by block

Buckets are equal ranges of hashed keys, and a block sends a key once at most,
so a key that a third of all documents hold costs its bucket one entry a block.
The number of buckets follows the input, so that a bucket's arrays stay small
(``KEYS_PER_BUCKET``). Blocks are cut from the text by size, never from the
rows' keys, so hot sources or groups of copies have no task of their own.

The blocks are written to the shared checkpoint folder, partitioned by block:
joins of answers to blocks shuffle the answers alone, and a lost executor
reads the blocks again.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.llm.ship import ship
from cierre.session import cut_lineage

BLOCK_BYTES = 2 << 20
KEYS_PER_BUCKET = 1_000_000
BLOCK_SCHEMA = "block long, n_docs long, n_bytes long, payload binary"
REQUEST_SCHEMA = "bucket int, block long, payload binary"
ANSWER_SCHEMA = "block long, bucket int, payload binary"
#: A null doc_id sorts after every other and comes back as null.
NO_ID = np.iinfo(np.int64).max


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed value; bytes of like significance lie together."""
    out = [struct.pack("<I", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(struct.pack("<2sQ", a.dtype.str[1:].encode(), a.size))
        out.append(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.size else b"")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(data))
    (n,), at, out = struct.unpack_from("<I", raw), 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<2sQ", raw, at)
        dtype, at = np.dtype(kind.decode()), at + 10
        width = dtype.itemsize
        planes = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(-1))
        at += size * width
    return out


def least(a: np.ndarray) -> np.ndarray:
    """The same non-negative integers in the narrowest type."""
    return a.astype(np.min_scalar_type(int(a.max()) if a.size else 0))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection, in place)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def text_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Documents as compressed blocks in the checkpoint folder (``BLOCK_SCHEMA``).

    A null text counts as empty, a null id stays null. A document is never
    split: one longer than ``BLOCK_BYTES`` has a block of its own. The columns
    ``carry`` go with the documents as they are (``carried``), but for the text,
    which is null among them.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seq, ids, texts, rest, size = TaskContext.get().partitionId() << 36, 0, [], [], [], 0
        for batch in batches:
            begin, other = 0, batch.select(range(2, batch.num_columns))
            for row, (i, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                ids.append(NO_ID if i is None else i)
                texts.append(b"" if t is None else t)
                size += len(texts[-1]) + 16
                if size >= BLOCK_BYTES:
                    yield _block(base + seq, ids, texts, [*rest, other.slice(begin, row + 1 - begin)])
                    seq, ids, texts, rest, size, begin = seq + 1, [], [], [], 0, row + 1
            rest.append(other.slice(begin))
        if ids:
            yield _block(base + seq, ids, texts, rest)

    ship(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"),
                         *((F.lit(None).cast("string") if c == text_col else F.col(f"`{c}`")).alias(f"carried{n}")
                           for n, c in enumerate(carry)))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with _planned_ahead(docs.sparkSession):
        return cut_lineage(picked.mapInArrow(build, BLOCK_SCHEMA).repartition(n, "block"))


@contextmanager
def _planned_ahead(spark):
    """A checkpoint keeps the partitioning of a plan that is fixed beforehand, so
    joins by block don't shuffle the blocks again; an adaptive plan's is unknown."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _block(block: int, ids: list[int], texts: list[bytes], rest: list[pa.RecordBatch]) -> pa.RecordBatch:
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    squeeze = zstandard.ZstdCompressor(level=3).compress
    head, body, tail = pack(np.array(ids, np.int64), lens), squeeze(b"".join(texts)), b""
    if rest and rest[0].num_columns:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rest[0].schema) as out:
            for r in rest:
                out.write_batch(r)
        tail = squeeze(sink.getvalue().to_pybytes())
    payload = struct.pack("<II", len(head), len(body)) + head + body + tail
    return record(BLOCK_SCHEMA, [block], [len(ids)], [int(lens.sum())], [payload])


def open_block(payload: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """doc ids, byte lengths and the concatenated texts of a block."""
    n, m = struct.unpack_from("<II", payload)
    ids, lens = unpack(payload[8 : 8 + n])
    return ids, lens, zstandard.ZstdDecompressor().decompress(payload[8 + n : 8 + n + m])


def carried(payload: bytes) -> list[pa.ChunkedArray]:
    """The carried columns of a block's documents."""
    n, m = struct.unpack_from("<II", payload)
    data = zstandard.ZstdDecompressor().decompress(payload[8 + n + m :])
    return pa.ipc.open_stream(data).read_all().columns


_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64(),
          "boolean": pa.bool_()}


def record(schema: str, *columns) -> pa.RecordBatch:
    """A batch of the columns of a flat DDL schema."""
    fields = [f.split() for f in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, (_, k) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, so that one block's payload is copied at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {n: c[k].as_py() for n, c in zip(batch.schema.names, batch.columns)}


def bucket_count(blocks: DataFrame, bytes_per_key: float) -> int:
    """Buckets for one exchange, from the text's size."""
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(n, int(total / bytes_per_key / KEYS_PER_BUCKET) + 1)


def edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted keys, and the end."""
    at = (np.arange(1, buckets, dtype=object) << 64) // buckets
    return np.concatenate([[0], np.searchsorted(keys, at.astype(np.uint64)), [len(keys)]])


def request_rows(block: int, keys: np.ndarray, values: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """``keys`` sorted and distinct; one row for each bucket that has some."""
    at = edges(keys, buckets)
    full = np.flatnonzero(at[1:] > at[:-1])
    rows = []
    for b in full.tolist():
        k = keys[at[b] : at[b + 1]]
        v = values[at[b] : at[b + 1]]
        low = v.min() if v.dtype.kind == "i" else 0
        rows.append(pack(np.diff(k, prepend=np.uint64(0)), np.array([low], np.int64), least(v - low)))
    if rows:
        yield record(REQUEST_SCHEMA, full, [block] * len(rows), rows)


def exchange(blocks: DataFrame, request: Callable, buckets: int, combine: str, extra: Callable | None = None) -> DataFrame:
    """Answers (``ANSWER_SCHEMA``) to all blocks' requests.

    ``request(row)`` yields batches of ``request_rows`` for a block's row (a
    dict of the columns of ``blocks``). ``combine`` is ``sum`` or ``min``, over
    all blocks' values of a key. ``min`` answers how far the smallest value lies
    below the block's own. ``extra(keys, totals)`` may give an array that comes
    back in a row of block -1.
    """

    def ask(batches):
        for row in each_row(batches):
            yield from request(row)

    def answer(table: pa.Table) -> pa.Table:
        asked = [unpack(p.as_py()) for p in table.column("payload")]
        sizes = [len(a[0]) for a in asked]
        keys = np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in asked])
        own = np.concatenate([a[2].astype(np.int64) + a[1][0] for a in asked])
        del asked
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        total = (np.add if combine == "sum" else np.minimum).reduceat(own[order], first)
        out = np.empty(len(keys), np.int64)
        out[order] = np.repeat(total, np.diff(np.append(first, len(keys))))
        if combine == "min":
            out = own - out
        block, bucket, rows = table.column("block").to_pylist(), table.column("bucket")[0].as_py(), []
        at = 0
        for n in sizes:
            rows.append(pack(least(out[at : at + n])))
            at += n
        if extra is not None:
            block.append(-1)
            rows.append(pack(extra(ranked[first], total)))
        return pa.Table.from_batches([record(ANSWER_SCHEMA, block, [bucket] * len(rows), rows)])

    asked = blocks.mapInArrow(ask, REQUEST_SCHEMA)
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return asked.repartition(max(n, buckets // 4), "bucket").groupBy("bucket").applyInArrow(answer, ANSWER_SCHEMA)


def with_answers(blocks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Each block with its answers, as lists of (bucket, payload) named
    ``answer0``, ``answer1``, ...; a list is as large as the block's own keys."""
    out = blocks
    for k, a in enumerate(answers):
        got = a.filter("block >= 0").groupBy("block").agg(
            F.sort_array(F.collect_list(F.struct("bucket", "payload"))).alias(f"answer{k}"))
        out = out.join(got, "block", "left")
    return out


def answered(parts: list[dict] | None) -> np.ndarray:
    """A block's answers in the order of its sorted keys."""
    return np.concatenate([unpack(p["payload"])[0].astype(np.int64) for p in parts]) if parts else np.empty(0, np.int64)


def extras(answers: DataFrame) -> list[np.ndarray]:
    """What ``extra`` gave, one small array for each bucket."""
    return [unpack(r[0])[0] for r in answers.filter("block < 0").select("payload").toLocalIterator()]
