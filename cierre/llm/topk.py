"""Exact top-k search by inner product with segment statistics.

A vector is cut into s segments; with segment means m and deviations d
(root of the summed squares about the mean), the inner product of q and x is at
most the sum over segments of len * mq * mx + dq * dx. Bounds are taken from
coarse to fine (``LEVELS``): candidates whose bound lies under the k-th best
score found so far are dropped, the rest go to the next level, and survivors
get their exact score.

The stated queries are searched against all rows in blocks: query blocks and
vector blocks of fixed size meet once each, in one task, and leave k rows for
each query there. Vector blocks are dealt out over keys, a few blocks each, and a
copy of the queries goes to every key; no key grows with the table.

Defined results: components are floor(scale * x). Vectors that are null or hold
a null or non-finite component, and rows without id, take no part; vectors are
compared with those of the same length; a repeated row is a row of its own (a
query's own row is left out, its twin is not); scores beyond a long are cut to
its range; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cierre.llm import exchange as X
from cierre.llm.ship import ship
from cierre.session import cut_lineage

LEVELS = (1, 4, 16)
QUERIES_PER_BLOCK = 1024
VECTORS_PER_BLOCK = 8192
BLOCKS_PER_KEY = 4
_BLOCK = "dim int, block long, asked long, payload binary"
_FOUND = "query_id long, query_row long, vec_id long, score long"


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows (id, v, q) as blocks of vectors of one length; ``row`` numbers them."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seq, held = TaskContext.get().partitionId() << 36, 0, {}

        def out(dim):
            ids, row, asked, parts = held.pop(dim)
            payload = X.pack(np.array(ids, np.int64), np.array(row, np.int64), np.array(asked, np.uint8),
                             np.concatenate(parts) if dim else np.empty(0))
            return X.record(_BLOCK, [dim], [row[0]], [sum(asked)], [payload])

        for batch in batches:
            for i, v, q in zip(*(c.to_pylist() for c in batch.columns)):
                if i is None or v is None or None in v:
                    continue
                x = np.array(v, np.float64)
                if not np.isfinite(x).all():
                    continue
                ids, row, asked, parts = held.setdefault(len(x), ([], [], [], []))
                for to, what in ((ids, i), (row, base + seq), (asked, q), (parts, x)):
                    to.append(what)
                seq += 1
                if len(ids) >= VECTORS_PER_BLOCK:
                    yield out(len(x))
        for dim in list(held):
            yield out(dim)

    return rows.mapInArrow(build, _BLOCK)


class _Side:
    """Vectors with their statistics at each level."""

    def __init__(self, payload: bytes, dim: int):
        self.ids, self.rows, _, flat = X.unpack(payload)
        self.x = flat.reshape(len(self.ids), dim)
        self.most = float(np.abs(self.x).max()) if self.x.size else 0.0
        self.levels = []
        for s in [n for n in LEVELS if n <= dim]:
            cut = np.linspace(0, dim, s + 1).astype(int)[:-1]
            length = np.diff(np.append(cut, dim))
            mean = np.add.reduceat(self.x, cut, axis=1) / length
            spread = self.x - np.repeat(mean, length, axis=1)
            self.levels.append(np.hstack([mean * np.sqrt(length), np.sqrt(np.add.reduceat(spread * spread, cut, axis=1))]))
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))


def _exact(q: np.ndarray, x: np.ndarray, safe: bool) -> np.ndarray:
    if safe:  # every partial sum is an integer below 2^53
        return (x @ q).astype(np.int64)
    whole = [int(c) for c in q.tolist()]
    low, high = -(2**63), 2**63 - 1
    return np.array([max(low, min(high, sum(a * int(b) for a, b in zip(whole, r)))) for r in x.tolist()], np.int64)


def search_block(q: _Side, x: _Side, k: int) -> list[tuple[int, int, int, int]]:
    """The k best rows of x for each row of q, ties to the smaller id."""
    dim = x.x.shape[1]
    safe = q.most * x.most * max(dim, 1) < 2**52
    found = []
    for i in range(len(q.ids)):
        other = x.rows != q.rows[i]
        slack = 1e-9 * q.norm[i] * x.norm + 1e-6
        left, floor = np.flatnonzero(other), None
        for level, mine in enumerate(q.levels):
            bound = x.levels[level][left] @ mine[i] + slack[left]
            if floor is None and len(left) > k:  # a first floor: exact scores where the coarse bound is highest
                probe = left[np.argpartition(-bound, k - 1)[:k]]
                floor = _exact(q.x[i], x.x[probe], safe).min()
            if floor is not None:
                left = left[bound >= floor]
        score = _exact(q.x[i], x.x[left], safe)
        best = np.lexsort((x.ids[left], -score if safe else np.array([-int(s) for s in score], object)))[:k]
        found += [(int(q.ids[i]), int(q.rows[i]), int(x.ids[left[b]]), int(score[b])) for b in best]
    return found


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """For each row where ``is_query``: its ``k`` best other rows.

    Returns query_id, rank (from 1), vec_id, score.
    """
    ship(vectors.sparkSession)
    floored = F.transform(F.col(vec_col).cast("array<double>"), lambda x: _floor(x * F.lit(scale)))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), floored.alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("q"))
    blocks = cut_lineage(_blocks(rows))

    def pick(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                dim, block, _, payload = (c[n].as_py() for c in batch.columns)
                ids, row, asked, flat = X.unpack(payload)
                mine = asked > 0
                part = flat.reshape(len(ids), dim)[mine].ravel()
                yield X.record(_BLOCK, [dim], [block], [int(mine.sum())], [X.pack(ids[mine], row[mine], asked[mine], part)])

    def gather(table: pa.Table) -> pa.Table:
        parts = [X.unpack(p.as_py()) for p in table.column("payload")]
        payload = X.pack(*(np.concatenate(p) for p in zip(*parts)))
        first = [table.column(c)[0].as_py() for c in ("dim", "block")]
        return pa.Table.from_batches([X.record(_BLOCK, *([c] for c in first), [0], [payload])])

    n_queries = blocks.agg(F.sum("asked")).first()[0] or 0
    groups = 1 + n_queries // QUERIES_PER_BLOCK
    queries = (blocks.filter("asked > 0").mapInArrow(pick, _BLOCK)
               .groupBy("dim", F.pmod(F.xxhash64("block"), F.lit(groups))).applyInArrow(gather, _BLOCK))
    # The queries go to the vectors: a copy of each group to every few blocks, which share a key.
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = max(n, 1 + blocks.count() // BLOCKS_PER_KEY)
    stored = blocks.select("dim", F.pmod(F.xxhash64("block"), F.lit(keys)).alias("part"), F.col("payload").alias("x"))
    copied = queries.select("dim", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(keys - 1).cast("bigint"))).alias("part"), F.col("payload").alias("q"))
    pairs = stored.join(copied, ["dim", "part"]).select("dim", "x", "q")

    def search(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                dim, x, q = (c[n].as_py() for c in batch.columns)
                out = search_block(_Side(q, dim), _Side(x, dim), k)
                if out:
                    yield X.record(_FOUND, *zip(*out))

    found = pairs.mapInArrow(search, _FOUND)
    w = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), F.asc("vec_id"))
    best = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def _floor(x: Column) -> Column:
    """floor as a double, so that large components keep their size; a value
    that is not finite stays so."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)
