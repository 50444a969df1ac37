"""Near-duplicates by SimHash, linked exactly with vantage-point trees.

A document's fingerprint has a bit set if it is set in over half of the XXH64
values (seed 42) of its word shingles. Documents whose fingerprints differ in
``distance`` bits or fewer are linked, and linked documents form classes.

Links are found among distinct fingerprints. A routing tree over a bounded,
fixed sample of them (``ROUTE_SAMPLE``) cuts the Hamming space into shards: at
each node a fingerprint goes to the near or the far side of the median
distance to a vantage point. A fingerprint is stored in one shard, and asks
every shard whose side it can reach within ``distance`` (triangle bound), so
no link is lost at a boundary. Inside a shard a tree over all its fingerprints
is searched the same way. A shard reports a spanning star of each class it
sees, at most one row a fingerprint, never the pairs.

Defined results: null and empty texts have the fingerprint zero and are linked
like any other; fewer words than a shingle's are one shingle; a class is named
by its smallest doc_id that is not null; repeated rows are rows of one class;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cierre.llm import exchange as X
from cierre.llm import graph
from cierre.llm.ship import ship
from cierre.session import cut_lineage

SEED = 42
#: Fingerprints that the routing tree is built on, and those it aims at for a shard.
ROUTE_SAMPLE = 16384
SHARD_SIZE = 65536
_LEAF = 64
_PART = 1 << 15
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64-bit SimHash of a text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], stops[:-1]])
    n, ones = len(words) - shingle + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, _PART):
        e = min(a + _PART, n)
        spans = zip(starts[a:e].tolist(), (stops[a + shingle - 1 : e + shingle - 1] - 1).tolist())
        h = np.fromiter((digest(joined[s:t], SEED) for s, t in spans), np.uint64, e - a)
        if len(h) < 200:
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:
            planes = h.view(np.uint8).reshape(-1, 8).T
            ones += np.concatenate([np.bincount(p, minlength=256) @ _BITS for p in planes])
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, fp): the fingerprint as a signed long, and a hash of the text."""
    ship(docs.sparkSession)
    schema = "doc_id long, digest long, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py() or b"", shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield X.record(schema, batch.column(0), batch.column(2), fp)

    text = F.col(text_col).cast("string")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.cast("binary"), _digest(text))
    return picked.mapInArrow(run, schema)


def _digest(text) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def hamming(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Node:
    """A vantage point, the median distance to it, and both sides; a leaf has a shard number."""

    __slots__ = ("point", "radius", "near", "far", "shard")

    def __init__(self, points: np.ndarray, depth: int, shards: list):
        self.shard = self.point = None
        if depth:
            self.point = points[len(points) // 2]
            d = hamming(points, self.point)
            self.radius = int(np.sort(d)[(len(d) - 1) // 2])
            near = points[d <= self.radius]
            if 0 < len(near) < len(points):
                self.near = Node(near, depth - 1, shards)
                self.far = Node(points[d > self.radius], depth - 1, shards)
                return
        self.point, self.shard = None, len(shards)
        shards.append(self)

    def route(self, fps: np.ndarray, at: np.ndarray, home: np.ndarray, distance: int) -> Iterator[tuple]:
        """(shard, places, whether each is stored there)."""
        if self.point is None:
            yield self.shard, at, home
            return
        d = hamming(fps[at], self.point).astype(np.int64)
        for child, there, reach in ((self.near, d <= self.radius, d - distance <= self.radius),
                                    (self.far, d > self.radius, d + distance > self.radius)):
            if reach.any():
                yield from child.route(fps, at[reach], (home & there)[reach], distance)


def links(stored: np.ndarray, asking: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place in stored, place in asking) within ``distance``, from one tree search."""
    stack = [(np.arange(len(stored)), np.arange(len(asking)))]
    while stack:
        here, who = stack.pop()
        if not len(here) or not len(who):
            continue
        d = radius = None
        if len(here) > _LEAF:
            point = stored[here[len(here) // 2]]
            d = hamming(stored[here], point)
            radius = int(np.sort(d)[(len(d) - 1) // 2])
        if radius is None or (d <= radius).all():
            for s in range(0, len(here), _LEAF):
                for a in range(0, len(who), _PART):
                    mine, ask = here[s : s + _LEAF], who[a : a + _PART]
                    x, y = np.nonzero(hamming(stored[mine][:, None], asking[ask][None, :]) <= distance)
                    if len(x):
                        yield mine[x], ask[y]
            continue
        far = hamming(asking[who], point).astype(np.int64)
        stack.append((here[d <= radius], who[far - distance <= radius]))
        stack.append((here[d > radius], who[far + distance > radius]))


def shard_edges(fps: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each linked fingerprint of a shard to its class's first one."""
    order = np.argsort(~home, kind="stable")
    fps, n_home = fps[order], int(home.sum())
    root = np.arange(len(fps))
    a, b, held = [], [], 0
    for x, y in links(fps[:n_home], fps, distance):
        x, y = root[x], root[y]
        differ = x != y
        a.append(x[differ]), b.append(y[differ])
        held += int(differ.sum())
        if held > 1 << 20:
            root, a, b, held = graph.local_roots(len(fps), np.concatenate([np.arange(len(fps)), *a]), np.concatenate([root, *b])), [], [], 0
    root = graph.local_roots(len(fps), np.concatenate([np.arange(len(fps)), *a]), np.concatenate([root, *b]))
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return fps[linked], fps[root[linked]]


def classes(marked: DataFrame, distance: int = 3) -> DataFrame:
    """``marked(doc_id, digest, fp)`` with ``component_id``."""
    spark = marked.sparkSession
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("low")))
    n = nodes.count()
    sample = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(ROUTE_SAMPLE).collect()
    depth = 0
    while (n >> depth) > SHARD_SIZE and (len(sample) >> depth) > 64:
        depth += 1
    shards: list = []
    tree = Node(np.array([r[0] for r in sample], np.int64).view(np.uint64), depth, shards)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def route(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, at, home in tree.route(fps, np.arange(len(fps)), np.ones(len(fps), bool), distance):
                yield X.record("shard int, fp long, home boolean", [shard] * len(at), fps[at].view(np.int64), home)

    def search(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        a, b = shard_edges(fps, table.column("home").to_numpy().astype(bool), distance)
        return pa.Table.from_batches([X.record("a long, b long", a.view(np.int64), b.view(np.int64))])

    routed = nodes.select("fp").repartition(parts, "fp").mapInArrow(route, "shard int, fp long, home boolean")
    edges = routed.groupBy("shard").applyInArrow(search, "a long, b long")
    roots = graph.components(edges)
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return marked.join(named.join(low, "root").select("fp", "component_id"), "fp").select(*marked.columns, "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    marked = cut_lineage(fingerprints(docs, shingle, id_col, text_col))
    out = classes(marked, distance)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one for each class: the one with the smallest doc_id
    (of several, the smallest hash of the text). Rows without doc_id stay."""
    marked = cut_lineage(fingerprints(docs, shingle, id_col, text_col))
    kept = classes(marked, distance).filter("doc_id = component_id").groupBy("fp", "component_id").agg(
        F.min("digest").alias("digest"))
    kept = kept.groupBy(F.col("component_id").alias("id"), "digest").agg(F.lit(True).alias("stays"))
    # The rows travel as one value, so that no name of theirs can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"),
                       _digest(F.col(text_col).cast("string")).alias("digest"))
    # Rows without doc_id stay, each by itself.
    rows = rows.withColumn("own", F.when(F.col("id").isNull(), F.monotonically_increasing_id()))
    chosen = rows.join(kept, ["id", "digest"], "left").filter("id IS NULL OR stays")
    one = chosen.groupBy("id", "digest", "own").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select(*[F.col("row")[c].alias(c) for c in docs.columns])
