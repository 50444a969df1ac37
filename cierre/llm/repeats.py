"""Removal of passages that an earlier document holds, by suffix buckets.

Every byte covered by a string of ``length`` bytes that also starts in a
document with a smaller id is removed. Suffixes are put into buckets by their
first bytes, and buckets are refined by the bucket identifiers of later offsets
until they agree on ``length`` bytes:

1. Suffixes with the same first ``GRAM`` bytes share a bucket. Its identifier is
   itself built by doubling: bucket(p, 2k) names the pair (bucket(p, k),
   bucket(p + k, k)), and each level is used again by the next. Of all
   suffixes only the anchors are asked for: the smallest identifier in each
   window of ``length`` bytes. Equal windows have equal anchors, so a window
   whose anchor's bucket holds one document only has no twin.
2. Suffixes in buckets of two documents or more are refined to ``length``
   bytes by the identifiers at offsets GRAM and 2 GRAM. The refined bucket's
   smallest document decides.

Identifiers are 64-bit names of the strings, the same on every machine, so a
refinement needs no shuffle; only the question which buckets are shared goes
through the cluster (``exchange``). Two different strings share a name with a
chance of 2^-64 a pair. Exact copies of a document are settled first, by a
digest, so that large groups of copies send their windows once.

Defined results: a null text is empty; texts under ``length`` bytes lose
nothing; a null doc_id sorts last; rows with the same doc_id are no earlier
document for each other; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.llm import exchange as X
from cierre.llm.ship import give_back
from cierre.session import cut_lineage

LENGTH = 50
GRAM = 24
_SEGMENT = 1 << 16
_LEVEL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_BYTE = X.mix(np.arange(1, 257, dtype=np.uint64) * _LEVEL[0])
SPANS_SCHEMA = "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary"


def _join(a: np.ndarray, b: np.ndarray, gap: int, level: int) -> np.ndarray:
    """Names of the pairs (a at p, b at p + gap)."""
    n = len(b) - gap
    out = a[:n] * _LEVEL[level]
    out += b[gap:]
    return out


def gram_names(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the 2 and of the GRAM bytes at each offset that has them."""
    n2 = _join(_BYTE[buf], _BYTE[buf], 1, 1)
    n4 = _join(n2, n2, 2, 2)
    n8 = _join(n4, n4, 4, 3)
    n16 = _join(n8, n8, 8, 4)
    return n2, _join(n16, n8, 16, 5)


def refine(n2: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Names of LENGTH bytes from those at the offsets 0, GRAM and 2 GRAM."""
    out = _join(_join(gram, gram, GRAM, 6), n2, 2 * GRAM, 7)
    return X.mix(out)


def lowest(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    size = 1
    while size * 2 <= width:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    return np.minimum(a[: len(a) - (width - size)], a[width - size :]) if size < width else a


def anchor_runs(body: bytes, begin: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: start, end, document, anchor's name."""
    buf = np.frombuffer(body, np.uint8)
    total = len(buf) - LENGTH + 1
    starts, names = [], []
    for a in range(0, max(total, 0), _SEGMENT):
        part = buf[a : min(a + _SEGMENT, total) + LENGTH - 1]
        low = lowest(X.mix(gram_names(part)[1]), LENGTH - GRAM + 1)
        last = begin[np.searchsorted(begin, a) : np.searchsorted(begin, a + len(low))] - a
        new = np.ones(len(low), bool)
        new[1:] = low[1:] != low[:-1]
        new[last] = True
        at = np.flatnonzero(new)
        starts.append(at + a)
        names.append(low[at])
    if not starts:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    start, name = np.concatenate(starts), np.concatenate(names)
    doc = np.searchsorted(begin, start, "right") - 1
    end = np.minimum(np.append(start[1:], total), begin[doc] + lens[doc] - LENGTH + 1)
    ok = end > start
    return start[ok], end[ok], doc[ok], name[ok]


def _first(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, each one's smallest value, and each row's place."""
    n = len(keys)
    if not n:
        return keys, np.empty(0, np.int64), np.empty(0, np.int32)
    order = np.argsort(keys).astype(np.int32 if n < 1 << 31 else np.int64)
    ranked = keys[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first = np.flatnonzero(new)
    distinct = ranked[first]
    del ranked
    low = np.minimum.reduceat(values[order], first)
    place = np.empty(n, order.dtype)
    place[order] = np.cumsum(new, dtype=order.dtype) - 1
    return distinct, low, place


class Texts:
    def __init__(self, payload: bytes):
        self.ids, self.lens, self.body = X.open_block(payload)
        self.begin = np.cumsum(self.lens) - self.lens

    def digests(self) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(self.body[b : b + n]) if n >= LENGTH else 0
                         for b, n in zip(self.begin.tolist(), self.lens.tolist())], np.uint64)

    def windows(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and names of the windows that start in the ranges."""
        buf = np.frombuffer(self.body, np.uint8)
        kind = np.int32 if len(buf) < 1 << 30 else np.int64
        at, names = [np.empty(0, kind)], [np.empty(0, np.uint64)]
        for a, b in zip(starts.tolist(), ends.tolist()):
            for s in range(a, b, _SEGMENT):
                e = min(s + _SEGMENT, b)
                names.append(refine(*gram_names(buf[s : e + LENGTH - 1])))
                at.append(np.arange(s, e, dtype=kind))
        return np.concatenate(at), np.concatenate(names)

    def without(self, k: int, spans: list[tuple[int, int]]) -> bytes:
        """Document k less the spans."""
        b, edge = int(self.begin[k]), [0, *(x for s in spans for x in s), int(self.lens[k])]
        return b"".join([self.body[b + x : b + y] for x, y in zip(edge[::2], edge[1::2])])

    def whole_characters(self, k: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The spans, shrunk to whole UTF-8 characters."""
        b, n, out = int(self.begin[k]), int(self.lens[k]), []
        inside = lambda at: at < n and self.body[b + at] & 0xC0 == 0x80
        for s, e in spans:
            while s < e and inside(s):
                s += 1
            while e > s and inside(e):
                e -= 1
            if s < e:
                out.append((s, e))
        return out

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        # begin has ties where texts are empty; the last of them holds the byte
        return np.searchsorted(self.begin, at, "right") - 1


def _each(fn):
    """fn(row) gives batches for one block; a block at a time in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in X.each_row(batches):
            yield from fn(row)
            give_back()

    return run


def _settled(t: Texts, row: dict) -> np.ndarray:
    """Documents that copy an earlier one."""
    digest = t.digests()
    keys, low, place = _first(digest, t.ids)
    earlier = low - X.answered(row["answer0"])
    return (digest != 0) & (earlier[place] < t.ids)


def _candidates(row: dict) -> tuple[Texts, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    t = Texts(row["payload"])
    copy = _settled(t, row)
    start, end, doc, name = anchor_runs(t.body, t.begin, t.lens)
    ok = ~copy[doc]
    return t, start[ok], end[ok], doc[ok], name[ok]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What each document loses: byte spans (``starts``, ``ends``, maximal and in
    order) and the remaining bytes ``kept``."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

    def tell(t: Texts, spans: list[list[tuple[int, int]]], payload: bytes) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(spans), 512):
            rows = range(a, min(a + 512, len(spans)))
            columns = ([None if t.ids[k] == X.NO_ID else int(t.ids[k]) for k in rows], [int(t.lens[k]) for k in rows],
                       [[s for s, _ in spans[k]] for k in rows], [[e for _, e in spans[k]] for k in rows],
                       [t.without(k, spans[k]) for k in rows])
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)],
                                             names=["doc_id", "n_bytes", "starts", "ends", "kept"])

    return _search(X.text_blocks(docs, id_col, text_col), tell, SPANS_SCHEMA)


def trimmed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with all its columns, its texts without the repeated passages, and
    their new length in ``n_chars_col`` if there is such a column. Only whole
    characters are removed; a text that is repeated wholly becomes empty."""
    names, schema = docs.columns, docs.schema

    def tell(t: Texts, spans: list[list[tuple[int, int]]], payload: bytes) -> Iterator[pa.RecordBatch]:
        columns = dict(zip(names, X.carried(payload)))
        for a in range(0, len(spans), 512):
            rows = range(a, min(a + 512, len(spans)))
            texts = [t.without(k, t.whole_characters(k, spans[k])).decode("utf-8", "replace") for k in rows]
            part = {n: c.slice(a, len(rows)).combine_chunks() for n, c in columns.items()}
            part[text_col] = pa.array(texts, pa.string())
            if n_chars_col in part:
                part[n_chars_col] = pa.array(map(len, texts), pa.int64()).cast(part[n_chars_col].type)
            yield pa.RecordBatch.from_arrays([part[n] for n in names], names=names)

    return _search(X.text_blocks(docs, id_col, text_col, carry=tuple(names)), tell, schema)


def _search(blocks: DataFrame, tell, schema) -> DataFrame:
    """``tell(texts, spans of each document, payload)`` gives a block's result."""

    def ask_copies(row):
        t = Texts(row["payload"])
        keys, low, _ = _first(t.digests(), t.ids)
        yield from X.request_rows(row["block"], keys, low, few)

    few = X.bucket_count(blocks, bytes_per_key=2000)
    copies = cut_lineage(X.exchange(blocks, ask_copies, few, "min"))

    def ask_anchors(row):
        _, _, _, doc, name = _candidates(row)
        order = np.lexsort((doc, name))
        name, doc = name[order], doc[order]
        new = np.ones(len(name), bool)
        new[1:] = name[1:] != name[:-1]
        other = np.zeros(len(name), bool)
        other[1:] = ~new[1:] & (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        held = 1 + np.add.reduceat(other, first, dtype=np.uint64) if len(first) else np.empty(0, np.uint64)
        yield from X.request_rows(row["block"], name[first], np.minimum(held, 2).astype(np.uint64), many)
        del name, doc, new, other, order
        give_back()

    many = X.bucket_count(blocks, bytes_per_key=6)
    with_copies = X.with_answers(blocks, copies)
    anchors = X.exchange(with_copies, ask_anchors, many, "sum")

    def ranges(row):
        """Ranges of windows whose anchor two documents or more hold."""
        t, start, end, doc, name = _candidates(row)
        _, place = np.unique(name, return_inverse=True)
        shared = X.answered(row["answer1"])[place] > 1 if len(name) else np.empty(0, bool)
        start, end, doc = start[shared], end[shared], doc[shared]
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != end[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1 if len(first) else first
        copy = _settled(t, row)
        yield X.record("block long, ranges binary", [row["block"]], [X.pack(start[first], end[last], copy.astype(np.uint8))])

    both = X.with_answers(blocks, copies, anchors)
    found = cut_lineage(both.mapInArrow(_each(ranges), "block long, ranges binary"))
    ranged = blocks.join(found, "block")

    def ask_windows(row):
        t = Texts(row["payload"])
        start, end, _ = X.unpack(row["ranges"])
        at, name = t.windows(start, end)
        ids = t.ids[t.doc_of(at)]
        del at
        keys, low, _ = _first(name, ids)
        del name, ids
        yield from X.request_rows(row["block"], keys, low, some)
        del keys, low
        give_back()

    some = X.bucket_count(blocks, bytes_per_key=2)
    windows = X.exchange(ranged, ask_windows, some, "min")

    def finish(row):
        t = Texts(row["payload"])
        start, end, copy = X.unpack(row["ranges"])
        at, name = t.windows(start, end)
        ids = t.ids[t.doc_of(at)]
        _, low, place = _first(name, ids)
        gone = at[(low - X.answered(row["answer0"]))[place] < ids] if len(at) else at
        del at, name, ids, low, place  # the largest arrays, before the texts are made
        doc = t.doc_of(gone)
        new = np.ones(len(gone), bool)
        new[1:] = (gone[1:] > gone[:-1] + LENGTH) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(gone)) - 1 if len(first) else first
        span_doc, lo, hi = doc[first], gone[first], gone[last] + LENGTH
        cut = np.searchsorted(span_doc, np.arange(len(t.ids) + 1))
        spans = []
        for k, (b, n) in enumerate(zip(t.begin.tolist(), t.lens.tolist())):
            mine = slice(cut[k], cut[k + 1])
            spans.append([(0, n)] if copy[k] else list(zip((lo[mine] - b).tolist(), (hi[mine] - b).tolist())))
        yield from tell(t, spans, row["payload"])

    final = X.with_answers(ranged, windows).drop("n_docs", "n_bytes")
    return final.mapInArrow(_each(finish), schema)


def digest(spans: DataFrame) -> DataFrame:
    """One row of figures for each document of ``repeated_spans``."""
    removed = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return spans.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
