"""Alignment of two tokenizers' tokens over the same bytes.

A text with a blank before it is encoded by a byte-level BPE vocabulary (A) and
by a piece vocabulary with byte fallback (B). Each token ends at a byte; where
tokens of both end, a group of tokens ends. Within a group the byte ranges of A
and B tokens overlap in a staircase of links.

Groups are found by diagonal run skipping. With the arrays of ends and a
current shift between their indices, stretches of one-to-one tokens are equal
slices on the shifted diagonal: probes of 1, 2, 4, ... entries find how far it
goes, halving probes find where it stops. The irregular group that follows is
walked token by token until both end at one byte; the shift changes there. Many
texts are aligned in a row: both sides of a text end at one byte.

How often an A token and a B token are linked in all documents is counted in
two steps: a block of documents counts its own pairs, Spark sums them by pair;
then each block asks for the sums of its own pairs. A pair that every document
holds is one row a block.

Defined results: a null or empty text, and one that a vocabulary does not give
back byte for byte, has no tokens (zeros and an empty digest); null doc_ids stay
null; repeated rows are counted each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.llm import byte_ids, bpe
from cierre.llm import exchange as X
from cierre.llm.ship import ship
from cierre.session import cut_lineage

#: Links of a block of documents (a longer document has a block of its own).
BLOCK_LINKS = 1 << 20
#: Stretches encoded in a row.
_ROW = 1024
#: Stretches of a generation that a worker remembers the ids of.
_REMEMBERED = 250_000
_PAIRS: dict[str, "Pair"] = {}
OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
_BLOCK = "block long, keys binary, payload binary"
GROUPS = "doc_id long, a_first long, a_end long, b_first long, b_end long, byte_first long, byte_end long"


def irregular(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The irregular groups (first and end in a, first and end in b, a row each) of
    two ascending arrays of ends with the same last one. All between them is
    one-to-one."""
    n, i, j = len(a), 0, 0
    # Never equal, so that no stretch goes on beyond the ends.
    a, b = [*a.tolist(), -1], [*b.tolist(), -2]
    odd = []
    add = odd.extend
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            k = 1
            if a[i + 1] == b[j + 1]:
                k = step = 2
                while a[i + k : i + k + step] == b[j + k : j + k + step]:
                    k += step
                    step *= 2
                while step > 1:
                    step >>= 1
                    if a[i + k : i + k + step] == b[j + k : j + k + step]:
                        k += step
            i += k
            j += k
        else:
            i0, j0 = i, j
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i += 1
            j += 1
            add((i0, i, j0, j))
    return np.array(odd, np.int64).reshape(-1, 4)


def _inside(first: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n places lies in one of the ranges, which don't overlap."""
    steps = np.zeros(n + 1, np.int8)
    steps[first] += 1
    steps[end] -= 1
    return np.cumsum(steps[:-1], dtype=np.int8).astype(bool)


def _links(a: np.ndarray, b: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, ...]:
    """Whether each end of a, and of b, ends a group; and places in a and b of the
    links, those of one-to-one stretches and those of irregular groups."""
    i0, i1, j0, j1 = odd.T
    ends_a, ends_b = ~_inside(i0, i1 - 1, len(a)), ~_inside(j0, j1 - 1, len(b))
    in_a, in_b = _inside(i0, i1, len(a)), _inside(j0, j1, len(b))
    # In an irregular group each place where a token of either side ends links the tokens over it.
    odd_a, odd_b, inner_b = np.flatnonzero(in_a), np.flatnonzero(in_b), np.flatnonzero(~ends_b)
    over_a, over_b = odd_b[np.searchsorted(b[odd_b], a[odd_a])], odd_a[np.searchsorted(a[odd_a], b[inner_b])]
    return (ends_a, ends_b, (np.flatnonzero(~in_a), np.flatnonzero(~in_b)),
            (np.concatenate([odd_a, over_b]), np.concatenate([over_a, inner_b])))


def groups(a: list[int], b: list[int]) -> tuple[list[tuple], list[tuple], list[int], list[int]]:
    """One-to-one stretches (first in a, first in b, how many) and irregular groups
    (first and end in a, first and end in b) of two ascending lists of ends with
    the same last one, and the irregular groups' links (places in a and b)."""
    n, a, b = len(a), np.array(a, np.int64), np.array(b, np.int64)
    odd = irregular(a, b)
    *_, (link_a, link_b) = _links(a, b, odd)
    found = list(map(tuple, odd.tolist()))
    even = [(i, j, until - i) for (_, i, _, j), (until, *_) in zip([(0, 0, 0, 0), *found], [*found, (n,)]) if until > i]
    return even, found, link_a.tolist(), link_b.tolist()


def _steps(x: np.ndarray, first: int) -> np.ndarray:
    """Differences from the entry before, of the first from ``first``."""
    return np.diff(x, prepend=first)


class Pair:
    """Both vocabularies, and the tokens of texts in both."""

    def __init__(self, a_definition: str, b_model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.a = byte_ids.Encoder(a_definition, plain_specials=True)
        vocabulary, to_byte = self.a.tokenizer.get_vocab(with_added_tokens=False), bpe.byte_alphabet()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(to_byte.__getitem__, t))
        self.b = SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # No piece goes on over a blank: a text can be cut before blanks for B as well.
        self.local = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_size, self.b_size = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
        n, m = len(self.a_bytes), len(self.b_bytes)
        self.n, self.m = n, m
        # In fields of one width, zeros behind.
        self.listed = np.array([f"{i}{mark}".encode() for count, marks in ((n, ",|"), (m, ",;")) for mark in marks for i in range(count)])
        (self.lead,) = self.b.encode(["a"])
        if not {bytes([x]) for x in range(256)} <= set(self.a_bytes):
            raise ValueError("vocabulary A has no token for some bytes")
        self.known, self.of_a = byte_ids.Recent(_REMEMBERED), byte_ids.Recent()

    def forget(self) -> None:
        """A worker lives on after its task, which should not hold its memory."""
        self.a.forget()
        self.known, self.of_a = byte_ids.Recent(_REMEMBERED), byte_ids.Recent()

    def _learn(self, fresh: list[str]) -> None:
        """Both vocabularies' ids of stretches; None where B does not give one back."""
        self.a.after_blank(self.of_a.missing(fresh), self.of_a)
        of_b = self._learn_b(fresh)
        self.known.update((s, (self.of_a[s], of_b[s])) for s in fresh)

    def _learn_b(self, fresh: list[str]) -> dict[str, bytes | None]:
        of_b = {}
        # A blank that follows a blank or nothing may not begin a piece of its own.
        inner = [s for s in fresh if s and s[-1] != " "]
        for at in range(0, len(inner), _ROW):
            some = inner[at : at + _ROW]
            whole, found = " " + " ".join(some), self._b_ids([" " + " ".join(some)])[0]
            ids = np.array(found or [], np.int32)
            ends = np.cumsum(self.b_size[ids])
            wanted = np.cumsum(np.fromiter(map(len, map(str.encode, some)), np.int64, len(some)) + 1)
            last = np.minimum(np.searchsorted(ends, wanted), max(len(ends) - 1, 0))
            if found and (ends[last] == wanted).all() and whole.encode() == b"".join(map(self.b_bytes.__getitem__, found)):
                raw, cut = ids.tobytes(), (4 * last + 4).tolist()
                of_b.update(zip(some, [raw[x:y] for x, y in zip([0, *cut], cut)]))
            else:
                self._learn_apart(some, of_b)
        self._learn_apart([s for s in fresh if not s or s[-1] == " "], of_b)
        return of_b

    def _learn_apart(self, fresh: list[str], of_b: dict[str, bytes | None]) -> None:
        for s, b in zip(fresh, self._b_ids([" " + s for s in fresh])):
            fits = b is not None and (" " + s).encode() == b"".join(map(self.b_bytes.__getitem__, b))
            of_b[s] = np.array(b, np.int32).tobytes() if fits else None

    def _b_ids(self, texts: list[str]) -> list[list[int] | None]:
        """B's ids of texts that begin with a blank. B adds one to a text, but not to an
        empty one, so a word stands before each."""
        lead = len(self.lead)
        return [b[lead:] if b[:lead] == self.lead else None for b in self.b.encode(["a" + t for t in texts], num_threads=1)]

    def encoded(self, texts: pa.StringArray) -> tuple[np.ndarray, ...]:
        """Both vocabularies' ids of all texts (none of them null) in a row, and where
        each text's begin (and the end) in both; a text without tokens has none."""
        flat, offsets = byte_ids.cut(texts) if self.local else (texts, np.arange(len(texts) + 1))
        held = flat.dictionary_encode()
        words, which = held.dictionary.to_numpy(zero_copy_only=False).tolist(), held.indices.to_numpy().astype(np.int64)
        self._learn(self.known.missing(words))
        of_a, of_b = zip(*map(self.known.__getitem__, words)) if words else ((), ())
        keep = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
        if None in of_b:
            # A's single bytes are tokens, so that A gives every text back.
            lost = np.array([b is None for b in of_b], bool)[which]
            keep &= ~np.logical_or.reduceat(lost, offsets[:-1])
            of_b = [b or b"" for b in of_b]
        counts = np.diff(offsets)
        which, offsets = which[np.repeat(keep, counts)], np.concatenate([[0], np.cumsum(counts * keep)])
        ids, at = [], []
        for lists in (of_a, of_b):
            found, sizes = byte_ids.gather(lists, which)
            ids.append(found.astype(np.int64))
            at.append(byte_ids.by_text(sizes, offsets))
        return *ids, *at

    def tokens(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Both vocabularies' ids of each text; none for a text without tokens."""
        a, b, at_a, at_b = self.encoded(pa.array(texts, pa.string()))
        for k in range(len(texts)):
            yield a[at_a[k] : at_a[k + 1]], b[at_b[k] : at_b[k + 1]]

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """For tokens a and b of one text, or of many in a row: whether each token of a,
        and of b, ends its group, and the links (places in a, places in b)."""
        at_a, at_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends_a, ends_b, even, odd = _links(at_a, at_b, irregular(at_a, at_b))
        return ends_a, ends_b, *(np.concatenate(x) for x in zip(even, odd))

    def listing(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3;``: the groups' ids in decimal, in fields of one width."""
        after_a, after_b = np.flatnonzero(ends_a) + 1, np.flatnonzero(ends_b) + 1
        size_a, size_b = _steps(after_a, 0), _steps(after_b, 0)
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.repeat(after_b - size_b, size_a)] = a + self.n * ends_a
        out[np.arange(len(b)) + np.repeat(after_a, size_b)] = b + 2 * self.n + self.m * ends_b
        return self.listed[out].tobytes()


def pair_of(a_definition: str, b_model: bytes) -> Pair:
    """One for each worker process."""
    key = hashlib.sha256(a_definition.encode() + b_model).hexdigest()
    if key not in _PAIRS:
        _PAIRS[key] = Pair(a_definition, b_model)
    return _PAIRS[key]


def _vocabularies(spark, a_path: str, b_path: str):
    ship(spark)
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        return spark.sparkContext.broadcast((f.read(), g.read()))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def aligned_groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each group (``GROUPS``): its tokens' places in both
    vocabularies' sequences, and its bytes in a blank and the text."""
    vocabularies = _vocabularies(docs.sparkSession, a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*vocabularies.value)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ((a, b),) = pair.tokens([text.as_py() or ""])
                if len(a):
                    ends_a, ends_b, _, _ = pair.align(a, b)
                    a_end, b_end = np.flatnonzero(ends_a) + 1, np.flatnonzero(ends_b) + 1
                    bytes_end = np.cumsum(pair.a_size[a])[a_end - 1]
                    first = lambda x: np.concatenate([[0], x[:-1]])
                    yield X.record(GROUPS, [doc_id] * len(a_end), first(a_end), a_end, first(b_end), b_end, first(bytes_end), bytes_end)

    return _texts(docs, id_col, text_col).mapInArrow(run, GROUPS)


def _blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Documents' alignments in blocks (``_BLOCK``). ``keys``: the block's linked
    id pairs (A id in the high, B id in the low half) and how often it has them;
    ``payload``: the documents' figures, and which pairs each has how often."""
    vocabularies = _vocabularies(docs.sparkSession, a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, block = pair_of(*vocabularies.value), TaskContext.get().partitionId() << 36
        rows, held = [], 0
        for batch in batches:
            ids, texts = batch.column(0), pc.fill_null(batch.column(1).cast(pa.string()), "")
            for first, end in _parts(pc.binary_length(texts), 4 * BLOCK_LINKS):
                a, b, at_a, at_b = pair.encoded(texts[first:end])
                for x, y in _parts(np.diff(at_a + at_b), BLOCK_LINKS):
                    rows.append((ids[first + x : first + y], *_figures(pair, a, b, at_a[x : y + 1], at_b[x : y + 1])))
                    held += int(rows[-1][1].sum() + rows[-1][2].sum())
                    if held >= BLOCK_LINKS:
                        yield _block(block, rows)
                        block, rows, held = block + 1, [], 0
        if rows:
            yield _block(block, rows)
        pair.forget()

    return docs.mapInArrow(run, _BLOCK)


def _parts(sizes, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows whose sizes are ``most`` together at most; a row of a larger
    size is one of its own."""
    until = np.cumsum(np.asarray(sizes), dtype=np.int64)
    first, before = 0, 0
    while first < len(until):
        end = max(int(np.searchsorted(until, before + most, "right")), first + 1)
        yield first, end
        first, before = end, int(until[end - 1])


def _figures(pair: Pair, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> tuple:
    """For texts whose tokens begin at these places: each text's tokens, groups, links
    and digest, how many distinct pairs it has, and these with their counts."""
    a, b, n = a[at_a[0] : at_a[-1]], b[at_b[0] : at_b[-1]], len(at_a) - 1
    at_a, at_b = at_a - at_a[0], at_b - at_b[0]
    # Both sides of a text end at the same byte, so a group never goes on into the next text.
    ends_a, ends_b, link_a, link_b = pair.align(a, b)
    n_a, n_b = np.diff(at_a), np.diff(at_b)
    n_groups = np.diff(np.concatenate([[0], np.cumsum(ends_a)])[at_a])
    text = np.repeat(np.arange(n), n_a)[link_a]
    base = pair.n * pair.m
    keys, counts = np.unique(text * base + a[link_a] * pair.m + b[link_b], return_counts=True)
    sizes, keys = np.bincount(keys // base, minlength=n), keys % base
    listing, width, at = pair.listing(a, b, ends_a, ends_b), pair.listed.itemsize, (at_a + at_b).tolist()
    # SHA-256 of ``a1,a2|b1;a3|b2,b3``.
    digests = b"".join([hashlib.sha256(listing[x * width : y * width].translate(None, b"\0")[:-1]).digest() if x < y else bytes(32)
                        for x, y in zip(at, at[1:])])
    return n_a, n_b, n_groups, np.bincount(text, minlength=n), digests, sizes, keys // pair.m << 32 | keys % pair.m, counts


def _block(block: int, rows: list[tuple]) -> pa.RecordBatch:
    ids, n_a, n_b, n_groups, n_links, digests, sizes, keys, counts = zip(*rows)
    ids = pa.concat_arrays(ids)
    own, place = np.unique(np.concatenate(keys), return_inverse=True)
    times = np.concatenate(counts)
    total = np.bincount(place, times, minlength=len(own)).astype(np.int64)
    payload = X.pack(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                     *map(np.concatenate, (n_a, n_b, n_groups, n_links)), np.frombuffer(b"".join(digests), np.uint8),
                     np.concatenate(sizes), X.least(place), X.least(times))
    return X.record(_BLOCK, [block], [X.pack(np.diff(own, prepend=0), X.least(total))], [payload])


def _own_pairs(blocks: DataFrame) -> DataFrame:
    """(block, key, n): each block's pairs."""
    schema = "block long, key long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in X.each_row(batches):
            steps, n = X.unpack(row["keys"])
            if len(steps):
                yield X.record(schema, np.full(len(steps), row["block"]), np.cumsum(steps), n.astype(np.int64))

    return blocks.select("block", "keys").mapInArrow(run, schema)


def _totals(own: DataFrame) -> DataFrame:
    """(key, n, best): each pair's links in all documents, and whether no other
    pair of its B id has more."""
    totals = cut_lineage(own.groupBy("key").agg(F.sum("n").alias("n")))
    b_id = F.col("key").bitwiseAND(0xFFFFFFFF)
    highest = totals.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("highest"))
    # At most one row for each piece of B's vocabulary.
    return totals.join(F.broadcast(highest), b_id == F.col("b_id")).select("key", "n", (F.col("n") == F.col("highest")).alias("best"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a_id, b_id, n, best): how often tokens are linked in all documents."""
    totals = _totals(_own_pairs(_blocks(_texts(docs, id_col, text_col), a_path, b_path)))
    return totals.select(F.shiftright("key", 32).alias("a_id"), F.col("key").bitwiseAND(0xFFFFFFFF).alias("b_id"), "n", "best")


def alignment_report(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's tokens, groups and links, and how common its links are
    (``OUT``): ``n_best`` of them have their B id's highest count, ``count_sum``
    sums their counts."""
    blocks = cut_lineage(_blocks(_texts(docs, id_col, text_col), a_path, b_path))
    own = _own_pairs(blocks)
    # A block gets back as many sums as it has pairs.
    answers = own.select("block", "key").join(_totals(own), "key").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("key", "n", "best"))).alias("sums"))
    answers = answers.select("block", F.col("sums.n").alias("n"), F.col("sums.best").alias("best"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                n, best = (np.asarray(c[k].values) if c[k].is_valid else np.empty(0, np.int64) for c in (batch.column(1), batch.column(2)))
                yield _report(batch.column(0)[k].as_py(), n, best)

    return blocks.select("block", "payload").join(answers, "block", "left").select("payload", "n", "best").mapInArrow(run, OUT)


def _report(payload: bytes, n: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    ids, nulls, n_a, n_b, n_groups, n_links, digests, sizes, place, times = X.unpack(payload)
    doc, place, times = np.repeat(np.arange(len(ids)), sizes), place.astype(np.int64), times.astype(np.int64)
    # Integer sums: a double would round the sums of a large corpus.
    summed, held = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    np.add.at(summed, doc, n[place].astype(np.int64) * times)
    np.add.at(held, doc, best[place].astype(np.int64) * times)
    raw = digests.tobytes().hex()
    shas = [raw[64 * k : 64 * k + 64] if some else "" for k, some in enumerate((n_a > 0).tolist())]
    return X.record(OUT, pa.array(ids, mask=nulls.astype(bool)), n_a, n_b, n_groups, n_links, held, summed, shas)
