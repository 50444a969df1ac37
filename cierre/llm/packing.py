"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Documents become pieces of at most ``capacity`` tokens; only longer documents
are cut. Pieces above a third of the capacity are large: they are matched
greedily, the largest first with the largest partner that still fits, so a
sequence holds two of them at most. Smaller pieces, the largest first, go where
they leave the smallest gap.

Packing needs the pieces' lengths alone, and there are no more lengths than
tokens in a sequence. So the plan is made on the histogram of lengths (bounded
by ``capacity`` rows), in runs: "the next m sequences of this gap take k pieces
of this length each". A piece finds its place by its rank among the pieces of
its length; ranks come from counts by (length, bucket), so a length that a third
of all pieces share is spread over all buckets.

Defined results: a null or empty text is the closing id alone; null doc_ids are
packed like any other; repeated rows are packed each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cierre.llm import byte_ids
from cierre.llm import exchange as X
from cierre.llm.ship import give_back, ship
from cierre.session import cut_lineage

CAPACITY = 2048
CLOSING_ID = 0
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLAN = "length long, first long, last long, sequence long, copies long, place long"
_ENCODERS: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of a text by a word-level tokenizer that drops white space.

    Such a tokenizer treats what blanks and line ends separate apart, so each
    distinct stretch is encoded once and looked up after that. Stretches of letters
    with marks after them are told apart for a whole batch at once; their distinct
    letters, in lower case, and marks are words. Words are encoded many at a time; a
    word's last id is one of a token with a word end, which tells them apart again.
    """

    WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
    PLAIN = regex.compile(r"[!-~¡-¬®-įı-ɏ]+")
    #: Letters of PLAIN, whose lower case is one character each, and marks: no white space, letter or number.
    LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c != "İ")
    MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # The same merges for words that are already in lower case and apart.
        spec = json.loads(definition)
        spec |= {"normalizer": None, "truncation": None, "padding": None, "added_tokens": []}
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        self.merges = Tokenizer.from_str(json.dumps(spec))
        model = spec["model"]
        if model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges")):
            # Words met once only fill the library's cache.
            pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
            names = ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk")
            self.merges.model = models.BPE(vocab=model["vocab"], merges=pairs, cache_capacity=0,
                                           **{k: model[k] for k in names if model.get(k)})
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words, self.known = byte_ids.Recent(), byte_ids.Recent()

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self, words: list[str]) -> None:
        for a in range(0, len(words), 4096):
            some = words[a : a + 4096]
            raw = np.array(self.merges.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4").tobytes()
            last = (4 * (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1)).tolist()
            if len(last) == len(some):
                self.words.update(zip(some, [raw[x:y] for x, y in zip([0, *last], last)]))
            else:
                self.words.update(zip(some, self._encode(some)))

    def _learn(self, stretches) -> None:
        """Put into ``known`` stretches other than letters with marks after them."""
        plain, parts, other = [], [], []
        for s in stretches:
            if "<|" not in s and (s.isascii() and s.isprintable() or self.PLAIN.fullmatch(s)) and s:
                parts.append(self.WORD.findall(s.lower()))
                plain.append(s)
            else:
                other.append(s)
        self.known.update(zip(other, self._encode(other)))
        self._learn_words(self.words.missing(list({w for p in parts for w in p})))
        words = self.words
        self.known.update(zip(plain, [b"".join([words[w] for w in p]) for p in parts]))

    def distinct(self, held: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct stretches in a row, and how many each has."""
        plain, heads, tails = byte_ids.letters_and_marks(held, self.LETTERS, self.MARKS)
        heads, tails = pc.utf8_lower(heads).dictionary_encode(), tails.dictionary_encode()
        letters, marks = byte_ids.listed(heads.dictionary), byte_ids.listed(tails.dictionary)
        others = byte_ids.listed(held.filter(pa.array(~plain)))
        self._learn(self.known.missing(others))
        self._learn_words(self.words.missing([*letters, *filter(None, marks)]))
        words = self.words
        return byte_ids.put_together(
            plain, (list(map(words.__getitem__, letters)), heads.indices.to_numpy().astype(np.int64)),
            ([words[m] if m else b"" for m in marks], tails.indices.to_numpy().astype(np.int64)),
            list(map(self.known.__getitem__, others)))

    def forget(self) -> None:
        """A worker lives on after its task, which should not hold its memory."""
        self.words, self.known = byte_ids.Recent(), byte_ids.Recent()

    def batch(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (none of them null) in a row, and where each text's
        begin (and the end). Each distinct stretch of all texts is looked up once."""
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        held = parts.flatten().dictionary_encode()
        ids, sizes = byte_ids.gather_flat(*self.distinct(held.dictionary), held.indices.to_numpy().astype(np.int64))
        return ids, byte_ids.by_text(sizes, offsets - offsets[0])

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        ids, at = self.batch(pa.array(texts, pa.string()))
        raw, at = ids.tobytes(), (4 * at).tolist()
        return (raw[a:b] for a, b in zip(at, at[1:]))


def encoder(definition: str) -> Encoder:
    """One for each worker process."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text", release: bool = False) -> DataFrame:
    """Each document's pieces: ``_PIECE``. With ``release`` workers drop the tokenizer
    after each task, as one stage of many should."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(definition.value)
        for batch in batches:
            for a, b in byte_ids.at_once(batch.column(1)):
                part, rows = batch.slice(a, b - a), []
                found, at = enc.batch(part.column(1))
                at = at.tolist()
                for d, i in enumerate(part.column(0).to_pylist()):
                    ids = found[at[d] : at[d + 1]].tobytes() + closing
                    n = len(ids) // 4
                    for k, start in enumerate(range(0, n, capacity)):
                        end = min(start + capacity, n)
                        rows.append((i, k, start, end - start, zlib.crc32(ids[4 * start : 4 * end])))
                yield X.record(_PIECE, *zip(*rows))
        enc.forget()
        if release:
            _ENCODERS.clear()
            del enc
        give_back()

    picked = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return picked.mapInArrow(run, _PIECE)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, last rank, first sequence, copies, place).

    Piece r of a length, first <= r < last, goes to sequence
    first sequence + (r - first) // copies, at place + (r - first) % copies * length.
    """
    left = {s: c for s, c in counts.items() if c > 0}
    taken, out, sequences = dict.fromkeys(left, 0), [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []

    def open_gap(gap, first, n):
        if gap and n:
            if gap not in gaps:
                bisect.insort(order, gap)
            gaps.setdefault(gap, []).append((first, n))

    def put(length, n, first, copies, place):
        out.append((length, taken[length], taken[length] + n, first, copies, place))
        taken[length] += n
        left[length] -= n

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        s = large[-1]
        m = left[s]
        at = bisect.bisect_right(large, capacity - s) - 1
        if at >= 0 and large[at] == s and m == 1:
            at -= 1
        if at < 0:
            put(s, m, sequences, 1, 0)
            open_gap(capacity - s, sequences, m)
        else:
            t = large[at]
            m = m // 2 if t == s else min(m, left[t])
            put(s, m, sequences, 1, 0)
            put(t, m, sequences, 1, s)
            open_gap(capacity - s - t, sequences, m)
            if t != s and not left[t]:
                large.remove(t)
        sequences += m
        if not left[s]:
            large.remove(s)

    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            at = bisect.bisect_left(order, s)
            if at == len(order):
                n = -(-left[s] // (capacity // s))
                open_gap(capacity, sequences, n)
                sequences += n
                continue
            gap = order[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            copies = min(gap // s, left[s])
            m = min(n, left[s] // copies)
            put(s, m * copies, first, copies, capacity - gap)
            open_gap(gap, first + m, n - m)
            open_gap(gap - copies * s, first, m)
    return out


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with their sequence_id and offset."""
    spark = cut.sparkSession
    cut = cut_lineage(cut)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counted = cut_lineage(placed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")))
    # at most `capacity` rows
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(plan(histogram, capacity), _PLAN)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = placed.withColumn("rn", F.row_number().over(inside) - 1).join(offsets, ["length", "bucket"]).withColumn(
        "rank", F.col("rn") + F.col("before"))
    i = F.col("rank") - F.col("first")
    # The runs are bounded by the number of lengths, whatever the number of pieces.
    return ranked.alias("p").join(F.broadcast(runs).alias("r"), (F.col("p.length") == F.col("r.length")) & (
        F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))).select(
        "doc_id", "piece", "start", "p.length", "ids_crc32",
        (F.col("sequence") + F.floor(i / F.col("copies"))).alias("sequence_id"),
        (F.col("place") + F.pmod(i, F.col("copies")) * F.col("p.length")).alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text", release: bool = False) -> DataFrame:
    """Tokenize, cut and pack all documents; one row for each piece."""
    return packed(pieces(docs, tokenizer_path, capacity, id_col, text_col, release), capacity)
