"""Byte-level BPE in linear time by backtracking, and decoding by offsets.

The merges' result is the only sequence of tokens in which every neighbouring
pair is compatible: encoding the pair's own bytes gives back the pair. A
stretch is read from the left with the longest token that matches (the matches
of all offsets come from one Aho-Corasick pass); a token that does not go with
the one before is replaced by the next shorter match there, and where none is
left the encoder steps back and does not come to that offset again. Each
offset is left for good once at most, which makes the time linear.

Whether a pair is compatible is read from the table of merges: the merge that
could join the two tokens, or parts of them at the seam, must come later than
those that built them.

Decoding looks up each id's bytes in one byte string by a table of offsets.

Defined results: a null text is empty and has no ids; null doc_ids stay null;
repeated rows are encoded each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.llm import byte_ids
from cierre.llm import exchange as X
from cierre.llm.ship import ship

OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_CODECS: dict[str, "Codec"] = {}


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 characters for themselves, the others from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(other)}


class Codec:
    """Encoder and decoder of a byte-level BPE definition (JSON of the tokenizers library)."""

    #: The pattern that splits text before the merges (a fixed value of the vocabulary).
    SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def __init__(self, definition: str):
        spec = json.loads(definition)
        to_byte = byte_alphabet()
        raw = {t: bytes(to_byte[c] for c in t) for t in spec["model"]["vocab"]}
        self.id_of = {raw[t]: i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.id_of.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for b, i in self.id_of.items():
            self.token[i] = b
        for t, i in self.special.items():
            self.token[i] = t.encode()
        # When a token is made: 0 for bytes, then by merge; and of what.
        self.made, self.parts = [0] * size, [None] * size
        self.merged: dict[tuple[int, int], int] = {}
        for n, pair in enumerate(spec["model"]["merges"], 1):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = raw[a], raw[b]
            i, j, k = self.id_of[a], self.id_of[b], self.id_of[a + b]
            if (i, j) not in self.merged:
                self.merged[i, j] = n
                if not self.made[k]:
                    self.made[k], self.parts[k] = n, (i, j)
        self.length = [len(t) for t in self.token]
        self.matcher = ahocorasick.Automaton()
        for b, i in self.id_of.items():
            self.matcher.add_word(b.decode("latin-1"), i)
        self.matcher.make_automaton()
        self.shorter = [self._next_prefix(i) for i in range(size)]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.offsets = np.zeros(size + 1, np.int64)
        np.cumsum(self.length, out=self.offsets[1:])
        self.bytes = np.frombuffer(b"".join(self.token), np.uint8)
        self.splitter = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.decimal = list(map(str, range(size)))
        self.listed, self.raw, self.pieces = byte_ids.Recent(), byte_ids.Recent(), byte_ids.Recent()

    def _next_prefix(self, i: int) -> int:
        """The longest token that is a shorter prefix of token i, or -1."""
        t = self.token[i]
        if self.id_of.get(t) != i:
            return -1
        return next((self.id_of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.id_of), -1)

    def compatible(self, a: int, b: int) -> bool:
        """Whether a and b stay apart when their bytes are encoded together."""
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 1 << 20:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        made, parts, merged = self.made, self.parts, self.merged
        # Undo merges from the last one back. `until`: the merge undone last; one that
        # joins the seam counts if it comes before that.
        until = 1 << 60
        left_first = False
        while True:
            n = merged.get((a, b))
            # Of equal merges the one further left goes first; when the left part's
            # own merge was undone last, the seam lies to its right.
            if n is not None and (n < until or (n == until and not left_first)):
                return False
            if made[a] > made[b] or (made[a] == made[b] and made[a]):
                if made[a] == made[b]:
                    # the same merge on both sides: the right one is done later
                    until, left_first = made[b], False
                    b = parts[b][0]
                    continue
                until, left_first = made[a], True
                a = parts[a][1]
            elif made[b]:
                until, left_first = made[b], False
                b = parts[b][0]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of bytes that the split pattern keeps together."""
        whole = self.id_of.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [-1] * n
        length, shorter, fits, seen = self.length, self.shorter, self.compatible, self.pairs.get
        for end, i in self.matcher.iter(piece.decode("latin-1")):
            start = end + 1 - length[i]
            if longest[start] < 0 or length[i] > length[longest[start]]:
                longest[start] = i
        ids: list[int] = []
        open_ = bytearray(b"\1") * (n + 1)
        at, token = 0, longest[0] if n else -1
        while at < n:
            before = ids[-1] if ids else -1
            while token >= 0:
                end = at + length[token]
                if open_[end] and (before < 0 or (seen((before, token)) or fits(before, token))):
                    ids.append(token)
                    at = end
                    token = longest[at] if at < n else -1
                    break
                token = shorter[token]
            else:
                open_[at] = 0
                token = ids.pop()
                at -= length[token]
                token = shorter[token]
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids, gathered by offsets."""
        size = self.offsets[ids + 1] - self.offsets[ids]
        step = np.ones(int(size.sum()), np.int64)
        if not len(step):
            return b""
        full = size > 0
        first = self.offsets[ids][full]
        begin = (np.cumsum(size) - size)[full]
        step[begin] = first
        step[begin[1:]] -= first[:-1] + size[full][:-1] - 1
        return self.bytes[np.cumsum(step)].tobytes()

    def encode(self, text: str) -> list[int]:
        parts = self.splitter.split(text) if self.splitter else [text]
        out: list[int] = []
        for n, part in enumerate(parts):
            if n % 2:
                out.append(self.special[part])
            else:
                for piece in self.SPLIT.findall(part):
                    ids = self.pieces.get(piece)
                    if ids is None:
                        ids = self.pieces.older.get(piece)
                        if ids is None:
                            ids = self.encode_piece(piece.encode())
                        if len(piece) < 64:
                            self.pieces.put(piece, ids)
                    out += ids
        return out

    def _learn(self, stretches: list[str]) -> None:
        for s in stretches:
            ids = self.encode(" " + s)
            self.listed[s], self.raw[s] = ",".join(map(self.decimal.__getitem__, ids)).encode(), array("i", ids).tobytes()

    def digests(self, texts: pa.StringArray) -> list[tuple[int, str, str]]:
        """Of each text (none of them null): number of ids, SHA-256 of the ids in
        decimal, joined by commas, and of the decoded text.

        Texts are cut into stretches that can be encoded one by one, and each distinct
        stretch of all texts is encoded once; the texts' ids are gathered by index."""
        apart = {}
        if self.splitter:
            special = pc.match_substring_regex(texts, self.splitter.pattern).to_numpy(zero_copy_only=False)
            apart = {k: texts[k].as_py() for k in np.flatnonzero(special).tolist()}
            if apart:
                texts = pc.if_else(pa.array(special), "", texts)
        flat, offsets = byte_ids.cut(texts)
        held = flat.dictionary_encode()
        words, which = held.dictionary.to_pylist(), held.indices.to_numpy().astype(np.int64)
        known = self.raw.missing(words)
        self.listed.missing(words)
        self._learn(known)
        # No blank stands before a text's first stretch; a special token makes a whole text one.
        heads = [self.encode(apart.get(k, h)) for k, h in enumerate(flat.take(pa.array(offsets[:-1])).to_pylist())]
        which[offsets[:-1]] = len(words) + np.arange(len(heads))
        raw = [*map(self.raw.__getitem__, words), *(array("i", h).tobytes() for h in heads)]
        listed = [*map(self.listed.__getitem__, words), *(",".join(map(self.decimal.__getitem__, h)).encode() for h in heads)]
        ids, sizes = byte_ids.gather(raw, which)
        at, begin = byte_ids.by_text(sizes, offsets).tolist(), offsets.tolist()
        ends = np.concatenate([[0], np.cumsum(self.offsets[ids + 1] - self.offsets[ids])])
        decoded, place, of = self.decode(ids), ends[at].tolist(), which.tolist()
        out = []
        for k in range(len(heads)):
            parts = list(map(listed.__getitem__, of[begin[k] : begin[k + 1]]))
            text = b",".join(parts if parts[0] else parts[1:])
            whole = decoded[place[k] : place[k + 1]].decode("utf-8", "replace").encode()
            out.append((at[k + 1] - at[k], hashlib.sha256(text).hexdigest(), hashlib.sha256(whole).hexdigest()))
        return out

    def digest(self, text: str) -> tuple[int, str, str]:
        return self.digests(pa.array([text], pa.string()))[0]

    def forget(self) -> None:
        """A worker lives on after its task; the pieces stay, which cost most to encode."""
        self.raw, self.listed = byte_ids.Recent(), byte_ids.Recent()


def codec(definition: str) -> Codec:
    """One for each worker process."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(definition)
    return _CODECS[key]


def encode_report(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text encoded and decoded again: ``OUT``."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(definition.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                yield X.record(OUT, part.column(0), *zip(*c.digests(part.column(1))))
        c.forget()

    picked = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return picked.mapInArrow(run, OUT)


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every text."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    kinds = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(definition.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids = [c.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, kinds.field(1).type)], schema=kinds)

    picked = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return picked.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of lists of ids; bytes that are no UTF-8 become U+FFFD."""
    spark = encoded.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(definition.value)
        for batch in batches:
            texts = [c.decode(np.array(i or [], np.int64)).decode("utf-8", "replace") for i in batch.column(1).to_pylist()]
            yield X.record("doc_id long, text string", batch.column(0), texts)

    picked = encoded.select(F.col(id_col).cast("long"), F.col(ids_col).cast("array<int>"))
    return picked.mapInArrow(run, "doc_id long, text string")
