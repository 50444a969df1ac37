"""Ids of a byte-level BPE vocabulary for whole batches of texts, by the tokenizers library.

A blank that follows something other than white space always begins a new word
of the split pattern, so the stretches between such blanks can be encoded
apart: each distinct stretch goes to the library once and is looked up after
that. Most are letters with marks after them; those are told apart for a whole
batch at once, and only their distinct letters and marks are looked up. Texts
with the string of a special token are encoded whole where that string stands
for its id.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Stretches of a generation that a worker remembers the ids of, and those encoded in a row.
_REMEMBERED = 150_000
_ROW = 2048
#: Stretches of letters up to U+024F, marks other than the apostrophe, and single line ends between them;
#: the split pattern's words in them (after a blank, or after another word).
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"
_LATIN = re.compile(f"[{_LETTERS}]+")
_ENDS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_PLAIN = re.compile(rf"(?:[{_LETTERS}{_MARKS}]++(?:\n(?=[{_LETTERS}{_MARKS}]))?+)++")
_WORD = re.compile(rf" ?[{_LETTERS}]+| ?[{_MARKS}]+|\n")
_ENCODERS: dict[tuple, "Encoder"] = {}
_LATIN_LETTERS = "".join(c for c in map(chr, range(0x250)) if _LATIN.match(c))
#: Bytes of the texts that are encoded at once; each distinct stretch of them is looked up once.
_AT_ONCE = 8 << 20
#: White space (of any kind that a pattern may know) before a blank, or a blank at the start.
_WIDE = r"^ |[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "


def stretches(text: str) -> list[str]:
    """A text cut at each blank that follows something other than white space; the
    blank is left out, and belongs to the stretch after it."""
    parts = text.split(" ")
    out = [parts[0]]
    for p in parts[1:]:
        if out[-1] and not out[-1][-1].isspace():
            out.append(p)
        else:
            out[-1] += " " + p
    return out


def cut(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """All texts' stretches in a row, and where each text's begin (and the end)."""
    parts = pc.split_pattern(texts, " ")
    odd = np.flatnonzero(pc.match_substring_regex(texts, _WIDE).to_numpy(zero_copy_only=False))
    flat, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    if not len(odd):
        return flat, offsets
    # Texts with white space before a blank are cut one by one.
    counts, pieces, at = np.diff(offsets), [], 0
    for k in odd.tolist():
        own = stretches(texts[k].as_py())
        pieces += [flat.slice(offsets[at], offsets[k] - offsets[at]), pa.array(own, pa.string())]
        counts[k], at = len(own), k + 1
    pieces.append(flat.slice(offsets[at]))
    return pa.concat_arrays(pieces), np.concatenate([[0], np.cumsum(counts)])


def gather(lists: list[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit integers of the lists named by ``which``, in a row, and how many
    each has."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
    return gather_flat(np.frombuffer(b"".join(lists), np.int32), sizes, which)


def gather_flat(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``gather`` from lists that lie in a row already, with their sizes."""
    begins, held = np.cumsum(sizes) - sizes, sizes[which]
    place = np.repeat(begins[which] - (np.cumsum(held) - held), held)
    place += np.arange(len(place))
    return flat[place], held


def at_once(texts: pa.StringArray, most: int = _AT_ONCE) -> Iterator[tuple[int, int]]:
    """Rows a..b-1 with at most so many bytes of text together, or one row."""
    ends, a = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def listed(texts: pa.StringArray) -> list[str]:
    """As ``to_pylist`` gives, in a tenth of the time."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def letters_and_marks(stretches: pa.StringArray, letters: str, marks: str) -> tuple[np.ndarray, pa.StringArray, pa.StringArray]:
    """Which stretches are ``letters``, one at least, with any ``marks`` after them;
    the letters and the marks of those."""
    head, tail = pc.utf8_rtrim(stretches, marks), pc.utf8_ltrim(stretches, letters)
    sizes = [pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (stretches, head, tail)]
    # What is left of the first letter that is none and right of the last mark that is none is all.
    plain = (sizes[1] + sizes[2] == sizes[0]) & (sizes[1] > 0)
    return plain, head.filter(pa.array(plain)), tail.filter(pa.array(plain))


def put_together(plain: np.ndarray, heads: tuple[list[bytes], np.ndarray], tails: tuple[list[bytes], np.ndarray],
                 others: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit integers of all stretches in a row, and how many each has: those of
    a plain one's head and tail (lists, and which of them), or those of the next of
    the others."""
    pairs = np.zeros((len(plain), 2), np.int64)  # list 0 is empty
    lists = [b"", *heads[0], *tails[0], *others]
    pairs[plain, 0], pairs[plain, 1] = 1 + heads[1], 1 + len(heads[0]) + tails[1]
    pairs[~plain, 0] = len(lists) - len(others) + np.arange(len(others))
    flat, sizes = gather(lists, pairs.ravel())
    return flat, sizes.reshape(-1, 2).sum(1)


def by_text(held: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each text's integers begin (and the end), from its stretches' sizes."""
    return np.concatenate([[0], np.cumsum(held)])[offsets]


class Recent(dict):
    """What was learnt about stretches lately: those of two generations, of which
    the older goes when the newer has grown to ``most``."""

    def __init__(self, most: int = _REMEMBERED):
        super().__init__()
        self.most = most
        self.older: dict = {}

    def put(self, key: str, value) -> None:
        """Add one key."""
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value

    def missing(self, keys: list[str]) -> list[str]:
        """The keys that neither generation has; those of the older one move up."""
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
        fresh = list(filterfalse(self.__contains__, keys))
        if not self.older:
            return fresh
        older, still = self.older, []
        for key in fresh:
            if key in older:
                self[key] = older[key]
            else:
                still.append(key)
        return still


class Encoder:
    """``plain_specials``: the strings of special tokens are ordinary text."""

    def __init__(self, definition: str, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models

        self.tokenizer, spec = Tokenizer.from_str(definition), json.loads(definition)["model"]
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
        if spec["type"] == "BPE" and not any(spec.get(k) for k in (*plain, "byte_fallback", "ignore_merges")):
            # The same merges without the library's cache, which stretches met once only fill.
            merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["merges"]]
            self.tokenizer.model = models.BPE(vocab=spec["vocab"], merges=merges, cache_capacity=0)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain_specials
        specials = [] if plain_specials else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        # A token's characters stand for its bytes, one for one.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.size[i] = len(token)
        self.known = Recent()
        self.words: dict[str, bytes] = {}
        (self.line,) = self.whole(["\n"])

    def forget(self) -> None:
        """A worker lives on after its task, which should not hold its memory."""
        self.known, self.words = Recent(), {}

    def whole(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of texts that are given to the library as they are."""
        return [array("i", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _in_rows(self, pieces: list[str], lead: str) -> Iterator[tuple[str, bytes]]:
        """Each piece with its ids where it follows ``lead``, a character that begins
        a word of the split pattern. Many are encoded in a row: the tokens' sizes
        tell them apart again."""
        for at in range(0, len(pieces), _ROW):
            some = pieces[at : at + _ROW]
            (raw,) = self.whole([lead + lead.join(some)])
            ends = np.cumsum(self.size[np.frombuffer(raw, np.int32)])
            wanted = np.cumsum(np.fromiter(map(len, map(str.encode, some)), np.int64, len(some)) + 1)
            last = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
            if (ends[last] == wanted).all():
                cut = (4 * last + 4).tolist()
                yield from zip(some, [raw[a:b] for a, b in zip([0, *cut], cut)])
            else:
                yield from zip(some, self.whole([lead + s for s in some]))

    def after_blank(self, fresh: list[str], known: dict[str, bytes]) -> None:
        """Put into ``known`` each stretch with the ids of a blank and the stretch.

        Letters with marks after them are put together from both, which very many
        stretches share; so are stretches of plain letters, marks and line ends."""
        whole, ended, mixed, apart = [], [], [], []
        for s in fresh:
            if s.isalpha():
                whole.append(s)
                continue
            word = s.rstrip(_ENDS)
            if word.isalpha() and (word.isascii() or _LATIN.fullmatch(word)):
                ended.append((s, word, s[len(word) :]))
            elif _PLAIN.fullmatch(s):
                mixed.append((s, _WORD.findall(" " + s)))
            elif s and not s[-1].isspace():
                whole.append(s)
            else:
                apart.append(s)
        parts = {w for _, w, _ in ended}
        parts.update(ws[0][1:] for _, ws in mixed if ws[0][0] == " ")
        parts.update(whole)
        known.update(self._in_rows(list(filterfalse(known.__contains__, parts)), " "))
        known.update(zip(apart, self.whole([" " + s for s in apart])))
        later = {marks for _, _, marks in ended}
        later.update(w for _, ws in mixed for w in ws if w[0] != " ")
        words = self.after_other(later)
        for s, word, marks in ended:
            known[s] = known[word] + words[marks]
        for s, ws in mixed:
            known[s] = b"".join([known[w[1:]] if w[0] == " " else words[w] for w in ws])

    def after_other(self, later) -> dict[str, bytes]:
        """The ids of words that follow a letter, a mark or a line end; these are among them."""
        words, line = self.words, len(self.line)
        if len(words) > _REMEMBERED:
            words.clear()
        later = [w for w in filterfalse(words.__contains__, later) if w != "\n"]
        words.update((w, ids[line:]) for w, ids in self._in_rows(later, "\n"))
        words["\n"] = self.line
        return words

    def distinct(self, held: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct stretches, each after a blank, in a row, and how many each has."""
        known, (plain, heads, tails) = self.known, letters_and_marks(held, _LATIN_LETTERS, _ENDS)
        heads, tails = heads.dictionary_encode(), tails.dictionary_encode()
        letters, marks, others = listed(heads.dictionary), listed(tails.dictionary), listed(held.filter(pa.array(~plain)))
        own, fresh = set(others), known.missing(letters + others)
        known.update(self._in_rows(list(filterfalse(own.__contains__, fresh)), " "))
        self.after_blank(list(filter(own.__contains__, fresh)), known)
        after = self.after_other(filter(None, marks))
        return put_together(plain, (list(map(known.__getitem__, letters)), heads.indices.to_numpy().astype(np.int64)),
                            ([after[m] if m else b"" for m in marks], tails.indices.to_numpy().astype(np.int64)),
                            list(map(known.__getitem__, others)))

    def batch(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (none of them null) in a row, and where each text's
        begin (and the end)."""
        whole = []
        if self.special is not None:
            # Encoded as one stretch each.
            whole = np.flatnonzero(pc.match_substring_regex(texts, self.special.pattern).to_numpy(zero_copy_only=False)).tolist()
        apart = {k: texts[k].as_py() for k in whole}
        if apart:
            texts = pc.if_else(pa.array([k in apart for k in range(len(texts))]), "", texts)
        flat, offsets = cut(texts)
        held = flat.dictionary_encode()
        found, sizes = self.distinct(held.dictionary)
        which = held.indices.to_numpy().astype(np.int64)
        # No blank stands before a text's first stretch.
        heads = flat.take(pa.array(offsets[:-1])).to_pylist()
        heads = [apart.get(k, h) for k, h in enumerate(heads)]
        which[offsets[:-1]] = len(sizes) + np.arange(len(heads))
        first = self.whole(heads)
        found = np.concatenate([found, np.frombuffer(b"".join(first), np.int32)])
        sizes = np.concatenate([sizes, np.fromiter(map(len, first), np.int64, len(first)) // 4])
        ids, held = gather_flat(found, sizes, which)
        return ids, by_text(held, offsets)

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        ids, at = self.batch(pa.array(texts, pa.string()))
        raw, at = ids.tobytes(), (4 * at).tolist()
        return (raw[a:b] for a, b in zip(at, at[1:]))


def encoder(definition: str, plain_specials: bool = False) -> Encoder:
    """One for each worker process."""
    key = (hashlib.sha256(definition.encode()).hexdigest(), plain_specials)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(definition, plain_specials)
    return _ENCODERS[key]
