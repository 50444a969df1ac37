"""Periodic runs of words, found on a grammar-compressed text.

The words of a batch of documents become integers, and Re-Pair turns their
sequence into a grammar: each round replaces the most frequent pair, and with
it every pair that outranks the pairs it overlaps, by a new nonterminal; when
no pair occurs twice, neighbours are paired by turns until each document is one
symbol. The grammar's depth is logarithmic, and a nonterminal's text is known
from its first place.

For each nonterminal X -> A B the runs that cross the boundary of A and B are
computed once. Such a run has at least four periods, so two of them lie on one
side: a period q is a candidate only if the q words next to the boundary and
the q words beyond them are equal. Sums of hashed words find the candidates
and how far they reach; each reported run is then compared word by word.

A run of X stands at every place that derives X. All places' runs are put
together, and of those with one period the maximal intervals stay: a run of a
document crosses the boundary of the smallest nonterminal that holds it, so it
is found whole there, and in parts at other nonterminals.

Defined results: a null or empty text has no words and no run; the texts of
rows without doc_id are taken as they are; repeated rows have a result each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.llm import exchange as X
from cierre.llm.ship import ship

#: A run has so many words and periods at least.
MIN_WORDS, MIN_PERIODS = 6, 4
OUT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
       "collapsed_sha256 string")
SPANS = "doc_id long, start long, length long, period long"
#: Words whose grammar is built at once (a longer document has one of its own).
_BATCH_WORDS = 1 << 18
#: Candidate periods that are tested at once.
_PART = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Hashes:
    """Prefix sums that tell whether two stretches of a sequence are equal."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.power = np.ones(len(words) + 1, np.uint64)
        self.power[1:] = _BASE
        np.cumprod(self.power, out=self.power)
        values = X.mix(words.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
        self.total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(values * self.power[:-1], out=self.total[1:])

    def equal(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether n words from x and from y > x are equal."""
        t = self.total
        return (t[x + n] - t[x]) * self.power[y - x] == t[y + n] - t[y]

    def reach(self, x: np.ndarray, y: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from x and y on (back: before them) are equal."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            half = (low + high + 1) >> 1
            same = self.equal(x - half, y - half, half) if back else self.equal(x, y, half)
            low = np.where(same, half, low)
            high = np.where(same, high, half - 1)
        return low


def _ramp(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i, counts[i] times: i, and 0, 1, 2, ..."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)


def crossing_runs(h: Hashes, s: np.ndarray, m: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of words[s:e] that cross m: (which, first word, end, smallest period)."""
    w, size, found = h.words, e - s, []
    for left in (False, True):
        most = np.minimum((m - s if left else e - m) // 2, size // MIN_PERIODS)
        most[size < MIN_WORDS] = 0
        upto = np.cumsum(most)
        a = 0
        while a < len(most):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + _PART, "right")))
            which, q = _ramp(most[a:b])
            which, q, a = which + a, q + 1, b
            x = m[which] - 2 * q if left else m[which]
            hit = np.flatnonzero(w[x] == w[x + q])
            which, q, x = which[hit], q[hit], x[hit]
            hit = np.flatnonzero(h.equal(x, x + q, q))
            found.append((which[hit], q[hit], x[hit]))
    which, q, x = (np.concatenate(c) for c in zip(*found)) if found else [np.empty(0, np.int64)] * 3
    first = x - h.reach(x, x + q, x - s[which], back=True)
    end = x + 2 * q + h.reach(x + q, x + 2 * q, e[which] - x - 2 * q)
    good = (first < m[which]) & (end > m[which]) & (end - first >= np.maximum(MIN_WORDS, MIN_PERIODS * q))
    which, first, end, q = which[good], first[good], end[good], q[good]
    # A multiple of the smallest period reaches equally far.
    order = np.lexsort((q, end, first, which))
    which, first, end, q = which[order], first[order], end[order], q[order]
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (first[1:] != first[:-1]) | (end[1:] != end[:-1])
    which, first, end, q = which[new], first[new], end[new], q[new]
    wrong = {k for k, a, b, p in zip(which.tolist(), first.tolist(), end.tolist(), q.tolist())
             if not _is_run(w, int(s[k]), int(e[k]), a, b, p)}
    if wrong:  # equal sums of different words
        fine = ~np.isin(which, list(wrong))
        exact = np.array([(k, *r) for k in sorted(wrong) for r in _compared(w, int(s[k]), int(m[k]), int(e[k]))],
                         np.int64).reshape(-1, 4)
        which, first, end, q = (np.concatenate([c[fine], exact[:, n]]) for n, c in enumerate((which, first, end, q)))
    return which, first, end, q


def _is_run(w, s, e, a, b, q) -> bool:
    return (np.array_equal(w[a : b - q], w[a + q : b]) and (a == s or w[a - 1] != w[a - 1 + q])
            and (b == e or w[b] != w[b - q]))


def _compared(w: np.ndarray, s: int, m: int, e: int) -> list[tuple[int, int, int]]:
    """The same as ``crossing_runs`` for one boundary, word by word."""
    out = {}
    for q in range(1, (e - s) // MIN_PERIODS + 1):
        differ = s - 1 + np.flatnonzero(np.concatenate([[True], w[s : e - q] != w[s + q : e], [True]]))
        for a, b in zip((differ[:-1] + 1).tolist(), (differ[1:] + q).tolist()):
            if a < m < b and b - a >= max(MIN_WORDS, MIN_PERIODS * q):
                out.setdefault((a, b), q)
    return [(a, b, q) for (a, b), q in out.items()]


def _ranks(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Order of pairs: by frequency, ties by a hash of the pair; 0 for single ones."""
    tie = X.mix(codes.astype(np.uint64)) >> np.uint64(40)
    return np.where(counts > 1, (counts.astype(np.uint64) << np.uint64(24)) | tie, np.uint64(0))


def _outranking(rank: np.ndarray) -> np.ndarray:
    """Places whose rank is above those before and after; in a stretch of equal
    ranks (one symbol repeated) every second place."""
    n = len(rank)
    ahead = np.concatenate([[True], rank[1:] != rank[:-1]])
    begin = np.maximum.accumulate(np.where(ahead, np.arange(n), 0))
    best = (rank > 0) & ((np.arange(n) - begin) % 2 == 0)
    best[1:] &= rank[1:] >= rank[:-1]
    best[:-1] &= rank[:-1] >= rank[1:]
    return np.flatnonzero(best)


def _by_turns(closes: np.ndarray) -> np.ndarray:
    """Every second place of each document that has a next one."""
    n = len(closes)
    begin = np.maximum.accumulate(np.where(np.concatenate([[True], closes[:-1]]), np.arange(n), 0))
    return np.flatnonzero(((np.arange(n) - begin) % 2 == 0) & ~closes)


def periodic_runs(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of documents that begin at ``starts`` in ``words`` (integers from 0):
    first word, end and period, by first word and period."""
    n = len(words)
    if not n:
        return (np.empty(0, np.int64),) * 3
    h = Hashes(words)
    symbol, place = words.astype(np.int64), np.arange(n)
    closes = np.zeros(n, bool)  # the symbol is its document's last
    ends = np.append(starts[1:], n)
    closes[ends[ends > starts] - 1] = True
    fresh, firsts, lasts, periods, repeats = int(symbol.max()) + 1, [], [], [], True
    while not closes.all():
        open_ = np.flatnonzero(~closes)
        codes = symbol[open_] * fresh + symbol[open_ + 1]
        pair, distinct = pd.factorize(codes)
        if repeats:
            ranks = _ranks(distinct, np.bincount(pair))
            rank = np.zeros(len(symbol), np.uint64)
            rank[open_] = ranks[pair]
            chosen = _outranking(rank)
            repeats = len(chosen) > 0
        if not repeats:
            chosen = _by_turns(closes)
        pair = pair[np.searchsorted(open_, chosen)]
        used = np.zeros(len(distinct), bool)
        used[pair] = True
        number = (np.cumsum(used) - 1)[pair]
        n_new = int(used.sum())
        first = np.empty(n_new, np.int64)
        first[number[::-1]] = chosen[::-1]
        bounds = np.append(place, n)
        s = bounds[first]
        which, a, b, q = crossing_runs(h, s, bounds[first + 1], bounds[first + 2])
        if len(which):
            # to every place that derives the nonterminal
            by_number = np.argsort(number, kind="stable")
            count = np.bincount(number, minlength=n_new)
            run, nth = _ramp(count[which])
            there = place[chosen[by_number[(np.cumsum(count) - count)[which[run]] + nth]]] - s[which[run]]
            firsts.append(there + a[run]), lasts.append(there + b[run]), periods.append(q[run])
        symbol[chosen] = fresh + number
        fresh += n_new
        closes[chosen] = closes[chosen + 1]
        stays = np.ones(len(symbol), bool)
        stays[chosen + 1] = False
        symbol, place, closes = symbol[stays], place[stays], closes[stays]
    if not firsts:
        return (np.empty(0, np.int64),) * 3
    return _maximal(np.concatenate(firsts), np.concatenate(lasts), np.concatenate(periods), n)


def _maximal(a: np.ndarray, b: np.ndarray, q: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each period that no other of that period contains."""
    order = np.lexsort((-b, a, q))
    a, b, q = a[order], b[order], q[order]
    group = np.cumsum(np.concatenate([[0], q[1:] != q[:-1]])) * (n + 1)
    far = np.maximum.accumulate(b + group)
    keep = np.ones(len(a), bool)
    keep[1:] = (b + group)[1:] > far[:-1]
    a, b, q = a[keep], b[keep], q[keep]
    order = np.lexsort((q, a))
    return a[order], b[order], q[order]


def planted(words: list, doc_id: int | None) -> list:
    """Every tenth id's text with a repeating end, by the query's rule."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def _batches(batches: Iterator[pa.RecordBatch], change) -> Iterator[tuple[list, list[list], tuple]]:
    """ids, words and runs of some documents at a time."""
    for batch in batches:
        ids, docs, held = [], [], 0
        for k in range(batch.num_rows):
            i, text = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
            words = text.split() if text else []
            docs.append(change(words, i) if change else words)
            ids.append(i)
            held += len(words)
            if held >= _BATCH_WORDS or k + 1 == batch.num_rows:
                yield ids, docs, _runs_of(docs)
                ids, docs, held = [], [], 0


def _runs_of(docs: list[list]) -> tuple:
    """Each document's first word, and all runs with their document."""
    number = defaultdict()
    number.default_factory = number.__len__
    starts = np.cumsum([0, *map(len, docs)])
    words = np.empty(int(starts[-1]), np.int64)
    for d, a, b in zip(docs, starts[:-1].tolist(), starts[1:].tolist()):
        words[a:b] = np.fromiter(map(number.__getitem__, d), np.int64, b - a)
    # Empty documents have no first word of their own.
    full = np.flatnonzero(starts[1:] > starts[:-1])
    a, b, q = periodic_runs(words, starts[:-1][full])
    doc = full[np.searchsorted(starts[:-1][full], a, "right") - 1] if len(a) else a
    return starts, doc, a, b, q


def run_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=None) -> DataFrame:
    """One row for each run (``SPANS``): first word, number of words, period."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, (starts, doc, a, b, q) in _batches(batches, change):
            yield X.record(SPANS, [ids[d] for d in doc.tolist()], a - starts[doc], b - a, q)

    return _picked(docs, id_col, text_col).mapInArrow(run, SPANS)


def run_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=None) -> DataFrame:
    """``OUT``: each document's longest run, and digests of all its runs and of the
    words that are left when each run keeps its first period only. ``change(words,
    doc_id)`` may give other words for a document's."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, found in _batches(batches, change):
            yield X.record(OUT, ids, *zip(*_reports(texts, *found)))

    return _picked(docs, id_col, text_col).mapInArrow(run, OUT)


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary"))


def _reports(texts: list[list], starts: np.ndarray, doc: np.ndarray, a: np.ndarray, b: np.ndarray, q: np.ndarray) -> list[tuple]:
    edge = np.zeros(int(starts[-1]) + 1, np.int64)
    np.add.at(edge, a + q, 1)
    np.add.at(edge, b, -1)
    kept = np.cumsum(edge[:-1]) == 0
    at = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
    first, size, period = (a - starts[doc]).tolist(), (b - a).tolist(), q.tolist()
    sha = lambda x: hashlib.sha256(x).hexdigest()
    out = []
    for k, words in enumerate(texts):
        mine = list(zip(first[at[k] : at[k + 1]], size[at[k] : at[k + 1]], period[at[k] : at[k + 1]]))
        if mine:
            start, length, p = min(mine, key=lambda r: (-r[1], r[0], r[2]))
            best = (start, length, p, 1000 * length // p)
            words = [words[i] for i in np.flatnonzero(kept[starts[k] : starts[k + 1]]).tolist()]
        else:
            best = (None,) * 4
        out.append((len(mine), *best, sha("".join("%d,%d,%d\n" % r for r in mine).encode()), sha(b" ".join(words))))
    return out
