"""Language-model scoring with a weighted backoff automaton.

Model: n-grams of the training documents with Dirichlet-smoothed weights,

    p1(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    pm(w | h) = (c(hw) + mu * pm-1(w | h')) / (c(h) + mu)

written as an automaton: a state for each training n-gram shorter than the
order, an arc for each training n-gram with the log of its smoothed
probability, and from each state h a failure arc to h' with the log of
mu / (c(h) + mu). Scoring reads a text once from left to right: it carries the
state, follows failure arcs until the next word has an arc, and adds weights.
One unknown type takes the mass of all unseen words, as in the base score.

The model grows with the corpus and is never gathered in one place. A block of
documents asks all others for the training counts of its own n-grams
(``exchange``) and builds the part of the automaton that its texts can reach.

Defined results: a null or empty text is the end token alone; null doc_ids are
training rows and stay null; repeated rows are scored each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

from cierre.llm import exchange as X
from cierre.session import cut_lineage

HELD_OUT_MOD = 10
#: Sentinels: no word holds white space.
START, END = b"\n", b" "
_STEP = np.uint64(0x9E3779B97F4A7C15)
OUT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
       "score double, train_types long")


def held_out(ids: np.ndarray, mod: int) -> np.ndarray:
    """crc32 of the id as text, mod ``mod``, is 0; never for a null id."""
    return np.array([i != X.NO_ID and zlib.crc32(b"%d" % i) % mod == 0 for i in ids.tolist()], bool)


class Grams:
    """The n-grams of a block.

    ``keys``: the distinct n-grams' keys, sorted. ``at[m]``: the place in it of
    each position's m-gram; ``distinct[m]`` and ``where[m]``: the places of the
    distinct m-grams and a position that has each. A key is a hash of 56 bits
    with the order in its two low bits.
    """

    def __init__(self, payload: bytes, order: int, mod: int):
        self.ids, lens, body = X.open_block(payload)
        self.held = held_out(self.ids, mod)
        word = defaultdict()
        word.default_factory = word.__len__
        word[START], word[END] = 0, 1
        codes, sizes, at = [], [], 0
        for n in lens.tolist():
            tokens = body[at : at + n].lower().split()
            tokens.append(END)
            codes.extend(map(word.__getitem__, tokens))
            sizes.append(len(tokens))
            at += n
        self.codes, self.sizes = np.array(codes, np.int64), np.array(sizes, np.int64)
        names = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in word), np.uint64, len(word))
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.n_words = len(word)
        raw = hashes = names[self.codes]
        place, found = [self.codes], [self._key(names, 1)]
        for m in range(2, order + 1):
            before = np.empty_like(raw)
            before[1:] = raw[:-1]
            before[self.begin] = names[0] + np.uint64(m)
            raw = X.mix(before * _STEP + hashes)
            which, distinct = pd.factorize(raw)
            place.append(which)
            found.append(self._key(distinct, m))
        keys = np.concatenate(found)
        self.keys, rank = np.unique(keys, return_inverse=True)
        self.start = int(rank[0])
        self.at, self.distinct, self.where, done = [None], [None], [None], 0
        for which, own in zip(place, found):
            rank_of = rank[done : done + len(own)]
            done += len(own)
            first = np.full(len(own), -1)
            first[which[::-1]] = np.arange(len(which))[::-1]
            used = first >= 0
            self.at.append(rank_of[which])
            self.distinct.append(rank_of[used])
            self.where.append(first[used])
        self.train_docs = int((~self.held).sum())

    @staticmethod
    def _key(h: np.ndarray, order: int) -> np.ndarray:
        return (h & ~np.uint64(0xFF)) | np.uint64(order & 3)

    def train_counts(self) -> np.ndarray:
        mine = np.repeat(~self.held, self.sizes)
        out = np.zeros(len(self.keys), np.int64)
        for at in self.at[1:]:
            out += np.bincount(at[mine], minlength=len(out))
        out[self.start] = self.train_docs
        return out


class Automaton:
    """The part of the model that one block's texts can reach."""

    def __init__(self, grams: Grams, counts: np.ndarray, order: int, n: int, v: int, mu: float):
        mass = n + 0.1 * (v + 1)
        size, words = len(grams.keys), grams.n_words
        prob = np.zeros(size)
        uni = grams.at[1]
        prob[uni] = (counts[uni] + 0.1) / mass
        self.base = np.log10(prob[uni])
        self.known = counts[uni] > 0
        # A state is the place of its n-gram's key; the root is `size`.
        self.words = words
        fail, weight = np.full(size + 1, size), np.zeros(size + 1)
        arcs = {}
        for m in range(1, order + 1):
            first, where = grams.distinct[m], grams.where[m]
            if m == 1:
                source = np.full(len(where), size)
                seen = np.ones(len(where), bool)
            else:
                shifted = np.empty_like(grams.at[m])
                shifted[1:] = grams.at[m - 1][:-1]
                shifted[grams.begin] = grams.start
                lower = grams.at[m - 1][where]
                source = shifted[where]
                context = counts[source]
                prob[first] = (counts[first] + mu * prob[lower]) / (context + mu)
                seen = counts[first] > 0
                if m < order:
                    fail[first] = lower
            if m < order:
                weight[first] = np.log10(mu / (counts[first] + mu))
            arcs.update(zip((source[seen] * words + grams.codes[where][seen]).tolist(), first[seen].tolist()))
        weight[grams.start] = math.log10(mu / (counts[grams.start] + mu))
        with np.errstate(divide="ignore"):
            self.arcs, self.arc_weight = arcs, np.log10(prob).tolist()
        self.fail, self.fail_weight = fail.tolist(), weight.tolist()
        # After an n-gram of full order the state is its longest proper suffix; an
        # n-gram that training lacks is no state of its own.
        after = np.arange(size + 1)
        if order == 1:
            after[:] = size
        else:
            after[grams.distinct[order]] = grams.at[order - 1][grams.where[order]]
            for m in range(order - 1, 0, -1):
                gone = grams.distinct[m][counts[grams.distinct[m]] == 0]
                after[gone] = size if m == 1 else after[fail[gone]]
        self.after = after.tolist()
        self.start = grams.start if order > 1 and counts[grams.start] else size

    def score(self, codes: list[int]) -> float:
        arcs, fail, cost, weight, after, words = self.arcs, self.fail, self.fail_weight, self.arc_weight, self.after, self.words
        state, total = self.start, 0.0
        for w in codes:
            arc = arcs.get(state * words + w)
            while arc is None:
                total += cost[state]
                state = fail[state]
                arc = arcs.get(state * words + w)
            total += weight[arc]
            state = after[arc]
        return total


def score(docs: DataFrame, order: int = 2, mu: float = 20.0, held_out_mod: int = HELD_OUT_MOD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Score every text with a model of the documents that are not held out.

    ``order``: longest n-gram, 1 to 3. ``mu``: weight of the shorter history.
    Returns ``OUT``: scores are log10 probabilities of the whole text with its
    end token; ``base_score`` is that of the order 1.
    """
    if order not in (1, 2, 3):
        raise ValueError("order is 1, 2 or 3")
    blocks = X.text_blocks(docs, id_col, text_col)
    buckets = X.bucket_count(blocks, bytes_per_key=4)

    def request(row):
        g = Grams(row["payload"], order, held_out_mod)
        yield from X.request_rows(row["block"], g.keys, g.train_counts().astype(np.uint64), buckets)

    start = int(Grams._key(np.array([xxhash.xxh3_64_intdigest(START)], np.uint64), 1)[0])

    def totals(keys, counts):
        uni = (keys & np.uint64(3) == 1) & (keys != np.uint64(start))
        return np.array([counts[uni].sum(), (counts[uni] > 0).sum()], np.int64)

    answers = cut_lineage(X.exchange(blocks, request, buckets, "sum", totals))
    n, v = (int(x) for x in sum(X.extras(answers), np.zeros(2, np.int64)))

    def finish(batches):
        for row in X.each_row(batches):
            g = Grams(row["payload"], order, held_out_mod)
            a = Automaton(g, X.answered(row["answer0"]), order, n, v, mu)
            codes, begin = g.codes.tolist(), g.begin.tolist()
            scores = [a.score(codes[b : b + k]) for b, k in zip(begin, g.sizes.tolist())]
            ids = [None if i == X.NO_ID else i for i in g.ids.tolist()]
            yield X.record(OUT, ids, g.held, g.sizes, np.add.reduceat(a.known.astype(np.int64), g.begin),
                           [n] * len(ids), np.add.reduceat(a.base, g.begin), scores, [v] * len(ids))

    return X.with_answers(blocks, answers).select("payload", "answer0").mapInArrow(finish, OUT)
