"""Quality scores by Bradley-Terry pairwise ranking.

A document's features describe its whole text. In a preference pair a document
with label 1 is preferred to one with label 0; a Bradley-Terry model gives the
preference the probability sigmoid(w . (x1 - x0)), and w minimises the logistic
loss on the feature differences. A document's strength is w . x. Documents are
accepted from a quantile of the strengths on: the share of label 0. Strengths
become scores from 0 to 1 by a logistic curve, set so that the quantile lies at
``THRESHOLD``.

The fit takes every labelled document that is not held out, and every pair of
them. Their features stay in Spark; the driver sees sums. A pair's probability
depends on two strengths only, so each step of Newton's method counts the
documents of each label by strength, on the points of a grid (a document between
two points counts at both by its distance), and the pairs are those of points.
What a document adds is rounded to a multiple of 1 / ``_ONE``, so that sums don't
depend on the order of rows.

Defined results: a null or empty text has features zero and a score like any
other; held_out is false and doc_id null for a null id; without labels of both
kinds every score is 0.5; repeated rows are scored each, and of several texts
with one id one is learnt from; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.llm import exchange as X
from cierre.llm import learn
from cierre.llm.ship import give_back, ship
from cierre.session import cut_lineage

HELD_OUT_MOD = 5
THRESHOLD = 0.3
#: Points of the grid in a unit of strength near 0; they lie apart in proportion to strengths far from it.
_GRID = 64
_STEPS = 25
_CELLS = 4096
_ONE = 1 << 20
_PART = 1 << 20


def _kinds() -> np.ndarray:
    """What each byte counts as: 0 other, 1 lower case, 2 upper case, 3 digit, 4 sentence
    mark, 5 symbol, 6 blank, 7 line end, 8 beyond ASCII."""
    kind = np.zeros(256, np.int64)
    for values, k in ((range(97, 123), 1), (range(65, 91), 2), (range(48, 58), 3), (b".,;:?'\"()-", 4),
                      (b"!#$%&*+/<=>@[\\]^_`{|}~", 5), (b" \t", 6), (b"\n\r", 7), (range(128, 256), 8)):
        kind[list(values)] = k
    return kind


_KIND = _kinds()
NAMES = ("length", "lower", "upper", "digits", "marks", "symbols", "symbols_sat", "lines", "beyond", "exclaim", "bars",
         "word_length", "distinct_words", "distinct_lines", "line_words", "capital_words", "symbol_words", "long_words",
         "sentence_ends", "commonest_word", "short")


def features(text: bytes) -> list[float]:
    """Figures of a whole text, each of them within a few units."""
    n = len(text)
    if not n:
        return [0.0] * len(NAMES)
    count = np.zeros(256, np.int64)
    for a in range(0, n, _PART):
        count += np.bincount(np.frombuffer(text[a : a + _PART], np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=count, minlength=9)
    words = text.split()
    m = max(len(words), 1)
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    upper = symbol = long_ = ends = 0
    for w, c in tally.items():
        if len(w) > 1 and w.isupper():
            upper += c
        if w[-1] in b"!#$%&*+/<=>@^_`{|}~":
            symbol += c
        elif w[-1] in b".?":
            ends += c
        if len(w) > 15:
            long_ += c
    lines = [x for x in text.split(b"\n") if x]
    k = max(len(lines), 1)
    share = kinds / n
    return [
        math.log1p(m) / 5, share[1], share[2], share[3], share[4], share[5], min(1.0, 20 * share[5]), share[7] * 20, share[8],
        min(1.0, 20 * count[33] / n), min(1.0, 20 * count[124] / n), min(3.0, sum(map(len, tally)) / max(len(tally), 1) / 8),
        len(tally) / m, len(set(lines)) / k, min(3.0, m / k / 50), upper / m, symbol / m, long_ / m, ends / m * 5,
        max(tally.values(), default=0) / m, 1.0 if m < 10 else 0.0,
    ]


def feature_rows(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, *keep, features) of every document; ``keep`` are long columns."""
    ship(docs.sparkSession)
    schema = "doc_id long, " + "".join(f"{c} long, " for c in keep) + "features array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py() or b"") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(rows, pa.list_(pa.float64()))],
                                             names=["doc_id", *keep, "features"])
        give_back()

    picked = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary"), *keep)
    return picked.mapInArrow(run, schema)


#: Of features and labels (1: good) of some documents: keys, and for each a row of whole numbers to sum.
Part = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
#: Sums a part's rows by key over all documents: ascending keys and their rows.
Total = Callable[[Part, int], tuple[np.ndarray, np.ndarray]]


def _by_key(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    own, first = np.unique(keys[order], return_index=True)
    return own, np.add.reduceat(values[order], first, axis=0)


def _total_here(x: np.ndarray, good: np.ndarray) -> Total:
    return lambda part, width: _by_key(*part(x, good))


def _total_of(rows: DataFrame) -> Total:
    """Sums over (label, features): a task yields its own sums, Spark adds those up."""
    def total(part: Part, width: int) -> tuple[np.ndarray, np.ndarray]:
        names = [f"s{k}" for k in range(width)]
        schema = "key long, " + ", ".join(f"{n} long" for n in names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                keys, values = part(x, batch.column(0).to_numpy() == 1)
                if held is not None:
                    keys, values = np.concatenate([held[0], keys]), np.concatenate([held[1], values])
                held = _by_key(keys, values)
            if held is not None:
                yield X.record(schema, held[0], *held[1].T)

        # As many rows as the grid has occupied points, twice at most, or as there are features or cells.
        summed = rows.select("label", "features").mapInArrow(run, schema).groupBy("key").agg(*[F.sum(n).alias(n) for n in names]).collect()
        table = np.array(sorted(tuple(r) for r in summed), np.int64).reshape(len(summed), width + 1)
        return table[:, 0], table[:, 1:]

    return total


def _whole(x: np.ndarray) -> np.ndarray:
    return np.rint(x * _ONE).astype(np.int64)


def _strengths(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Added up feature by feature: the same number in whatever batch a row comes."""
    out = np.zeros(len(x))
    for k in range(len(w)):
        out += (x[:, k] - mean[k]) / scale[k] * w[k]
    return out


def _points(strength: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The grid point at or below each strength, and how far it lies towards the next."""
    low = np.floor(np.arcsinh(strength) * _GRID).astype(np.int64)
    a, b = _at(low), _at(low + 1)
    return low, np.clip((strength - a) / (b - a), 0.0, 1.0)


def _at(point: np.ndarray) -> np.ndarray:
    return np.sinh(point / _GRID)


def _one_row(total: Total, of: Callable[[np.ndarray], np.ndarray], m: int, one: int = 1 << 28) -> tuple[int, int, np.ndarray]:
    """How many documents there are, how many of label 0, and the sums of figures of the features."""
    def part(x, good):
        return np.zeros(len(x), np.int64), np.column_stack([np.ones(len(x), np.int64), ~good, np.rint(of(x) * one).astype(np.int64)])

    _, ((n, poor, *sums),) = total(part, m + 2)
    return int(n), int(poor), np.array(sums) / one


class Ranking:
    """A fitted model: centre and scale of the features, weights, and the curve of scores."""

    def __init__(self, x: np.ndarray, good: np.ndarray):
        self._fit(_total_here(x, good), x.shape[1])

    @classmethod
    def of(cls, rows: DataFrame) -> Ranking | None:
        """Of (label, features); None without both labels."""
        counts = {r["good"]: r["n"] for r in rows.groupBy((F.col("label") == 1).alias("good")).agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(counts) < 2:
            return None
        model = cls.__new__(cls)
        model._fit(_total_of(rows), len(NAMES))
        return model

    def _fit(self, total: Total, m: int) -> None:
        n, poor, sums = _one_row(total, lambda x: x, m)
        mean = sums / n
        scale = np.sqrt(_one_row(total, lambda x: (x - mean) ** 2, m)[2] / n) + 1e-3
        w = self._weights(total, mean, scale, m)
        self.mean, self.scale, self.w = mean, scale, w
        point, bad, one = self._counts(total)
        # Between the last of as many as have label 0 and the next one, as near to that as the share of label 1.
        last, after = (self._ranked(total, _at(point[0] - 1), _at(point[-1] + 1), k) for k in (poor - 1, poor))
        self.cut = last + (1 - poor / n) * (after - last)
        # The curve's logistic loss, of which a point's documents are so many equal rows.
        x = np.column_stack([_at(point) - self.cut, np.ones(len(point))])
        curve = learn.logistic(np.concatenate([x, x]), np.repeat([0.0, 1.0], len(x)), 1e-4, times=np.concatenate([bad, one]))
        self.slope = max(float(curve[0]), 1e-3)

    def _weights(self, total: Total, mean: np.ndarray, scale: np.ndarray, m: int, ridge: float = 1e-3) -> np.ndarray:
        """Newton's method on the loss of all pairs of a document with label 1 and one with label 0."""
        w = np.zeros(m)
        for _ in range(_STEPS):
            def held(x, good, w=w):
                low, to_next = _points(_strengths(x, mean, scale, w))
                z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
                keys = np.concatenate([2 * low + good, 2 * (low + 1) + good])
                return keys, np.concatenate([_whole(z * (1 - to_next)[:, None]), _whole(z * to_next[:, None])])

            keys, sums = total(held, m + 1)
            sums = sums / _ONE
            one, bad = ((_at(keys[keys % 2 == k] // 2), sums[keys % 2 == k]) for k in (1, 0))
            pairs = one[1][:, 0].sum() * bad[1][:, 0].sum()
            missed = learn.sigmoid(bad[0][None, :] - one[0][:, None])
            for_one, for_bad = missed @ bad[1][:, 0], one[1][:, 0] @ missed
            slope = (for_bad @ bad[1][:, 1:] - for_one @ one[1][:, 1:]) / pairs + ridge * w
            # A pair's curvature is that of its difference: the squares of either document, less both products.
            bend = missed * (1 - missed)
            both = one[1][:, 1:].T @ bend @ bad[1][:, 1:]
            for_good, for_poor = (one[0], bend @ bad[1][:, 0]), (bad[0], one[1][:, 0] @ bend)
            most = max(float(for_good[1].max()), float(for_poor[1].max()))

            def squares(x, good, w=w, for_good=for_good, for_poor=for_poor, most=most):
                at = _strengths(x, mean, scale, w)
                bent = np.where(good, np.interp(at, *for_good), np.interp(at, *for_poor)) / most
                # Whole numbers whose products are summed exactly.
                v = np.rint((x - mean) / scale * np.sqrt(bent)[:, None] * (1 << 12))
                return np.arange(m), np.rint(v.T @ v).astype(np.int64)

            _, bent = total(squares, m)
            step = np.linalg.solve((bent * (most / (1 << 24)) - both - both.T) / pairs + ridge * np.eye(m), slope)
            w = w - step
            if np.abs(step).max() < 1e-6:
                break
        return w

    def _counts(self, total: Total) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ascending grid points, and how many documents of label 0 and of label 1 lie at each."""
        mean, scale, w = self.mean, self.scale, self.w

        def held(x, good):
            low, to_next = _points(_strengths(x, mean, scale, w))
            return np.concatenate([low, low + 1]), _whole(np.column_stack([
                np.concatenate([(1 - to_next) * kind, to_next * kind]) for kind in (~good, good)]))

        point, n = total(held, 2)
        return point, *(n / _ONE).T

    def _ranked(self, total: Total, low: float, high: float, below: int) -> float:
        """The strength that ``below`` documents of all lie under: the counts of a range's
        cells tell the cell, which is the next range."""
        mean, scale, w = self.mean, self.scale, self.w
        while high - low > 1e-9 * max(1.0, abs(low), abs(high)):
            width = (high - low) / _CELLS

            def held(x, good, low=low, width=width):
                cell = np.floor((_strengths(x, mean, scale, w) - low) / width)
                return np.clip(cell, -1, _CELLS).astype(np.int64), np.ones((len(x), 1), np.int64)

            cells, n = total(held, 1)
            found = int(np.clip(cells[np.searchsorted(np.cumsum(n[:, 0]), below, side="right")], 0, _CELLS - 1))
            low, high = low + found * width, low + (found + 1) * width
        return float(low)

    def score(self, x: np.ndarray) -> np.ndarray:
        strength = _strengths(x, self.mean, self.scale, self.w)
        return learn.sigmoid(self.slope * (strength - self.cut) + math.log(THRESHOLD / (1 - THRESHOLD)))


def learning_rows(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, label, features) of every labelled document that is not held out. Of
    several texts with one id the shortest counts, then the one with the least hash."""
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.length(text).cast("long").alias("size"),
                        F.xxhash64(text).alias("digest")).filter(learn.not_held_out(F.col("doc_id"), HELD_OUT_MOD))
    known = feature_rows(texts, ["size", "digest"]).groupBy("doc_id").agg(F.min(F.struct("size", "digest", "features"))["features"].alias("features"))
    return known.join(learn.known_labels(labels, label, HELD_OUT_MOD), "doc_id").select("doc_id", "label", "features")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ranking | None:
    """Learn from all labelled documents that are not held out; None without both labels."""
    return Ranking.of(cut_lineage(learning_rows(docs, labels, label)))


def score(docs: DataFrame, model: Ranking | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    ship(docs.sparkSession)
    schema = "doc_id long, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            if model is None:
                got = np.full(batch.num_rows, 0.5)
            else:
                got = model.score(np.array([features(t.as_py() or b"") for t in batch.column(1)]))
            yield X.record(schema, batch.column(0), got)
        give_back()

    picked = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary"))
    return picked.mapInArrow(run, schema).select(
        "doc_id", F.coalesce(learn.crc_mod(F.col("doc_id"), HELD_OUT_MOD) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Ranking | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``THRESHOLD`` or more, with all their columns."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None or not batch.num_rows:
                yield batch
                continue
            got = model.score(np.array([features((t.as_py() or "").encode()) for t in batch.column(at)]))
            yield batch.filter(pa.array(got >= THRESHOLD))
        give_back()

    return docs.mapInArrow(run, docs.schema)
