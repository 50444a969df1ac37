"""Periodic runs against a search of all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cierre.llm import periods
from tests.llm import helpers


def brute(words):
    """All (start, length, period), by trying every period at every place."""
    out = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in out.items())


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def sequences(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        docs = []
        for _ in range(rng.randint(1, 6)):
            words = []
            for _ in range(rng.randint(0, 6)):
                unit = [rng.randint(0, rng.choice([1, 2, 9])) for _ in range(rng.randint(1, 6))]
                words += unit * rng.randint(1, 9) + unit[: rng.randint(0, len(unit))]
            docs.append(words)
        yield [d for d in docs if d]


def check(docs):
    starts = np.cumsum([0, *map(len, docs)])
    a, b, q = periods.periodic_runs(np.array([w for d in docs for w in d], np.int64), starts[:-1])
    want = [(s + x, n, p) for s, d in zip(starts.tolist(), docs) for x, n, p in sorted(brute(d), key=lambda r: (r[0], r[2]))]
    assert list(zip(a.tolist(), (b - a).tolist(), q.tolist())) == want


def test_random_sequences():
    for docs in sequences(3, 400):
        check(docs)


def test_equal_sums_of_different_words_do_no_harm(monkeypatch):
    class Weak(periods.Hashes):
        def __init__(self, words):
            super().__init__(words)
            self.power[:] = 1
            self.total[1:] = np.cumsum(words % 2).astype(np.uint64)

    monkeypatch.setattr(periods, "Hashes", Weak)
    for docs in sequences(5, 150):
        starts = np.cumsum([0, *map(len, docs)])
        a, b, q = periods.periodic_runs(np.array([w for d in docs for w in d], np.int64), starts[:-1])
        for x, y, p in zip(a.tolist(), b.tolist(), q.tolist()):
            d = int(np.searchsorted(starts, x, "right")) - 1
            assert (x - int(starts[d]), y - x, p) in brute(docs[d])


def test_shapes():
    check([[0] * 5000])
    check([[0, 1] * 2500, [0] * 3, [0] * 6, [0, 1, 2, 3]])
    check([list(range(40)) * 5 + [7] + list(range(40)) * 4])
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    check([fib[-1]])  # powers below four only, or none


def test_grammar_depth_stays_small():
    """Rounds of the grammar, counted through the boundaries' calls."""
    calls, real = [], periods.crossing_runs
    periods.crossing_runs = lambda *a: (calls.append(1), real(*a))[1]
    try:
        words = np.array((list(range(3000)) + list(range(3000, 0, -1))) * 2, np.int64)
        periods.periodic_runs(words, np.array([0]))
    finally:
        periods.crossing_runs = real
    assert len(calls) < 60


ROWS = [(n, " ".join(f"w{i % (n % 7 + 1)}" for i in range(n))) for n in range(60)] + [
    (200, "a  b\ta\nb\x0ba\x0cb a b a b"), (201, "x y " * 9), (202, "x " * 9), (203, None), (203, ""), (204, "z " * 6),
    (204, "z " * 6), (None, "q " * 8)]


@pytest.mark.parametrize("whole", [True, False])
def test_rows(spark, whole, monkeypatch):
    if not whole:
        monkeypatch.setattr(periods, "_BATCH_WORDS", 50)
    docs = helpers.documents(spark, helpers.TEXTS + ROWS, long=False)
    got = sorted(map(tuple, periods.run_report(docs, change=periods.planted).collect()), key=repr)
    want = sorted((brute_row(i, t) for i, t in helpers.TEXTS + ROWS), key=repr)
    assert got == want
    assert any(r[1] for r in got)


def test_spans_and_long_text(spark):
    docs = helpers.documents(spark, [(1, "a b c " * 20000 + "end"), (2, "no runs here")])
    got = {tuple(r) for r in periods.run_spans(docs).collect()}
    assert (1, 0, 60000, 3) in got and all(r[0] in (1, 100, 101) for r in got)


def test_empty(spark):
    assert periods.run_report(helpers.empty(spark)).collect() == []
    assert periods.run_spans(helpers.empty(spark)).collect() == []


def test_on_tables(spark):
    """The registered query over the smallest tables, against every period."""
    from cierre.llm.queries import QUERIES

    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op11_repair_runs"](spark, path).collect()), key=repr)
    assert got == sorted((brute_row(r.doc_id, r.text) for r in docs), key=repr)
