import hashlib
import random

import numpy as np

from cierre.llm import repeats
from tests.llm.helpers import LONG, SHARED, TEXTS, documents, empty


def brute(rows, length=50):
    texts = [((1 << 62) if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        for p in range(len(b) - length + 1):
            k = b[p : p + length]
            first[k] = min(first.get(k, i), i)
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        spans = int(np.sum(gone[1:] & ~gone[:-1]) + gone[0]) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def figures(spark, rows, **how):
    got = repeats.digest(repeats.repeated_spans(documents(spark, rows, **how))).collect()
    return sorted(((1 << 62) if r[0] is None else r[0], *r[1:]) for r in got)


def test_awkward_rows(spark):
    assert figures(spark, TEXTS, long=False) == brute(TEXTS)


def test_random_edits_and_copies(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("ab cdé") for _ in range(400)) for _ in range(4)]
    rows = []
    for i in range(60):
        t = rng.choice(base)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(t))
            t = t[:k] + rng.choice(["", "q", "zz", rng.choice(base)[:70]]) + t[k + rng.randint(0, 3):]
        rows.append((rng.randint(0, 80), t))
    rows += [(500 + n, base[0]) for n in range(30)] + [(200, "s" * 49), (201, "s" * 50), (202, "s" * 51), (203, "s" * 120)]
    assert figures(spark, rows, long=False) == brute(rows)


def test_long_text_against_its_shifted_copy(spark):
    got = {r[0]: r for r in figures(spark, TEXTS, long=True)}
    assert got[100][2] == 0
    assert got[101][2] == len(LONG) - 7


def test_segments_do_not_change_the_result(spark, monkeypatch):
    body = (LONG[:5000] + LONG[100:5000]).encode()
    begin, lens = np.array([0, 5000]), np.array([5000, 4900])
    whole = repeats.anchor_runs(body, begin, lens)
    monkeypatch.setattr(repeats, "_SEGMENT", 97)
    cut = repeats.anchor_runs(body, begin, lens)
    spread = lambda runs: {p: int(n) for s, e, _, n in zip(*runs) for p in range(s, e)}
    assert spread(whole) == spread(cut)


def test_trimmed_keeps_columns_and_whole_characters(spark):
    docs = documents(spark, TEXTS, long=False)
    got = repeats.trimmed(docs)
    assert got.schema.simpleString() == docs.schema.simpleString()
    rows = got.collect()
    assert len(rows) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] in (1, 2, 5)}
    assert by_id[1]["text"] == TEXTS[1][1] and by_id[2]["text"] == "" and by_id[2]["n_chars"] == 0
    assert SHARED not in by_id[5]["text"] and by_id[5]["n_chars"] == len(by_id[5]["text"])
    assert by_id[5]["rank"] == 5
    cut = [(1, "é" * 40), (2, "a" + "é" * 40)]
    assert {r["doc_id"]: r["text"] for r in repeats.trimmed(documents(spark, cut, long=False)).collect()} == {1: "é" * 40, 2: "a"}


def test_empty_table(spark):
    assert repeats.repeated_spans(empty(spark)).collect() == []
    assert repeats.trimmed(empty(spark)).collect() == []
