"""Alignments of two tokenizers against a byte-by-byte computation."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from cierre.llm import alignment, bpe
from tests.llm import helpers

public_tokenizers = pytest.importorskip("public_tokenizers")
pytest.importorskip("sentencepiece")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def library(texts):
    """Whole texts' ids and token bytes in both vocabularies."""
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letters, of_a = bpe.byte_alphabet(), {i: w for w, i in t.get_vocab().items()}
    for text in texts:
        if not text:
            yield [], [], [], []
            continue
        a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        a_bytes = [bytes(letters[c] for c in of_a[i]) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, sp.id_to_piece(i)) for i in b)]
        whole = (" " + text).encode()
        yield (a, b, a_bytes, b_bytes) if b"".join(a_bytes) == whole == b"".join(b_bytes) else ([], [], [], [])


def brute(rows):
    per, counts = [], Counter()
    for (doc_id, _), (a, b, a_bytes, b_bytes) in zip(rows, library([t for _, t in rows])):
        owner = [[k for k, x in enumerate(side) for _ in x] for side in (a_bytes, b_bytes)]
        links = sorted(set(zip(*owner)))
        n = len(owner[0])
        cuts = [p for p in range(n) if p + 1 == n or (owner[0][p] != owner[0][p + 1] and owner[1][p] != owner[1][p + 1])]
        groups, at = [], 0
        for p in cuts:
            groups.append(tuple(sorted(set(side[at : p + 1])) for side in owner))
            at = p + 1
        listed = ";".join(",".join(str(a[k]) for k in x) + "|" + ",".join(str(b[k]) for k in y) for x, y in groups)
        pairs = [(a[x], b[y]) for x, y in links]
        counts.update(pairs)
        per.append((doc_id, len(a), len(b), len(groups), pairs, listed))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return [(i, n_a, n_b, n_groups, len(pairs), sum(counts[p] == top[p[1]] for p in pairs), sum(counts[p] for p in pairs),
             hashlib.sha256(listed.encode()).hexdigest() if n_a else "") for i, n_a, n_b, n_groups, pairs, listed in per]


def hostile(seed, count):
    rng = random.Random(seed)
    marks = ["a", "Word", "  ", " ", "\n", "\t ", " \n", "é", "é", "中文", "🙂", "'s", "12", ".", " ", "　", "<|endoftext|>", "<s>", "▁",
             "\x00", "ś́", "ﬁ", "<0x41>", "́", "straße", "der", "the", "...", "\x85", "\x1c"]
    return ["", " ", "  a", "a  ", "   ", "\n a", *("".join(rng.choices(marks, k=rng.randint(1, 12))) for _ in range(count))]


def test_tokens_equal_the_libraries():
    texts = hostile(2, 5000)
    pair = alignment.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    got = [(a.tolist(), b.tolist()) for a, b in pair.tokens(texts)]
    assert got == [(a, b) for a, b, _, _ in library(texts)]
    assert any(not a for (a, _), t in zip(got, texts) if t)


def test_groups_of_random_ends():
    rng = random.Random(4)
    for _ in range(3000):
        n = rng.randint(1, 60)
        common = rng.choice([0.1, 0.5, 0.9])
        both = [[p for p in range(1, n) if (rng.random() < common if side is None else rng.random() < side)] for side in (None, 0.2, 0.2)]
        a, b = (sorted({*both[0], *own, n}) for own in both[1:])
        even, odd, link_a, link_b = alignment.groups(a, b)
        ends = sorted(set(a) & set(b))
        found = [(a[i + x], i + x, i + x + 1, j + x, j + x + 1) for i, j, k in even for x in range(k)]
        found = sorted(found + [(a[i1 - 1], i, i1, j, j1) for i, i1, j, j1 in odd])
        assert [f[0] for f in found] == ends
        links = {(i + x, j + x) for i, j, k in even for x in range(k)} | set(zip(link_a, link_b))
        spans = [[(s, e) for s, e in zip([0, *x[:-1]], x)] for x in (a, b)]
        assert links == {(x, y) for x, p in enumerate(spans[0]) for y, q in enumerate(spans[1]) if max(p[0], q[0]) < min(p[1], q[1])}
        assert len(links) == len(a) + len(b) - len(ends)


def test_long_even_stretches():
    ends = list(range(1, 5000))
    assert alignment.groups(ends, ends) == ([(0, 0, 4999)], [], [], [])
    even, odd, _, _ = alignment.groups(ends, ends[:2500] + ends[2501:])
    assert even == [(0, 0, 2500), (2502, 2501, 2497)] and odd == [(2500, 2502, 2500, 2501)]


@pytest.mark.parametrize("links", [1 << 20, 300])
def test_rows(spark, monkeypatch, links):
    monkeypatch.setattr(alignment, "BLOCK_LINKS", links)
    rows = helpers.TEXTS + [(1000 + n, t) for n, t in enumerate(hostile(6, 300))]
    docs = helpers.documents(spark, rows, long=False)
    got = sorted(map(tuple, alignment.alignment_report(docs, A, B).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)


def test_general_results(spark):
    rows = [(1, "a text of words"), (2, "straßenbahn 🙂"), (3, "x▁y"), (4, None)]
    docs = helpers.documents(spark, rows, long=False)
    found = alignment.aligned_groups(docs, A, B).orderBy("doc_id", "byte_first").collect()
    assert {r.doc_id for r in found} == {1, 2}
    assert b"".join((" " + rows[1][1]).encode()[r.byte_first : r.byte_end] for r in found if r.doc_id == 2) == (" " + rows[1][1]).encode()
    counts = alignment.pair_counts(docs, A, B).collect()
    assert sum(r.n for r in counts) == sum(r[4] for r in brute(rows)) and any(r.best for r in counts)


def test_long_and_empty(spark):
    docs = helpers.documents(spark, [(1, "short")])
    got = {r.doc_id: r for r in alignment.alignment_report(docs, A, B).collect()}
    assert got[100].n_links == got[100].n_a + got[100].n_b - got[100].n_groups > 60000
    assert alignment.alignment_report(helpers.empty(spark), A, B).collect() == []


def test_on_tables(spark):
    from cierre.llm.queries import QUERIES

    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op12_diagonal_alignment"](spark, path).collect())) == sorted(brute(rows))


def test_texts_in_a_row():
    """All texts of a part are aligned at once; each text's figures are those that it has alone, whatever the parts."""
    import numpy as np
    import pyarrow as pa

    texts = ["", *hostile(9, 400), "the end", ""]
    pair = alignment.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    a, b, at_a, at_b = pair.encoded(pa.array(texts))
    whole = alignment._figures(pair, a, b, at_a, at_b)
    alone = [alignment._figures(pair, *pair.encoded(pa.array([t]))) for t in texts]
    for k in (0, 1, 2, 3, 5, 6, 7):
        assert np.array_equal(whole[k], np.concatenate([x[k] for x in alone])), k
    assert whole[4] == b"".join(x[4] for x in alone) and len(whole[4]) == 32 * len(texts)
    for most in (1, 50, 10**6):
        parts = list(alignment._parts(np.diff(at_a), most))
        assert [p for x, y in parts for p in range(x, y)] == list(range(len(texts)))
        assert all(y - x == 1 or at_a[y] - at_a[x] <= most for x, y in parts)
