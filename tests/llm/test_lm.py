import math
import zlib
from collections import Counter

import pytest

from cierre.llm import lm
from tests.llm.helpers import TEXTS, documents, empty


def brute(rows, mu=20.0, order=2):
    """The same model from its formula, with plain dictionaries."""
    tokens = [(t or "").encode().lower().split() + [b"END "] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    grams = [None] + [Counter() for _ in range(order)]
    docs = 0
    for toks, h in zip(tokens, held):
        if h:
            continue
        docs += 1
        padded = [b"START"] * (order - 1) + toks
        for m in range(1, order + 1):
            for p in range(len(toks)):
                grams[m][tuple(padded[p + order - m : p + order])] += 1
    n, v = sum(grams[1].values()), len(grams[1])

    def context(h):
        return docs if set(h) == {b"START"} else grams[len(h)][h]

    def prob(m, h, w):
        if m == 1:
            return (grams[1][(w,)] + 0.1) / (n + 0.1 * (v + 1))
        h = h[-(m - 1):]
        if b"START" in h and set(h) != {b"START"} and len(h) > 1:
            pass
        return (grams[m][(*h, w)] + mu * prob(m - 1, h, w)) / (context(h) + mu)

    out = []
    for (i, _), toks, h in zip(rows, tokens, held):
        padded = (b"START",) * (order - 1) + tuple(toks)
        score = sum(math.log10(prob(order, padded[p : p + order - 1], w)) for p, w in enumerate(toks))
        base = sum(math.log10(prob(1, (), w)) for w in toks)
        out.append((i, h, len(toks), sum(grams[1][(w,)] > 0 for w in toks), n, base, score))
    return out


@pytest.mark.parametrize("order", [1, 2])
def test_scores_match_the_formula(spark, order):
    rows = TEXTS + [(20 + k, f"some words of document {k % 4} and again some words {k}") for k in range(40)]
    got = lm.score(documents(spark, rows, long=False), order=order).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    want = sorted(brute(rows, order=order), key=key)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), want):
        assert tuple(g)[:5] == w[:5]
        assert g["base_score"] == pytest.approx(w[5], rel=1e-9)
        assert g["score"] == pytest.approx(w[6], rel=1e-9)


def test_probabilities_of_next_words_sum_to_one(spark):
    """Over the known words, the end and one unknown type, after any history."""
    from cierre.llm import exchange as X

    train = "a b a c b b a"
    words = ["a", "b", "c", "zzz"]
    ids = [i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 10]
    rows = [(ids[0], train), (ids[1], "b c a a")]
    probes = [(i, f"a {w}") for i, w in zip([i for i in range(1, 400) if zlib.crc32(str(i).encode()) % 10 == 0], words)]
    got = {r["doc_id"]: r for r in lm.score(documents(spark, rows + probes, long=False)).collect()}
    # log10 P(a w END) - log10 P(END | w) differ by the factor P(w | a)
    tok = [(train + " END ").split(), "b c a a END".split()]
    big, uni = Counter(), Counter()
    for t in tok:
        uni.update(t)
        big.update(zip(["S", *t], t))
    n, v, mu = sum(uni.values()), len(uni), 20.0
    p1 = lambda w: (uni[w] + 0.1) / (n + 0.1 * (v + 1))
    p2 = lambda h, w, c: (big[h, w] + mu * p1(w)) / (c + mu)
    total = p2("a", "END", uni["a"])
    for (i, text), w in zip(probes, words):
        after = p2(w, "END", uni[w])
        first = p2("S", "a", 2)
        total += 10 ** got[i]["score"] / first / after
    assert total == pytest.approx(1.0, rel=1e-9)
    assert X.NO_ID > 0


def test_longer_texts_and_order_three(spark):
    got = lm.score(documents(spark), order=3).collect()
    assert len(got) == len(TEXTS) + 2
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in got)


def test_no_training_rows_and_empty_table(spark):
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    (row,) = lm.score(documents(spark, [(held, "never seen")], long=False)).collect()
    assert (row["n_known"], row["train_tokens"], row["base_score"]) == (0, 0, 0.0)
    assert lm.score(empty(spark)).collect() == []
