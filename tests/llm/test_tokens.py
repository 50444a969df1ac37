import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cierre.llm import bpe, packing
from tests.llm.helpers import LONG, TEXTS, documents, empty

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = list("aeiotnsrhldABC  \n\t.,;'-_=#*0123éÀßΣςİı中🙂　\xa0́\x1c\x85 ") + [
    "the", "ing", "er", "  ", "ll", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "aaaa", "----", " the", "<|"]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(open(BYTES, encoding="utf-8").read())


def test_backtracking_equals_merging(codec):
    public = Tokenizer.from_file(BYTES)
    for t in random_texts(4000, 1) + [c * n for c in "a=-* #z" for n in (1, 2, 3, 7, 50, 199)] + [LONG[:20000], "q" * 5000]:
        ids = public.encode(t, add_special_tokens=False).ids
        assert codec.encode(t) == ids
        whole = public.decode(ids, skip_special_tokens=False)
        assert codec.decode(np.array(ids, np.int64)).decode("utf-8", "replace") == whole
        assert codec.digest(t) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                   hashlib.sha256(whole.encode()).hexdigest())


def test_encode_report_and_round_trip(spark, codec):
    docs = documents(spark, TEXTS)
    rows = [*TEXTS, (100, LONG), (101, LONG[7:])]
    got = bpe.encode_report(docs, BYTES).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(map(tuple, got), key=key) == sorted(((i, *codec.digest(t or "")) for i, t in rows), key=key)
    back = bpe.decode(bpe.encode(docs, BYTES), BYTES).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in back) == sorted(
        (i is None, i or 0, t or "") for i, t in rows)
    assert bpe.encode_report(empty(spark), BYTES).collect() == []


def test_word_encoder_equals_library():
    public, enc = Tokenizer.from_file(WORDS), packing.Encoder(open(WORDS, encoding="utf-8").read())
    texts = random_texts(3000, 2)
    for t, ids in zip(texts, enc.ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == public.encode(t, add_special_tokens=False).ids


def test_letters_and_marks_are_looked_up_apart():
    """One word in any case and with any marks is one entry, whatever stretches hold it."""
    public, enc = Tokenizer.from_file(WORDS), packing.Encoder(open(WORDS, encoding="utf-8").read())
    texts = ["Señor señor. SEÑOR, señor$$$ señor''", "it's señor's x.y ...", "", *(f"{c}a {c}, {c}. a{c}'" for c in map(chr, range(33, 0x250)))]
    for t, ids in zip(texts, enc.ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == public.encode(t, add_special_tokens=False).ids
    assert not [s for s in enc.known if "eñor" in s.lower() and s != "señor's"]
    assert [w for w in enc.words if "eñor" in w.lower()] == ["señor"]


def check_plan(counts, capacity):
    bins, done = {}, dict.fromkeys(counts, 0)
    for length, first, last, sequence, copies, place in packing.plan(counts, capacity):
        assert first == done[length]
        done[length] = last
        for r in range(first, last):
            bins.setdefault(sequence + (r - first) // copies, []).append((place + (r - first) % copies * length, length))
    assert done == counts and sorted(bins) == list(range(len(bins)))
    for items in bins.values():
        at = 0
        for place, length in sorted(items):
            assert place == at
            at += length
        assert at <= capacity and sum(3 * x > capacity for _, x in items) <= 2
    return len(bins)


def test_plans_are_valid_and_tight():
    rng = random.Random(3)
    for _ in range(150):
        cap = rng.choice([10, 30, 64])
        counts = {rng.randint(1, cap): rng.randint(1, 60) for _ in range(rng.randint(1, 20))}
        n = check_plan(counts, cap)
        assert n <= 1.25 * sum(s * c for s, c in counts.items()) / cap + 1 or max(counts) * 2 > cap
    assert check_plan({683: 4, 1365: 4, 2048: 1, 1: 1000}, 2048) == 5 + 1
    assert packing.plan({}, 2048) == []


def test_packing_of_documents(spark):
    rows = [*TEXTS, (100, LONG), (101, LONG[7:])]
    got = packing.pack(documents(spark, TEXTS), WORDS, capacity=256).collect()
    public = Tokenizer.from_file(WORDS)
    want = []
    for i, t in rows:
        ids = public.encode(t or "", add_special_tokens=False).ids + [0]
        want += [(i is None, i or 0, k, a, len(ids[a : a + 256]), zlib.crc32(np.array(ids[a : a + 256], "<u4").tobytes()))
                 for k, a in enumerate(range(0, len(ids), 256))]
    assert sorted((r[0] is None, r[0] or 0, *r[1:5]) for r in got) == sorted(want)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in by_sequence.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in got)
    assert len(by_sequence) <= total // 256 + 3
    assert packing.pack(empty(spark), WORDS).collect() == []
