"""Files of token ids: round trips, random access, damage."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest
import xxhash
import zstandard

from cierre.llm import byte_ids, frames
from tests.llm import helpers

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts, plain=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = plain
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def brute(rows):
    """Rows (doc_id, text) in the files' order, as (doc_id, start, n_tokens, ids_crc32)."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, np.uint64(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)).astype(np.int64)))
    out, start = [], 0
    for (i, _), ids in zip(order, library([t or "" for _, t in order])):
        raw = np.array([*ids, 0], "<u4").tobytes()
        out.append((i, start, len(raw) // 4, zlib.crc32(raw)))
        start += len(raw) // 4
    return out


def table(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: r[1])


@pytest.mark.parametrize("plain", [True, False])
def test_ids_equal_the_library(plain):
    rng = random.Random(7)
    marks = ["a", "Word", "  ", " ", "\n", "\t ", " \n", "é", "中", "🙂", "'s", "12", ".", " ", "　", "<|endoftext|>", "▁", "\x00", "ś́"]
    texts = ["", " ", "  a", "a  ", "\n a", *("".join(rng.choices(marks, k=rng.randint(1, 14))) for _ in range(6000))]
    enc = byte_ids.Encoder(open(PATH, encoding="utf-8").read(), plain)
    got = [np.frombuffer(b, "<u4").tolist() for b in enc.ids(texts)]
    assert got == library(texts, plain)


def test_letters_and_marks_are_looked_up_apart():
    """One word with any marks is one entry, whatever stretches hold it."""
    enc = byte_ids.Encoder(open(PATH, encoding="utf-8").read())
    texts = ["x señor señor. señor, señor$$$ señor", "x it's señor's x.y ...", "", *(f"{c}a {c}, {c}. a{c}' {c}a{c}" for c in map(chr, range(33, 0x260)))]
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.ids(texts)] == library(texts)
    assert sorted(s for s in enc.known if "eñor" in s) == ["señor", "señor's"]


def test_parts_of_a_batch_are_bounded_by_their_bytes():
    import pyarrow as pa

    texts = pa.array(["aaaa", "", "é" * 3, "b" * 50, "", "c"], pa.string())
    for most in (1, 4, 10, 56, 1000):
        parts = list(byte_ids.at_once(texts, most))
        assert [k for a, b in parts for k in range(a, b)] == list(range(6))
        assert all(b - a == 1 or sum(len(t.as_py().encode()) for t in texts.slice(a, b - a)) <= most for a, b in parts)
        assert list(byte_ids.at_once(texts.slice(3), most))[0][0] == 0
    assert list(byte_ids.at_once(texts.slice(0, 0))) == []


def test_rows(spark, tmp_path):
    docs = helpers.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    catalog = frames.write_ids(docs, str(tmp_path), PATH)
    assert table(frames.read_digests(catalog).collect()) == brute(rows)


def test_small_files_and_frames(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(frames, "FILE_BYTES", 4000)
    monkeypatch.setattr(frames, "FRAME_IDS", 500)
    docs = helpers.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    catalog = frames.write_ids(docs, f"file://{tmp_path}", PATH)
    assert catalog.count() > 1 and catalog.agg({"n_frames": "sum"}).first()[0] > len(rows)
    assert table(frames.read_digests(catalog).collect()) == brute(rows)
    ids = {tuple(r.ids) for r in frames.fetch(catalog, [9, 100, -3, 12345]).collect()}
    assert ids == {(*i, 0) for i in library([t or "" for i, t in rows if i in (9, 100, -3)])}


def test_same_id_everywhere(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(frames, "FILE_BYTES", 200)
    rows = [(5, f"text {n % 7}") for n in range(90)] + [(None, "x")] * 3
    catalog = frames.write_ids(helpers.documents(spark, rows, long=False), str(tmp_path), PATH)
    assert table(frames.read_digests(catalog).collect()) == brute(rows)
    assert frames.fetch(catalog, [5]).count() == 90


def test_a_reader_takes_what_it_needs(spark, tmp_path):
    rows = [(n, f"document number {n} " * (n % 5 + 1)) for n in range(300)]
    catalog = frames.write_ids(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), str(tmp_path), PATH)
    uri = catalog.first()["path"]
    file = frames.Reader(uri)
    asked, real = [], file.file

    class Counting:
        def read_at(self, n, at):
            asked.append(n)
            return real.read_at(n, at)

    file.file = Counting()
    (k,) = file.places(file.ids[7])
    assert np.frombuffer(b"".join(file.document(k)), "<u4").tolist() == [*library([rows[file.ids[7]][1]])[0], 0]
    assert asked == [int(file.size[file.frame[k]])]
    assert list(file.places(10**6)) == []


def test_the_format_is_plain_zstandard(spark, tmp_path):
    rows = [(n, f"document number {n}") for n in range(20)]
    catalog = frames.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path), PATH)
    whole = b""
    for r in catalog.orderBy("part", "roll").collect():
        data = open(r["path"], "rb").read()
        assert data[-4:] == bytes.fromhex("b1ea928f")
        whole += zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert np.frombuffer(whole, "<u4").tolist() == [i for ids in library([t for _, t in rows]) for i in [*ids, 0]]
    assert not [n for n in os.listdir(tmp_path) if n.startswith("_open")]


def test_damage_is_found(spark, tmp_path):
    rows = [(n, f"document number {n} of some length " * 9) for n in range(20)]
    catalog = frames.write_ids(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), str(tmp_path), PATH)
    path = catalog.first()["path"]
    good = open(path, "rb").read()
    file = frames.Reader(path)
    for at in (int(file.at[3]) + int(file.size[3]) - 3, int(file.at[3]) + 12):
        with open(path, "wb") as f:
            f.write(good[:at] + bytes([good[at] ^ 0xFF]) + good[at + 1 :])
        broken = frames.Reader(path)
        assert b"".join(broken.document(2))
        with pytest.raises(frames.DamagedFrame):
            list(broken.document(3))
    with open(path, "wb") as f:
        f.write(good[:-1])
    with pytest.raises(frames.DamagedFrame):
        frames.Reader(path)


def test_empty(spark, tmp_path):
    catalog = frames.write_ids(helpers.empty(spark), str(tmp_path), PATH)
    assert catalog.collect() == [] and frames.read_digests(catalog).collect() == [] and frames.fetch(catalog, [1]).collect() == []


def test_on_tables(spark):
    from cierre.llm.queries import QUERIES

    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    assert table(QUERIES["op13_seekable_ids"](spark, path).collect()) == brute(rows)
