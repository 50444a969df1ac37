import hashlib

import pytest
from pyspark.sql import functions as F

from cierre.llm import fingerprint as fp
from tests.llm.helpers import LONG, TEXTS, documents, empty


def value(spark, texts):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, text string")
    return [r[1] for r in df.select("n", fp.lanes(F.col("text"))).orderBy("n").collect()]


def test_order_does_not_matter_and_content_does(spark):
    a, b, c, d = value(spark, ["one line\ntwo lines\n\nthree", "three\none line\ntwo lines", "one line\ntwo lines", "one line\ntwo lines\nthree\nthree"])
    assert a == b and a != c and a != d


def test_insert_and_delete(spark):
    df = spark.createDataFrame([("alpha beta\ngamma", "delta epsilon", "alpha beta\ngamma\ndelta epsilon")], "a string, b string, ab string")
    a, b, ab = (fp.lanes(F.col(c)) for c in ("a", "b", "ab"))
    row = df.select(a.alias("a"), b.alias("b"), ab.alias("ab")).select(
        fp.combined(F.col("a"), F.col("b")).alias("sum"), "ab", fp.combined(F.col("ab"), F.col("b"), -1).alias("less"), "a").first()
    assert row["sum"] == row["ab"] and row["less"] == row["a"]


def test_lanes_by_brute_force(spark):
    """Signs from the pieces' hashes, one by one."""
    text = "a b c d e f g\nh  i\tj\n\nk"
    pieces = ["a b c d e", "f g", "h  i\tj", "k"]
    hashes = spark.createDataFrame([(p,) for p in pieces], "p string").select(
        F.xxhash64("p", F.lit(0)), F.xxhash64("p", F.lit(-1))).collect()
    bits = lambda h, j: 1 if (h >> j) & 1 else -1
    a = [sum(bits(h[0], j) for h in hashes) for j in range(64)]
    b = [sum(bits(h[1], j) for h in hashes) for j in range(64)]
    assert list(value(spark, [text])[0]["signs"]) == a[:32] + b[:32] + a[32:] + b[32:]


def test_report_matches_brute_force(spark):
    rows = [r for r in TEXTS if r[0] != 9] + [(100, LONG), (101, LONG[7:])]
    got = {r["doc_id"]: r for r in fp.edit_report(documents(spark, rows, long=False)).collect()}
    order = sorted((r for r in rows if r[0] is not None), reverse=True) + [r for r in rows if r[0] is None]
    prints = {}
    for (i, t), (_, after) in zip(order, [*order[1:], order[0]]):
        t, after = t or "", after or ""
        m = len(t) // 3
        edited = t[: len(t) - m] + after[:m]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
        assert got[i]["near_next"] == 1 or t != after
        prints.setdefault(t, set()).add(got[i]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert got[101]["near_edited"] == pytest.approx(2 / 3, abs=0.1)


def test_repeated_ids_share_their_next_document(spark):
    got = fp.edit_report(documents(spark, TEXTS, long=False)).collect()
    assert len(got) == len(TEXTS)
    nine = [r for r in got if r["doc_id"] == 9]
    assert len(nine) == 3 and {r["n_chars"] for r in nine} == {1, len(TEXTS[8][1])}


def test_single_document_and_empty_table(spark):
    (row,) = fp.edit_report(documents(spark, [(1, "abc\nabcdef")], long=False)).collect()
    assert row["near_next"] == 1.0
    assert fp.edit_report(empty(spark)).collect() == []


def test_main_path_is_native(spark):
    plan = fp.edit_report(documents(spark, TEXTS, long=False))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_very_frequent_lines_do_not_wrap(spark):
    """Pieces that occur 40,000 and 60,000 times: the last third is gone."""
    for n in (40_000, 60_000):
        df = spark.createDataFrame([("hot 1\n" * n, "hot 1\n" * (n - n // 3))], "a string, b string").select(
            fp.lanes(F.col("a")).alias("a"), fp.lanes(F.col("b")).alias("b"))
        row = df.select("a", fp.likeness(F.col("a"), F.col("b")).alias("near")).first()
        assert {abs(x) for x in row["a"]["signs"]} == {n}
        assert row["near"] == pytest.approx(1 - (1 / 3) ** 2 / (1 + (2 / 3) ** 2), abs=1e-4)
