"""Homomorphic fingerprints of documents, in DataFrame functions alone.

A paragraph is a line that is not empty. Each paragraph is hashed to a wide
vector and a document's fingerprint is the sum of its paragraphs' vectors,
lane by lane modulo a power of two. The sum does not depend on the order of the
paragraphs, and a paragraph is inserted or deleted by adding or subtracting its
vector (``combined``). The lanes:

* ``EXACT`` lanes modulo 2^32 of the paragraph's XXH64 values with different
  seeds: equal sums mean equal multisets of paragraphs, but for a chance of
  2^-256.
* 128 sign lanes modulo 2^32: each piece of up to ``PIECE`` words of the
  paragraph adds +1 or -1, by the bits of its hash. The squared distance of
  two documents' sign lanes estimates the size of the difference of their
  multisets of pieces, so fingerprints alone tell how alike the texts are
  (``likeness``; a lane's sum stays within 2^31 for any text that a row can hold).

Defined results: a null text is empty and has the fingerprint of no paragraphs;
documents with one doc_id share their next document, the first (by length, then
hash) of the next smaller doc_id; a null doc_id (and the smallest long, which
stands for it) sorts last; a single document follows itself; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cierre.session import cut_lineage

EXACT = 8
PIECE = 5
_LOW = 0xFFFFFFFF
_HALF = 1 << 31
_NO_ID = -(2**63)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _longs(n: int) -> Column:
    return F.array_repeat(F.lit(0).cast("long"), n)


def exact_lanes(text: Column) -> Column:
    """Sums modulo 2^32 over the paragraphs."""
    seeds = F.sequence(F.lit(1), F.lit(EXACT))
    paragraphs = F.filter(F.split(text, "\n", -1), lambda p: p != "")
    return F.aggregate(paragraphs, _longs(EXACT), lambda sums, p: F.zip_with(
        sums, seeds, lambda s, k: (s + F.xxhash64(p, k).bitwiseAND(_LOW)).bitwiseAND(_LOW)))


def sign_lanes(text: Column) -> Column:
    """128 sums of signs over the pieces. A long counts the set bits j and
    j + 32 of the pieces' hashes in its two halves; 64 of them cover two hashes,
    and the last one counts the pieces."""
    places = F.sequence(F.lit(0), F.lit(64))
    pieces = F.regexp_extract_all(text, F.lit(r"\S++(?:[^\S\n]++\S++){0,%d}" % (PIECE - 1)), F.lit(0))
    hashed = F.transform(pieces, lambda p: F.struct(F.xxhash64(p, F.lit(0)).alias("a"), F.xxhash64(p, F.lit(-1)).alias("b")))
    both = 1 + (1 << 32)

    def add(n, h, j):
        a, b = (F.call_function("shiftright", h[c], F.pmod(j, F.lit(32))).bitwiseAND(both) for c in "ab")
        return n + F.when(j < 32, a).when(j < 64, b).otherwise(F.lit(1).cast("long"))

    counts = F.aggregate(hashed, _longs(65), lambda acc, h: F.zip_with(acc, places, lambda n, j: add(n, h, j)))
    return _let(counts, lambda c: F.concat(
        F.transform(F.slice(c, 1, 64), lambda x: 2 * x.bitwiseAND(_LOW) - F.element_at(c, 65)),
        F.transform(F.slice(c, 1, 64), lambda x: 2 * F.shiftright(x, 32) - F.element_at(c, 65))))


def lanes(text: Column) -> Column:
    """The fingerprint as a struct of its two arrays, sign lanes within 2^31."""
    signs = F.transform(sign_lanes(text), lambda x: F.pmod(x + _HALF, F.lit(2 * _HALF)) - _HALF)
    return F.struct(exact_lanes(text).alias("exact"), signs.alias("signs"))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of a multiset after inserting (1) or deleting (-1) another."""
    return F.struct(
        F.zip_with(a["exact"], b["exact"], lambda x, y: F.pmod(x + sign * y, F.lit(1 << 32))).alias("exact"),
        F.zip_with(a["signs"], b["signs"], lambda x, y: F.pmod(x + sign * y + _HALF, F.lit(2 * _HALF)) - _HALF).alias("signs"))


def text_of(fp: Column) -> Column:
    """A fingerprint as a string (base64 of its lanes)."""

    def digits(lane, n):
        return F.array_join(F.transform(lane, lambda x: F.lpad(F.hex(F.pmod(x, F.lit(16**n))), n, "0")), "")

    raw = F.unhex(F.concat(digits(fp["exact"], 8), digits(fp["signs"], 8)))
    return F.translate(F.base64(raw), "\r\n", "")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, about 0 where no piece is shared."""
    wide = [F.transform(x["signs"], lambda v: v.cast("double")) for x in (a, b)]
    terms = F.zip_with(*wide, lambda x, y: F.struct(((x - y) * (x - y)).alias("d"), (x * x + y * y).alias("s")))
    zero = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("s"))
    sums = F.aggregate(terms, zero, lambda acc, t: F.struct((acc["d"] + t["d"]).alias("d"), (acc["s"] + t["s"]).alias("s")))
    value = _let(sums, lambda t: F.when(t["s"] == 0, 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - t["d"] / t["s"])))
    same = a["exact"] == b["exact"]
    return F.when(same, F.lit(1.0)).otherwise(value)


def _followers(docs: DataFrame) -> DataFrame:
    """(key, before, room): each id, the id it follows in descending order, and
    the length of the longest text there. Ids are cut into ranges; only the
    ranges' first ids, one a partition, are sorted together."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.groupBy("key").agg(F.max(F.length("text")).alias("n"))
    ranged = cut_lineage(ids.repartitionByRange(n, F.desc("key")).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(F.desc("key"))
    rows = ranged.withColumn("before", F.lag("key").over(inside)).withColumn("room", F.lag("n").over(inside))
    # The last id of the part before goes before a part's first one; the first part follows the last.
    tails = ranged.groupBy("part").agg(F.min(F.struct("key", "n")).alias("tail"))
    parts = Window.orderBy("part")
    every = Window.partitionBy()
    tails = tails.withColumn("tail_before", F.coalesce(F.lag("tail").over(parts), F.max_by("tail", "part").over(every)))
    return rows.join(F.broadcast(tails.select("part", "tail_before")), "part").select(
        "key", F.coalesce("before", F.col("tail_before")["key"]).alias("before"),
        F.coalesce("room", F.col("tail_before")["n"]).alias("room"))


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text (the last third replaced
    by the head of the next document), and their likenesses.

    The texts are shuffled by id once, for both joins; the next document sends
    only as much of its head as the edit needs, and its fingerprint.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("key"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    follow = cut_lineage(_followers(named))
    dealt = named.repartition(n, "key")
    first = Window.partitionBy("key").orderBy(F.length("text"), F.xxhash64("text"))
    sent = dealt.withColumn("rn", F.row_number().over(first)).filter("rn = 1").join(follow, "key").select(
        F.col("before").alias("key"), F.substring(F.col("text"), F.lit(1), (F.col("room") / 3).cast("int")).alias("head"),
        lanes(F.col("text")).alias("next_fp"))
    own = dealt.join(sent, "key")
    length = F.length("text")
    third = F.floor(length / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), length - third), F.substring(F.col("head"), F.lit(1), third))
    told = own.select("key", "text", "next_fp", edited.alias("edited")).select(
        "key", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        lanes(F.col("text")).alias("fp"), lanes(F.col("edited")).alias("edited_fp"), "next_fp")
    return told.select(
        F.when(F.col("key") != _NO_ID, F.col("key")).alias("doc_id"), "n_chars", "edited_sha256",
        text_of(F.col("fp")).alias("fingerprint"), text_of(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
