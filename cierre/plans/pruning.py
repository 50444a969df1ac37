"""Keeping only rows whose key another frame may hold: a Bloom filter as a frame.

The filter is a table of 64-bit words: a key's hash names one word and four bits
of it. Building it is one ``bit_or`` aggregate that combines map-side, and it has
``words`` rows at most, whatever the number of keys, so it can always be
broadcast. A row passes if its word holds its bits; a row that passes without a
match (a false positive) must be harmless to the caller, as it is before a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the filter at most: 64 MB of bits, a few hundred MB at worst as a hash table; about one false
#: positive in a hundred at six million keys.
WORDS = 1 << 20


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _bits(key: Column) -> Column:
    h, one = F.xxhash64(key, F.lit(1)), F.lit(1).cast("bigint")
    out = None
    for k in range(4):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", one, place)
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def key_filter(keys: DataFrame, words: int = WORDS) -> DataFrame:
    """``(word, bits)`` of the one-column frame ``keys``; null keys are left out."""
    key = F.col(keys.columns[0])
    return keys.filter(key.isNotNull()).groupBy(_word(key, words).alias("word")).agg(F.bit_or(_bits(key)).alias("bits"))


def maybe_in(rows: DataFrame, column: str, found: DataFrame, words: int = WORDS) -> DataFrame:
    """``rows`` whose ``column`` may be one of the filter's keys (its type must be
    the keys' type). A broadcast join: no shuffle of ``rows``."""
    key = F.col(column)
    held = found.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    same = (_word(key, words) == F.col("_word")) & (F.col("_bits").bitwiseAND(_bits(key)) == _bits(key))
    return rows.join(F.broadcast(held), same, "left_semi")
