"""As-of join: each left row gets the value that was current at its time.

Both sides are put together and shuffled once by key; a window over each key in
time order carries the latest value forward. No side is doubled, and there is no
join whose rows could multiply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(left: DataFrame, right: DataFrame, left_on: tuple[str, str], right_on: tuple[str, str], value: str,
               lookback: int, out: str, prefer: Column | None = None, otherwise_latest: bool = False, salt: int = 1) -> DataFrame:
    """``left`` with a column ``out``: ``value`` of the latest right row of the same
    key in the ``lookback`` days before the left row's day, or on it. Without one,
    null, or with ``otherwise_latest`` the key's latest value of all.

    ``left_on``, ``right_on``: names of the key and of the DATE column. Of several
    right rows on one day the one with the greatest ``prefer`` counts, then the
    greatest value. Right rows without key, day or value say nothing. A left row
    without key gets null, one without day the latest value if that is asked for.

    ``salt``: a key's left rows are spread over so many groups, each of which sees
    a copy of the key's right rows; for keys that very many left rows share. Left
    rows without key are always spread by a hash of the row.
    """
    (lkey, lday), (rkey, rday) = left_on, right_on
    kind = left.schema[lkey].dataType
    spread = F.xxhash64(*left.columns)
    days = lambda c: F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))
    rank = prefer if prefer is not None else F.lit(0)
    asking = left.select(
        F.col(lkey).alias("_key"),
        F.when(F.col(lkey).isNull(), spread).otherwise(F.pmod(spread, F.lit(salt))).alias("_salt"),
        days(lday).alias("_day"), F.struct(*left.columns).alias("_row"))
    known = right.filter(F.col(rkey).isNotNull() & F.col(rday).isNotNull() & F.col(value).isNotNull())
    said = known.select(
        F.col(rkey).cast(kind).alias("_key"),
        F.explode(F.array(*[F.lit(k).cast("bigint") for k in range(salt)])).alias("_salt"),
        days(rday).alias("_day"), F.struct(days(rday).alias("day"), rank.alias("rank"), F.col(value).alias("value")).alias("_said"))
    both = asking.unionByName(said, allowMissingColumns=True)
    key = Window.partitionBy("_key", "_salt")
    recent = F.max("_said").over(key.orderBy("_day").rangeBetween(-lookback, Window.currentRow))
    found = F.when(F.col("_day").isNotNull(), recent["value"])
    if otherwise_latest:
        found = F.coalesce(found, F.max("_said").over(key)["value"])
    merged = both.select("_row", found.alias("_found")).filter(F.col("_row").isNotNull())
    return merged.select(*[F.col("_row")[c].alias(c) for c in left.columns], F.col("_found").alias(out))
