"""Joins of large inputs in tasks of bounded size.

Left to itself a shuffle has as many partitions as the session says, or fewer
after merging small ones by their compressed bytes, and all operators up to the
next shuffle run in them; their sorts and hash tables grow with the input. Large
sides are dealt to so many partitions that each gets about ``ROWS`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of the larger side in a task: 100 to 200 MB in the joins and aggregates of snapshots.
ROWS = 1 << 18


def partitions_for(n_rows: int, cores: int, rows: int = ROWS) -> int | None:
    """Partitions for so many rows; None where no more are needed than there are cores."""
    n = -(-n_rows // rows)
    return n if n > cores else None


def deal_out(large: DataFrame, large_key: str, other: DataFrame, other_key: str, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join, dealt alike by their keys if ``large`` has many rows.
    Counts them, for which a table of Parquet files is not read but its footers.
    A task's rows of ``other`` are few then and are hashed, where a merge would sort
    both sides, and each sort holds a first page of up to 64 MB."""
    cores, n_rows = large.sparkSession.sparkContext.defaultParallelism, large.count()
    if partitions_for(n_rows, cores, rows) is None:
        return large, other
    n = partitions_for(max(n_rows, other.count()), cores, rows)
    return large.repartition(n, large_key), other.repartition(n, other_key).hint("shuffle_hash")
