"""Snapshots stored by car: the layout that the inventory joins need no shuffle on.

The table is bucketed by ``bk_stock`` and sorted by ``(bk_stock, inv_date)``
within each bucket. Everything the reports ask of snapshots is asked by car
(first receipt, a day's snapshot, the region as of a day), so aggregates and
joins on the car read the buckets in place, and only the closed bookings move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cierre.sources.schema import standardize_inventory

#: Buckets of a new table. A bucket is read by one task: choose total size / 1 GB or so.
BUCKETS = 512


def write_snapshots(inventory: DataFrame, table: str, buckets: int = BUCKETS, path: str | None = None) -> None:
    """Store ``inventory`` as ``table``, replacing what was there. One file a bucket:
    rows move to the bucket's task before they are written."""
    _writer(standardize_inventory(inventory), buckets, path).mode("overwrite").saveAsTable(table)


def append_snapshots(inventory: DataFrame, table: str) -> None:
    """Add new snapshots (a day's, say) to the stored table, in its own buckets: one
    more file for each bucket. ``rewrite_snapshots`` joins the files again."""
    _writer(standardize_inventory(inventory), _buckets(inventory.sparkSession, table), None).mode("append").saveAsTable(table)


def rewrite_snapshots(spark: SparkSession, source: str, table: str, buckets: int | None = None) -> None:
    """Copy a stored table to a new one with one file a bucket, or other buckets."""
    if source == table:
        raise ValueError("a table cannot be read and replaced at once")
    write_snapshots(spark.table(source), table, buckets or _buckets(spark, source))


def read_snapshots(spark: SparkSession, table: str) -> DataFrame:
    """The stored snapshots. Columns keep their declared types, so that the plan
    still knows the buckets."""
    return standardize_inventory(spark.table(table))


def _writer(rows: DataFrame, buckets: int, path: str | None):
    w = rows.repartition(buckets, "bk_stock").write.format("parquet").bucketBy(buckets, "bk_stock").sortBy("bk_stock", "inv_date")
    return w.option("path", path) if path else w


def _buckets(spark: SparkSession, table: str) -> int:
    for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect():  # a row a column or property
        if row["col_name"] == "Num Buckets":
            return int(row["data_type"])
    raise ValueError(f"{table} has no buckets")
