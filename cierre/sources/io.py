"""Report I/O: optional inputs (S3), empty typed dimensions (S4), writing a
report (S5), publishing a set and replacing one dataset of it (S6), and the
checks of a published set (R30).

A published set is a folder of versions and of manifests. Every run writes its
datasets to a folder of its own; figures of the rows (``METRICS``) are observed
in the write itself. When all are written, a manifest names for each dataset the
folder that holds it and its figures.

Manifests are numbered, and a number is given once: a run builds on the newest
manifest and creates the next number, which fails if another run has it by then;
it then reads that one and tries again on top of it. So runs at the same time lose
nothing of each other, and one that fails halfway leaves the set as it was.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The "con/sin pago" dimension has this shape.
PAYMENT_DIM_SCHEMA = "semana date, metodo_de_pago string, pago_dim string, ventas bigint, cancelaciones bigint"
#: Rows; rows with a null among the text and date columns; sum of all whole-number columns; range of the first date column.
METRICS = ["n_rows", "n_null_keys", "total", "first_period", "last_period"]
MANIFEST_SCHEMA = ("version bigint, parent bigint, run string, dataset string, path string, format string, n_rows bigint, "
                   "n_null_keys bigint, total bigint, first_period date, last_period date")


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_or_empty(spark: SparkSession, path: str | None, schema: str | T.StructType, fmt: str = "parquet") -> DataFrame:
    """S3: an optional dataset that is not there reads as an empty frame of its
    schema, so reports built on it come out empty instead of failing. Any other
    error (no permission, a bad option) is raised."""
    if path is None:
        return empty_dim(spark, schema)
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as e:
        if not _missing(e):
            raise
        return empty_dim(spark, schema)


def empty_dim(spark: SparkSession, schema: str | T.StructType = PAYMENT_DIM_SCHEMA) -> DataFrame:
    """An empty typed dimension frame (the payment split without payments)."""
    return spark.createDataFrame([], schema)


def write_report(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> dict:
    """Write one report dataset, replacing what was there. Returns ``METRICS`` of
    the rows, gathered while they are written."""
    seen = Observation()
    w = df.observe(seen, *_metrics(df)).write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    found = seen.get
    return {"n_rows": 0, "n_null_keys": 0, "total": 0, "first_period": None, "last_period": None, **found}


def _metrics(df: DataFrame) -> list:
    kinds = df.dtypes
    keys = [F.col(f"`{c}`") for c, t in kinds if t in ("string", "date")]
    numbers = [F.col(f"`{c}`") for c, t in kinds if t in ("int", "bigint")]
    date_col = next((F.col(f"`{c}`") for c, t in kinds if t == "date"), F.lit(None).cast("date"))
    some_null = F.greatest(*[k.isNull() for k in keys], F.lit(False)) if keys else F.lit(False)
    row_total = sum((F.coalesce(n.cast("bigint"), F.lit(0)) for n in numbers), F.lit(0).cast("bigint"))
    return [F.count(F.lit(1)).alias("n_rows"), F.count(F.when(some_null, 1)).alias("n_null_keys"),
            F.coalesce(F.sum(row_total), F.lit(0)).alias("total"),
            F.min(date_col).alias("first_period"), F.max(date_col).alias("last_period")]


# ------------------------------------------------------------- manifests ----
def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The newest manifest: ``MANIFEST_SCHEMA``, one row for each dataset of the set."""
    runs = _manifests(spark, root)
    newest = runs.agg(F.max("version").alias("newest"))  # one row
    return runs.join(F.broadcast(newest), F.col("version") == F.col("newest")).drop("newest")


def _manifests(spark: SparkSession, root: str) -> DataFrame:
    folder = f"{root.rstrip('/')}/manifest"
    return read_or_empty(spark, folder if _names(spark, folder) else None, MANIFEST_SCHEMA, "json")


def write_all(reports: Mapping[str, DataFrame], root: str, fmt: str = "parquet", parallelism: int = 8,
              partition_by: list[str] | None = None) -> list[dict]:
    """Write all reports of a run to a folder of its own; their manifest rows."""
    run = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"

    def write(item) -> dict:
        name, df = item
        path = f"{root.rstrip('/')}/versions/{run}/{name}"
        return {"run": run, "dataset": name, "path": path, "format": fmt, **write_report(df, path, fmt, partition_by)}

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(write, reports.items()))


def commit(spark: SparkSession, root: str, written: list[dict], attempts: int = 100, parent: int | None = None,
           without: Iterable[str] = ()) -> int | None:
    """Name the written datasets in a new manifest on top of the newest one, whose
    other datasets stay as they are, but for those ``without``; its number. With
    ``parent`` the newest one must be that: None if it is not."""
    root = root.rstrip("/")
    for _ in range(attempts):
        before = [r.asDict() for r in manifest(spark, root).collect()]  # a row a dataset
        newest = before[0]["version"] if before else 0
        if parent is not None and newest != parent:
            return None
        rows = {r["dataset"]: r for r in [*(r for r in before if r["dataset"] not in without), *written]}
        lines = [json.dumps({**r, "version": newest + 1, "parent": newest}, default=str) for _, r in sorted(rows.items())]
        if _create(spark, f"{root}/manifest/{newest + 1:012d}.json", "\n".join(lines) + "\n"):
            return newest + 1
    raise RuntimeError(f"no manifest of {root} could be committed in {attempts} attempts")


def publish(reports: Mapping[str, DataFrame], root: str, fmt: str = "parquet", parallelism: int = 8) -> list[str]:
    """Write all reports of a run side by side, then name them in a new
    manifest; datasets of the set that the run does not write stay as they were."""
    spark = next(iter(reports.values())).sparkSession
    written = write_all(reports, root, fmt, parallelism)
    commit(spark, root, written)
    return sorted(r["dataset"] for r in written)


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One dataset of the newest set."""
    row = manifest(spark, root).filter(F.col("dataset") == name).first()
    if row is None:
        raise KeyError(name)
    return spark.read.format(row["format"]).load(row["path"])


def vacuum(spark: SparkSession, root: str, keep: int = 5, grace_hours: float = 24.0) -> list[str]:
    """Remove the folders of runs that none of the last ``keep`` manifests names, and
    older manifests. Runs younger than ``grace_hours`` stay: they may be about to
    commit, or being read. Returns the removed runs."""
    root = root.rstrip("/")
    rows = _manifests(spark, root).select("version", "path").distinct().collect()  # a row a dataset and kept manifest
    last = sorted({r["version"] for r in rows})[-keep:]
    named = {r["path"].split("/versions/")[1].split("/")[0] for r in rows if r["version"] in last}
    until = f"{int((time.time() - 3600 * grace_hours) * 1000):015d}"
    gone = [run for run in _names(spark, f"{root}/versions") if run not in named and run < until]
    for name in _names(spark, f"{root}/manifest"):
        if name.endswith(".json") and last and int(name[:-5]) < last[0]:
            remove(spark, f"{root}/manifest/{name}")
    for run in gone:
        remove(spark, f"{root}/versions/{run}")
    return sorted(gone)


# -------------------------------------------------- files, on the driver ----
def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, where = _file_system(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of this module's making, on any file system of Spark."""
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all its text at once; False if it is there already."""
    folder, name = path.rsplit("/", 1)
    fs, draft = _file_system(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            # A hard link is made if there is none of that name, in one step.
            try:
                os.link(draft.toUri().getPath(), _file_system(spark, path)[1].toUri().getPath())
                return True
            except FileExistsError:
                return False
        return _renamed(spark, draft, path)
    finally:
        fs.delete(draft, False)


def _renamed(spark: SparkSession, draft, path: str) -> bool:
    """Rename without replacing, which is one step on distributed file systems."""
    from py4j.protocol import Py4JJavaError

    hadoop = spark._jvm.org.apache.hadoop.fs
    target, gateway = hadoop.Path(path), spark.sparkContext._gateway
    rename = getattr(hadoop, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.valueOf("NONE")
    try:
        hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)
        return True
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise


# ---------------------------------------------------------------- checks ----
def dataset_presence(spark: SparkSession, root: str, expected: list[str]) -> DataFrame:
    """One row per expected dataset: whether the set has it, and its row
    count, as they were when it was written."""
    return dataset_checks(spark, root, [(name, None, None) for name in expected]).select("dataset", "present", "n_rows")


def dataset_checks(spark: SparkSession, root: str, expected: list[tuple]) -> DataFrame:
    """R30 with limits: for each ``(dataset, least rows, latest first day of the last
    period)`` its figures from the manifest, and ``passed``: it is there, has that
    many rows at least, and reaches that day. A limit of None asks nothing."""
    wanted = spark.createDataFrame([tuple(x) for x in expected], "dataset string, min_rows bigint, min_last date")
    held = manifest(spark, root).select("dataset", *METRICS, F.lit(True).alias("held"))
    rows = wanted.join(held, "dataset", "left")
    passed = (F.col("held").isNotNull() & (F.coalesce("n_rows", F.lit(0)) >= F.coalesce("min_rows", F.lit(0)))
              & (F.col("min_last").isNull() | F.coalesce(F.col("last_period") >= F.col("min_last"), F.lit(False))))
    return rows.select("dataset", F.col("held").isNotNull().alias("present"), *METRICS, passed.alias("passed"))
