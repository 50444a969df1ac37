"""KPI reports (R9-R14) kept up to date from changed bookings alone.

The state is a published set (``sources.io``): ``events``, the KPI events of all
bookings counted by day, and a log of booking versions, in which each run adds
the rows of the bookings that changed. A booking's contribution to the counts is
a function of its own rows, so a run adds the contributions of the new rows and
takes back those of the rows that the log held for the same bookings:

    events' = events + events of the new rows - events of the old rows

Late cancels, corrections of any column and removed bookings are all of this
form. What is read follows the change: the log is stored by ranges of booking
ids, and only the ranges of changed bookings are read.

A run is committed in one manifest, which must follow the one it was computed
from. Of two runs at once the later one fails with ``StateMoved`` and changes
nothing; repeat it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cierre.operators import kpis as K
from cierre.params import Params
from cierre.session import cut_lineage
from cierre.sources import io as IO
from cierre.sources.schema import BOOKINGS_SCHEMA

#: Booking ids of one range of the log. Ids are given in order, so a day's changes lie in few ranges.
RANGE_IDS = 1_000_000
#: Runs whose versions lie apart; one more rewrites the log as one.
MAX_RUNS = 30
_LOG = "versions-"
_ALWAYS = (date(1, 1, 1), date(9999, 12, 31))


class StateMoved(RuntimeError):
    """Another run has changed the state meanwhile."""


def contributions(bookings: DataFrame, sign: int = 1) -> DataFrame:
    """KPI events of all days, counted; ``sign`` -1 takes them back."""
    any_day = Params(as_of=date(2000, 1, 1), weeks_start=date(2000, 1, 1))
    counted = K.kpi_events(bookings, any_day, "korvedc", *_ALWAYS, daily=True)
    return counted if sign > 0 else counted.withColumn("n", -F.col("n"))


def events(spark: SparkSession, root: str) -> DataFrame:
    """The counted events, input of ``kpis.*_of``."""
    return IO.read_published(spark, root, "events")


def _stored(spark: SparkSession, root: str) -> dict[str, dict]:
    return {r["dataset"]: r.asDict() for r in IO.manifest(spark, root).collect()}  # a row a run of the log


def versions(spark: SparkSession, logs: list[dict], ranges: list[int] | None = None) -> DataFrame:
    """The log's rows: bookings' columns, ``gone`` (a removed booking's only row) and
    ``seq``, the number of the run; with ``ranges`` those id ranges only."""
    schema = _log_schema()
    rows = None
    for log in logs:
        part = spark.read.schema(schema).parquet(log["path"])
        if ranges is not None:
            part = part.filter(F.col("id_range").isin(ranges))
        rows = part if rows is None else rows.unionByName(part)
    return rows if rows is not None else spark.createDataFrame([], schema)


def _log_schema() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BOOKINGS_SCHEMA.fields) + ", gone boolean, seq long, id_range long"


def latest(rows: DataFrame) -> DataFrame:
    """Of each booking the rows of the last run that had it, none if that removed it."""
    newest = F.max("seq").over(Window.partitionBy("booking_id"))
    return rows.withColumn("_newest", newest).filter("seq = _newest AND NOT gone").drop("_newest")


def update(spark: SparkSession, root: str, changed: DataFrame, removed: DataFrame | None = None) -> int:
    """Bring the state below ``root`` up to date; the number of its manifest.

    ``changed``: all current rows of every booking that is new or has changed since
    the last run (the first run: all bookings); ``removed``: ``booking_id`` of
    bookings that are no more. Bookings without an id cannot change later; their
    rows are added each time they are given.
    """
    root = root.rstrip("/")
    held = _stored(spark, root)
    parent = max((r["version"] for r in held.values()), default=0)
    logs = [held[name] for name in sorted(held) if name.startswith(_LOG)]
    columns = [f.name for f in BOOKINGS_SCHEMA.fields]
    given = changed.select(*columns, F.lit(False).alias("gone"))
    if removed is not None:
        once = removed.select("booking_id").filter("booking_id IS NOT NULL").distinct()
        once = once.join(given.select("booking_id").distinct(), "booking_id", "left_anti")
        given = given.unionByName(once.select("booking_id", F.lit(True).alias("gone")), allowMissingColumns=True)
    given = cut_lineage(given.withColumn("seq", F.lit(parent + 1).cast("bigint")).withColumn(
        "id_range", F.floor(F.coalesce("booking_id", F.lit(-1)) / RANGE_IDS).cast("bigint")))
    ids = given.select("booking_id").filter("booking_id IS NOT NULL").distinct()
    ranges = [r[0] for r in given.select("id_range").distinct().collect()]  # ranges of ids that changed
    old = latest(versions(spark, logs, ranges).join(ids, "booking_id", "left_semi"))
    delta = contributions(given.filter("NOT gone").select(*columns)).unionByName(contributions(old.select(*columns), -1))
    if "events" in held:
        delta = delta.unionByName(spark.read.parquet(held["events"]["path"]).select(*delta.columns))
    counted = delta.groupBy(*K.EVENT_KEYS).agg(F.sum("n").alias("n")).filter("n <> 0")
    log, gone = given, []
    if len(logs) >= MAX_RUNS:
        whole = versions(spark, logs).unionByName(given.select(*_names()))
        # Rows without an id all stay; a hash of the row spreads them.
        spread = F.when(F.col("booking_id").isNull(), F.xxhash64(*_names()))
        newest = F.max("seq").over(Window.partitionBy("booking_id", spread))
        log = whole.withColumn("_newest", newest).filter("(booking_id IS NULL OR seq = _newest) AND NOT gone").drop("_newest")
        gone = [r["dataset"] for r in logs]
    written = IO.write_all({"events": counted}, root)
    written += IO.write_all({f"{_LOG}{parent + 1:012d}": log.select(*_names())}, root, partition_by=["id_range"])
    number = IO.commit(spark, root, written, parent=parent, without=gone)
    if number is None:
        raise StateMoved(f"{root} has moved on from manifest {parent}")
    return number


def _names() -> list[str]:
    return [f.name for f in BOOKINGS_SCHEMA.fields] + ["gone", "seq", "id_range"]


def reports(spark: SparkSession, root: str, p: Params) -> dict[str, DataFrame]:
    """R9-R14 of ``p`` from the state; bookings are not read."""
    e = events(spark, root)
    periods = K.kpi_periods_of(e, p)
    return {
        "weekly_hub_str": K.weekly_hub_str_of(e, p), "bookings_weekly": K.bookings_weekly_of(e, p),
        "profile_mix_weekly": K.profile_mix_weekly_of(e, p),
        "kpi_mtd": periods.filter("period_kind = 'mtd'").drop("period_kind"),
        "kpi_lmtd": periods.filter("period_kind = 'lmtd'").drop("period_kind"),
        "daily_hub": K.daily_hub_of(e, p), "last_month_hub": K.last_month_hub_of(e, p),
    }
