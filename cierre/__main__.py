"""Daily refresh from the command line.

    spark-submit ... -m cierre --bookings PATH --inventory PATH --as-of 2001-04-18 \\
        --weeks-start 2001-01-01 --out PATH [--verdicts PATH] [--payments PATH] [--snapshots-by-car] [--format parquet|json]

Reads the two stored tables with their declared schemas, computes every
report of ``as_of`` and publishes them as one set (``sources.io``). Without
verdicts or payments, or where their path does not exist, their reports are left
out (the payment split is an empty dataset). ``--snapshots-by-car``: the
inventory is the name of a table that ``sources.layout`` has written.

    spark-submit ... -m cierre --state PATH --changed PATH [--removed PATH] --as-of ... --weeks-start ... --out PATH

brings the KPI state below ``--state`` up to date with the changed bookings (the
first run: all bookings) and publishes R9-R14 from it; no other booking is read. Master, partitions, memory and ``spark.checkpoint.dir`` are the
submitter's; outside local mode the checkpoint folder is required.
"""

from __future__ import annotations

import argparse
from datetime import date

from cierre import incremental
from cierre.params import Params
from cierre.refresh import full_refresh
from cierre.session import ensure_checkpoint_dir, job_session
from cierre.sources.datasets import PAYMENT_SCHEMA, VERDICT_SCHEMA
from cierre.sources.io import dataset_presence, publish, read_or_empty, vacuum
from cierre.sources.layout import read_snapshots
from cierre.sources.schema import Labels, read_bookings, read_inventory


def _some(spark, path: str | None, schema: str):
    """An optional input, None where it has no rows."""
    df = read_or_empty(spark, path, schema) if path else None
    return None if df is None or df.isEmpty() else df


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="cierre", description=__doc__.splitlines()[0])
    ap.add_argument("--bookings", help="stored bookings (needed without --state)")
    ap.add_argument("--inventory", help="stored snapshots (needed without --state)")
    ap.add_argument("--state", help="KPI state to bring up to date instead of a full refresh")
    ap.add_argument("--changed", help="all current rows of the bookings that changed")
    ap.add_argument("--removed", help="booking_id of bookings that are no more")
    ap.add_argument("--as-of", required=True, type=date.fromisoformat)
    ap.add_argument("--weeks-start", required=True, type=date.fromisoformat)
    ap.add_argument("--out", required=True)
    ap.add_argument("--verdicts", help="verdict events: booking_id, dictamen, event_time, event_id")
    ap.add_argument("--payments", help="payments: booking_id, payment_id, paid_on, amount")
    ap.add_argument("--snapshots-by-car", action="store_true", help="the inventory is a table stored by car")
    ap.add_argument("--keep", type=int, default=0, help="published sets whose files stay; 0 keeps all")
    ap.add_argument("--format", default="parquet", choices=["parquet", "json"])
    for option, text in (("financing", "financing method"), ("cash", "cash method"), ("financing-captive", "captive lender's method"),
                         ("captive-provider", "captive lender")):
        ap.add_argument(f"--label-{option}", default=getattr(Labels(), option.replace("-", "_")), help=f"the table's name of the {text}")
    args = ap.parse_args(argv)
    if args.state is None and not (args.bookings and args.inventory) or args.state is not None and not args.changed:
        ap.error("--bookings and --inventory, or --state and --changed, are needed")

    spark = job_session()
    ensure_checkpoint_dir(spark)
    p = Params(as_of=args.as_of, weeks_start=args.weeks_start)
    labels = Labels(args.label_financing, args.label_cash, args.label_financing_captive, args.label_captive_provider)
    if args.state is not None:
        removed = _some(spark, args.removed, "booking_id bigint")
        incremental.update(spark, args.state, read_bookings(spark, args.changed, labels), removed)
        names = publish(incremental.reports(spark, args.state, p), args.out, args.format)
        return _report(spark, args, names)
    inventory = read_snapshots(spark, args.inventory) if args.snapshots_by_car else read_inventory(spark, args.inventory)
    names = full_refresh(read_bookings(spark, args.bookings, labels), inventory, p, args.out, args.format,
                         _some(spark, args.verdicts, VERDICT_SCHEMA), payments=_some(spark, args.payments, PAYMENT_SCHEMA),
                         stored_by_car=args.snapshots_by_car)
    return _report(spark, args, names)


def _report(spark, args, names: list[str]) -> int:
    for row in dataset_presence(spark, args.out, names).collect():  # one row a report
        print(row["dataset"], row["n_rows"])
    if args.keep:
        vacuum(spark, args.out, args.keep)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
