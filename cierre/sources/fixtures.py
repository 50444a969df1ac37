"""The two input tables as views over the driver's TPC-H-like tables.

The reference ships no data; FIXTURES.md defines ``bookings`` and
``inventory_velocity`` as expressions over ``orders``, ``customer``,
``nation`` and ``lineitem`` so that Spark and the DuckDB oracle read the
same rows. The mapping constants below are fixed values of that definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cierre.plans.spread import deal_out
from cierre.sources.schema import standardize_bookings, standardize_inventory

# ---------------------------------------------------------------------------
# Fixed values of the fixture definition (FIXTURES.md), in order.
# ---------------------------------------------------------------------------
# o_orderpriority -> metodo_de_pago ("5-LOW": Other on even keys, else null).
PRIORITY_METHOD = [
    ("1-URGENT", "Financing"),
    ("2-HIGH", "Financing Inhouse"),
    ("3-MEDIUM", "Cash payment"),
    ("4-NOT SPECIFIED", "Cash payment"),
]
LOW_PRIORITY = "5-LOW"
LOW_PRIORITY_METHOD = "Other"
FINANCED_PRIORITIES = ["1-URGENT", "2-HIGH"]
PROVIDER_CAPTIVE = "Captive"
PROVIDER_BANK = "Bank"
# o_custkey % 7 -> perfil (6 -> null).
PROFILE_BY_MOD7 = ["X", "A", "B", "C", "Z_R", "Revisar"]
# c_nationkey % 8 -> hub name prefix; nation 24 has no hub.
HUB_PREFIX_BY_MOD8 = ["CDMX ", "edomex ", "GDL ", "QRO ", "MTY ", "PUE ", "CUE ", "TIJ "]
NO_HUB_NATION = 24
# MIN(l_suppkey) % 8 -> stock_region (7 -> null).
STOCK_REGION_BY_MOD8 = [
    "CDMX", "GUADALAJARA", "MONTERREY", "PUEBLA", "QUERETARO", "CUERNAVACA", "TIJUANA",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_index(value: Column, labels: list[str]) -> Column:
    expr = None
    for i, label in enumerate(labels):
        cond = value == F.lit(i)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def _plus_days(d: Column, n: Column) -> Column:
    return F.date_add(d, n.cast("int"))


def fixture_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bookings`` = orders JOIN customer JOIN nation, plus duplicate rows.

    Rows with ``booking_id % 50 = 1`` appear twice (history-table duplicates);
    they are emitted by one ``explode`` over a repeat count, so the orders
    scan is read once instead of twice as a ``UNION ALL`` would.
    """
    o = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation is a fixed 25-row dimension: broadcasting it is size-safe.
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)

    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    d = F.col("o_orderdate").cast("date")
    status = F.col("o_orderstatus")
    prio = F.col("o_orderpriority")

    method = None
    for p, m in PRIORITY_METHOD:
        method = F.when(prio == p, F.lit(m)) if method is None else method.when(prio == p, F.lit(m))
    method = method.when((prio == LOW_PRIORITY) & (k % 2 == 0), F.lit(LOW_PRIORITY_METHOD))

    hub = F.when(
        F.col("c_nationkey") != NO_HUB_NATION,
        F.concat(_by_index(F.col("c_nationkey") % 8, HUB_PREFIX_BY_MOD8), F.col("n_name")),
    )
    handoff = F.when(k % 3 != 0, _plus_days(d, k % 5))
    sale = F.when(status == "F", _plus_days(d, k % 30))
    delivered = (status == "F") & (k % 5 != 0)

    out = j.select(
        k.alias("booking_id"),
        F.when(k % 97 == 0, F.concat(F.lit("N/A-"), k.cast("string")))
        .otherwise(k.cast("string"))
        .alias("stock"),
        F.when(cust % 10 == 0, 1).otherwise(0).alias("b2b"),
        F.when(k % 7 == 0, 0).otherwise(1).alias("estimate_flag"),
        (cust % 2).cast("int").alias("trade_in"),
        method.alias("metodo_de_pago"),
        F.when(
            prio.isin(FINANCED_PRIORITIES),
            F.when(cust % 3 == 0, F.lit(PROVIDER_CAPTIVE)).otherwise(F.lit(PROVIDER_BANK)),
        ).alias("financing_provider"),
        _by_index(cust % 7, PROFILE_BY_MOD7).alias("perfil"),
        hub.alias("reservation_hub_name"),
        d.alias("fecha_reserva"),
        F.date_sub(d, (k % 4).cast("int")).alias("fecha_origen"),
        handoff.alias("fecha_handoff"),
        F.when((k % 3 != 0) & (k % 4 != 0), _plus_days(d, k % 5 + k % 6)).alias("fecha_aprobacion"),
        sale.alias("fecha_venta_declarada"),
        F.when((status == "O") | ((status == "F") & (k % 11 == 0)), _plus_days(d, k % 20)).alias(
            "fecha_cancelacion_reserva"
        ),
        F.when(delivered, _plus_days(d, k % 30 + 7)).alias("fecha_entrega"),
        F.when(delivered & (k % 13 == 0), _plus_days(d, k % 30 + 12)).alias("devolucion_date"),
        F.explode(F.array_repeat(F.lit(1), F.when(k % 50 == 1, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")
    return standardize_bookings(out)


def fixture_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``inventory_velocity`` = lineitem JOIN orders, one row per (car, day).

    The group key starts with ``l_orderkey``, the join key, so the aggregate
    reuses the join's hash partitioning (no second shuffle). What reports do by
    car goes on in the same tasks, which have a bounded number of rows.
    """
    l = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey"
    )
    o = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    l, o = deal_out(l, "l_orderkey", o, "o_orderkey")
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    g = j.groupBy(
        F.col("l_orderkey").alias("bk_stock"),
        F.date_sub(F.col("d"), (F.col("l_linenumber") % 3).cast("int")).alias("inv_date"),
    ).agg(
        F.min("l_quantity").alias("min_qty"),
        F.min(F.date_sub(F.col("d"), (F.col("l_quantity") * 3).cast("int"))).alias("min_receipt"),
        F.min("l_linenumber").alias("min_line"),
        F.min("l_extendedprice").alias("min_price"),
        F.min("l_tax").alias("min_tax"),
        F.min("l_discount").alias("min_disc"),
        F.min("l_suppkey").alias("min_supp"),
    )
    out = g.select(
        "bk_stock",
        "inv_date",
        F.when(F.col("min_qty") < 48, F.col("min_receipt")).alias("item_receipt_date"),
        F.when(F.col("min_line") < 7, F.col("min_price") * 6).alias("real_published_price"),
        F.when(F.col("min_tax") < 0.02, 1).when(F.col("min_tax") < 0.07, 0).alias("flag_coming_soon"),
        F.when(
            F.col("min_line") != 3, (1 - F.col("min_disc") - F.col("min_tax")).cast("decimal(6,2)")
        ).alias("pix_financing"),
        F.when(F.col("min_line") != 5, (1 - F.col("min_disc")).cast("decimal(6,2)")).alias("pix_cash"),
        _by_index(F.col("min_supp") % 8, STOCK_REGION_BY_MOD8).alias("stock_region"),
    )
    return standardize_inventory(out)


def verdict_of(booking_id: Column) -> Column:
    """Stand-in verdict of a booking (FIXTURES.md): ``booking_id % 9`` picks
    0-2 Aprobada, 3 Incompleta, 4 Rechazada, 5 Condicionada, 6 En proceso,
    7 null, 8 an unlisted value (which reports must recode as Otro)."""
    r = booking_id % 9
    return (
        F.when(r <= 2, F.lit("Aprobada"))
        .when(r == 3, F.lit("Incompleta"))
        .when(r == 4, F.lit("Rechazada"))
        .when(r == 5, F.lit("Condicionada"))
        .when(r == 6, F.lit("En proceso"))
        .when(r == 8, F.lit("Foo"))
    )


def fixture_verdicts(bookings: DataFrame) -> DataFrame:
    """Verdict events of the fixture (FIXTURES.md): each booking's stand-in verdict
    on its reservation day, and up to three later ones whose names and ids come
    before it; on even bookings the last of them at the same time as the first."""
    k = F.col("booking_id")
    later = F.array(F.lit("En proceso"), F.lit("Condicionada"), F.lit("Aprobada"))
    events = bookings.select("booking_id", "fecha_reserva", F.posexplode(
        F.concat(F.array(verdict_of(k)), F.slice(later, F.lit(1), F.when(verdict_of(k).isNull(), 0).otherwise(k % 4).cast("int"))))
        .alias("n", "dictamen"))
    day = F.date_add("fecha_reserva", F.when((F.col("n") == 3) & (k % 2 == 0), 0).otherwise(F.col("n")))
    return events.select("booking_id", "dictamen", day.cast("timestamp").alias("event_time"),
                         F.when(F.col("n") == 0, 0).otherwise(9 - F.col("n")).cast("bigint").alias("event_id"))


def fixture_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments of the fixture (FIXTURES.md): one for each line of an order, several
    on one day, some without amount or day."""
    l = _table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    day = F.date_add(F.col("l_shipdate").cast("date"), ((F.col("l_orderkey") + n) % 3).cast("int"))
    return l.select(
        F.col("l_orderkey").alias("booking_id"), n.cast("bigint").alias("payment_id"),
        F.when(n != 6, day.cast("timestamp")).alias("paid_on"),
        F.when(F.col("l_quantity") > 2, F.col("l_extendedprice") * F.col("l_discount")).alias("amount"))


def fixture_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User-given periods of the fixture (FIXTURES.md): one for each nation,
    overlapping, of 0 to 408 days; one is empty (it ends before it begins)."""
    n = F.col("n_nationkey")
    lo = F.date_add(F.lit("1999-01-01").cast("date"), (n * 31).cast("int"))
    return _table(spark, sf_dir, "nation").select(
        F.lit("campaign").alias("period_kind"), F.col("n_name").alias("period_key"), lo.alias("lo"),
        F.date_add(lo, (n * 17).cast("int") - 1).alias("hi"))
