"""Close rate ("STR") by dimension: R1-R8, plus the W2/W3/O4/O5 forms.

One pass: closed rows are enriched once with every requested dimension and
counted by their labels, then one ``explode`` per count emits its (dimension, method, period) memberships and
one partial+final aggregate counts sales and cancels for all of them. The
report is that small aggregate left-joined onto a dense scaffold of
(dimension value x method x period), so absent combinations still show
(Q7: STR null, Mix 0.0 when the period has rows).

Definitions (survey 1.5): a row can be both sale and cancel and counts in
both, in the period of its close date COALESCE(sale, cancel).
Method ``all`` = Financing + Cash payment + null method; other methods count
nowhere (Q5). The country row ``MX`` has no region filter (Q6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cierre.functions import buckets as B
from cierre.functions.rates import delta_pp, rate
from cierre.params import Params
from cierre.plans import enrich as E
from cierre.plans.periods import monthly_tags_sql, weekly_tags_sql, with_periods
from cierre.plans.pruning import WORDS, key_filter, maybe_in
from cierre.session import cut_lineage
from cierre.sources.datasets import first_payments

DIMS = ["region", "aging", "price", "coming_soon", "pix", "stock_region"]
# Reports with a fixed dim list (and no mix); the others show observed dims.
FIXED_DIMS = {"region", "stock_region"}
MIX_DIMS = {"aging", "price", "coming_soon", "pix", "payment"}


def data_window_start(p: Params, grains: list[str]):
    starts = []
    if "week" in grains:
        starts += [p.weeks_start, p.lwtd_start]
    if "month" in grains:
        starts.append(p.months_start)
    return min(starts)


#: What a report reads of the reservation day's snapshot.
SNAPSHOT_COLUMNS = {"price": ["real_published_price"], "coming_soon": ["flag_coming_soon"], "pix": ["pix_financing", "pix_cash"]}


def closed_columns(bookings: DataFrame, p: Params, grains: list[str]) -> DataFrame:
    """The closed rows of the data window, with what dimensions are made of."""
    lo = data_window_start(p, grains)
    return bookings.filter(F.expr(E.closed_where(lo, p.yesterday))).selectExpr(
        "booking_id", "stock_key", "fecha_reserva", "metodo_de_pago", f"{B.region_sql('reservation_hub_name')} AS region",
        "coalesce(fecha_venta_declarada, fecha_cancelacion_reserva) AS close_date",
        "CAST(fecha_venta_declarada IS NOT NULL AS INT) AS venta",
        "CAST(fecha_cancelacion_reserva IS NOT NULL AND estimate_flag = 1 AS INT) AS cancel")


def _pruned(closed: DataFrame, snaps: DataFrame, whole_history: bool, words: int) -> DataFrame:
    """Snapshots of cars that the closed rows may hold and, unless a car's whole
    history counts, of the days they may ask."""
    if not whole_history:
        lo, hi = closed.agg(F.min("fecha_reserva"), F.max("fecha_reserva")).first()  # one row
        snaps = snaps.filter(F.col("inv_date").between(F.lit(lo), F.lit(hi)))
    return maybe_in(snaps, "bk_stock", key_filter(closed.select("stock_key"), words), words)


def enrich_dims(bookings: DataFrame, inventory: DataFrame, p: Params, dims: list[str], grains: list[str],
                payments: DataFrame | None = None, prune: bool = False, stored_by_car: bool = False,
                words: int = WORDS) -> DataFrame:
    """Closed rows of the data window with one ``dim_<name>`` column per
    requested dimension; a null value means "not in this dimension" (what
    the reference's inner joins and ``HAVING ... IS NOT NULL`` drop).

    Bookings and snapshots are read once each. One left join that cannot fan out:
    to a row per car and day where only the reservation day counts (J2), to a row
    per car with its first receipt (J1), or to a row per car with its whole
    history (W1, J3), which also serves snapshots stored by car
    (``stored_by_car``): those are joined where they lie.

    ``prune``: the closed rows are written to the checkpoint folder first, and a
    Bloom filter of their cars and the range of their days cut the snapshots at the
    scan. For snapshot tables much larger than the cars that closed.

    ``payments`` (``sources.datasets.PAYMENT_SCHEMA``) is needed by the dimension
    ``payment`` only.
    """
    closed = closed_columns(bookings, p, grains)
    if prune:
        closed = cut_lineage(closed)
    frames, joins = {"b": closed}, []
    columns = [c for d in dims for c in SNAPSHOT_COLUMNS.get(d, [])]
    with_history = bool(columns) and (stored_by_car or bool({"aging", "stock_region"} & set(dims)))
    today, region = "car", "CAST(NULL AS STRING)"
    if columns or {"aging", "stock_region"} & set(dims):
        snaps = E.snapshots_before(inventory, p.as_of)
        if prune:
            snaps = _pruned(closed, snaps, bool({"aging", "stock_region"} & set(dims)), words)
        on = f"car.bk_stock = {E.spread_key('b')} AND b.stock_key IS NOT NULL"
        if with_history:
            frames["car"] = E.car_history(snaps, columns)
            today = "try_element_at(car.days, b.fecha_reserva)"
            region = f"coalesce({today}.region, try_element_at(car.days, date_sub(b.fecha_reserva, 1)).region, car.latest_region)"
        elif columns:
            frames["car"] = E.day_facts(snaps, columns)
            on = f"{on} AND car.inv_date = b.fecha_reserva"
        elif "stock_region" in dims:
            frames["car"] = E.car_regions(snaps)
            recent = "filter(car.listed, x -> x.inv_date BETWEEN date_sub(b.fecha_reserva, 1) AND b.fecha_reserva)"
            region = f"coalesce(array_max({recent}).stock_region, array_max(car.listed).stock_region)"
        else:
            frames["car"] = snaps.groupBy("bk_stock").agg(F.min("item_receipt_date").alias("item_receipt_date"))
        joins.append(f"LEFT JOIN {{car}} car ON {on}")
    if "payment" in dims:
        frames["paid"] = first_payments(payments)
        joins.append("LEFT JOIN {paid} paid ON paid.booking_id = b.booking_id")
    snap = f"{today}.snap"
    pix = (f"{snap}.pix_financing", f"{snap}.pix_cash")
    value = {
        "region": "b.region",
        "aging": f"CASE WHEN car.item_receipt_date IS NOT NULL THEN {B.aging_sql('car.item_receipt_date', 'b.fecha_reserva')} END",
        "price": f"CASE WHEN {snap}.real_published_price IS NOT NULL THEN {B.price_sql(f'{snap}.real_published_price')} END",
        "coming_soon": f"CASE WHEN {snap} IS NOT NULL THEN {B.coming_soon_sql(f'{snap}.flag_coming_soon')} END",
        "pix": f"CASE WHEN {pix[0]} IS NOT NULL OR {pix[1]} IS NOT NULL THEN {B.pix_sql('b.metodo_de_pago', *pix)} END",
        "stock_region": B.stock_region_sql(region),
        "payment": B.payment_sql("paid.amount"),
    }
    cols = ["b.metodo_de_pago", "b.close_date", "b.venta", "b.cancel", *(f"{value[d]} AS dim_{d}" for d in dims)]
    return bookings.sparkSession.sql(f"SELECT {', '.join(cols)} FROM {{b}} b {' '.join(joins)}", **frames)


def dim_counts(enriched: DataFrame, p: Params, dims: list[str], grains: list[str], gather: bool = False) -> DataFrame:
    """The single aggregate behind every dim report, already dense:
    ``(dim_name, dim, method, period_kind, period) -> ventas, cancelaciones,
    _present`` for every candidate cell.

    Each closed row explodes into its (dimension, method, period)
    memberships; ``dim_name = 'country'`` (dim ``MX``) holds every closed row,
    and its weeks are the observed weeks of all reports. Method ``~other``
    rows are kept so that observed weeks and buckets include them, as in the
    reference. The literal scaffold of candidate cells (labels x methods x
    calendar periods, ``_present = 0``) is unioned into the same aggregate,
    so absent cells exist without a join or a second aggregation.

    Rows are first counted by (method, dimension labels, close date), which is
    bounded by labels x days at any data size; only those counts explode.
    ``gather``: the exploded counts move to one partition, where this aggregate and
    those after it need no further shuffle; for a single dimension, whose counts
    are a few thousand rows.
    """
    def pair(name, value_sql):
        return f"CASE WHEN {value_sql} IS NOT NULL THEN named_struct('dim_name', '{name}', 'dim', {value_sql}) END"

    pairs = ", ".join([pair("country", f"'{B.COUNTRY_DIM}'")] + [pair(d, f"dim_{d}") for d in dims])
    labels = "".join(f", dim_{d}" for d in dims)
    items = (weekly_tags_sql("close_date", p) if "week" in grains else []) + (
        monthly_tags_sql("close_date", p) if "month" in grains else [])
    spark = enriched.sparkSession
    memberships = spark.sql(f"""
      SELECT x.dim_name, x.dim, m AS method, t.period_kind, t.period, venta, cancel, 1 AS _present
      FROM (SELECT metodo_de_pago, close_date{labels}, SUM(venta) AS venta, SUM(cancel) AS cancel
            FROM {{enriched}} GROUP BY metodo_de_pago, close_date{labels})
      LATERAL VIEW explode(array_compact(array({pairs}))) xs AS x
      LATERAL VIEW explode({B.method_fold_sql("metodo_de_pago")}) ms AS m
      LATERAL VIEW explode(array_compact(array({", ".join(items)}))) ts AS t
      UNION ALL
      SELECT dim_name, dim, method, period_kind, period, 0, 0, 0
      FROM ({_scaffold_sql(p, dims, grains)})""", enriched=enriched)
    return (memberships.repartition(1) if gather else memberships).groupBy("dim_name", "dim", "method", "period_kind", "period").agg(
        F.sum("venta").cast("bigint").alias("ventas"), F.sum("cancel").cast("bigint").alias("cancelaciones"),
        F.max("_present").alias("_present"))


def calendar_periods(p: Params, grain: str) -> list[tuple[str, object]]:
    """Candidate periods of a report, known from the parameters alone:
    every Monday from the week of ``weeks_start`` up to last week, plus WTD
    and LWTD; or the four calendar months."""
    from datetime import timedelta

    from cierre.params import monday_of

    if grain == "month":
        return [("month", m) for m in p.month_starts]
    out, w = [], monday_of(p.weeks_start)
    while w < p.wtd_start:
        out.append(("week", w))
        w += timedelta(days=7)
    return out + [("wtd", p.wtd_start), ("lwtd", p.lwtd_start)]


def _scaffold_sql(p: Params, dims: list[str], grains: list[str]) -> str:
    """SQL of every candidate cell (label x method x calendar period): three
    explodes of small literal arrays over one row, planned in the JVM."""
    labels = [("country", B.COUNTRY_DIM)] + [
        (dim, x) for dim in dims for x in B.DIM_LABELS[dim] if x != B.COUNTRY_DIM
    ]
    lab = ", ".join(f"named_struct('dim_name', {B.q(n)}, 'dim', {B.q(d)})" for n, d in labels)
    met = ", ".join(B.q(m) for m in B.METHOD_TARGETS + ["~other"])
    per = ", ".join(
        f"named_struct('period_kind', '{k}', 'period', DATE'{v.isoformat()}')"
        for g in grains for k, v in calendar_periods(p, g)
    )
    return (
        "SELECT l.dim_name, l.dim, m AS method, pp.period_kind, pp.period FROM (SELECT 1) one "
        f"LATERAL VIEW explode(array({lab})) ls AS l "
        f"LATERAL VIEW explode(array({met})) ms AS m "
        f"LATERAL VIEW explode(array({per})) ps AS pp"
    )


def dim_report(counts: DataFrame, p: Params, dim: str, grain: str = "week", gathered: bool = False) -> DataFrame:
    """R1-R7 in long form: ``method, dim, period_kind, period, ventas,
    cancelaciones, str, mix``.

    Weekly periods: every observed closed week (``week``), ``wtd`` (period =
    Monday of this week) and ``lwtd`` (Monday of last week). Monthly: the four
    calendar months (``month``). ``mix`` is null for region reports.

    Reads the dense ``counts`` once. The report's slice of it is bounded by
    labels x methods x calendar periods (a few hundred rows at any data
    size), so it moves to one partition with a single tiny shuffle and the
    three window flags (observed week, observed bucket, period total for the
    mix) run there without further shuffles.
    """
    fixed = dim in FIXED_DIMS
    kinds = ["week", "wtd", "lwtd"] if grain == "week" else ["month"]
    seen_kinds = ["week", "wtd"] if grain == "week" else ["month"]
    grid = counts.filter(F.col("dim_name").isin("country", dim) & F.col("period_kind").isin(kinds))
    if not gathered:
        grid = grid.repartition(1)
    kinds_sql = ", ".join(f"'{k}'" for k in seen_kinds)
    dim_filter = "TRUE" if fixed else f"dim_name = '{dim}' AND _seen = 1"
    closed = "(ventas + cancelaciones)"
    mix = (
        f"CASE WHEN _total > 0 THEN CAST(FLOOR(({closed} * 2000 + _total) / (_total * 2)) AS DOUBLE) / 10 END"
        if dim in MIX_DIMS else "CAST(NULL AS DOUBLE)"
    )
    sql = f"""
    SELECT method, dim, period_kind, period, ventas, cancelaciones,
           CASE WHEN {closed} > 0 THEN CAST(FLOOR((ventas * 2000 + {closed}) / ({closed} * 2)) AS DOUBLE) / 10 END AS str,
           {mix} AS mix
    FROM (
      SELECT *, SUM(CASE WHEN {dim_filter} THEN {closed} END)
                  OVER (PARTITION BY method, period_kind, period) AS _total
      FROM (
        SELECT *,
          MAX(CASE WHEN _present = 1 AND period_kind IN ({kinds_sql}) THEN 1 END)
            OVER (PARTITION BY dim_name, dim) AS _seen,
          MAX(CASE WHEN _present = 1 AND dim_name = 'country' THEN 1 END)
            OVER (PARTITION BY period_kind, period) AS _observed
        FROM {{grid}}
      )
      WHERE method <> '~other' AND (period_kind <> 'week' OR _observed = 1)
    )
    WHERE {dim_filter}
    """
    return counts.sparkSession.sql(sql, grid=grid)


def report(bookings: DataFrame, inventory: DataFrame, p: Params, dims: list[str] = DIMS,
           grains: list[str] = ("week", "month"), **how) -> DataFrame:
    """All dimension reports (R1-R7) of one ``as_of`` as one long DataFrame:
    ``report, grain, method, dim, period_kind, period, ventas,
    cancelaciones, str, mix``.

    One enrichment (``how``: as ``enrich_dims``), one aggregate and one pass of
    window flags for every (dimension, grain): the dense grid of all reports
    together is still bounded by labels x methods x calendar periods, so it
    moves to a single partition and the flags need no further shuffles. The
    country rows (``MX``) feed the two fixed-list reports.
    """
    grains = list(grains)
    counts = dim_counts(enrich_dims(bookings, inventory, p, dims, grains, **how), p, dims, grains, gather=len(dims) == 1)
    grid = counts.repartition(1)
    fixed = [d for d in dims if d in FIXED_DIMS]
    mixed = ", ".join(f"'{d}'" for d in dims if d in MIX_DIMS) or "''"
    country_reports = "array(" + ", ".join(f"'{d}'" for d in fixed) + ")" if fixed else "array()"
    closed = "(ventas + cancelaciones)"
    sql = f"""
    SELECT report, grain, method, dim, period_kind, period, ventas, cancelaciones,
           CASE WHEN {closed} > 0 THEN CAST(FLOOR((ventas * 2000 + {closed}) / ({closed} * 2)) AS DOUBLE) / 10 END AS str,
           CASE WHEN report IN ({mixed}) AND _total > 0
                THEN CAST(FLOOR(({closed} * 2000 + _total) / (_total * 2)) AS DOUBLE) / 10 END AS mix
    FROM (
      SELECT *, SUM({closed}) OVER (PARTITION BY report, method, period_kind, period) AS _total
      FROM (
        SELECT g.*, r AS report
        FROM (
          SELECT *,
            CASE WHEN period_kind = 'month' THEN 'month' ELSE 'week' END AS grain,
            MAX(CASE WHEN _present = 1 AND period_kind IN ('week', 'wtd', 'month') THEN 1 END)
              OVER (PARTITION BY dim_name, dim, CASE WHEN period_kind = 'month' THEN 1 ELSE 0 END) AS _seen,
            MAX(CASE WHEN _present = 1 AND dim_name = 'country' THEN 1 END)
              OVER (PARTITION BY period_kind, period) AS _observed
          FROM {{grid}}
        ) g
        LATERAL VIEW explode(CASE WHEN dim_name = 'country' THEN {country_reports} ELSE array(dim_name) END) rs AS r
        WHERE method <> '~other' AND (period_kind <> 'week' OR _observed = 1)
          AND (r IN ({", ".join(f"'{d}'" for d in fixed) or "''"}) OR _seen = 1)
      )
    )
    """
    return bookings.sparkSession.sql(sql, grid=grid)


def dim_reports(bookings: DataFrame, inventory: DataFrame, p: Params, dims: list[str] = DIMS,
                grains: list[str] = ("week", "month")) -> dict[tuple[str, str], DataFrame]:
    """Every (dim, grain) report from one enrichment and one aggregate."""
    grains = list(grains)
    counts = dim_counts(enrich_dims(bookings, inventory, p, dims, grains), p, dims, grains)
    return {(d, g): dim_report(counts, p, d, g) for d in dims for g in grains}


def str_report(bookings: DataFrame, inventory: DataFrame, p: Params, dim: str, grain: str = "week", **how) -> DataFrame:
    """One report (only the join its dimension needs); ``how`` as ``enrich_dims``."""
    dims = [dim]
    counts = dim_counts(enrich_dims(bookings, inventory, p, dims, [grain], **how), p, dims, [grain], gather=True)
    return dim_report(counts, p, dim, grain, gathered=True)


# ---------------------------------------------------------------------------
# Derived forms
# ---------------------------------------------------------------------------
def last_two(report: DataFrame, kind: str, keys: tuple[str, ...] = ("method", "dim")) -> DataFrame:
    """STR of the last two periods of ``kind`` per ``keys``.

    The scaffold gives every (method, dim) every period, so "last two" are
    the last two observed closed weeks (or calendar months) for all rows.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("period").desc())
    r = report.filter(F.col("period_kind") == kind).withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
    return r.groupBy(*keys).agg(
        F.max(F.when(F.col("_rn") == 1, F.col("period"))).alias("last_period"),
        F.max(F.when(F.col("_rn") == 2, F.col("period"))).alias("prev_period"),
        F.max(F.when(F.col("_rn") == 1, F.col("str"))).alias("str_last"),
        F.max(F.when(F.col("_rn") == 2, F.col("str"))).alias("str_prev"),
    ).withColumn("delta", delta_pp("str_last", "str_prev"))


def _ranked_weeks(report: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """A weekly report with ``_rn``: 1 for the last closed week, 2 for the one before."""
    w = Window.partitionBy(*keys, "period_kind").orderBy(F.col("period").desc())
    return report.withColumn("_rn", F.when(F.col("period_kind") == "week", F.row_number().over(w)))


def _delta_aggs() -> list:
    of = lambda cond: F.max(F.when(cond, F.col("str")))
    return [of(F.col("_rn") == 1).alias("_last"), of(F.col("_rn") == 2).alias("_prev"),
            of(F.col("period_kind") == "wtd").alias("wtd"), of(F.col("period_kind") == "lwtd").alias("lwtd")]


def str_deltas(report: DataFrame, keys: tuple[str, ...] = ("method", "dim")) -> DataFrame:
    """Per (method, dim) of a weekly report: ``wow_delta`` (last two
    closed weeks), ``wtd``, ``lwtd`` and ``delta`` = wtd - lwtd (Q2: deltas
    of the rounded rates), in one aggregate."""
    wide = _ranked_weeks(report, keys).groupBy(*keys).agg(*_delta_aggs())
    return wide.select(*keys, delta_pp("_last", "_prev").alias("wow_delta"), "wtd", "lwtd", delta_pp("wtd", "lwtd").alias("delta"))


def all_deltas(reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """R8 for every dimension of the long ``report``: weekly deltas, and
    month-over-month ones (W3)."""
    keys = ("report", "method", "dim")
    return (str_deltas(reports.filter("grain = 'week'"), keys), last_two(reports.filter("grain = 'month'"), "month", keys))


def mix_rows(report: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The interleaved ``dim — STR`` / ``dim — Mix%`` rows, as an unpivot
    of (str, mix) with a ``metric`` column."""
    u = report.unpivot(
        [*keys, "method", "dim", "period_kind", "period"], ["str", "mix"], "metric", "value"
    )
    metric = F.when(F.col("metric") == "str", F.lit("STR")).otherwise(F.lit("Mix%"))
    return u.select(
        *keys,
        "method",
        "dim",
        metric.alias("metric"),
        F.concat(F.col("dim"), F.lit(" — "), metric).alias("row_label"),
        "period_kind",
        "period",
        "value",
    )


def pivot_weeks(report: DataFrame, p: Params) -> DataFrame:
    """Periods to columns, one row per (method, dim), with the deltas.

    The columns are the calendar's closed weeks (``yyyy-MM-dd`` of their Monday,
    whatever day ``weeks_start`` is), ``wtd`` and ``lwtd``; a week without data
    is an all-null column. One aggregate, with no job to find the values.
    """
    keys = ("method", "dim")
    weeks = [F.max(F.when((F.col("period_kind") == "week") & (F.col("period") == F.lit(w)), F.col("str"))).alias(w.isoformat())
             for k, w in calendar_periods(p, "week") if k == "week"]
    wide = _ranked_weeks(report, keys).groupBy(*keys).agg(*weeks, *_delta_aggs())
    return wide.withColumn("wow_delta", delta_pp("_last", "_prev")).withColumn("delta", delta_pp("wtd", "lwtd")).drop("_last", "_prev")


def with_dim_order(report: DataFrame, dim: str) -> DataFrame:
    """Ordinal of each bucket in its fixed order, for sorting at the
    sink (``orderBy`` on it only where output order matters)."""
    labels = B.DIM_LABELS[dim]
    ordinal = None
    for i, label in enumerate(labels, start=1):
        c = F.col("dim") == label
        ordinal = F.when(c, F.lit(i)) if ordinal is None else ordinal.when(c, F.lit(i))
    return report.withColumn("dim_ord", ordinal)


def sorted_report(reports: DataFrame) -> DataFrame:
    """O1: the long ``report`` in the order it is shown in: report, grain, method,
    bucket (P15), period. The rows are bounded by labels x methods x periods."""
    places = F.create_map(*[x for n, labels in B.DIM_LABELS.items() for i, label in enumerate(labels)
                            for x in (F.lit(f"{n}/{label}"), F.lit(i))])
    methods = F.array_position(F.array(*map(F.lit, B.METHOD_TARGETS)), F.col("method"))
    kinds = F.array_position(F.array(*map(F.lit, ("month", "week", "wtd", "lwtd"))), F.col("period_kind"))
    return reports.orderBy(F.array_position(F.array(*map(F.lit, [*DIMS, "payment"])), F.col("report")), F.desc("grain"), methods,
                           F.try_element_at(places, F.concat_ws("/", "report", "dim")), kinds, "period")


def method_weekly(bookings: DataFrame, p: Params, grain: str = "week", fold: bool = False) -> DataFrame:
    """Country STR per period and method, observed periods only.

    Without ``fold``: per normalised method (null and Other included), the
    country query of the reference. With ``fold``: per report method
    (all / Financing / Cash payment).
    """
    lo = p.weeks_start if grain == "week" else p.months_start
    rows = E.closed_rows(bookings, lo, p.yesterday)
    bucket = F.date_trunc(grain, "close_date").cast("date").alias("period")
    if fold:
        rows = rows.select(bucket, F.explode(B.method_fold("metodo_de_pago")).alias("method"), "venta", "cancel")
        rows = rows.filter(F.col("method").isin(B.METHOD_TARGETS))
    else:
        rows = rows.select(bucket, B.method_norm().alias("method"), "venta", "cancel")
    g = rows.groupBy("period", "method").agg(
        F.sum("venta").cast("bigint").alias("ventas"), F.sum("cancel").cast("bigint").alias("cancelaciones")
    )
    return g.withColumn("str", rate(F.col("ventas"), F.col("ventas") + F.col("cancelaciones")))


def period_report(bookings: DataFrame, periods: DataFrame, p: Params) -> DataFrame:
    """Close rate by report method for any table of periods (``period_kind,
    period_key, lo, hi``), overlapping or not: closed rows are counted by day, and
    the daily counts meet the periods that hold them (``with_periods``). Periods
    reach up to ``as_of - 1``; one without closed rows has none."""
    span = periods.filter("lo <= hi").agg(F.min("lo"), F.max("hi")).first()  # one row
    lo, hi = (span[0] or p.as_of), min(span[1] or p.yesterday, p.yesterday)
    daily = E.closed_rows(bookings, lo, hi).groupBy("metodo_de_pago", "close_date").agg(
        F.sum("venta").alias("venta"), F.sum("cancel").alias("cancel"))
    rows = with_periods(daily, "close_date", periods.select("period_kind", "period_key", "lo", "hi"))
    rows = rows.select("*", F.explode(B.method_fold("metodo_de_pago")).alias("method")).filter(F.col("method").isin(B.METHOD_TARGETS))
    out = rows.groupBy("period_kind", "period_key", "method").agg(
        F.sum("venta").cast("bigint").alias("ventas"), F.sum("cancel").cast("bigint").alias("cancelaciones"))
    return out.withColumn("str", rate(F.col("ventas"), F.col("ventas") + F.col("cancelaciones")))


def payment_split(bookings: DataFrame, payments: DataFrame, p: Params, grain: str = "week") -> DataFrame:
    """Sales and cancels by period, normalised method (P1) and whether the first
    payment was one of at least ``PAYMENT_MIN`` (``sources.io.PAYMENT_DIM_SCHEMA``).
    Without any payment there is nothing to tell and no row."""
    lo = p.weeks_start if grain == "week" else p.months_start
    paid = first_payments(payments).withColumn("_any", F.lit(1))
    some = paid.agg(F.max("_any")).scalar()
    rows = E.closed_rows(bookings, lo, p.yesterday).join(paid, "booking_id", "left").filter(some.isNotNull())
    return rows.groupBy(
        F.date_trunc(grain, "close_date").cast("date").alias("semana"), B.method_norm().alias("metodo_de_pago"),
        F.expr(B.payment_sql("amount")).alias("pago_dim"),
    ).agg(F.sum("venta").cast("bigint").alias("ventas"), F.sum("cancel").cast("bigint").alias("cancelaciones"))
