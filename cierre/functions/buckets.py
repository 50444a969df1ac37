"""Projections and bucketing (survey 2.2: P1, P2, P8-P14, P21, P24).

Each function returns a ``Column``; the fixed labels and edges below must
equal the reference's so that reports bucket identically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference; stated here together, in order).
# ---------------------------------------------------------------------------
FINANCING = "Financing"
CASH = "Cash payment"
# Neutral stand-in name of the captive financing method; it folds into FINANCING.
FINANCING_CAPTIVE = "Financing Inhouse"
# Neutral stand-in name of the captive financing provider (the "_captive" counts).
CAPTIVE_PROVIDER = "Captive"
KPI_METHODS = [FINANCING, CASH, FINANCING_CAPTIVE]
FINANCING_METHODS = [FINANCING, FINANCING_CAPTIVE]
# Method fold targets, in report order.
METHOD_TARGETS = ["all", FINANCING, CASH]

# Hub name prefix -> region (case-insensitive prefix match, first match wins).
REGION_PREFIXES = [
    ("CDMX", ["CDMX", "EDOMEX"]),
    ("GDL", ["GDL"]),
    ("QRO", ["QRO"]),
    ("MTY", ["MTY"]),
    ("PUE", ["PUE"]),
    ("CUE", ["CUE"]),
]
# Fixed dimension list of the region and stock-region reports, in report order.
REGION_DIMS = ["MX", "CDMX", "CUE", "GDL", "MTY", "PUE", "QRO"]
# Stock region (inventory) -> region code.
STOCK_REGION_CODES = [
    ("CDMX", "CDMX"),
    ("GUADALAJARA", "GDL"),
    ("MONTERREY", "MTY"),
    ("PUEBLA", "PUE"),
    ("QUERETARO", "QRO"),
    ("CUERNAVACA", "CUE"),
]
# Aging: days from first receipt to reservation.
AGING_BUCKETS = [(30, "0-30d"), (60, "30-60d"), (90, "60-90d")]
AGING_TOP = "90+d"
# Published price.
PRICE_BUCKETS = [(250000, "0-250K"), (350000, "250-350K"), (500000, "350-500K")]
PRICE_TOP = "500K+"
# Coming-soon flag.
COMING_SOON_YES = "Coming Soon"
COMING_SOON_NO = "Sin Coming Soon"
# Price index (PIX).
PIX_BUCKETS = [(0.88, "< 0.88"), (0.93, "0.88-0.93"), (0.98, "0.93-0.98")]
PIX_TOP = "≥ 0.98"
# Payment split: first payment of a booking.
PAYMENT_MIN = 1000
PAYMENT_YES = "Con Pago"
PAYMENT_NO = "Sin Pago"
# Credit profiles.
PROFILES_KNOWN = ["X", "A", "B", "C", "Z_R"]
PROFILE_REVIEW = "Revisar"
PROFILE_FUNNEL_PROFILES = ["X", "A", "B", "C"]
# Verdict categories, in chart order; anything else (and null) is "Otro".
VERDICT_CATEGORIES = [
    "Aprobada", "Incompleta", "Rechazada", "Condicionada", "En proceso", "Sin dictamen", "Otro",
]
VERDICT_OTHER = "Otro"
VERDICT_APPROVED = "Aprobada"
# Trade-in flags.
TI_WITH = "con_ti"
TI_WITHOUT = "sin_ti"
# Labels of the country rows.
COUNTRY_DIM = "MX"
COUNTRY_HUB = "__MX__"
NULL_HUB = "null"

# Ordered label lists per bucket dimension (the P15 sort order).
DIM_LABELS = {
    "region": REGION_DIMS,
    "stock_region": REGION_DIMS,
    "aging": [label for _, label in AGING_BUCKETS] + [AGING_TOP],
    "price": [label for _, label in PRICE_BUCKETS] + [PRICE_TOP],
    "coming_soon": [COMING_SOON_YES, COMING_SOON_NO],
    "pix": [label for _, label in PIX_BUCKETS] + [PIX_TOP],
    "payment": [PAYMENT_YES, PAYMENT_NO],
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def method_norm(method="metodo_de_pago") -> Column:
    """The captive financing method counts as Financing; null stays null."""
    m = _col(method)
    return F.when(m == FINANCING_CAPTIVE, F.lit(FINANCING)).otherwise(m)


def is_kpi_method(method="metodo_de_pago") -> Column:
    """One of the three listed methods (null and others drop out)."""
    return _col(method).isin(KPI_METHODS)


def is_financing(method="metodo_de_pago") -> Column:
    return _col(method).isin(FINANCING_METHODS)


def is_cash(method="metodo_de_pago") -> Column:
    return _col(method) == CASH


def method_fold(method: str = "metodo_de_pago") -> Column:
    """A10: the report methods a row counts in, as an array.

    null -> [all]; Financing (either name) -> [Financing, all];
    Cash payment -> [Cash payment, all]; any other method -> [~other], which
    no report shows but which still marks its week as observed (survey Q5).
    """
    return F.expr(method_fold_sql(f"`{method}`"))


def method_fold_sql(n: str) -> str:
    """SQL text of :func:`method_fold` for the quoted column name ``n``."""
    fin = ", ".join(q(x) for x in FINANCING_METHODS)
    return (
        f"CASE WHEN {n} IS NULL THEN array('all') "
        f"WHEN {n} IN ({fin}) THEN array({q(FINANCING)}, 'all') "
        f"WHEN {n} = {q(CASH)} THEN array({q(CASH)}, 'all') ELSE array('~other') END"
    )


def hub_label(hub="reservation_hub_name") -> Column:
    """One literal label for the null hub in every report."""
    return F.coalesce(_col(hub), F.lit(NULL_HUB))


def ti_flag(trade_in="trade_in") -> Column:
    return F.when(_col(trade_in) == 1, F.lit(TI_WITH)).otherwise(F.lit(TI_WITHOUT))


def region_sql(n: str) -> str:
    """City prefix of the hub name -> region code, else null."""
    whens = " ".join(
        "WHEN " + " OR ".join(f"{n} ILIKE {q(p + '%')}" for p in prefixes) + f" THEN {q(code)}"
        for code, prefixes in REGION_PREFIXES
    )
    return f"CASE {whens} END"


def edges_sql(value_sql: str, buckets, top: str) -> str:
    """SQL text of a bucket chain ``value < edge`` (first match), else ``top``."""
    whens = " ".join(f"WHEN {value_sql} < {edge!r} THEN {q(label)}" for edge, label in buckets)
    return f"CASE {whens} ELSE {q(top)} END"


def aging_sql(receipt: str, reservation: str) -> str:
    """P10: days from first receipt to reservation; negative -> first bucket, null -> top bucket."""
    return edges_sql(f"datediff({reservation}, {receipt})", AGING_BUCKETS, AGING_TOP)


def price_sql(price: str) -> str:
    """P11."""
    return edges_sql(price, PRICE_BUCKETS, PRICE_TOP)


def coming_soon_sql(flag: str) -> str:
    """1 -> yes; anything else, null included -> no."""
    return f"CASE WHEN {flag} = 1 THEN {q(COMING_SOON_YES)} ELSE {q(COMING_SOON_NO)} END"


def pix_sql(method: str, pix_financing: str, pix_cash: str) -> str:
    """Bucket of the price index that applies to the booking's (raw)
    method; a null index falls in the top bucket."""
    fin = ", ".join(q(m) for m in FINANCING_METHODS)
    value = (f"CASE WHEN {method} IN ({fin}) THEN {pix_financing} WHEN {method} = {q(CASH)} THEN {pix_cash} "
             f"ELSE coalesce({pix_financing}, {pix_cash}) END")
    return edges_sql(f"({value})", PIX_BUCKETS, PIX_TOP)


def payment_sql(first_amount: str) -> str:
    """A first payment of at least ``PAYMENT_MIN``; none at all is none."""
    return f"CASE WHEN {first_amount} >= {PAYMENT_MIN} THEN {q(PAYMENT_YES)} ELSE {q(PAYMENT_NO)} END"


def stock_region_sql(region: str) -> str:
    """Inventory stock region name -> region code, else null."""
    return f"CASE {region} " + " ".join(f"WHEN {q(a)} THEN {q(c)}" for a, c in STOCK_REGION_CODES) + " END"


def stock_region_code(region: str) -> Column:
    return F.expr(stock_region_sql(f"`{region}`"))


def stock_region_names() -> list[str]:
    return [name for name, _ in STOCK_REGION_CODES]


def is_profiled(perfil="perfil") -> Column:
    """A known profile (not null, not under review)."""
    p = _col(perfil)
    return p.isNotNull() & (p != PROFILE_REVIEW)


def verdict_category(dictamen="dictamen") -> Column:
    """Null or unlisted verdicts become Otro."""
    d = _col(dictamen)
    return F.when(d.isin(VERDICT_CATEGORIES), d).otherwise(F.lit(VERDICT_OTHER))
