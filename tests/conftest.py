from __future__ import annotations

import os
import sys
from datetime import date, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cierre.sources.schema import BOOKINGS_SCHEMA, INVENTORY_SCHEMA, standardize_bookings, standardize_inventory  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cierre.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="cierre-tests")
    yield s


BOOKING_DEFAULTS = dict(
    booking_id=1, stock="1", b2b=0, estimate_flag=1, trade_in=0, metodo_de_pago="Financing",
    financing_provider=None, perfil="A", reservation_hub_name="CDMX Centro",
    fecha_reserva=date(2001, 4, 2), fecha_origen=date(2001, 4, 2), fecha_handoff=None, fecha_aprobacion=None,
    fecha_venta_declarada=None, fecha_cancelacion_reserva=None, fecha_entrega=None, devolucion_date=None,
)


def make_bookings(spark, rows: list[dict]):
    recs = []
    for i, r in enumerate(rows):
        d = dict(BOOKING_DEFAULTS)
        d["booking_id"] = i + 1
        d["stock"] = str(i + 1)
        d.update(r)
        recs.append(tuple(d[f.name] for f in BOOKINGS_SCHEMA.fields))
    return standardize_bookings(spark.createDataFrame(recs, BOOKINGS_SCHEMA))


INVENTORY_DEFAULTS = dict(
    bk_stock=1, inv_date=date(2001, 4, 2), item_receipt_date=None, real_published_price=None,
    flag_coming_soon=None, pix_financing=None, pix_cash=None, stock_region=None,
)


def make_inventory(spark, rows: list[dict]):
    from decimal import Decimal

    recs = []
    for r in rows:
        d = dict(INVENTORY_DEFAULTS)
        d.update(r)
        for k in ("pix_financing", "pix_cash"):
            if d[k] is not None:
                d[k] = Decimal(str(d[k]))
        recs.append(tuple(d[f.name] for f in INVENTORY_SCHEMA.fields))
    return standardize_inventory(spark.createDataFrame(recs, INVENTORY_SCHEMA))


def empty_inventory(spark):
    return standardize_inventory(spark.createDataFrame([], INVENTORY_SCHEMA))


def days(d: date, n: int) -> date:
    return d + timedelta(days=n)


def rows_by(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}
