"""Declared schemas of the two input tables and their standard form.

The reference has no DDL; types are inferred from use (survey 1.2, 1.3).
``standardize_*`` casts every event column to DATE (Q22: a timestamp compared
with a date string loses the rest of the last day) and adds ``stock_key``, the
car key as BIGINT via ``try_cast`` (Q10: a bad key drops out of inner joins
instead of failing the query under ANSI mode).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cierre.functions import buckets as B


@dataclass(frozen=True)
class Labels:
    """What the booking table calls the payment methods and the captive lender;
    the reports use the names of ``functions.buckets``."""

    financing: str = B.FINANCING
    cash: str = B.CASH
    financing_captive: str = B.FINANCING_CAPTIVE
    captive_provider: str = B.CAPTIVE_PROVIDER

    def method(self, c: Column) -> Column:
        """The table's method under the reports' name. Of another method that happens
        to have one of those names a report must not count it: it is marked as other."""
        names = {self.financing: B.FINANCING, self.cash: B.CASH, self.financing_captive: B.FINANCING_CAPTIVE}
        out = F.when(c.isNull(), F.lit(None).cast("string"))
        for own, name in names.items():
            out = out.when(c == own, F.lit(name))
        return out.when(c.isin(B.KPI_METHODS), F.concat(F.lit("other: "), c)).otherwise(c)

    def provider(self, c: Column) -> Column:
        return F.when(c == self.captive_provider, F.lit(B.CAPTIVE_PROVIDER)).when(
            c == B.CAPTIVE_PROVIDER, F.concat(F.lit("other: "), c)).otherwise(c)


BOOKING_DATE_COLUMNS = [
    "fecha_reserva",
    "fecha_origen",
    "fecha_handoff",
    "fecha_aprobacion",
    "fecha_venta_declarada",
    "fecha_cancelacion_reserva",
    "fecha_entrega",
    "devolucion_date",
]

BOOKINGS_SCHEMA = T.StructType(
    [
        T.StructField("booking_id", T.LongType()),
        T.StructField("stock", T.StringType()),
        T.StructField("b2b", T.IntegerType()),
        T.StructField("estimate_flag", T.IntegerType()),
        T.StructField("trade_in", T.IntegerType()),
        T.StructField("metodo_de_pago", T.StringType()),
        T.StructField("financing_provider", T.StringType()),
        T.StructField("perfil", T.StringType()),
        T.StructField("reservation_hub_name", T.StringType()),
    ]
    + [T.StructField(c, T.DateType()) for c in BOOKING_DATE_COLUMNS]
)

INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField("bk_stock", T.LongType()),
        T.StructField("inv_date", T.DateType()),
        T.StructField("item_receipt_date", T.DateType()),
        T.StructField("real_published_price", T.DoubleType()),
        T.StructField("flag_coming_soon", T.IntegerType()),
        T.StructField("pix_financing", T.DecimalType(6, 2)),
        T.StructField("pix_cash", T.DecimalType(6, 2)),
        T.StructField("stock_region", T.StringType()),
    ]
)


def standardize_bookings(df: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """Declared types, DATE event columns, ``stock_key`` (P20), and the reports'
    names of methods and provider."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in BOOKINGS_SCHEMA.fields]
    out = df.select(*cols)
    if labels != Labels():
        out = out.withColumn("metodo_de_pago", labels.method(F.col("metodo_de_pago"))).withColumn(
            "financing_provider", labels.provider(F.col("financing_provider")))
    return out.withColumn("stock_key", F.col("stock").try_cast("bigint"))


def standardize_inventory(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in INVENTORY_SCHEMA.fields])


def read_bookings(spark: SparkSession, path: str, labels: Labels = Labels()) -> DataFrame:
    """Scan a stored bookings table (Parquet) with the declared schema."""
    return standardize_bookings(spark.read.parquet(path), labels)


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Scan stored inventory snapshots (Parquet)."""
    return standardize_inventory(spark.read.parquet(path))
