"""Service utilization per employee, and reservations by status class."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyspark.functions import rules
from tallyspark.functions.money import money, total
from tallyspark.functions.times import minutes_between
from tallyspark.operators.aggregate import surrogate_key
from tallyspark.operators.keys import having_keys
from tallyspark.schema import SUMMARY_DAILY, SUMMARY_RAW, UTILIZATION_DAILY, UTILIZATION_RAW
from tallyspark.sources.tables import Source

def _reservation_status():
    """Status codes arrive as text or number; they are compared as numbers."""
    return F.col("status").try_cast("int")


def utilization_raw(source: Source, reservations: DataFrame | None = None) -> DataFrame:
    """One row per main service of a utilized reservation."""
    chosen = source.reservations if reservations is None else reservations
    chosen = chosen.filter(_reservation_status().isin(*rules.UTILIZED_STATUSES))
    services = source.services.filter(F.col("is_parent") == 1)
    if reservations is not None:
        services = having_keys(services, chosen.select(F.col("id").alias("reservation_id")), ["reservation_id"])
    lines = services.select(
        F.col("id").alias("id_reservation_detail"), F.col("reservation_id").alias("id_reservation"), "product_id",
        F.col("service_date").alias("date"), "start_time", "end_time",
        minutes_between("start_time", "end_time").alias("duration"), "employee_id",
        money("total_price").alias("price"))
    heads = chosen.select(F.col("id").alias("id_reservation"), "merchant_id", "outlet_id", "customer_id")
    return UTILIZATION_RAW.conform(heads.join(lines, "id_reservation")).fillna(0)


def utilization_contributions(raw: DataFrame) -> DataFrame:
    """What each raw row adds to its employee's day; services without a date belong to no day."""
    return raw.filter(F.col("date").isNotNull()).select(
        "merchant_id", "outlet_id", "employee_id", "date", F.col("duration").cast("bigint").alias("duration"), "price")


def utilization_daily(raw: DataFrame, *, random_key: bool = False) -> DataFrame:
    """Minutes and revenue per employee and day; services without a date belong to no day."""
    grouped = raw.filter(F.col("date").isNotNull()).groupBy(*UTILIZATION_DAILY.key).agg(
        F.sum("duration").alias("duration"), total("price").alias("price"))
    return UTILIZATION_DAILY.conform(grouped.withColumn("no", surrogate_key(UTILIZATION_DAILY.key, random_key)))


def summary_raw(source: Source, reservations: DataFrame | None = None, *, random_key: bool = False) -> DataFrame:
    """Reservations with their status class, except those that are not reported."""
    chosen = source.reservations if reservations is None else reservations
    reported = chosen.filter(_reservation_status() != rules.UNREPORTED_STATUS)
    return SUMMARY_RAW.conform(reported.select(
        surrogate_key(["id"], random_key).alias("no"), F.col("id").alias("id_reservation"), "merchant_id", "outlet_id",
        F.col("reserved_on").alias("date"), rules.reservation_class("status").alias("status"), "type",
    )).fillna(0)


def summary_contributions(raw: DataFrame) -> DataFrame:
    """What each raw row adds to its day and status class."""
    counted = F.when(F.col("status").isNotNull(), 1).otherwise(0).cast("bigint")
    return raw.select(*SUMMARY_DAILY.key, counted.alias("total"))


def summary_daily(raw: DataFrame, *, random_key: bool = False) -> DataFrame:
    grouped = raw.groupBy(*SUMMARY_DAILY.key).agg(F.count("status").alias("total"))
    return SUMMARY_DAILY.conform(grouped.withColumn("no", surrogate_key(SUMMARY_DAILY.key, random_key)))
