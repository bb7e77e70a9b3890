"""Free-of-charge promotions: one row per complimented transaction."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tallyspark.functions import rules
from tallyspark.functions.money import money
from tallyspark.operators.aggregate import surrogate_key
from tallyspark.plans.sales import children_of
from tallyspark.schema import COMPLIMENT_RAW
from tallyspark.sources.tables import Source


def complimentable() -> Column:
    """Counter sales that somebody authorised and a cashier closed."""
    return (
        rules.has_status() & rules.has_purpose([rules.COMPLIMENT_PURPOSE]) & rules.sane_sale_time()
        & F.col("auth_id").isNotNull() & F.col("cashier_id").isNotNull()
    )


def changed_compliments(source: Source, start: datetime | None = None, end: datetime | None = None, *,
                        merchants: Sequence[int] | int | None = None, outlet: int | None = None) -> DataFrame:
    """Candidate transactions of a window; increments and recoveries both go by the change time."""
    return source.transactions.filter(
        rules.within("updated_at", start, end) & complimentable() & rules.merchant_scope(merchants, outlet))


def compliment_raw(source: Source, transactions: DataFrame | None = None, *, random_key: bool = False) -> DataFrame:
    chosen = (changed_compliments(source) if transactions is None else transactions)
    chosen = chosen.filter(rules.is_active() & complimentable())
    promos = children_of(source, None if transactions is None else chosen).promos
    # Several promotions of the category on one transaction: the smallest value, so that a rerun gives the same row.
    granted = (promos.filter(F.col("category_id") == rules.COMPLIMENT_PROMO_CATEGORY)
               .groupBy("transaction_id").agg(F.min("value").alias("value")))
    joined = chosen.join(granted, chosen.id == granted.transaction_id).select(
        surrogate_key(["id"], random_key).alias("no"), F.col("id").alias("transaction_id"), "merchant_id", "outlet_id",
        F.col("receipt_no").alias("no_nota"), F.col("sold_at").alias("datetime"), F.to_date("sold_at").alias("date"),
        "cashier_id", F.col("item_count").alias("product_qty"), "auth_id", money("value").alias("value"), "note",
    )
    return COMPLIMENT_RAW.conform(joined).fillna(0)
