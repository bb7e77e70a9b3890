"""Tax report marts: one row per transaction, then day, month and year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyspark.functions import rules
from tallyspark.functions.money import money, money_or_zero, total, total_or_zero
from tallyspark.operators.aggregate import roll_up
from tallyspark.plans.sales import children_of, dealt, is_sale
from tallyspark.schema import TAX_MEASURES, TAX_RAW
from tallyspark.sources.tables import Source

TAX_DIMENSIONS = {"merchant_id": "merchant_id", "outlet_id": "outlet_id", "base_type": "base_type"}


def taxable() -> Column:
    """Transactions with a receipt and no refund; the test is part of the window, not of the active filter."""
    return (F.col("refund") == 0) & F.col("receipt_no").isNotNull()


def line_taxes(details: DataFrame, extends: DataFrame, whole: bool = True) -> DataFrame:
    """Line taxes per transaction, and whether any line carries an extension.

    Extensions are counted per line first. A line counts once per extension, as it does in a plain left join, but no
    joined row is ever repeated. Extensions that name their transaction are dealt by it together with the lines.
    """
    times = F.greatest(F.coalesce(F.col("extends"), F.lit(0)), F.lit(1))
    if "transaction_id" in extends.columns:
        key, taxes = ("transaction_id", "detail_id"), ("total_product_tax", "product_tax")
        counted = F.col("id").isNotNull().cast("int")
        lines = dealt(details.select(*key, F.lit(1).alias("lines"), F.lit(None).alias("extends"), *taxes),
                      extends.select(*key, F.lit(0).alias("lines"), counted.alias("extends"), *(F.lit(None).alias(t) for t in taxes)),
                      whole).groupBy(*key).agg(
            F.sum("lines").alias("lines"), F.when(F.col("detail_id").isNotNull(), F.sum("extends")).alias("extends"),
            *(F.sum(t).alias(t) for t in taxes)).filter("lines > 0")
        return _taxes(lines, times)
    per_line = extends.groupBy("detail_id").agg(F.count("id").alias("extends"))
    return _taxes(details.join(per_line, "detail_id", "left"), times)


def _taxes(lines: DataFrame, times: Column) -> DataFrame:
    return lines.groupBy("transaction_id").agg(
        F.max(F.col("extends") > 0).alias("extended"),
        total(F.col("total_product_tax") * times).alias("line_tax"),
        total_or_zero(F.col("product_tax") * times).alias("tax_product"),
    )


def tax_raw(source: Source, transactions: DataFrame | None = None) -> DataFrame:
    """The raw mart. Line taxes replace the tax of the receipt as soon as one line is extended."""
    chosen = source.transactions if transactions is None else transactions
    chosen = chosen.filter(is_sale() & rules.is_active() & taxable())
    children = children_of(source, None if transactions is None else chosen)
    taxes = line_taxes(children.details, children.detail_extends, transactions is None)
    joined = chosen.join(taxes, chosen.id == taxes.transaction_id, "left")
    return TAX_RAW.conform(joined.select(
        F.col("id").alias("id_transaction"), "merchant_id", "outlet_id", F.col("sold_at").alias("datetime"),
        F.to_date("sold_at").alias("date"), F.col("receipt_no").alias("no_nota"),
        money("total").alias("transaction_value"), rules.tax_base_type().alias("base_type"),
        F.when(F.col("extended"), F.col("line_tax")).otherwise(money("tax_nominal")).alias("tax_value"),
        money_or_zero("tax_product").alias("tax_product"),
    ))


def contributions(raw: DataFrame) -> DataFrame:
    """What each raw row adds to its day."""
    return raw.select("merchant_id", "outlet_id", "base_type", "date", *TAX_MEASURES)


def tax_daily(raw: DataFrame) -> DataFrame:
    return roll_up(raw, {**TAX_DIMENSIONS, "date": "date"}, TAX_MEASURES)


def tax_monthly(daily: DataFrame) -> DataFrame:
    return roll_up(daily, {**TAX_DIMENSIONS, "year": F.year("date"), "month": F.month("date")}, TAX_MEASURES)


def tax_yearly(monthly: DataFrame) -> DataFrame:
    return roll_up(monthly, {**TAX_DIMENSIONS, "year": "year"}, TAX_MEASURES)
