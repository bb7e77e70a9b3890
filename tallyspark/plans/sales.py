"""Sales marts: one row per transaction, then hour, day, month and year."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyspark.functions import rules
from tallyspark.functions.money import MONEY, money, money_or_zero, total, total_or_zero, total_where
from tallyspark.operators.aggregate import roll_up
from tallyspark.operators.keys import having_keys
from tallyspark.schema import SALES_MEASURES, SALES_RAW
from tallyspark.sources.tables import Source

CLOCKS = {"etl": "updated_at", "recovery": "sold_at"}


def is_sale() -> Column:
    return rules.has_status() & rules.has_purpose() & rules.sane_sale_time()


def changed_transactions(source: Source, start: datetime | None = None, end: datetime | None = None, *,
                         mode: str = "etl", merchants: Sequence[int] | int | None = None,
                         outlet: int | None = None) -> DataFrame:
    """Sales transactions of a window, cancelled ones included.

    An increment selects on the change time, a recovery on the time of sale.
    """
    return source.transactions.filter(
        rules.within(CLOCKS[mode], start, end) & is_sale() & rules.merchant_scope(merchants, outlet))


def batch_rows(transactions: DataFrame) -> DataFrame:
    """The columns a batch is steered by: who, when, which order type, and whether the row still counts."""
    return transactions.select(
        F.col("id").alias("id_transaction"), "merchant_id", "outlet_id", rules.order_type().alias("order_type"),
        F.to_date("sold_at").alias("date"), F.hour("sold_at").alias("hour"),
        F.month("sold_at").alias("month"), F.year("sold_at").alias("year"), "updated_at", "status",
    )


def product_summary(details: DataFrame) -> DataFrame:
    return details.groupBy("transaction_id").agg(
        total_or_zero("quantity").alias("product"),
        total_or_zero(F.col("quantity") * F.col("unit_cost")).alias("hpp_product"),
        total_or_zero("total_price").alias("gross_sales"),
    )


def addon_costs(details: DataFrame, addons: DataFrame, whole: bool = True) -> DataFrame:
    """Cost of add-ons per transaction.

    Add-ons are summed per line first, so the join to the lines is one to one whatever a line carries. Add-ons that name their
    transaction are dealt by it together with the lines, and no row travels twice.
    """
    cost = F.col("quantity") * F.col("material_quantity") * F.col("unit_cost")
    if "transaction_id" in addons.columns:
        lines = dealt(details.select("transaction_id", "detail_id", F.lit(1).alias("lines"), F.lit(0).alias("addons"), F.lit(None).alias("cost")),
                      addons.select("transaction_id", "detail_id", F.lit(0).alias("lines"), F.lit(1).alias("addons"), cost.alias("cost")),
                      whole).groupBy("transaction_id", "detail_id").agg(
            F.sum("lines").alias("lines"), F.sum("addons").alias("addons"), total("cost").alias("line_cost"))
        lines = lines.filter("lines > 0 AND addons > 0 AND detail_id IS NOT NULL")
        return lines.groupBy("transaction_id").agg(total_or_zero(F.col("line_cost") * F.col("lines").cast("int")).alias("hpp_addon"))
    per_line = addons.groupBy("detail_id").agg(total(cost).alias("line_cost"))
    return (details.select("detail_id", "transaction_id").join(per_line, "detail_id")
            .groupBy("transaction_id").agg(total_or_zero("line_cost").alias("hpp_addon")))


def line_summaries(details: DataFrame, addons: DataFrame, whole: bool = True) -> list[DataFrame]:
    """Products and add-on costs per transaction.

    Where add-ons name their transaction, both come from one pass: the lines are read and dealt once, by it, and meet the add-ons
    of the same line there. Add-ons are dealt by it, too, and summed per line first, so no line is repeated. Rows of a batch, and
    those of ``Source.dealt``, are dealt so already (not ``whole``).
    """
    if "transaction_id" not in addons.columns:
        return [product_summary(details), addon_costs(details, addons, whole)]
    key, cost = ["transaction_id", "detail_id"], F.col("quantity") * F.col("material_quantity") * F.col("unit_cost")
    if whole:
        details, addons = details.repartition("transaction_id"), addons.repartition("transaction_id")
    per_line = addons.groupBy(*key).agg(total(cost).alias("line_cost"))
    lines = details.select(*key, "quantity", (F.col("quantity") * F.col("unit_cost")).alias("cost"), "total_price")
    lines = lines.join(per_line, key, "left")
    return [lines.groupBy("transaction_id").agg(
        total_or_zero("quantity").alias("product"), total_or_zero("cost").alias("hpp_product"),
        total_or_zero("total_price").alias("gross_sales"), total_or_zero("line_cost").alias("hpp_addon"))]


def dealt(details: DataFrame, children: DataFrame, whole: bool) -> DataFrame:
    """Lines and what hangs on them, dealt by the transaction that both name; rows of a batch are so already."""
    both = details.unionByName(children)
    return both.repartition("transaction_id") if whole else both


def commission_summary(commissions: DataFrame) -> DataFrame:
    return commissions.groupBy("transaction_id").agg(total_or_zero("nominal").alias("commission"))


def payment_summary(payments: DataFrame) -> DataFrame:
    """Card fees and paid amounts per transaction.

    Cash is kept apart together with its number of rows: change is handed out once per cash row, and it is a column of
    the transaction, so it can be taken off after the join instead of before the sum.
    """
    cash = F.col("method_id") == rules.CASH_METHOD
    return payments.groupBy("transaction_id").agg(
        total_or_zero("mdr").alias("mdr"),
        total_where(cash, "value").alias("cash_value"),
        F.count(F.when(cash, F.col("value"))).alias("cash_rows"),
        total_or_zero(F.when(~F.coalesce(cash, F.lit(False)), F.col("value"))).alias("other_value"),
    )


def paid_value(change: str = "cash_change") -> Column:
    """Paid amount net of change; a cash row without a known change does not count."""
    cash = F.when(F.col(change).isNotNull(), F.col("cash_value") - F.col("cash_rows") * F.col(change))
    return (money_or_zero("other_value") + money_or_zero(cash)).cast(MONEY)


def children_of(source: Source, transactions: DataFrame | None) -> Source:
    """Limit the child tables to the batch; ``None`` means every transaction, where the star join does the work."""
    return source if transactions is None else source.of_transactions(transactions.select(F.col("id")))


def commission_counts() -> Column:
    """Commission counts once the transaction is paid and is not a later part of a split bill."""
    return rules.settles_own_bill() & F.col("paid_at").isNotNull()


def settled_commission(counted: Column) -> Column:
    return F.when(counted, money_or_zero("commission")).otherwise(money(F.lit(0)))


def star(source: Source, transactions: DataFrame, whole: bool) -> DataFrame:
    """Transactions with the summaries of their lines, add-ons, commissions and payments.

    Every summary is keyed by the transaction, so the joins never multiply rows and all use the same shuffle key.
    """
    deal = whole and "transaction_id" in source.addons.columns
    details, addons = (source.dealt("details"), source.dealt("addons")) if deal else (source.details, source.addons)
    summaries = (
        payment_summary(source.payments), *line_summaries(details, addons, whole and not deal),
        commission_summary(source.commissions),
    )
    facts = transactions.withColumnRenamed("id", "transaction_id")
    return reduce(lambda left, right: left.join(right, "transaction_id", "left"), summaries, facts)


def sales_raw(source: Source, transactions: DataFrame | None = None) -> DataFrame:
    """The raw mart: one row per active transaction.

    ``transactions`` limits the work to a batch; without it the whole source is taken.
    """
    chosen = (source.transactions if transactions is None else transactions).filter(is_sale() & rules.is_active())
    # What the rules make of other columns is made before the transactions are dealt, so that those stay behind.
    facts = chosen.select(
        "id", "merchant_id", "outlet_id", "sold_at", "total", "refund", "cash_change", rules.order_type().alias("order_type"),
        rules.is_refund().alias("is_refund"), rules.counts_as_transaction().alias("count_transaction"), commission_counts().alias("settled"))
    joined = star(children_of(source, None if transactions is None else chosen), facts, transactions is None)
    return SALES_RAW.conform(joined.select(
        F.col("transaction_id").alias("id_transaction"), "merchant_id", "outlet_id",
        "is_refund", F.col("sold_at").alias("datetime"), F.to_date("sold_at").alias("date"),
        money("total").alias("sales_value"), paid_value().alias("payment_value"),
        money_or_zero("gross_sales").alias("gross_sales"), money("refund").alias("refund"),
        "order_type", money_or_zero("product").alias("product"),
        money_or_zero("hpp_product").alias("hpp_product"), money_or_zero("hpp_addon").alias("hpp_addon"),
        money_or_zero("mdr").alias("mdr"), settled_commission(F.col("settled")).alias("commission"), "count_transaction",
    ))


def gross_profit() -> Column:
    """Sales less card fee, costs and commission; a refund gives those back on top of its sales value."""
    burden = F.col("mdr") + F.col("hpp_product") + F.col("hpp_addon") + F.col("commission")
    return (F.col("sales_value") + F.when(F.col("is_refund"), burden).otherwise(-burden)).cast(MONEY)


def _sales_rollup(raw: DataFrame, **when: Column | str) -> DataFrame:
    sale = ~F.col("is_refund")
    keys = {"merchant_id": "merchant_id", "outlet_id": "outlet_id", "order_type": "order_type", **when}
    return raw.groupBy(*(F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in keys.items())).agg(
        total_where(sale, "sales_value").alias("sales_value"),
        total_where(sale, "payment_value").alias("payment_value"),
        total(gross_profit()).alias("gross_value"),
        total_where(sale, "gross_sales").alias("gross_sales"),
        total_where(sale, "product").alias("product_qty"),
        F.sum("count_transaction").alias("transaction"),
        total_where(F.col("is_refund"), "refund").alias("refund"),
        total(F.when(sale, F.col("commission")).otherwise(-F.col("commission"))).alias("commission"),
    )


def contributions(raw: DataFrame) -> DataFrame:
    """What each raw row adds to its hour."""
    sale, refund = ~F.col("is_refund"), F.col("is_refund")
    return raw.select(
        "merchant_id", "outlet_id", "order_type", "date", F.hour("datetime").alias("hour"),
        *(money_or_zero(F.when(sale, F.col(c))).alias(c) for c in ("sales_value", "payment_value", "gross_sales")),
        money_or_zero(F.when(sale, F.col("product"))).alias("product_qty"), gross_profit().alias("gross_value"),
        F.col("count_transaction").alias("transaction"), money_or_zero(F.when(refund, F.col("refund"))).alias("refund"),
        F.when(sale, F.col("commission")).otherwise(-F.col("commission")).cast(MONEY).alias("commission"))


def sales_hourly(raw: DataFrame) -> DataFrame:
    return _sales_rollup(raw, date="date", hour=F.hour("datetime"))


def sales_daily(raw: DataFrame) -> DataFrame:
    return _sales_rollup(raw, date="date")


SALES_DIMENSIONS = {"merchant_id": "merchant_id", "outlet_id": "outlet_id", "order_type": "order_type"}


def sales_daily_from_hourly(hourly: DataFrame) -> DataFrame:
    """The daily mart from the hourly one, which is the smaller input of the two."""
    return roll_up(hourly, {**SALES_DIMENSIONS, "date": "date"}, SALES_MEASURES)


def sales_monthly(daily: DataFrame) -> DataFrame:
    return roll_up(daily, {**SALES_DIMENSIONS, "year": F.year("date"), "month": F.month("date")}, SALES_MEASURES)


def sales_yearly(monthly: DataFrame) -> DataFrame:
    return roll_up(monthly, {**SALES_DIMENSIONS, "year": "year"}, SALES_MEASURES)
