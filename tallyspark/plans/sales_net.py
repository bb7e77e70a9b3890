"""Net sales variant: split bills are folded into their parent and refunds are booked against the day they fall on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyspark.functions import rules
from tallyspark.functions.money import MONEY, money_or_zero, total, total_or_zero, total_where
from tallyspark.operators.keys import distinct_keys, having_keys, lacking_keys
from tallyspark.plans.sales import children_of, commission_counts, is_sale, paid_value, settled_commission, star
from tallyspark.schema import SALES_RAW
from tallyspark.sources.tables import TRANSACTION_CHILDREN, Source, id_ranges

BILL = ("merchant_id", "outlet_id", "receipt_no")


def split_bill_children(source: Source, parents: DataFrame) -> DataFrame:
    """Totals and payments of the later parts of each split bill, keyed by the parent transaction.

    Parts are summed per bill before they meet the parent, so a bill with very many parts is combined on the map side
    and the join back is one row to one. Change belongs to the parent and is taken off once per cash payment.
    """
    heads = parents.filter(is_sale() & rules.is_active() & rules.is_split_parent() & F.col("receipt_no").isNotNull())
    parts = source.transactions.filter(F.col("parent_receipt_no").isNotNull()).select(
        "id", "merchant_id", "outlet_id", F.col("parent_receipt_no").alias("receipt_no"), "total")
    parts = parts.join(heads.select(*BILL).distinct(), list(BILL), "left_semi")
    cash = F.col("method_id") == rules.CASH_METHOD
    paid = having_keys(source.payments, parts.select(F.col("id").alias("transaction_id")), ["transaction_id"])
    paid = paid.groupBy("transaction_id").agg(
        total_or_zero("mdr").alias("mdr"), total_where(cash, "value").alias("cash_value"),
        F.count(F.when(cash, F.col("value"))).alias("cash_rows"),
        total_or_zero(F.when(~F.coalesce(cash, F.lit(False)), F.col("value"))).alias("other_value"))
    per_bill = (parts.join(paid, parts.id == paid.transaction_id, "left").groupBy(*BILL).agg(
        total("total").alias("total"), total_or_zero("mdr").alias("mdr"),
        total_or_zero("cash_value").alias("cash_value"), F.sum("cash_rows").alias("cash_rows"),
        total_or_zero("other_value").alias("other_value")))
    return heads.select(F.col("id").alias("id_transaction"), *BILL, "cash_change").join(per_bill, list(BILL)).select(
        "id_transaction", "total", "mdr", paid_value().alias("payment_value"))


def sales_net_raw(source: Source, transactions: DataFrame | None = None) -> DataFrame:
    """One row per active transaction that settles its own bill, with the parts of a split bill added to the parent."""
    window = (source.transactions if transactions is None else transactions).filter(is_sale())
    chosen = window.filter(rules.is_active() & rules.settles_own_bill())
    joined = star(children_of(source, None if transactions is None else chosen), chosen, transactions is None)
    parts = split_bill_children(source, window).select(
        F.col("id_transaction").alias("transaction_id"), F.col("total").alias("part_total"),
        F.col("mdr").alias("part_mdr"))
    return joined.join(parts, "transaction_id", "left").select(
        F.col("transaction_id").alias("id_transaction"), "merchant_id", "outlet_id",
        F.col("sold_at").alias("datetime"), F.to_date("sold_at").alias("date"),
        (money_or_zero("total") + money_or_zero("part_total")).cast(MONEY).alias("sales_value"),
        rules.is_refund().alias("is_refund"), money_or_zero("refund").alias("refund"),
        rules.order_type().alias("order_type"), money_or_zero("product").alias("product"),
        money_or_zero("hpp_product").alias("hpp_product"), money_or_zero("gross_sales").alias("gross_sales"),
        (money_or_zero("mdr") + money_or_zero("part_mdr")).cast(MONEY).alias("mdr"),
        paid_value().alias("payment_value"), money_or_zero("hpp_addon").alias("hpp_addon"),
        settled_commission(commission_counts()).alias("commission"),
    )


def bill_links(transactions: DataFrame) -> DataFrame:
    """The parts of split bills and the bills that they are booked on."""
    return transactions.filter(F.col("parent_receipt_no").isNotNull()).select(
        F.col("id").alias("id_transaction"), "merchant_id", "outlet_id", "parent_receipt_no",
        F.col("sold_at").alias("datetime"), F.to_date("sold_at").alias("date"))


def with_parents(source: Source, transactions: DataFrame, stored_links: DataFrame | None = None) -> DataFrame:
    """Transactions of a batch together with the heads of the split bills they are parts of, or were by the stored links."""
    links = bill_links(transactions)
    links = links if stored_links is None else links.unionByName(stored_links.select(*links.columns))
    bills = links.select("merchant_id", "outlet_id", F.col("parent_receipt_no").alias("receipt_no")).distinct()
    heads = having_keys(source.transactions, bills, list(BILL))
    return transactions.unionByName(lacking_keys(heads, transactions, ["id"]))


def bounded(source: Source, transactions: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> Source:
    """The source as far as the net rows of a batch need it: its transactions with the parts of its bills, and the children
    of those by a few literal ranges of ids."""
    heads = transactions.filter(rules.is_split_parent() & F.col("receipt_no").isNotNull())
    bills = heads.select("merchant_id", "outlet_id", F.col("receipt_no").alias("parent_receipt_no")).distinct()
    parts = having_keys(source.transactions.filter(F.col("parent_receipt_no").isNotNull()), bills,
                        ["merchant_id", "outlet_id", "parent_receipt_no"])
    parts = keep(parts, "parts")
    ranges = id_ranges(transactions.select("id").union(parts.select("id")))
    return source.near_ids(ranges, TRANSACTION_CHILDREN).replacing(transactions=parts)


def stored_net_raw(source: Source, transactions: DataFrame | None = None) -> DataFrame:
    """The net raw rows in the layout of the raw mart; every sale counts as a transaction, a refund as none."""
    counted = F.when(F.col("is_refund"), F.lit(0)).otherwise(F.lit(1)).cast("bigint")
    return SALES_RAW.conform(sales_net_raw(source, transactions).withColumn("count_transaction", counted))


def _net_rollup(raw: DataFrame, **when: Column | str) -> DataFrame:
    """Sales and refunds of a key in one pass.

    A key that holds refunds only needs no separate branch: its sales sums are zero and its gross value is the refund
    taken off with the commission given back.
    """
    refund, sale = F.col("is_refund"), ~F.col("is_refund")
    cost = F.col("hpp_product") + F.col("hpp_addon") + F.col("mdr")
    net = F.when(sale, F.col("sales_value") - cost - F.col("commission")).otherwise(F.col("commission") - F.col("refund"))
    keys = [F.col(c).alias(n) if isinstance(c, str) else c.alias(n)
            for n, c in {"merchant_id": "merchant_id", "outlet_id": "outlet_id", "order_type": "order_type", **when}.items()]
    return raw.groupBy(*keys).agg(
        total_where(sale, "sales_value").alias("sales_value"),
        total_where(sale, "payment_value").alias("payment_value"),
        total(net.cast(MONEY)).alias("gross_value"),
        total_where(sale, "gross_sales").alias("gross_sales"),
        total_where(sale, "product").alias("product_qty"),
        F.count(F.when(sale, F.col("id_transaction"))).alias("transaction"),
        total_where(refund, "refund").alias("refund"),
        total(F.when(sale, F.col("commission")).otherwise(-F.col("commission"))).alias("commission"),
    )


def contributions(raw: DataFrame) -> DataFrame:
    """What each net raw row adds to its hour."""
    refund, sale = F.col("is_refund"), ~F.col("is_refund")
    burden = F.col("hpp_product") + F.col("hpp_addon") + F.col("mdr") + F.col("commission")
    net = F.when(sale, F.col("sales_value") - burden).otherwise(F.col("commission") - F.col("refund"))
    return raw.select(
        "merchant_id", "outlet_id", "order_type", "date", F.hour("datetime").alias("hour"),
        *(money_or_zero(F.when(sale, F.col(c))).alias(c) for c in ("sales_value", "payment_value", "gross_sales")),
        money_or_zero(F.when(sale, F.col("product"))).alias("product_qty"), net.cast(MONEY).alias("gross_value"),
        F.col("count_transaction").alias("transaction"), money_or_zero(F.when(refund, F.col("refund"))).alias("refund"),
        F.when(sale, F.col("commission")).otherwise(-F.col("commission")).cast(MONEY).alias("commission"))


def sales_net_hourly(raw: DataFrame) -> DataFrame:
    return _net_rollup(raw, date="date", hour=F.hour("datetime"))


def sales_net_daily(raw: DataFrame) -> DataFrame:
    return _net_rollup(raw, date="date")


def refund_only_keys(raw: DataFrame, *, hourly: bool = False) -> DataFrame:
    """Keys under which nothing but refunds was booked."""
    key = ["merchant_id", "outlet_id", "order_type", "date"] + (["hour"] if hourly else [])
    rows = raw.withColumn("hour", F.hour("datetime")) if hourly else raw
    refunds = distinct_keys(rows.filter("is_refund"), key=key)
    return lacking_keys(refunds, rows.filter(~F.col("is_refund")), key)
