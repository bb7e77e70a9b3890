"""Business predicates and flags on source transactions, reservations and accounts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, functions as F

# Codes of the source system.
ACTIVE_STATUS = "1"
KNOWN_STATUSES = ("1", "4", "9")
SALES_PURPOSES = ("5", "9")
COMPLIMENT_PURPOSE = "5"
COMPLIMENT_PROMO_CATEGORY = 4
CASH_METHOD = 1
DEFAULT_ORDER_TYPE = 99
DEFAULT_TAX_BASE = 1
UTILIZED_STATUSES = (700, 9)
UNREPORTED_STATUS = 9
EARLIEST_SALE = "1970-01-01 00:00:00"


def within(column: str, start: datetime | None, end: datetime | None) -> Column:
    """Increment window, inclusive at both ends; an open end is not tested."""
    test = F.lit(True)
    if start is not None:
        test = test & (F.col(column) >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        test = test & (F.col(column) <= F.lit(str(end)).cast("timestamp_ntz"))
    return test


def sane_sale_time(column: str = "sold_at") -> Column:
    return F.col(column) > F.lit(EARLIEST_SALE).cast("timestamp_ntz")


def has_status(statuses: Sequence[str] = KNOWN_STATUSES) -> Column:
    return F.col("status").isin(*statuses)


def is_active() -> Column:
    return F.col("status") == ACTIVE_STATUS


def has_purpose(purposes: Sequence[str] = SALES_PURPOSES) -> Column:
    return F.col("purpose").isin(*purposes)


def settles_own_bill() -> Column:
    """True unless the transaction is a later payment of a split bill."""
    split = F.col("split_flag")
    return ((split == 1) & (F.col("payment_no") <= 1)) | (split != 1) | split.isNull()


def is_split_parent() -> Column:
    return (F.col("split_flag") == 1) & (F.col("payment_no") <= 1)


def is_refund() -> Column:
    return F.coalesce(F.col("refund") > 0, F.lit(False)) | (F.coalesce(F.col("refund_reason"), F.lit("")) != "")


def counts_as_transaction() -> Column:
    """0 for split-bill children and refunds, 1 otherwise."""
    child = (F.coalesce(F.col("split_flag"), F.lit(0)) == 1) & (F.coalesce(F.col("parent_receipt_no"), F.lit("")) != "")
    return F.when(child | is_refund(), F.lit(0)).otherwise(F.lit(1)).cast("bigint")


def order_type() -> Column:
    return F.coalesce(F.col("order_type"), F.lit(DEFAULT_ORDER_TYPE)).cast("int")


def tax_base_type(detail: str = "type_detail") -> Column:
    """``$.tax_base_type`` of the JSON text; absent, empty, malformed and 0 all mean the default base."""
    found = F.get_json_object(F.col(detail), "$.tax_base_type").try_cast("decimal(10,0)").cast("int")
    return F.when(found.isNull() | (found == 0), F.lit(DEFAULT_TAX_BASE)).otherwise(found).cast("int")


def merchant_list(merchants: Sequence[int] | int | str) -> list[int]:
    """Merchants given as one number, a list, or comma-separated text."""
    if isinstance(merchants, str):
        return [int(m) for m in merchants.split(",")]
    return [merchants] if isinstance(merchants, int) else [int(m) for m in merchants]


def merchant_scope(merchants: Sequence[int] | int | str | None, outlet: int | None = None,
                   merchant_column: str = "merchant_id", outlet_column: str = "outlet_id") -> Column:
    """One merchant, a list of merchants, or everything; the outlet only narrows a given merchant."""
    if merchants is None:
        return F.lit(True)
    listed = merchant_list(merchants)
    scope = F.col(merchant_column).isin(*listed)
    return scope & (F.col(outlet_column) == outlet) if outlet is not None else scope


def reservation_class(status: str = "status") -> Column:
    """1 = completed, 3 = cancelled by error, 2 = anything else."""
    code = F.col(status).try_cast("int")
    return F.when(code == 700, 1).when(code == 15, 3).otherwise(2).cast("int")


def account_owner() -> Column:
    """A sub-account stands for its parent."""
    return F.when(F.col("parent_id") == 0, F.col("id")).otherwise(F.col("parent_id")).cast("bigint")
