"""Mart tables: keys, columns, and the layout under which they are published."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from tallyspark.functions.money import MONEY

LONG, INT, TEXT, FLAG = LongType(), IntegerType(), StringType(), BooleanType()
DAY, MOMENT, AMOUNT = DateType(), TimestampNTZType(), MONEY

# Published names of the two columns that carry no table prefix.
MERCHANT_COLUMN = "m_user_id_user"
OUTLET_COLUMN = "m_cabang_id_cabang"

# Storage partition of rows without a date.
UNDATED = "undated"
# Ids in one storage partition of a ledger. New ids follow each other, so a batch touches few.
ID_RANGE = 1_000_000
# How many raw rows a key of a roll-up stands for.
ROWS = "n_rows"


def tally(measure: str) -> str:
    return f"n_{measure}"


@dataclass(frozen=True)
class MartTable:
    """A mart table.

    ``key`` is what rows are replaced by. ``calendar`` names the columns that place a row in time; storage partitions
    follow from them, so a table with a date can be kept by day or by month. ``sums`` are the measures of a roll-up, and
    ``nullable`` those of them that are null where no raw row has a value.
    """

    name: str
    prefix: str
    key: tuple[str, ...]
    columns: tuple[tuple[str, object], ...]
    calendar: tuple[str, ...] = field(default=("date",))
    sums: tuple[str, ...] = ()
    nullable: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType([StructField(name, kind, True) for name, kind in self.columns])

    @property
    def tallies(self) -> tuple[str, ...]:
        """Stored beside the columns of a roll-up: how many raw rows a key has, and how many gave a value to each sum that
        is null without any."""
        return (ROWS, *(tally(m) for m in self.nullable)) if self.sums else ()

    @property
    def stored_schema(self) -> StructType:
        return StructType([*self.schema.fields, *(StructField(t, LONG, True) for t in self.tallies)])

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def measures(self) -> list[str]:
        return [c for c in self.column_names if c not in self.key]

    def published_name(self, column: str) -> str:
        return {"merchant_id": MERCHANT_COLUMN, "outlet_id": OUTLET_COLUMN}.get(column, f"{self.prefix}_{column}")

    def publish(self, df: DataFrame) -> DataFrame:
        """Rename to the published layout, in column order."""
        return df.select(*(F.col(c).alias(self.published_name(c)) for c in self.column_names))

    def adopt(self, df: DataFrame) -> DataFrame:
        """Read the published layout back into the short names and declared types."""
        return df.select(*(F.col(self.published_name(c)).cast(kind).alias(c) for c, kind in self.columns))

    def conform(self, df: DataFrame) -> DataFrame:
        """Columns, order and types of the table."""
        return df.to(self.schema)

    def partitions(self, grain: str) -> dict[str, Column]:
        """Storage partition columns for a grain of ``day`` or ``month``; a table without a calendar lies by ranges of its id."""
        if not self.calendar:
            return {"p_ids": F.floor(F.col(self.key[0]) / ID_RANGE).cast("string")}
        if self.calendar == ("year",):
            return {"p_year": F.col("year").cast("string")}
        if self.calendar == ("year", "month"):
            return {"p_month": F.format_string("%04d-%02d", F.col("year"), F.col("month"))}
        stamps = {"p_month": "yyyy-MM"} | ({"p_day": "yyyy-MM-dd"} if grain == "day" else {})
        return {name: F.coalesce(F.date_format("date", pattern), F.lit(UNDATED)) for name, pattern in stamps.items()}


def _sales(level: str, when: tuple[tuple[str, object], ...], calendar: tuple[str, ...]) -> MartTable:
    return MartTable(
        f"mart_sales_dashboard_{level}", f"mart_sales_dashboard_{level}",
        ("merchant_id", "outlet_id", "order_type", *(name for name, _ in when)),
        (("merchant_id", LONG), ("outlet_id", LONG), ("order_type", INT), *when,
         *((m, LONG if m == "transaction" else AMOUNT) for m in SALES_MEASURES)),
        calendar, SALES_MEASURES, ("gross_value",),
    )


def _tax(level: str, when: tuple[tuple[str, object], ...], calendar: tuple[str, ...]) -> MartTable:
    return MartTable(
        f"mart_tax_report_{level}", "mart_tax_report",
        ("merchant_id", "outlet_id", "base_type", *(name for name, _ in when)),
        (("merchant_id", LONG), ("outlet_id", LONG), ("base_type", INT), *when,
         *((m, AMOUNT) for m in TAX_MEASURES)),
        calendar, TAX_MEASURES, ("transaction_value", "tax_value"),
    )


SALES_MEASURES = ("sales_value", "payment_value", "gross_value", "gross_sales", "product_qty", "transaction", "refund",
                  "commission")
TAX_MEASURES = ("transaction_value", "tax_value", "tax_product")

SALES_RAW = MartTable(
    "raw_mart_sales_dashboard", "raw_mart_sales_dashboard", ("id_transaction",),
    (("id_transaction", LONG), ("merchant_id", LONG), ("outlet_id", LONG), ("is_refund", FLAG), ("datetime", MOMENT),
     ("date", DAY), ("sales_value", AMOUNT), ("payment_value", AMOUNT), ("gross_sales", AMOUNT), ("refund", AMOUNT),
     ("order_type", INT), ("product", AMOUNT), ("hpp_product", AMOUNT), ("hpp_addon", AMOUNT), ("mdr", AMOUNT),
     ("commission", AMOUNT), ("count_transaction", LONG)),
)
# Which bill each part of a split bill was last booked on; parts have no raw row of their own in the net variant.
SALES_NET_LINKS = MartTable(
    "raw_mart_sales_net_links", "raw_mart_sales_net_links", ("id_transaction",),
    (("id_transaction", LONG), ("merchant_id", LONG), ("outlet_id", LONG), ("parent_receipt_no", TEXT),
     ("datetime", MOMENT), ("date", DAY)),
)
SALES_HOURLY = _sales("hourly", (("date", DAY), ("hour", INT)), ("date",))
SALES_DAILY = _sales("daily", (("date", DAY),), ("date",))
SALES_MONTHLY = _sales("monthly", (("year", INT), ("month", INT)), ("year", "month"))
SALES_YEARLY = _sales("yearly", (("year", INT),), ("year",))

TAX_RAW = MartTable(
    "raw_mart_tax_report", "raw_mart_tax_report", ("id_transaction",),
    (("id_transaction", LONG), ("merchant_id", LONG), ("outlet_id", LONG), ("datetime", MOMENT), ("date", DAY),
     ("no_nota", TEXT), ("transaction_value", AMOUNT), ("base_type", INT), ("tax_value", AMOUNT),
     ("tax_product", AMOUNT)),
)
TAX_DAILY = _tax("daily", (("date", DAY),), ("date",))
TAX_MONTHLY = _tax("monthly", (("year", INT), ("month", INT)), ("year", "month"))
TAX_YEARLY = _tax("yearly", (("year", INT),), ("year",))

COMPLIMENT_RAW = MartTable(
    "raw_mart_compliment", "raw_mart_compliment", ("transaction_id",),
    (("no", TEXT), ("transaction_id", LONG), ("merchant_id", LONG), ("outlet_id", LONG), ("no_nota", TEXT),
     ("datetime", MOMENT), ("date", DAY), ("cashier_id", LONG), ("product_qty", LONG), ("auth_id", LONG),
     ("value", AMOUNT), ("note", TEXT)),
)

UTILIZATION_RAW = MartTable(
    "raw_mart_utilization", "raw_mart_utilization", ("id_reservation",),
    (("id_reservation_detail", LONG), ("id_reservation", LONG), ("merchant_id", LONG), ("outlet_id", LONG),
     ("customer_id", LONG), ("employee_id", LONG), ("product_id", LONG), ("date", DAY), ("start_time", TEXT),
     ("end_time", TEXT), ("duration", INT), ("price", AMOUNT)),
)
UTILIZATION_DAILY = MartTable(
    "mart_utilization_daily", "mart_utilization_daily", ("merchant_id", "outlet_id", "employee_id", "date"),
    (("no", TEXT), ("merchant_id", LONG), ("outlet_id", LONG), ("employee_id", LONG), ("duration", LONG),
     ("date", DAY), ("price", AMOUNT)),
    sums=("duration", "price"),
)
SUMMARY_RAW = MartTable(
    "raw_mart_summary_reservation", "raw_mart_summary_reservation", ("id_reservation",),
    (("no", TEXT), ("id_reservation", LONG), ("merchant_id", LONG), ("outlet_id", LONG), ("date", DAY),
     ("status", INT), ("type", INT)),
)
SUMMARY_DAILY = MartTable(
    "mart_summary_reservation_daily", "mart_summary_reservation_daily",
    ("merchant_id", "outlet_id", "date", "status", "type"),
    (("no", TEXT), ("merchant_id", LONG), ("outlet_id", LONG), ("date", DAY), ("status", INT), ("total", LONG),
     ("type", INT)),
    sums=("total",),
)


def ledger_of(raw: MartTable) -> MartTable:
    """What a raw mart holds of each id, by its place: number of rows and their order-free digest."""
    return MartTable(
        f"{raw.name}_ledger", f"{raw.name}_ledger", ("id",),
        (("id", LONG), ("merchant_id", LONG), ("outlet_id", LONG), ("date", DAY), ("rows", LONG), ("digest", DecimalType(38, 0))),
        (),
    )


# Progress log, one row per run.
HISTORY = StructType([
    StructField("id", LONG), StructField("actdate", MOMENT), StructField("ts_current", MOMENT),
    StructField("ts_end", MOMENT), StructField("num_row", LONG), StructField("time_process", DoubleType()),
    StructField("params", TEXT), StructField("done_monthly", FLAG), StructField("done_yearly", FLAG),
    StructField("mart_param", TEXT),
])
