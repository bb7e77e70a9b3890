"""A small point-of-sale source built from Python rows, with sensible defaults for what a test does not care about."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tallyspark.sources.tables import Source

SCHEMAS = {
    "transactions": "id bigint, merchant_id bigint, outlet_id bigint, sold_at timestamp_ntz, updated_at timestamp_ntz, "
                    "paid_at timestamp_ntz, status string, purpose string, order_type int, type_detail string, "
                    "total decimal(18,2), refund decimal(18,2), refund_reason string, tax_nominal decimal(18,2), "
                    "cash_change decimal(18,2), split_flag int, payment_no int, receipt_no string, "
                    "parent_receipt_no string, cashier_id bigint, auth_id bigint, note string, item_count bigint",
    "details": "detail_id bigint, transaction_id bigint, quantity decimal(12,2), unit_cost decimal(18,2), "
               "total_price decimal(18,2), product_tax decimal(18,2), total_product_tax decimal(18,2)",
    "addons": "detail_id bigint, quantity decimal(12,2), material_quantity decimal(12,2), unit_cost decimal(18,2)",
    "commissions": "transaction_id bigint, nominal decimal(18,2)",
    "payments": "transaction_id bigint, method_id int, value decimal(18,2), mdr decimal(18,2)",
    "detail_extends": "id bigint, detail_id bigint",
    "promos": "transaction_id bigint, category_id int, value decimal(18,2)",
    "accounts": "id bigint, parent_id bigint, email string",
    "reservations": "id bigint, reservation_no string, merchant_id bigint, outlet_id bigint, customer_id bigint, "
                    "status string, updated_at timestamp_ntz, reserved_on date, type int",
    "services": "id bigint, reservation_id bigint, product_id bigint, service_date date, start_time string, "
                "end_time string, employee_id bigint, total_price decimal(18,2), is_parent int",
}
NOON = datetime(2023, 5, 10, 12)
DEFAULTS = {
    "transactions": dict(
        merchant_id=1, outlet_id=10, sold_at=NOON, updated_at=NOON, paid_at=NOON, status="1", purpose="5", order_type=1,
        total=100, refund=0, tax_nominal=11, cash_change=0, split_flag=0, payment_no=0, cashier_id=7, auth_id=8,
        note="n", item_count=2),
    "details": dict(quantity=1, unit_cost=10, total_price=20, product_tax=1, total_product_tax=2),
    "addons": dict(quantity=1, material_quantity=1, unit_cost=1),
    "commissions": dict(nominal=5),
    "payments": dict(method_id=2, value=100, mdr=3),
    "detail_extends": {}, "promos": dict(category_id=4, value=9), "accounts": dict(parent_id=0),
    "reservations": dict(reservation_no="R", merchant_id=1, outlet_id=10, customer_id=5, status="700", updated_at=NOON,
                         reserved_on=NOON.date(), type=1),
    "services": dict(product_id=3, service_date=NOON.date(), start_time="10:00:00", end_time="11:30:00", employee_id=4,
                     total_price=50, is_parent=1),
}


def frame(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    names = [c.strip().split(" ")[0] for c in SCHEMAS[table].replace("decimal(18,2)", "decimal").replace(
        "decimal(12,2)", "decimal").split(",")]
    money = {n for n, c in zip(names, SCHEMAS[table].replace(",2)", ".2)").split(",")) if "decimal" in c}

    def value(row: dict, name: str):
        found = {**DEFAULTS[table], **row}.get(name)
        return Decimal(str(found)) if name in money and found is not None else found

    return spark.createDataFrame([tuple(value(r, n) for n in names) for r in rows], SCHEMAS[table])


def shop(spark: SparkSession, **tables: list[dict]) -> Source:
    for row in tables.get("transactions", []):
        row.setdefault("receipt_no", f"N{row['id']}")
    return Source({name: (lambda name=name: frame(spark, name, tables.get(name, []))) for name in SCHEMAS})


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as plain sorted tuples, amounts as floats."""
    chosen = df.select(*columns) if columns else df.select(*sorted(df.columns))

    def plain(v):
        return float(v) if isinstance(v, Decimal) else v

    return sorted((tuple(plain(v) for v in r) for r in chosen.collect()), key=str)


def at(day: date | str, hour: int = 12) -> datetime:
    day = date.fromisoformat(day) if isinstance(day, str) else day
    return datetime(day.year, day.month, day.day) + timedelta(hours=hour)
