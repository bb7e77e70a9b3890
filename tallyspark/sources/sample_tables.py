"""The sample star schema (orders, lineitem, events ...) read as point-of-sale and reservation tables.

Every derivation is a plain expression on the row, so SQL on the same files can repeat it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.sources.tables import Keep, Source


def _hundredths(column: str) -> str:
    """A two-digit double as a whole number of hundredths; exact, and cheaper than a cast to decimal."""
    return f"floor({column} * 100 + 0.5D)"


def _price(hundredths: str) -> str:
    """Amounts of the files have at most eight digits; Spark sums decimals that narrow as plain integers."""
    return f"cast(cast({hundredths} AS decimal(8,0)) * 0.01 AS decimal(8,2))"


def _amount(ten_thousandths: str) -> str:
    return f"cast(cast({ten_thousandths} AS decimal(16,0)) * 0.0001 AS decimal(18,4))"


SOLD_AT = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 AS int))"
TRANSACTION = (
    "o_orderkey AS id",
    "cast(n_regionkey AS bigint) AS merchant_id",
    "cast(c_nationkey AS bigint) AS outlet_id",
    f"{SOLD_AT} AS sold_at",
    "o_orderdate + make_dt_interval(cast(o_orderkey % 5 AS int)) AS updated_at",
    f"if(o_orderkey % 17 <> 0, {SOLD_AT}, NULL) AS paid_at",
    "CASE WHEN o_orderstatus IN ('F', 'O') THEN '1' WHEN o_orderkey % 2 = 0 THEN '4' ELSE '9' END AS status",
    "CASE o_orderkey % 10 WHEN 0 THEN '1' WHEN 9 THEN '9' ELSE '5' END AS purpose",
    "if(o_orderpriority <> '4-NOT SPECIFIED', cast(substring(o_orderpriority, 1, 1) AS int), NULL) AS order_type",
    """CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 2 THEN '{"tax_base_type": 0}' WHEN 3 THEN '{"tax_base_type": 2}'
       WHEN 4 THEN '{bad' WHEN 5 THEN '{}' END AS type_detail""",
    f"{_price(_hundredths('o_totalprice'))} AS total",
    f"{_price('if(o_orderkey % 7 = 0, ' + _hundredths('o_totalprice') + ', 0)')} AS refund",
    "CASE WHEN o_orderkey % 11 = 0 THEN 'cancel' WHEN o_orderkey % 2 <> 0 THEN '' END AS refund_reason",
    f"cast({_amount(_hundredths('o_totalprice') + ' * 11')} AS decimal(8,2)) AS tax_nominal",
    "cast(o_orderkey % 1000 AS decimal(12,2)) AS cash_change",
    # The first order of a customer heads that customer's split bills; some later ones are parts of it.
    "CASE WHEN o_orderkey = head OR o_orderkey % 13 = 1 THEN 1 WHEN o_orderkey % 5 <> 0 THEN 0 END AS split_flag",
    "CASE WHEN o_orderkey = head THEN 1 WHEN o_orderkey % 13 = 1 THEN 2 ELSE 0 END AS payment_no",
    "if(o_orderkey % 101 <> 50, concat('N', o_orderkey), NULL) AS receipt_no",
    "if(o_orderkey <> head AND o_orderkey % 13 = 1, concat('N', head), NULL) AS parent_receipt_no",
    "if(o_orderkey % 19 <> 0, o_orderkey % 31, NULL) AS cashier_id",
    "if(o_orderkey % 3 <> 0, o_orderkey % 37, NULL) AS auth_id",
    "if(o_orderkey % 4 <> 0, concat('note ', o_orderkey), NULL) AS note",
    "if(o_orderkey % 23 <> 0, o_orderkey % 9, NULL) AS item_count",
)
# (order, line number) repeats in the files; the line is told apart by all its columns. Made of the line's own columns after
# it has met its part and its transaction, so that no value travels there twice.
DETAIL_ID = ("named_struct('o', transaction_id, 'n', line, 'p', part, 's', supplier, 'q', line_quantity, 'x', price) AS detail_id")
LINE = (
    "l_orderkey AS transaction_id", "l_linenumber AS line", "l_partkey AS part", "l_suppkey AS supplier",
    f"{_hundredths('l_quantity')} AS line_quantity", f"{_hundredths('l_extendedprice')} AS price",
    f"{_hundredths('l_discount')} AS discount", f"{_hundredths('l_tax')} AS tax", "l_returnflag", "l_linestatus",
)
DETAIL = (
    DETAIL_ID, "transaction_id", f"{_price('line_quantity')} AS quantity", "unit_cost", f"{_price('price')} AS total_price",
    f"{_amount('price * tax')} AS product_tax", f"{_amount('price * (tax + 1)')} AS total_product_tax",
)
ADDON = (
    "transaction_id", DETAIL_ID, "cast(1 AS decimal(6,2)) AS quantity", "material_quantity", "unit_cost",
)
RESERVATION = (
    "event_id AS id", "concat('R', event_id) AS reservation_no", "user_id % 10 AS merchant_id",
    "user_id % 3 AS outlet_id", "user_id AS customer_id",
    "CASE event_type WHEN 'purchase' THEN 700 WHEN 'signup' THEN 9 WHEN 'error' THEN 15 ELSE 100 END AS status",
    "ts AS updated_at", "to_date(ts) AS reserved_on", "cast(event_id % 3 AS int) AS type",
)
SERVICE = (
    "event_id AS id", "event_id AS reservation_id", "event_id % 40 AS product_id", "to_date(ts) AS service_date",
    "date_format(ts, 'HH:mm:ss') AS start_time",
    # The end is taken from the clock alone, so a service over midnight ends "before" it starts.
    "date_format(ts + make_dt_interval(0, 0, cast(floor(value) AS int)), 'HH:mm:ss') AS end_time",
    "user_id % 20 AS employee_id", f"{_price(_hundredths('value'))} AS total_price",
    "if(event_id % 4 <> 0, 1, 0) AS is_parent",
)


# Columns of the sample files. Stating them spares a Spark job per file.
FILES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class SampleTables:
    """Access to the parquet files of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.schema(FILES[name]).parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    def source(self) -> Source:
        return Source({
            "transactions": self.transactions, **self._children(), "accounts": self.accounts,
            "reservations": self.reservations, "services": self.services,
        }, self._children_of, {"details": DETAIL, "addons": ADDON})

    def _children(self) -> dict[str, Callable[[], DataFrame]]:
        return {"details": self._detail_rows, "addons": self._addon_rows, "commissions": self.commissions, "payments": self.payments,
                "promos": self.promos, "detail_extends": self.detail_extends}

    def _children_of(self, ids: DataFrame, keep: Keep) -> dict[str, Callable[[], DataFrame]]:
        """The children from their lines alone, which are read once. Most of the lines aren't copied: where a batch has more than a
        quarter of the transactions, each child reads the file."""
        if 4 * ids.count() > self.table("orders").count():
            return self._children()
        near = SampleTables(self.spark, self.folder)
        lines = self.table("lineitem").drop("l_shipdate")
        near._opened = {**self._opened, "lineitem": keep(
            lines.join(ids, F.col("l_orderkey") == F.col("id"), "left_semi"), "lineitem")}
        return near._children()

    def transactions(self) -> DataFrame:
        orders = self.table("orders")
        heads = orders.groupBy(F.col("o_custkey").alias("customer")).agg(F.min("o_orderkey").alias("head"))
        place = (self.table("customer").select("c_custkey", "c_nationkey")
                 .join(self.table("nation").select("n_nationkey", "n_regionkey"), F.expr("c_nationkey = n_nationkey"))
                 .join(heads, F.expr("c_custkey = customer")))
        return orders.join(place, F.expr("o_custkey = c_custkey")).selectExpr(*TRANSACTION)

    def _lines(self, condition: str = "true") -> DataFrame:
        return self.table("lineitem").filter(condition).selectExpr(*LINE)

    def _detail_rows(self) -> DataFrame:
        part = self.table("part").selectExpr("p_partkey", f"{_price(_hundredths('p_retailprice'))} AS unit_cost")
        return self._lines().join(part, F.expr("part = p_partkey"), "left")

    def _addon_rows(self) -> DataFrame:
        part = self.table("part").filter("p_type = 'PROMO'").selectExpr(
            "p_partkey", "cast(p_size AS decimal(6,2)) AS material_quantity", f"{_amount(_hundredths('p_retailprice'))} AS unit_cost")
        return self._lines().join(part, F.expr("part = p_partkey"))

    def details(self) -> DataFrame:
        return self._detail_rows().selectExpr(*DETAIL)

    def addons(self) -> DataFrame:
        return self._addon_rows().selectExpr(*ADDON)

    def commissions(self) -> DataFrame:
        return self._lines("l_returnflag = 'A'").selectExpr(
            "transaction_id", f"{_amount('price * discount')} AS nominal")

    def payments(self) -> DataFrame:
        return self._lines("l_linenumber <= 2").selectExpr(
            "transaction_id", "line AS method_id", f"{_amount('price * (100 - discount)')} AS value",
            f"{_amount('price * tax')} AS mdr")

    def promos(self) -> DataFrame:
        return self._lines().selectExpr("transaction_id", "line AS category_id", f"{_amount('price * discount')} AS value")

    def detail_extends(self) -> DataFrame:
        """One extension for each line with status F, two for the first line of a transaction."""
        lines = self._lines("l_linestatus = 'F'")
        columns = ("detail_id AS id", "transaction_id", "detail_id")
        return lines.selectExpr("*", DETAIL_ID).selectExpr(*columns).union(
            lines.filter("line = 1").selectExpr("*", DETAIL_ID).selectExpr(*columns))

    def accounts(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS id", "if(c_custkey % 3 = 0, 0, c_custkey - c_custkey % 3) AS parent_id", "c_name AS email")

    def reservations(self) -> DataFrame:
        return self.table("events").selectExpr(*RESERVATION)

    def services(self) -> DataFrame:
        return self.table("events").selectExpr(*SERVICE)
