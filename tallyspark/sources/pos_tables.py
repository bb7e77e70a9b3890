"""Point-of-sale and reservation tables under their own column names."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

from tallyspark.sources.tables import Source

# Table and column names of the source system, and what they are called here.
POS_COLUMNS: dict[str, tuple[str, dict[str, str]]] = {
    "transactions": ("Transactions", {
        "id_transaction": "id", "M_User_id_user": "merchant_id", "M_Cabang_id_cabang": "outlet_id",
        "transaction_tgl": "sold_at", "updatedate": "updated_at", "transaction_tgl_payment": "paid_at",
        "status": "status", "transaction_purpose": "purpose", "transaction_type": "order_type",
        "transaction_type_detail": "type_detail", "transaction_total": "total", "transaction_refund": "refund",
        "transaction_refund_reason": "refund_reason", "transaction_tax_nominal": "tax_nominal",
        "transaction_kembalian": "cash_change", "transaction_pisah": "split_flag",
        "transaction_no_payment": "payment_no", "transaction_no_nota": "receipt_no",
        "transaction_no_nota_parent": "parent_receipt_no", "transaction_id_kasir_bayar": "cashier_id",
        "transaction_otoritas": "auth_id", "transaction_catatan": "note", "transaction_jumlah_pesanan": "item_count",
    }),
    "details": ("Transaction_Detail", {
        "id_transaction_detail": "detail_id", "Transactions_id_transaction": "transaction_id",
        "transaction_detail_jumlah": "quantity", "transaction_detail_price_modal": "unit_cost",
        "transaction_detail_total_price": "total_price", "transaction_detail_pajak_produk": "product_tax",
        "transaction_detail_total_pajak_produk": "total_product_tax",
    }),
    "addons": ("Transaction_Addon_Detail", {
        "Transaction_Detail_id_transaction_detail": "detail_id", "transaction_addon_detail_quantity": "quantity",
        "transaction_addon_detail_quantity_bahan": "material_quantity",
        "transaction_addon_detail_harga_modal": "unit_cost",
    }),
    "commissions": ("Transaction_Commission", {
        "Transactions_id_transaction": "transaction_id", "commission_total_nominal": "nominal",
    }),
    "payments": ("Transaction_has_Payment_Method", {
        "Transaction_id_transaction": "transaction_id", "Payment_method_id_payment_method": "method_id",
        "transaction_has_payment_method_value": "value", "transaction_has_payment_method_MDR": "mdr",
    }),
    "detail_extends": ("transaction_detail_extend", {
        "id_transaction_detail_extend": "id", "Transaction_Detail_id_transaction_detail": "detail_id",
    }),
    "promos": ("Transaction_has_Promo", {
        "Transactions_id_transaction": "transaction_id", "M_Category_Promo_id_category_promo": "category_id",
        "transaction_promo_calculated_value": "value",
    }),
    "accounts": ("M_User", {"id_user": "id", "user_has_parent": "parent_id", "user_email": "email"}),
    "reservations": ("reservation", {
        "id": "id", "reservation_no": "reservation_no", "merchant_refno": "merchant_id", "outlet_refno": "outlet_id",
        "customer_id": "customer_id", "status": "status", "updated_at": "updated_at",
        "reservation_date": "reserved_on", "reservation_type": "type",
    }),
    "services": ("reservation_service", {
        "id": "id", "reservation_id": "reservation_id", "product_refno": "product_id",
        "reservation_service_date": "service_date", "reservation_service_start_time": "start_time",
        "reservation_service_end_time": "end_time", "employee_refno": "employee_id",
        "reservation_service_total_price": "total_price", "reservation_service_is_parent": "is_parent",
    }),
}

# Columns compared as text or read as dates, whatever the database calls them.
_CASTS = {"status": "string", "purpose": "string", "reserved_on": "date", "service_date": "date"}


def from_pos_tables(load: Callable[[str], DataFrame]) -> Source:
    """A source over tables that ``load`` finds by name, for example ``spark.table`` or a JDBC reader."""
    def builder(table: str, columns: Mapping[str, str]) -> Callable[[], DataFrame]:
        return lambda: load(table).select(
            *((F.col(old).cast(_CASTS[new]) if new in _CASTS else F.col(old)).alias(new) for old, new in columns.items()))

    return Source({name: builder(table, columns) for name, (table, columns) in POS_COLUMNS.items()})
