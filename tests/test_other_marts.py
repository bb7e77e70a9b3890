"""Tax, compliment, utilization and reservation rules."""

from datetime import date

import pytest

from tallyspark.functions.rules import tax_base_type
from tallyspark.plans import compliment, jobs, reservation, tax
from tests.shop import rows, shop


@pytest.mark.parametrize("text, base", [
    ("", 1), (None, 1), ("{bad", 1), ("{}", 1), ('{"tax_base_type": 0}', 1), ('{"tax_base_type": 2}', 2),
    ('{"tax_base_type": "3"}', 3), ('{"tax_base_type": "x"}', 1), ('{"tax_base_type": null}', 1),
])
def test_tax_base_from_json(spark, text, base):
    df = spark.createDataFrame([(text,)], "type_detail string")
    assert df.select(tax_base_type()).first()[0] == base


def test_one_extended_line_switches_to_line_taxes(spark):
    source = shop(
        spark, transactions=[dict(id=1, tax_nominal=11), dict(id=2, tax_nominal=12), dict(id=3, tax_nominal=13)],
        details=[dict(detail_id=1, transaction_id=1), dict(detail_id=2, transaction_id=1),
                 dict(detail_id=3, transaction_id=2)],
        detail_extends=[dict(id=1, detail_id=2)])
    assert rows(tax.tax_raw(source), "id_transaction", "tax_value", "tax_product") == [
        (1, 4.0, 2.0), (2, 12.0, 1.0), (3, 13.0, 0.0)]


def test_a_line_counts_once_per_extension(spark):
    source = shop(spark, transactions=[dict(id=1)], details=[dict(detail_id=1, transaction_id=1)],
                  detail_extends=[dict(id=i, detail_id=1) for i in range(3)])
    assert rows(tax.tax_raw(source), "tax_value", "tax_product") == [(6.0, 3.0)]


def test_tax_skips_refunds_and_missing_receipts(spark):
    source = shop(spark, transactions=[dict(id=1), dict(id=2, refund=1), dict(id=3, receipt_no=None)])
    assert rows(tax.tax_raw(source), "id_transaction") == [(1,)]


def test_compliment_rules(spark):
    source = shop(
        spark, transactions=[dict(id=1, item_count=None), dict(id=2, purpose="9"), dict(id=3, auth_id=None),
                             dict(id=4, cashier_id=None), dict(id=5), dict(id=6, status="9")],
        promos=[dict(transaction_id=i) for i in (1, 2, 3, 4, 6)]
        + [dict(transaction_id=1, value=4), dict(transaction_id=5, category_id=3)])
    raw = compliment.compliment_raw(source)
    assert rows(raw, "transaction_id", "value", "product_qty") == [(1, 4.0, 0)]
    first, again = raw.select("no").first(), compliment.compliment_raw(source).select("no").first()
    assert first == again
    random = compliment.compliment_raw(source, random_key=True).select("no").first()
    assert random != first and len(random["no"]) == 36


@pytest.mark.parametrize("start, end, minutes", [
    ("10:00:00", "11:30:00", 90), ("23:30:00", "00:30:00", 1380), ("10:00:00", "10:00:29", 0),
    ("10:00:00", "10:00:30", 1), ("10:00:00", None, 0),
])
def test_duration(spark, start, end, minutes):
    source = shop(spark, reservations=[dict(id=1)], services=[
        dict(id=1, reservation_id=1, start_time=start, end_time=end)])
    assert rows(reservation.utilization_raw(source), "duration") == [(minutes,)]


def test_utilization_takes_main_services_of_utilized_reservations(spark):
    source = shop(
        spark, reservations=[dict(id=1), dict(id=2, status="9"), dict(id=3, status="15"), dict(id=4, status="100")],
        services=[dict(id=i, reservation_id=i) for i in (1, 2, 3, 4)]
        + [dict(id=5, reservation_id=1, is_parent=0), dict(id=6, reservation_id=1, total_price=None),
           dict(id=7, reservation_id=1, service_date=None)])
    raw = reservation.utilization_raw(source)
    assert rows(raw, "id_reservation_detail") == [(1,), (2,), (6,), (7,)]
    assert rows(reservation.utilization_daily(raw), "employee_id", "duration", "price") == [(4, 270, 100.0)]


def test_reservation_classes(spark):
    source = shop(spark, reservations=[
        dict(id=i, status=s) for i, s in enumerate(["700", "15", "9", "100", "700"], start=1)])
    daily = reservation.summary_daily(reservation.summary_raw(source))
    assert rows(daily, "date", "status", "total") == [
        (date(2023, 5, 10), 1, 2), (date(2023, 5, 10), 2, 1), (date(2023, 5, 10), 3, 1)]


def test_account_owner(spark):
    source = shop(spark, accounts=[dict(id=1, email="a"), dict(id=2, parent_id=1, email="b")])
    assert [rows(jobs.owner_of(source.accounts, e), "merchant_id") for e in ("a", "b", "c")] == [[(1,)], [(1,)], []]
