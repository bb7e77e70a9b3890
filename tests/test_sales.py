"""Per-transaction rules and rollups of the sales marts."""

from tallyspark.plans import sales, sales_net
from tests.shop import at, rows, shop


def one(df, *columns):
    found = rows(df, *columns)
    assert len(found) == 1, found
    return found[0]


def test_mixed_payments_take_change_off_cash_only(spark):
    source = shop(spark, transactions=[dict(id=1, cash_change=15)], payments=[
        dict(transaction_id=1, method_id=1, value=60, mdr=0), dict(transaction_id=1, method_id=2, value=55, mdr=2)])
    assert one(sales.sales_raw(source), "payment_value", "mdr") == (100.0, 2.0)


def test_cash_without_known_change_does_not_count(spark):
    source = shop(spark, transactions=[dict(id=1, cash_change=None)], payments=[
        dict(transaction_id=1, method_id=1, value=60), dict(transaction_id=1, method_id=None, value=5)])
    assert one(sales.sales_raw(source), "payment_value") == (5.0,)


def test_children_are_summed_before_the_join(spark):
    source = shop(
        spark, transactions=[dict(id=1), dict(id=2)],
        details=[dict(detail_id=1, transaction_id=1, quantity=2, unit_cost=10, total_price=30),
                 dict(detail_id=2, transaction_id=1, quantity=1, unit_cost=4, total_price=9)],
        addons=[dict(detail_id=1, quantity=2, material_quantity=3, unit_cost=5), dict(detail_id=1, unit_cost=7)],
        commissions=[dict(transaction_id=1, nominal=5), dict(transaction_id=1, nominal=6)],
        payments=[dict(transaction_id=1, value=10), dict(transaction_id=1, value=20)])
    columns = ("id_transaction", "product", "hpp_product", "gross_sales", "hpp_addon", "commission", "payment_value")
    assert rows(sales.sales_raw(source), *columns) == [
        (1, 3.0, 24.0, 39.0, 37.0, 11.0, 30.0), (2, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)]


def test_only_active_sales_enter_the_raw_mart(spark):
    source = shop(spark, transactions=[
        dict(id=1), dict(id=2, status="4"), dict(id=3, status="9"), dict(id=4, purpose="1"), dict(id=5, purpose="9"),
        dict(id=6, sold_at=at("1970-01-01", 0)), dict(id=7, status="2")])
    assert rows(sales.sales_raw(source), "id_transaction") == [(1,), (5,)]


def test_order_type_defaults(spark):
    source = shop(spark, transactions=[dict(id=1, order_type=None)])
    assert one(sales.sales_raw(source), "order_type") == (99,)


def test_refund_flag_and_transaction_count(spark):
    source = shop(spark, transactions=[
        dict(id=1), dict(id=2, refund=5), dict(id=3, refund_reason="wrong"), dict(id=4, refund_reason=""),
        dict(id=5, split_flag=1, payment_no=2, parent_receipt_no="N1"), dict(id=6, split_flag=1, payment_no=1),
        dict(id=7, split_flag=0, parent_receipt_no="N1"), dict(id=8, split_flag=None, refund=None)])
    assert rows(sales.sales_raw(source), "id_transaction", "is_refund", "count_transaction") == [
        (1, False, 1), (2, True, 0), (3, True, 0), (4, False, 1), (5, False, 0), (6, False, 1), (7, False, 1),
        (8, False, 1)]


def test_commission_needs_payment_and_an_own_bill(spark):
    source = shop(spark, commissions=[dict(transaction_id=i) for i in range(1, 6)], transactions=[
        dict(id=1), dict(id=2, paid_at=None), dict(id=3, split_flag=1, payment_no=2),
        dict(id=4, split_flag=1, payment_no=1), dict(id=5, split_flag=None)])
    assert rows(sales.sales_raw(source), "id_transaction", "commission") == [
        (1, 5.0), (2, 0.0), (3, 0.0), (4, 5.0), (5, 5.0)]


def test_gross_value_of_sales_and_refunds(spark):
    source = shop(
        spark, transactions=[dict(id=1, total=100), dict(id=2, total=40, refund=40)],
        details=[dict(detail_id=1, transaction_id=1, unit_cost=10), dict(detail_id=2, transaction_id=2, unit_cost=4)],
        commissions=[dict(transaction_id=1, nominal=6), dict(transaction_id=2, nominal=1)],
        payments=[dict(transaction_id=1, mdr=2, value=100), dict(transaction_id=2, mdr=1, value=40)])
    daily = sales.sales_daily(sales.sales_raw(source))
    assert one(daily, "sales_value", "gross_value", "payment_value", "refund", "commission", "transaction") == (
        100.0, (100 - 2 - 10 - 6) + (40 + 1 + 4 + 1), 100.0, 40.0, 5.0, 1)


def test_rollups_chain(spark):
    source = shop(spark, transactions=[
        dict(id=i, sold_at=at(f"20{22 + i % 2}-0{1 + i % 3}-1{i % 4}", i % 24), order_type=i % 2, outlet_id=i % 3,
             total=i * 7, refund=i if i % 5 == 0 else 0) for i in range(1, 60)])
    raw = sales.sales_raw(source)
    hourly, daily = sales.sales_hourly(raw), sales.sales_daily(raw)
    assert rows(sales.sales_daily_from_hourly(hourly)) == rows(daily)
    monthly = sales.sales_monthly(daily)
    yearly = sales.sales_yearly(monthly)
    for df in (hourly, daily, monthly, yearly):
        assert sum(r[0] for r in rows(df, "sales_value")) == sum(i * 7 for i in range(1, 60) if i % 5)
    assert yearly.count() == len({(i % 2, i % 3) for i in range(1, 60)})


def test_split_bill_parts_join_their_parent(spark):
    parts = dict(split_flag=1, payment_no=2, parent_receipt_no="N1")
    source = shop(
        spark, transactions=[
            dict(id=1, split_flag=1, payment_no=1, total=50, cash_change=4), dict(id=2, total=30, **parts),
            dict(id=3, total=20, status="9", **parts), dict(id=4, total=10, outlet_id=11, **parts),
            dict(id=5, total=70)],
        payments=[dict(transaction_id=1, value=50, mdr=1), dict(transaction_id=2, method_id=1, value=30, mdr=0),
                  dict(transaction_id=2, method_id=1, value=10, mdr=2)])
    children = sales_net.split_bill_children(source, source.transactions)
    # Parts of any status count, parts of another outlet do not; change is the parent's and goes off per cash row.
    assert rows(children, "id_transaction", "total", "mdr", "payment_value") == [(1, 50.0, 2.0, 32.0)]
    raw = sales_net.sales_net_raw(source)
    assert rows(raw, "id_transaction", "sales_value", "mdr", "payment_value") == [
        (1, 100.0, 3.0, 50.0), (5, 70.0, 0.0, 0.0)]


def test_refund_only_key_in_the_net_variant(spark):
    source = shop(
        spark, transactions=[dict(id=1, refund=25, total=25), dict(id=2, order_type=2, total=80),
                             dict(id=3, order_type=2, refund=10, total=10)],
        commissions=[dict(transaction_id=1, nominal=3), dict(transaction_id=2, nominal=7),
                     dict(transaction_id=3, nominal=2)])
    raw = sales_net.sales_net_raw(source)
    assert rows(sales_net.sales_net_daily(raw), "order_type", "sales_value", "gross_value", "refund", "commission",
                "transaction") == [(1, 0.0, -22.0, 25.0, -3.0, 0), (2, 80.0, 65.0, 10.0, 5.0, 1)]
    assert rows(sales_net.refund_only_keys(raw), "order_type") == [(1,)]


def test_a_hot_bill_is_combined_before_it_meets_its_parent(spark):
    parts = [dict(id=i, split_flag=1, payment_no=2, parent_receipt_no="N1", total=1) for i in range(2, 400)]
    source = shop(spark, transactions=[dict(id=1, split_flag=1, payment_no=1), *parts])
    children = sales_net.split_bill_children(source, source.transactions)
    assert rows(children, "id_transaction", "total") == [(1, 398.0)]
    plan = children._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
