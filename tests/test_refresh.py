"""Incremental upkeep: after any changes the marts equal a full recompute."""

import random
from datetime import datetime, timedelta
from glob import glob

import pytest
from pyspark.sql import functions as F

from tallyspark.plans import jobs, refresh
from tallyspark.schema import SALES_DAILY, SALES_HOURLY, SALES_MONTHLY, SALES_RAW, SALES_YEARLY, TAX_DAILY
from tallyspark.session import Scratch
from tallyspark.sinks.store import MartStore
from tests.shop import at, rows, shop

NOW = datetime(2023, 8, 1)


def contents(df, table):
    return rows(df, *(c for c in table.column_names))


def stored_files(folder, mart):
    """The files of a store, without the log."""
    return sorted(glob(f"{folder}/*mart*/**/*.parquet", recursive=True))


def assert_same_as_full(store, mart, source, tables=None):
    expected = refresh.full(mart, source)
    for table in tables or mart.tables:
        assert contents(store.load(table), table) == contents(expected[table.name], table), table.name


def loaded(spark, folder, mart, source, grain="month"):
    store = MartStore(spark, folder, grain=grain)
    jobs.initial_load(store, mart, source, at("2023-06-01", 0), NOW)
    return store


JUNE = (at("2023-06-01", 0), at("2023-06-30", 0))


def sale(id, day="2023-05-10", hour=12, changed="2023-06-02", **more):
    return dict(id=id, sold_at=at(day, hour), updated_at=at(changed), **more)


def test_cancelling_one_of_two_keeps_the_other(spark, folder):
    before = shop(spark, transactions=[sale(1, total=100), sale(2, total=30)])
    after = shop(spark, transactions=[sale(1, total=100, changed="2023-05-11"), sale(2, total=30, status="4")])
    store = loaded(spark, folder, refresh.TAX, before)
    jobs.run_increment(store, refresh.TAX, after, *JUNE, NOW)
    assert rows(store.load(TAX_DAILY), "transaction_value") == [(100.0,)]
    assert_same_as_full(store, refresh.TAX, after)


def test_moved_sale_leaves_its_old_keys_right(spark, folder):
    before = shop(spark, transactions=[sale(1, total=100), sale(2, total=30), sale(3, day="2022-12-31", total=5)])
    after = shop(spark, transactions=[
        sale(1, total=100, changed="2023-05-11"), sale(2, day="2023-04-03", hour=9, order_type=3, total=30),
        sale(3, day="2023-01-01", total=5)])
    store = loaded(spark, folder, refresh.SALES, before)
    jobs.run_increment(store, refresh.SALES, after, *JUNE, NOW)
    assert_same_as_full(store, refresh.SALES, after, [SALES_RAW, SALES_HOURLY, SALES_DAILY, SALES_MONTHLY])
    # The emptied partition is gone, not just empty of this row.
    assert store.load(SALES_RAW).filter("p_month = '2022-12'").count() == 0


def test_running_month_waits_for_its_closing(spark, folder):
    before = shop(spark, transactions=[sale(1, changed="2023-05-10")])
    after = shop(spark, transactions=[sale(1, changed="2023-05-10"), sale(2, day="2023-06-05", total=7),
                                      sale(3, day="2023-05-20", total=9)])
    store = loaded(spark, folder, refresh.SALES, before)
    jobs.run_increment(store, refresh.SALES, after, *JUNE, NOW)
    assert rows(store.load(SALES_MONTHLY), "month", "sales_value") == [(5, 109.0)]
    # The published year is right although June is not published.
    assert rows(store.load(SALES_YEARLY), "year", "sales_value") == [(2023, 116.0)]
    batch = jobs.Batch(at("2023-07-01"), at("2023-07-01", 13), 1)
    assert jobs.close_periods(store, refresh.SALES, batch, False, True) == (True, True)
    assert rows(store.load(SALES_MONTHLY), "month", "sales_value") == [(5, 109.0), (6, 7.0)]


def test_delete_only_batch_and_vanished_ids(spark, folder):
    before = shop(spark, transactions=[sale(1, total=100), sale(2, total=30), sale(3, day="2023-05-11")])
    after = shop(spark, transactions=[sale(1, total=100)])
    store = loaded(spark, folder, refresh.TAX, before)
    changes = spark.createDataFrame([(2, True), (3, True), (77, True)], "id bigint, deleted boolean")
    batch = jobs.run_changes(store, refresh.TAX, after, changes, NOW)
    assert batch == jobs.Batch(None, None, 0)
    assert_same_as_full(store, refresh.TAX, after)
    empty = changes.limit(0)
    assert jobs.run_changes(store, refresh.TAX, after, empty, NOW).num_row == 0


def test_a_batch_applied_twice_changes_nothing(spark, folder):
    before = shop(spark, transactions=[sale(i, total=i) for i in range(1, 6)])
    after = shop(spark, transactions=[sale(i, total=i * 2, day=f"2023-05-1{i}") for i in range(1, 5)])
    store = loaded(spark, folder, refresh.TAX, before, grain="day")
    jobs.run_increment(store, refresh.TAX, after, *JUNE, NOW)
    once = {t.name: contents(store.load(t), t) for t in refresh.TAX.tables}
    jobs.run_increment(store, refresh.TAX, after, *JUNE, NOW)
    assert once == {t.name: contents(store.load(t), t) for t in refresh.TAX.tables}


@pytest.mark.parametrize("seed, mart", [(1, refresh.SALES), (2, refresh.SALES_NET), (3, refresh.TAX)], ids=lambda x: getattr(x, "name", x))
def test_random_changes_equal_a_full_recompute(spark, folder, seed, mart):
    """Upserts, cancellations, moves, merchant changes and unknown amounts, in three successive batches."""
    draw = random.Random(seed)

    def fresh(id, changed):
        return dict(
            id=id, merchant_id=draw.choice([1, 1, 1, 2]), outlet_id=draw.choice([10, 11]), updated_at=changed,
            sold_at=at("2021-11-20", draw.randrange(24 * 60)), order_type=draw.choice([None, 1, 2]),
            status=draw.choice("1114"), purpose=draw.choice(["5", "9", "9", "1"]), total=draw.choice([None, draw.randrange(1, 500)]),
            refund=draw.choice([0, 0, 0, 12]), split_flag=draw.choice([0, None, 1]), payment_no=draw.choice([0, 1, 2]),
            parent_receipt_no=draw.choice([None, None, f"N{draw.randrange(1, 70)}"]), tax_nominal=draw.choice([None, 3]),
            paid_at=draw.choice([None, at("2022-01-01")]))

    start = at("2022-03-01", 0)
    table = {i: fresh(i, start - timedelta(days=1)) for i in range(1, 50)}
    children = dict(
        details=[dict(detail_id=i, transaction_id=draw.randrange(1, 70), unit_cost=draw.randrange(9)) for i in range(150)],
        addons=[dict(detail_id=draw.randrange(150), unit_cost=2) for _ in range(40)],
        commissions=[dict(transaction_id=draw.randrange(1, 70), nominal=draw.randrange(9)) for _ in range(60)],
        payments=[dict(transaction_id=draw.randrange(1, 70), method_id=draw.choice([1, 2])) for _ in range(90)])
    store = loaded(spark, folder, mart, shop(spark, transactions=[dict(r) for r in table.values()], **children))
    for step in range(3):
        begin = start + timedelta(days=step)
        for id in draw.sample(range(1, 70), 15):
            table[id] = fresh(id, begin + timedelta(hours=1))
        source = shop(spark, transactions=[dict(r) for r in table.values()], **children)
        jobs.run_increment(store, mart, source, begin, begin + timedelta(hours=2), NOW)
    expected = refresh.full(mart, source)
    for t in mart.tables:
        got, wanted = contents(store.load(t), t), contents(expected[t.name], t)
        if "date" not in t.calendar:
            # Keys of the running month or year that were not published yet are still to come.
            year, month = t.column_names.index("year"), t.column_names.index("month") if "month" in t.key else None
            due = [r for r in wanted if r in got or (r[year], r[month] if month else 0) < (2022, 3 if month else 0)]
            assert got == due, t.name
        else:
            assert got == wanted, t.name
    for t in mart.tables[1:]:  # the tallies are those of a new load
        again = refresh.level_rows(mart, next(x for x in mart.levels if x.table == t), mart.raw, store.load(mart.raw))
        here = rows(store.load(t), *t.key, *t.tallies)
        assert set(here) <= set(rows(again, *t.key, *t.tallies)), t.name


def test_levels_read_no_finer_partition(spark, folder, monkeypatch):
    """A batch of known keys is carried up by its delta alone, and a repeated one writes nothing."""
    before = shop(spark, transactions=[sale(1, total=100), sale(2, total=30), sale(3, day="2023-04-02", total=5)])
    after = shop(spark, transactions=[sale(1, total=70), sale(2, total=30, status="4"), sale(3, day="2023-04-02", total=6)])
    store, opened = loaded(spark, folder, refresh.SALES, before), []
    read = MartStore.read

    def noted(self, table, parts, elsewhere):
        opened.append((table.name, parts is not None))
        return read(self, table, parts, elsewhere)

    monkeypatch.setattr(MartStore, "read", noted)
    jobs.run_increment(store, refresh.SALES, after, *JUNE, NOW)
    assert all(limited for _, limited in opened)
    # Old rows and the rest of their partitions; of each level its own partitions once.
    assert [opened.count((t.name, True)) for t in refresh.SALES.tables] == [2, 1, 1, 1, 1]
    assert_same_as_full(store, refresh.SALES, after)
    files = stored_files(folder, refresh.SALES)
    jobs.run_increment(store, refresh.SALES, after, *JUNE, NOW)
    assert stored_files(folder, refresh.SALES) == files


def test_look_ups_open_the_partitions_that_the_ledger_names(spark, folder):
    many = [sale(i, day=f"2023-0{1 + i % 5}-1{i % 9}", changed="2023-05-30") for i in range(1, 60)]
    store = loaded(spark, folder, refresh.TAX, shop(spark, transactions=[dict(r) for r in many]), grain="day")
    late, new = sale(7, day="2023-06-03"), sale(4_000_007, day="2023-06-04")
    ids = spark.createDataFrame([(7,), (4_000_007,)], "id bigint")
    known = jobs.located(store, refresh.TAX, ids)
    assert len(known.inputFiles()) == 1 and rows(known, "id") == [(7,)]
    assert len(jobs.raw_of(store, refresh.TAX, known, ids).inputFiles()) == 1
    files = set(stored_files(folder, refresh.TAX))
    now = shop(spark, transactions=[dict(r) for r in many if r["id"] != 7] + [late, new])
    jobs.run_increment(store, refresh.TAX, now, *JUNE, NOW)
    written = {f.split("/p_")[-1].split("/")[0] for f in set(stored_files(folder, refresh.TAX)) - files if "raw" in f and "ledger" not in f}
    assert written == {"day=2023-03-17", "day=2023-06-03", "day=2023-06-04"} - {
        "day=2023-03-17" if not any(r["id"] != 7 and r["sold_at"] == many[6]["sold_at"] for r in many) else ""}
    assert_same_as_full(store, refresh.TAX, now, [refresh.TAX.raw, TAX_DAILY])


def test_recovery_repairs_a_range_and_only_that(spark, folder):
    stale = shop(spark, transactions=[
        sale(1, total=1), sale(2, total=2, outlet_id=11), sale(3, day="2023-05-12", total=3), sale(9, total=99)])
    now = shop(spark, transactions=[
        sale(1, total=100), sale(2, total=200, outlet_id=11), sale(3, day="2023-05-12", total=300)])
    store = loaded(spark, folder, refresh.TAX, stale)
    jobs.run_recovery(store, refresh.TAX, now, at("2023-05-10", 0), at("2023-05-11", 0), merchants=1, outlet=10)
    # Id 9 left the source and is found by its place in the range; the other outlet and day stay stale.
    assert rows(store.load(refresh.TAX.raw), "id_transaction", "transaction_value") == [(1, 100.0), (2, 2.0), (3, 3.0)]
    jobs.run_recovery(store, refresh.TAX, now, at("2023-05-01", 0), at("2023-05-31", 0), merchants=[1, 5])
    assert_same_as_full(store, refresh.TAX, now)


def test_recovery_of_an_empty_range_clears_it(spark, folder):
    stale = shop(spark, transactions=[sale(1), sale(2, day="2023-04-10"), sale(3, merchant_id=2)])
    now = shop(spark, transactions=[sale(3, merchant_id=2)])
    store = loaded(spark, folder, refresh.SALES, stale)
    batch = jobs.run_recovery(store, refresh.SALES, now, at("2023-04-01", 0), at("2023-05-31", 0), merchants=1)
    assert batch.num_row == 0
    assert_same_as_full(store, refresh.SALES, now)


def test_reservation_marts_follow_status_changes(spark, folder):
    services = [dict(id=i, reservation_id=i) for i in range(1, 5)]
    before = shop(spark, services=services, reservations=[
        dict(id=i, status=s) for i, s in enumerate(["700", "700", "9", "100"], start=1)])
    changed = dict(updated_at=at("2023-06-02"))
    after = shop(spark, services=services, reservations=[
        dict(id=1, status="700"), dict(id=2, status="15", **changed), dict(id=3, status="700", outlet_id=3, **changed),
        dict(id=4, status="9", **changed)])
    for mart in (refresh.UTILIZATION, refresh.SUMMARY):
        store = loaded(spark, f"{folder}/{mart.name}", mart, before)
        jobs.run_increment(store, mart, after, *JUNE, NOW)
        assert_same_as_full(store, mart, after)


def test_compliments_follow_cancellations(spark, folder):
    promos = [dict(transaction_id=1), dict(transaction_id=2)]
    store = loaded(spark, folder, refresh.COMPLIMENT, shop(spark, promos=promos, transactions=[sale(1), sale(2)]))
    after = shop(spark, promos=promos, transactions=[sale(1, status="9"), sale(2)])
    jobs.run_increment(store, refresh.COMPLIMENT, after, *JUNE, NOW)
    assert rows(store.load(refresh.COMPLIMENT.raw), "transaction_id") == [(2,)]


def test_a_changed_part_refreshes_the_head_of_its_bill(spark, folder):
    head, part = dict(split_flag=1, payment_no=1), dict(split_flag=1, payment_no=2, parent_receipt_no="N1")
    before = shop(spark, transactions=[sale(1, total=50, changed="2023-05-10", **head), sale(2, total=30, **part)])
    after = shop(spark, transactions=[sale(1, total=50, changed="2023-05-10", **head), sale(2, total=35, **part)])
    mart = refresh.SALES_NET.up_to(SALES_DAILY)
    store = loaded(spark, folder, mart, before)
    jobs.run_increment(store, mart, after, *JUNE, NOW)
    assert rows(store.load(SALES_DAILY), "sales_value", "transaction") == [(85.0, 1)]


def bills(spark, *parts):
    head = dict(split_flag=1, payment_no=1, changed="2023-05-10")
    return shop(spark, transactions=[sale(1, total=50, **head), sale(2, total=70, **head), *[
        sale(i, total=30 + i, split_flag=1, payment_no=2, parent_receipt_no=on, **more) for i, on, more in parts]])


def test_parts_that_are_deleted_or_move_leave_their_old_head(spark, folder):
    old = dict(changed="2023-05-10")
    store = loaded(spark, folder, refresh.SALES_NET, bills(spark, (3, "N1", old), (4, "N1", old), (5, "N2", old)))
    moved = bills(spark, (3, "N2", {}), (5, "N2", old))
    jobs.run_changes(store, refresh.SALES_NET, moved, spark.createDataFrame(
        [(3, False), (4, True)], "id bigint, deleted boolean"), NOW)
    assert_same_as_full(store, refresh.SALES_NET, moved)
    assert rows(store.load(refresh.SALES_NET.raw), "id_transaction", "sales_value") == [(1, 50.0), (2, 138.0)]
    back = bills(spark, (3, "N1", {}), (5, "N2", old))
    jobs.run_increment(store, refresh.SALES_NET, back, *JUNE, NOW)
    assert_same_as_full(store, refresh.SALES_NET, back)
    assert rows(store.load(refresh.SALES_NET.links), "id_transaction", "parent_receipt_no") == [(3, "N1"), (5, "N2")]


def test_a_net_batch_reads_the_children_of_its_bills_only(spark, folder):
    old = dict(changed="2023-05-10")
    source = bills(spark, (3, "N1", old), (900, "N2", {}))
    batch = refresh.SALES_NET.batch(source, source.transactions.filter("id = 900"))
    near = refresh.SALES_NET.bound(source, batch, Scratch(spark).keep)
    assert rows(near.transactions, "id") == [(900,)]
    plan = refresh.SALES_NET.raw_rows(near, batch)._jdf.queryExecution().optimizedPlan().toString()
    paid = [x for x in plan.split("Aggregate [transaction_id")[1:] if "mdr" in x.split("\n")[0]]
    assert paid and all(">= 900" in x or "= 900" in x for x in paid)


def die_at(monkeypatch, name, calls=0):
    """The driver is lost at one of the calls of a function of the store."""
    real, count = getattr(MartStore, name), [0]

    def failing(self, *args, **more):
        count[0] += 1
        if count[0] > calls:
            raise RuntimeError("driver lost")
        return real(self, *args, **more)

    monkeypatch.setattr(MartStore, name, failing)


@pytest.mark.parametrize("name, calls", [("write", 0), ("write", 2), ("write", 4), ("put_in_place", 0), ("put_in_place", 3)])
def test_a_run_that_dies_anywhere_is_all_old_or_all_new(spark, folder, monkeypatch, name, calls):
    mart = refresh.TAX
    before = shop(spark, transactions=[sale(1, total=100), sale(2, total=30), sale(3, day="2023-04-02", total=5)])
    after = shop(spark, transactions=[sale(1, total=100, changed="2023-05-11"), sale(2, total=30, status="4"),
                                      sale(3, day="2023-03-02", total=5)])
    store = loaded(spark, folder, mart, before)
    with monkeypatch.context() as patch:
        die_at(patch, name, calls)
        with pytest.raises(RuntimeError):
            jobs.run_increment(store, mart, after, *JUNE, NOW)
    assert_same_as_full(store, mart, before if name == "write" else after)
    jobs.settle(store, mart)
    assert_same_as_full(store, mart, before if name == "write" else after)
    jobs.run_increment(store, mart, after, *JUNE, NOW)
    assert_same_as_full(store, mart, after)


@pytest.mark.parametrize("name, calls", [("write", 0), ("write", 2), ("put_in_place", 0), ("put_in_place", 2)])
def test_links_are_not_lost_with_a_run_that_is_left_out(spark, folder, monkeypatch, name, calls):
    """A part moves to another bill and the run dies; without its replay the part is deleted."""
    old, mart = dict(changed="2023-05-10"), refresh.SALES_NET
    store = loaded(spark, folder, mart, bills(spark, (3, "N1", old)))
    moved = bills(spark, (3, "N2", {}))
    with monkeypatch.context() as patch:
        die_at(patch, name, calls)
        with pytest.raises(RuntimeError):
            jobs.run_increment(store, mart, moved, *JUNE, NOW)
    jobs.settle(store, mart)
    gone = bills(spark)
    jobs.run_changes(store, mart, gone, spark.createDataFrame([(3, True)], "id bigint, deleted boolean"), NOW)
    assert_same_as_full(store, mart, gone)


def changed_days(before, after):
    return sorted({f.split("p_day=")[1].split("/")[0] for f in set(before) ^ set(after) if "p_day=" in f})


@pytest.mark.parametrize("mart", [refresh.SALES, refresh.SALES_NET, refresh.TAX, refresh.COMPLIMENT], ids=lambda m: m.name)
def test_a_years_recovery_rewrites_the_days_that_differ(spark, folder, mart):
    """One altered, one moved and one deleted row among many."""
    promos = [dict(transaction_id=i) for i in range(1, 40)]
    stored = [sale(i, day=f"2023-0{1 + i % 6}-1{i % 7}", changed=f"2023-0{1 + i % 6}-1{i % 7}") for i in range(1, 40)]
    store = loaded(spark, folder, mart, shop(spark, promos=promos, transactions=[dict(r) for r in stored]), grain="day")
    now = {r["id"]: dict(r) for r in stored}
    now[5] |= dict(total=999, item_count=9)
    now[12] |= dict(sold_at=at("2022-12-24"))
    del now[20]
    source = shop(spark, promos=promos, transactions=list(now.values()))
    files = stored_files(folder, mart)
    jobs.run_recovery(store, mart, source, at("2023-01-01", 0), at("2023-12-31", 0))
    assert_same_as_full(store, mart, source)
    touched = {str(r["sold_at"].date()) for r in stored if r["id"] in (5, 12, 20)} | {"2022-12-24"}
    assert changed_days(files, stored_files(folder, mart)) == sorted(touched)


@pytest.mark.parametrize("mart", [refresh.UTILIZATION, refresh.SUMMARY], ids=lambda m: m.name)
def test_recovery_of_reservations_that_moved_or_are_gone(spark, folder, mart):
    def booked(id, day, status="700"):
        when = at(day)
        return dict(id=id, reserved_on=when.date(), updated_at=when, status=status), dict(id=id, reservation_id=id, service_date=when.date())

    def source(*rows):
        return shop(spark, reservations=[r for r, _ in rows], services=[s for _, s in rows])

    days = [booked(i, f"2023-05-{10 + i % 5}") for i in range(1, 12)]
    store = loaded(spark, folder, mart, source(*days), grain="day")
    files = stored_files(folder, mart)
    now = source(*days[:3], booked(4, "2023-04-03"), booked(5, "2023-05-10", "15"), *days[6:])  # 6 is deleted
    jobs.run_recovery(store, mart, now, at("2023-05-01", 0), at("2023-05-31", 0))
    assert_same_as_full(store, mart, now)
    assert changed_days(files, stored_files(folder, mart)) == ["2023-04-03", "2023-05-10", "2023-05-11", "2023-05-14"]


def test_a_recovery_can_sum_levels_anew(spark, folder):
    source = shop(spark, transactions=[sale(1, total=100), sale(2, total=30, day="2023-04-02")])
    store = loaded(spark, folder, refresh.TAX, source)
    broken = store.begin("broken")
    broken.replace_where(TAX_DAILY, store.load(TAX_DAILY).select("p_month").distinct().collect(), F.lit(True), store.load(TAX_DAILY).limit(0))
    broken.commit()
    jobs.run_recovery(store, refresh.TAX, source, at("2023-04-01", 0), at("2023-05-31", 0))
    assert store.load(TAX_DAILY).isEmpty()  # the raw rows are what they should be
    jobs.run_recovery(store, refresh.TAX, source, at("2023-04-01", 0), at("2023-05-31", 0), resum=True)
    assert_same_as_full(store, refresh.TAX, source)


def test_recovery_keeps_rows_that_moved_out_of_its_range(spark, folder):
    stale = shop(spark, transactions=[sale(1), sale(2, total=5)])
    now = shop(spark, transactions=[sale(1), sale(2, day="2023-04-20", total=5, merchant_id=3)])
    store = loaded(spark, folder, refresh.TAX, stale)
    jobs.run_recovery(store, refresh.TAX, now, at("2023-05-01", 0), at("2023-05-31", 0))
    assert_same_as_full(store, refresh.TAX, now)


def test_every_month_that_a_batch_spans_is_closed(spark, folder):
    first = [sale(1, day="2022-11-10", changed="2022-11-10")]
    spread = [*first, *(sale(10 + i, day=d, changed=d) for i, d in enumerate(("2022-11-20", "2022-12-20", "2023-01-20", "2023-02-20")))]
    store = MartStore(spark, folder, "month")
    jobs.initial_load(store, refresh.TAX, shop(spark, transactions=first), at("2022-11-15", 0), NOW)
    jobs.run_sequence(store, refresh.TAX, shop(spark, transactions=spread), 200 * 1440, NOW)
    later = [*spread, sale(20, day="2023-02-25", changed="2023-06-20")]
    jobs.run_sequence(store, refresh.TAX, shop(spark, transactions=later), 200 * 1440, NOW)
    raw, days, months, years = refresh.TAX.tables
    assert_same_as_full(store, refresh.TAX, shop(spark, transactions=later), [raw, days, months])
    assert rows(store.load(years), "year") == [(2022,)]  # the year that is over


def test_runs_for_some_merchants_close_their_own_periods(spark, folder):
    """Runs for one merchant and for all, in turn, over the end of a year."""
    def sold(id, day, merchant):
        return sale(id, day=day, changed=day, merchant_id=merchant, total=id)

    first = [sold(1, "2022-11-10", 1), sold(2, "2022-11-10", 2)]
    later = [*first, *(sold(10 * m + i, d, m) for m in (1, 2) for i, d in enumerate(
        ("2022-11-20", "2022-12-20", "2023-01-20", "2023-02-20")))]
    store, mart = MartStore(spark, folder, "month"), refresh.TAX
    jobs.initial_load(store, mart, shop(spark, transactions=[dict(r) for r in first]), at("2022-11-15", 0), NOW)
    source = shop(spark, transactions=later)
    raw, days, months, years = mart.tables
    expected = refresh.full(mart, source)

    def over(table, merchants, month=2):
        """Rows of the full marts for periods before a month of 2023."""
        place = [table.column_names.index(c) for c in table.calendar]
        return [r for r in contents(expected[table.name], table)
                if r[0] in merchants and tuple(r[i] for i in place) < (2023, month)[:len(place)]]

    jobs.run_sequence(store, mart, source, 90 * 1440, NOW, merchants="1")  # to January
    jobs.run_sequence(store, mart, source, 40 * 1440, NOW)                 # all merchants to December
    jobs.run_sequence(store, mart, source, 90 * 1440, NOW, merchants="1")  # to February
    assert [r for r in contents(store.load(months), months) if r[0] == 1] == over(months, {1}, 1)
    assert [r for r in contents(store.load(years), years) if r[0] == 1] == over(years, {1})
    jobs.run_sequence(store, mart, source, 90 * 1440, NOW)
    jobs.run_sequence(store, mart, source, 90 * 1440, NOW)                 # closes what the last one saw the end of
    assert_same_as_full(store, mart, source, [raw, days])
    assert contents(store.load(months), months) == over(months, {1, 2})
    assert contents(store.load(years), years) == over(years, {1, 2})


def test_a_null_in_a_key_is_a_key(spark, folder):
    store = loaded(spark, folder, refresh.TAX, shop(spark, transactions=[sale(1, total=100, outlet_id=None)]))
    now = shop(spark, transactions=[sale(1, total=70, outlet_id=None)])
    jobs.run_increment(store, refresh.TAX, now, *JUNE, NOW)
    assert_same_as_full(store, refresh.TAX, now)


def test_a_loaded_mart_is_not_loaded_again(spark, folder, monkeypatch):
    source = shop(spark, transactions=[sale(1), sale(2)])
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "write_log", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            loaded(spark, folder, refresh.TAX, source)
    store = loaded(spark, folder, refresh.TAX, source)
    assert_same_as_full(store, refresh.TAX, source)
    with pytest.raises(ValueError):
        loaded(spark, folder, refresh.TAX, source)


def test_runs_for_some_merchants_leave_the_others_to_do(spark, folder):
    store = MartStore(spark, folder, "month")
    jobs.initial_load(store, refresh.TAX, shop(spark, transactions=[sale(1, changed="2023-05-10")]), at("2023-06-01", 0), NOW)
    now = shop(spark, transactions=[sale(1, changed="2023-05-10"), sale(2, merchant_id=2, changed="2023-06-02"),
                                    sale(3, changed="2023-06-02")])
    jobs.run_sequence(store, refresh.TAX, now, 3 * 1440, NOW, merchants="1")
    assert rows(store.load(refresh.TAX.raw), "id_transaction") == [(1,), (3,)]
    jobs.run_sequence(store, refresh.TAX, now, 3 * 1440, NOW)
    assert rows(store.load(refresh.TAX.raw), "id_transaction") == [(1,), (2,), (3,)]


def test_children_are_limited_before_they_are_summed(spark):
    source = shop(spark, transactions=[sale(1)], details=[dict(detail_id=1, transaction_id=1)])
    for build in (refresh.SALES.raw_rows, refresh.TAX.raw_rows):
        plan = build(source, source.transactions.filter("id = 1"))._jdf.queryExecution().optimizedPlan().toString()
        child = next(x for x in plan.split("Aggregate [detail_id")[1:])
        assert "LeftSemi" in child.split("Aggregate")[0]


def test_bad_clock_and_status_texts_are_nulls(spark, folder):
    source = shop(spark, reservations=[dict(id=1), dict(id=2, status="x")],
                  services=[dict(id=1, reservation_id=1, start_time="09:30"), dict(id=2, reservation_id=1, end_time="")])
    assert rows(refresh.UTILIZATION.raw_rows(source, None), "id_reservation_detail", "duration") == [(1, 0), (2, 0)]
    assert refresh.SUMMARY.raw_rows(source, None).count() == 1


def test_recovery_by_account(spark, folder):
    accounts = [dict(id=1, email="head@x"), dict(id=7, parent_id=1, email="till@x")]
    stale = shop(spark, transactions=[sale(1, total=1), sale(2, total=2, merchant_id=2)])
    now = shop(spark, accounts=accounts, transactions=[sale(1, total=100), sale(2, total=200, merchant_id=2)])
    store, month = loaded(spark, folder, refresh.TAX, stale), (at("2023-05-01", 0), at("2023-05-31", 0))
    assert jobs.run_account_recovery(store, refresh.TAX, now, "nobody@x", *month) is None
    assert jobs.run_account_recovery(store, refresh.TAX, now, "till@x", *month).num_row == 1
    assert rows(store.load(refresh.TAX.raw), "id_transaction", "transaction_value") == [(1, 100.0), (2, 2.0)]


def test_a_recovery_that_misses_nothing_does_not_ask_the_source_again(spark):
    """Ids that have left a range are looked for by their ranges; where there are none, no table is read."""
    found = spark.range(100).withColumn("total", F.col("id") * 2)
    asked = jobs.elsewhere(found, spark.createDataFrame([], "id long"))
    assert "Range" not in asked._jdf.queryExecution().optimizedPlan().toString() and asked.count() == 0
    gone = spark.createDataFrame([(7,), (None,), (90,), (400,)], "id long")
    assert rows(jobs.elsewhere(found, gone)) == [(7, 14), (90, 180)]


def test_the_days_that_differ_are_kept_before_ids_meet_them(spark):
    scratch, names = Scratch(spark), []

    def keep(df, name):
        names.append(name)
        return scratch.keep(df, name)

    day, other = NOW.date(), (NOW - timedelta(days=1)).date()
    new = spark.createDataFrame([(1, 1, 1, day, 1, 5), (2, 1, 1, day, 1, 6), (3, 1, 1, other, 1, 7)],
                                "id long, merchant_id long, outlet_id long, date date, rows long, digest int")
    known = new.withColumn("digest", F.when(F.col("id") == 2, 9).otherwise(F.col("digest")))
    try:
        assert rows(refresh.changed_ids(new, known, True, keep)) == [(2,)] and names == ["days"]
    finally:
        scratch.clean()
