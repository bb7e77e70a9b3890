"""One query per operator, each over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.functions import rules, times
from tallyspark.functions.money import as_doubles
from tallyspark.operators import changes, progress
from tallyspark.operators.aggregate import aggregate
from tallyspark.operators.keys import delete_range, distinct_keys, having_keys, upsert
from tallyspark.plans import compliment, jobs, refresh, reservation, sales, sales_net
from tallyspark.schema import (
    MartTable, SALES_DAILY, SALES_HOURLY, SALES_MONTHLY, SALES_RAW, SALES_YEARLY, SUMMARY_DAILY, SUMMARY_RAW, TAX_DAILY,
    TAX_MONTHLY, TAX_RAW, TAX_YEARLY, UTILIZATION_DAILY,
)
from tallyspark.session import Scratch, shared_dir, tune
from tallyspark.sinks.store import MartStore
from tallyspark.sources.jdbc import counted_frame, plan_slices
from tallyspark.sources.sample_tables import SampleTables
from tallyspark.sources.tables import Source
from tallyspark.streaming.change_stream import maintain, read_feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Windows that the increment, recovery and closing queries run on.
BATCH_START, BATCH_END = datetime(2001, 1, 1), datetime(2001, 12, 31)
EVENT_BATCH_START = datetime(2024, 1, 20)
RECOVERY = (datetime(1997, 3, 1), datetime(1997, 5, 31, 23, 59, 59))
RECOVERY_MERCHANT, RECOVERY_OUTLET = 2, 7
CLOSED_MONTH, CLOSED_YEAR = (1998, 4), 1999
NOW = datetime(2024, 2, 1)


def query(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register under the function's name; the function gets the sample tables, and its decimals leave as doubles."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return as_doubles(build(SampleTables(tune(spark), folder)))

    QUERIES[build.__name__] = run
    return build


def register(name: str, build: Callable[[SampleTables], DataFrame]) -> None:
    build.__name__ = name
    query(build)


# -- sales: extraction and summaries ---------------------------------------------------------------------------------

@query
def changed_transactions(t: SampleTables) -> DataFrame:
    rows = sales.changed_transactions(t.source(), BATCH_START, BATCH_END)
    return sales.batch_rows(rows).withColumns({"is_active": F.col("status") == "1"})


@query
def scoped_transactions(t: SampleTables) -> DataFrame:
    """A list of merchants, and one merchant with an outlet."""
    two = sales.changed_transactions(t.source(), *RECOVERY, mode="recovery", merchants=[1, 3])
    one = sales.changed_transactions(t.source(), *RECOVERY, mode="recovery", merchants=RECOVERY_MERCHANT,
                                     outlet=RECOVERY_OUTLET)
    return sales.batch_rows(two.unionByName(one)).drop("status")


@query
def product_summary(t: SampleTables) -> DataFrame:
    return sales.product_summary(t.source().details)


@query
def addon_costs(t: SampleTables) -> DataFrame:
    source = t.source()
    return sales.addon_costs(source.details, source.addons)


@query
def commission_summary(t: SampleTables) -> DataFrame:
    """Commission of the transactions that are paid and settle their own bill."""
    source = t.source()
    settled = sales.changed_transactions(source).filter(
        rules.is_active() & rules.settles_own_bill() & F.col("paid_at").isNotNull())
    summary = sales.commission_summary(source.commissions)
    return having_keys(summary, settled.select(F.col("id").alias("transaction_id")), ["transaction_id"])


@query
def payment_summary(t: SampleTables) -> DataFrame:
    source = t.source()
    trx = source.transactions.select(F.col("id").alias("transaction_id"), "cash_change")
    return sales.payment_summary(source.payments).join(trx, "transaction_id").select(
        "transaction_id", "mdr", sales.paid_value().alias("payment_value"))


def _store(t: SampleTables) -> MartStore:
    return MartStore(t.spark, f"{shared_dir(t.spark)}/marts", grain="month")


# -- marts from scratch ----------------------------------------------------------------------------------------------

def _full(mart: refresh.Mart, table: MartTable) -> Callable[[SampleTables], DataFrame]:
    return lambda t: refresh.full(mart, t.source())[table.name]


for _name, _mart, _table in (
    ("sales_raw", refresh.SALES, SALES_RAW), ("sales_hourly", refresh.SALES, SALES_HOURLY),
    ("sales_monthly", refresh.SALES, SALES_MONTHLY), ("sales_yearly", refresh.SALES, SALES_YEARLY),
    ("tax_raw", refresh.TAX, TAX_RAW), ("tax_daily", refresh.TAX, TAX_DAILY),
    ("tax_monthly", refresh.TAX, TAX_MONTHLY), ("tax_yearly", refresh.TAX, TAX_YEARLY),
    ("utilization_daily", refresh.UTILIZATION, UTILIZATION_DAILY),
    ("reservation_summary_raw", refresh.SUMMARY, SUMMARY_RAW),
    ("reservation_summary_daily", refresh.SUMMARY, SUMMARY_DAILY),
):
    register(_name, _full(_mart, _table))


@query
def sales_daily(t: SampleTables) -> DataFrame:
    return sales.sales_daily(sales.sales_raw(t.source()))


@query
def compliment_raw(t: SampleTables) -> DataFrame:
    return compliment.compliment_raw(t.source())


@query
def utilization_raw(t: SampleTables) -> DataFrame:
    return reservation.utilization_raw(t.source())


# -- net sales variant -----------------------------------------------------------------------------------------------

@query
def split_bill_children(t: SampleTables) -> DataFrame:
    source = t.source()
    return sales_net.split_bill_children(source, sales.changed_transactions(source))


@query
def sales_net_raw(t: SampleTables) -> DataFrame:
    return sales_net.sales_net_raw(t.source())


@query
def sales_net_hourly(t: SampleTables) -> DataFrame:
    return sales_net.sales_net_hourly(sales_net.sales_net_raw(t.source()))


@query
def sales_net_daily(t: SampleTables) -> DataFrame:
    return sales_net.sales_net_daily(sales_net.sales_net_raw(t.source()))


@query
def sales_net_monthly(t: SampleTables) -> DataFrame:
    return sales.sales_monthly(sales_net.sales_net_daily(sales_net.sales_net_raw(t.source())))


@query
def sales_net_yearly(t: SampleTables) -> DataFrame:
    daily = sales_net.sales_net_daily(sales_net.sales_net_raw(t.source()))
    return sales.sales_yearly(sales.sales_monthly(daily))


@query
def refund_only_keys_daily(t: SampleTables) -> DataFrame:
    return sales_net.refund_only_keys(sales_net.sales_net_raw(t.source()))


@query
def refund_only_keys_hourly(t: SampleTables) -> DataFrame:
    return sales_net.refund_only_keys(sales_net.sales_net_raw(t.source()), hourly=True)


@query
def grouped_measures(t: SampleTables) -> DataFrame:
    """The generic aggregate with subset, rename and column order."""
    raw = sales.sales_raw(t.source())
    return aggregate(
        raw, ["merchant_id", "order_type"], {"sales_value": "sum", "id_transaction": "count", "refund": "max"},
        only=["merchant_id", "order_type", "sales_value", "id_transaction", "refund"],
        rename={"id_transaction": "transactions", "refund": "largest_refund"},
        order=["merchant_id", "order_type", "transactions", "sales_value", "largest_refund"])


# -- keys of a batch -------------------------------------------------------------------------------------------------

def stored_transactions(t: SampleTables) -> DataFrame:
    """Transactions as they were before the batch: later ones are absent or had another day, type and status."""
    early, late = F.col("updated_at") < progress.moment(BATCH_START), F.col("updated_at") >= progress.moment(BATCH_START)
    return t.transactions().filter(early | (late & (F.col("id") % 2 == 0))).withColumns({
        "sold_at": F.when(late, F.col("sold_at") - F.make_dt_interval(days=F.lit(40))).otherwise(F.col("sold_at")),
        "order_type": F.when(late & (F.col("id") % 3 == 0), 1).otherwise(F.col("order_type")),
        "status": F.when(late, F.lit("1")).otherwise(F.col("status")),
    })


def stored_reservations(t: SampleTables) -> DataFrame:
    now = t.reservations()
    moved = now.filter((F.col("updated_at") >= progress.moment(EVENT_BATCH_START)) & (F.col("id") % 2 == 0)).withColumns({
        "reserved_on": F.date_sub("reserved_on", 3), "outlet_id": (F.col("outlet_id") + 1) % 3,
        "status": F.when(F.col("status") == 100, 700).otherwise(F.col("status")),
    })
    return now.filter(F.col("updated_at") < progress.moment(EVENT_BATCH_START)).unionByName(moved)


def before_batch(t: SampleTables) -> Source:
    return t.source().replacing(transactions=stored_transactions(t), reservations=stored_reservations(t))


def _batch_keys(t: SampleTables, *key: str) -> DataFrame:
    """Keys of a batch, and whether any of its rows is active there (rebuild) or none is (delete)."""
    rows = sales.batch_rows(sales.changed_transactions(t.source(), BATCH_START, BATCH_END))
    return rows.groupBy("merchant_id", "outlet_id", "order_type", *key).agg(
        F.max(F.col("status") == "1").alias("rebuild"))


@query
def batch_hourly_keys(t: SampleTables) -> DataFrame:
    return _batch_keys(t, "date", "hour")


@query
def batch_daily_keys(t: SampleTables) -> DataFrame:
    return _batch_keys(t, "date")


def _late_rows(t: SampleTables) -> DataFrame:
    # The batch of this window reaches into it from sales of the month before.
    rows = sales.changed_transactions(t.source(), datetime(2000, 1, 1), BATCH_END)
    return sales.batch_rows(rows).filter("status = '1'")


@query
def late_month_keys(t: SampleTables) -> DataFrame:
    late = _late_rows(t).filter(times.before_month("year", "month", BATCH_START.date()))
    return distinct_keys(late, key=["merchant_id", "outlet_id", "order_type", "year", "month"])


@query
def late_year_keys(t: SampleTables) -> DataFrame:
    late = _late_rows(t).filter(times.before_year("year", BATCH_START.date()))
    return distinct_keys(late, key=["merchant_id", "outlet_id", "order_type", "year"])


def _previous(t: SampleTables, mart: refresh.Mart, clock_start: datetime) -> DataFrame:
    raw = mart.raw_rows(before_batch(t), None)
    ids = mart.source_rows(t.source()).filter(rules.within("updated_at", clock_start, None))
    return refresh.steer(refresh.stored_rows(raw, mart, ids))


@query
def previous_daily_keys(t: SampleTables) -> DataFrame:
    return distinct_keys(_previous(t, refresh.SALES, BATCH_START), key=SALES_DAILY.key)


@query
def previous_hourly_keys(t: SampleTables) -> DataFrame:
    return distinct_keys(_previous(t, refresh.SALES, BATCH_START), key=SALES_HOURLY.key)


@query
def previous_utilization_keys(t: SampleTables) -> DataFrame:
    return distinct_keys(_previous(t, refresh.UTILIZATION, EVENT_BATCH_START), key=UTILIZATION_DAILY.key)


@query
def affected_daily_keys(t: SampleTables) -> DataFrame:
    """Keys the batch is stored under now, or was stored under before."""
    source = t.source()
    batch = source.transactions.filter(rules.within("updated_at", BATCH_START, None))
    touched = refresh.touched_keys(refresh.SALES, _previous(t, refresh.SALES, BATCH_START).select(*SALES_RAW.column_names),
                                   sales.sales_raw(source, batch))
    return refresh.level_keys(touched, SALES_DAILY)


# -- marts after a batch ---------------------------------------------------------------------------------------------

def _loaded(t: SampleTables, mart: refresh.Mart, source: Source) -> MartStore:
    """A store that holds a mart as it was for an earlier state of the source."""
    store = _store(t)
    jobs.initial_load(store, mart, source, BATCH_START, NOW)
    return store


def _rows(store: MartStore, table: MartTable) -> DataFrame:
    return store.load(table).select(*table.column_names)


def _after(mart: refresh.Mart, table: MartTable, start: datetime) -> Callable[[SampleTables], DataFrame]:
    """Stored marts brought up to date by one increment."""
    def build(t: SampleTables) -> DataFrame:
        some = mart.up_to(table)
        store = _loaded(t, some, before_batch(t))
        jobs.run_increment(store, some, t.source(), start, NOW, NOW)
        return _rows(store, table)

    return build


for _name, _mart, _table, _start in (
    ("sales_raw_after_batch", refresh.SALES, SALES_RAW, BATCH_START),
    ("sales_hourly_after_batch", refresh.SALES, SALES_HOURLY, BATCH_START),
    ("sales_daily_after_batch", refresh.SALES, SALES_DAILY, BATCH_START),
    ("sales_monthly_after_batch", refresh.SALES, SALES_MONTHLY, BATCH_START),
    ("sales_yearly_after_batch", refresh.SALES, SALES_YEARLY, BATCH_START),
    ("sales_net_daily_after_batch", refresh.SALES_NET, SALES_DAILY, BATCH_START),
    ("tax_daily_after_batch", refresh.TAX, TAX_DAILY, BATCH_START),
    ("tax_monthly_after_batch", refresh.TAX, TAX_MONTHLY, BATCH_START),
    ("compliment_raw_after_batch", refresh.COMPLIMENT, refresh.COMPLIMENT.raw, BATCH_START),
    ("utilization_daily_after_batch", refresh.UTILIZATION, UTILIZATION_DAILY, EVENT_BATCH_START),
    ("reservation_summary_daily_after_batch", refresh.SUMMARY, SUMMARY_DAILY, EVENT_BATCH_START),
):
    register(_name, _after(_mart, _table, _start))


LATE_BATCH = (datetime(1998, 7, 1), datetime(1998, 7, 7, 23, 59, 59))


@query
def sales_daily_after_late_ids(t: SampleTables) -> DataFrame:
    """A narrow batch: the sales that changed in one week, found by the ledger among all ids."""
    mart, late = refresh.SALES.up_to(SALES_DAILY), rules.within("updated_at", *LATE_BATCH)
    early = t.transactions().withColumns({
        "sold_at": F.when(late & (F.col("id") % 2 == 0), F.col("sold_at") - F.make_dt_interval(days=F.lit(90))).otherwise(F.col("sold_at")),
        "total": F.when(late, F.col("total") + 1).otherwise(F.col("total")).cast("decimal(12,2)")})
    store = _loaded(t, mart, t.source().replacing(transactions=early.filter(~(late & (F.col("id") % 3 == 0)))))
    jobs.run_increment(store, mart, t.source(), *LATE_BATCH, NOW)
    return _rows(store, SALES_DAILY)


@query
def tax_daily_sequence_resumed(t: SampleTables) -> DataFrame:
    """Runs over a year, each from where the log says that the last one stopped; one dies before its record and is repeated."""
    mart, old = refresh.TAX.up_to(TAX_DAILY), t.transactions().filter(F.col("updated_at") < progress.moment(BATCH_START))
    store = _loaded(t, mart, t.source().replacing(transactions=old))
    for step in range(4):
        if step == 1:
            died = store.begin(mart.name)
            died.put(TAX_DAILY, store.places(TAX_DAILY, old.limit(0).select(F.to_date("sold_at").alias("date"))), store.load(TAX_DAILY))
            died.replace_where(TAX_DAILY, store.load(TAX_DAILY).select("p_month").distinct().limit(1).collect(), F.lit(True),
                               store.load(TAX_DAILY).limit(0))
        jobs.run_sequence(store, mart, t.source(), 100 * 1440, NOW, until=NOW)
    return _rows(store, TAX_DAILY)


@query
def run_log_of_a_sequence(t: SampleTables) -> DataFrame:
    """The log that such runs leave: windows, rows seen and closing flags."""
    mart, old = refresh.TAX, t.transactions().filter(F.col("updated_at") < progress.moment(BATCH_START))
    store = _loaded(t, mart, t.source().replacing(transactions=old))
    for _ in range(2):
        jobs.run_sequence(store, mart, t.source(), 100 * 1440, NOW, until=NOW)
    return store.history(mart.name).select("id", "ts_current", "ts_end", "num_row", "done_monthly", "done_yearly")


@query
def upserted_daily(t: SampleTables) -> DataFrame:
    """Daily rows of the current source put over those of the stored one."""
    old = SALES_DAILY.conform(sales.sales_daily(sales.sales_raw(before_batch(t))))
    new = SALES_DAILY.conform(sales.sales_daily(sales.sales_raw(t.source())))
    return upsert(old, new, SALES_DAILY.key)


# -- period closing and recovery -------------------------------------------------------------------------------------

def _closed(mart: refresh.Mart, table: MartTable, year: int, month: int | None = None):
    """Stored marts whose days are up to date and whose months and years are those of before; one period is closed."""
    def build(t: SampleTables) -> DataFrame:
        some = mart.up_to(table)
        store = _loaded(t, some, before_batch(t))
        finer = some.levels[-1].by_key_from or some.levels[-1].parent
        jobs.run_recovery(store, mart.up_to(finer), t.source(), datetime(1970, 1, 1), NOW)
        begin = datetime(year + 1, 1, 1, 1) if month is None else datetime(year, month + 1, 1, 1)
        jobs.close_periods(store, some, jobs.Batch(begin, begin, 1), month is None, month is not None)
        return _rows(store, table)

    return build


for _name, _mart, _table, _period in (
    ("sales_month_closed", refresh.SALES, SALES_MONTHLY, (2001, 2)),
    ("sales_year_closed", refresh.SALES, SALES_YEARLY, (2001,)),
    ("tax_month_closed", refresh.TAX, TAX_MONTHLY, (2001, 2)),
    ("tax_year_closed", refresh.TAX, TAX_YEARLY, (2001,)),
):
    register(_name, _closed(_mart, _table, *_period))


def _stale(t: SampleTables) -> Source:
    """A source that was wrong about one merchant in the recovery range."""
    wrong = rules.within("sold_at", *RECOVERY) & (F.col("merchant_id") == RECOVERY_MERCHANT)
    return t.source().replacing(transactions=t.transactions().withColumns({
        "order_type": F.when(wrong & (F.col("id") % 3 == 0), 1).otherwise(F.col("order_type")),
        "total": F.when(wrong, F.col("total") * 2).otherwise(F.col("total")).cast("decimal(12,2)"),
        "status": F.when(wrong, F.lit("1")).otherwise(F.col("status")),
    }))


def _recovered(mart: refresh.Mart, table: MartTable):
    """Stored marts of a stale source after a recovery of its range."""
    def build(t: SampleTables) -> DataFrame:
        some = mart.up_to(table)
        store = _loaded(t, some, _stale(t))
        jobs.run_recovery(store, some, t.source(), *RECOVERY, merchants=RECOVERY_MERCHANT)
        return _rows(store, table)

    return build


for _name, _mart, _table in (
    ("sales_hourly_recovered", refresh.SALES, SALES_HOURLY), ("sales_daily_recovered", refresh.SALES, SALES_DAILY),
    ("sales_monthly_recovered", refresh.SALES, SALES_MONTHLY), ("sales_yearly_recovered", refresh.SALES, SALES_YEARLY),
    ("tax_daily_recovered", refresh.TAX, TAX_DAILY), ("tax_yearly_recovered", refresh.TAX, TAX_YEARLY),
):
    register(_name, _recovered(_mart, _table))


def _without_range(t: SampleTables, outlet: int | None = None) -> Source:
    gone = rules.within("sold_at", *RECOVERY) & rules.merchant_scope(RECOVERY_MERCHANT, outlet)
    return t.source().replacing(transactions=t.transactions().filter(~gone))


@query
def sales_daily_cleared(t: SampleTables) -> DataFrame:
    """Recovery of an outlet for which the source has nothing left in the range."""
    mart = refresh.SALES.up_to(SALES_DAILY)
    store = _loaded(t, mart, t.source())
    jobs.run_recovery(store, mart, _without_range(t, RECOVERY_OUTLET), *RECOVERY, merchants=RECOVERY_MERCHANT,
                      outlet=RECOVERY_OUTLET)
    return _rows(store, SALES_DAILY)


@query
def sales_monthly_cleared(t: SampleTables) -> DataFrame:
    mart = refresh.SALES.up_to(SALES_MONTHLY)
    store = _loaded(t, mart, t.source())
    jobs.run_recovery(store, mart, _without_range(t), *RECOVERY, merchants=RECOVERY_MERCHANT)
    return _rows(store, SALES_MONTHLY)


@query
def utilization_range_deleted(t: SampleTables) -> DataFrame:
    daily = reservation.utilization_daily(reservation.utilization_raw(t.source()))
    return delete_range(daily, "2024-01-05", "2024-01-12", merchants=RECOVERY_MERCHANT)


@query
def utilization_recovered(t: SampleTables) -> DataFrame:
    """Reservations of ten days rebuilt over marts that had other statuses for them."""
    start, end = datetime(2024, 1, 5), datetime(2024, 1, 14)
    wrong = rules.within("reserved_on", start, end)
    stale = t.source().replacing(reservations=t.reservations().withColumns({
        "status": F.when(wrong & (F.col("id") % 2 == 0), 700).otherwise(F.col("status")),
        "outlet_id": F.when(wrong & (F.col("id") % 5 == 0), 0).otherwise(F.col("outlet_id")).cast("bigint")}))
    store = _loaded(t, refresh.UTILIZATION, stale)
    jobs.run_recovery(store, refresh.UTILIZATION, t.source(), start, end)
    return _rows(store, UTILIZATION_DAILY)


# Recoveries of a range in which the source has altered, moved and lost rows since they were stored.
SALE_RECOVERY = (datetime(2000, 1, 1), datetime(2001, 12, 31, 23, 59, 59))
BOOKING_RECOVERY = (datetime(2024, 1, 1), datetime(2024, 1, 31, 23, 59, 59))


def _shifted(t: SampleTables) -> Source:
    """A source as it was when some rows had another day, and when rows were there that it has lost since."""
    sold = rules.within("sold_at", *SALE_RECOVERY)
    booked = rules.within("reserved_on", *BOOKING_RECOVERY)
    transactions, reservations, services = t.transactions(), t.reservations(), t.services()
    lost = transactions.filter(sold & (F.col("id") % 23 == 5)).withColumn("id", F.col("id") + F.lit(1_000_000_000))
    lost_bookings = reservations.filter(booked & (F.col("id") % 23 == 5)).withColumn("id", F.col("id") + F.lit(1_000_000_000))
    day = F.make_dt_interval(days=F.lit(1))
    return t.source().replacing(
        transactions=transactions.withColumns({
            "sold_at": F.when(sold & (F.col("id") % 7 == 0), F.col("sold_at") + day).otherwise(F.col("sold_at")),
            "total": F.when(sold & (F.col("id") % 11 == 0), 1).otherwise(F.col("total")).cast("decimal(12,2)"),
        }).unionByName(lost),
        promos=t.promos().unionByName(_again(t.promos(), "transaction_id")),
        reservations=reservations.withColumns({
            "reserved_on": F.when(booked & (F.col("id") % 7 == 0), F.date_add("reserved_on", 1)).otherwise(F.col("reserved_on")),
            "status": F.when(booked & (F.col("id") % 11 == 0), 700).otherwise(F.col("status")),
        }).unionByName(lost_bookings),
        services=services.withColumn("service_date", F.when(
            rules.within("service_date", *BOOKING_RECOVERY) & (F.col("id") % 7 == 0), F.date_add("service_date", 1)).otherwise(
            F.col("service_date"))).unionByName(_again(services, "reservation_id")))


def _again(children: DataFrame, parent: str) -> DataFrame:
    """The children of the rows that are lost."""
    return children.filter(F.col(parent) % 23 == 5).withColumn(parent, F.col(parent) + F.lit(1_000_000_000))


def _recovered_from_shifted(mart: refresh.Mart, table: MartTable):
    """The range is that of the mart's recovery clock; what was stored in it and isn't there any more goes, too."""
    def build(t: SampleTables) -> DataFrame:
        some, booked = mart.up_to(table), mart.entity == "reservations"
        store = _loaded(t, some, _shifted(t))
        jobs.run_recovery(store, some, t.source(), *(BOOKING_RECOVERY if booked else SALE_RECOVERY))
        return _rows(store, table)

    return build


for _name, _mart, _table in (
    ("sales_yearly_recovered_after_moves", refresh.SALES, SALES_YEARLY), ("tax_monthly_recovered_after_moves", refresh.TAX, TAX_MONTHLY),
    ("sales_net_daily_recovered_after_moves", refresh.SALES_NET, SALES_DAILY),
    ("utilization_daily_recovered_after_moves", refresh.UTILIZATION, UTILIZATION_DAILY),
    ("reservation_summary_daily_recovered_after_moves", refresh.SUMMARY, SUMMARY_DAILY),
):
    register(_name, _recovered_from_shifted(_mart, _table))


@query
def covered_months(t: SampleTables) -> DataFrame:
    """Months between the first and last sale of every outlet."""
    span = t.transactions().groupBy("outlet_id").agg(
        F.to_date(F.min("sold_at")).alias("first"), F.to_date(F.max("sold_at")).alias("last"))
    months = span.select("outlet_id", F.explode(times.months_covered("first", "last")).alias("month_start"))
    return months.select("outlet_id", "month_start", F.year("month_start").alias("year"),
                         F.month("month_start").alias("month"))


@query
def account_lookup(t: SampleTables) -> DataFrame:
    accounts = t.accounts()
    return jobs.owner_of(accounts, accounts)


# -- progress --------------------------------------------------------------------------------------------------------

def run_log(t: SampleTables) -> DataFrame:
    """A run log as long as the event table: several runs stop at the same hour."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return t.table("events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("actdate"), hour.alias("ts_current"), hour.alias("ts_end"),
        (F.col("event_id") % 100).alias("num_row"), F.col("value").alias("time_process"), F.col("props").alias("params"),
        (F.col("event_type") != "error").alias("done_monthly"), (F.col("event_type") != "signup").alias("done_yearly"),
        F.col("event_type").alias("mart_param"))


@query
def next_sequence_window(t: SampleTables) -> DataFrame:
    steps = [progress.next_window(run_log(t), m).withColumn("minutes", F.lit(m)) for m in (1, 5, 45, 120)]
    return steps[0].unionByName(steps[1]).unionByName(steps[2]).unionByName(steps[3])


@query
def next_period_window(t: SampleTables) -> DataFrame:
    early = progress.next_period(run_log(t), 600, datetime(2024, 1, 31, 1))
    return early.unionByName(progress.next_period(run_log(t), 600, datetime(2024, 3, 1)))


@query
def overlapping_windows(t: SampleTables) -> DataFrame:
    """Every logged window with its start moved back, as seen from the middle of the month."""
    windows = run_log(t).select("id", F.col("ts_current").alias("window_start"),
                                (F.col("ts_end") + F.make_dt_interval(mins=F.lit(5))).alias("window_end"))
    return progress.reach_back(windows, progress.moment(datetime(2024, 1, 16, 12, 3)))


@query
def batch_watermark(t: SampleTables) -> DataFrame:
    batch = sales.changed_transactions(t.source(), BATCH_START, BATCH_END)
    return progress.batch_watermark(batch, BATCH_START, BATCH_END, NOW)


@query
def empty_batch_watermark(t: SampleTables) -> DataFrame:
    """Windows after the last change: one in the past, one that reaches beyond the present."""
    late = (datetime(2023, 1, 1), datetime(2023, 1, 2))
    batch = sales.changed_transactions(t.source(), *late)
    return progress.batch_watermark(batch, *late, NOW).unionByName(
        progress.batch_watermark(batch, *late, datetime(2023, 1, 1, 12)))


@query
def period_closing(t: SampleTables) -> DataFrame:
    runs = t.transactions().select(
        "id", F.col("sold_at").alias("ts_current"),
        (F.col("updated_at") + F.make_dt_interval(days=(F.col("id") % 40).cast("int"))).alias("ts_end"),
        (F.col("id") % 2 == 0).alias("done_monthly"), (F.col("id") % 3 == 0).alias("done_yearly"))
    return progress.period_closing(runs)


@query
def calendar_functions(t: SampleTables) -> DataFrame:
    return t.transactions().select(
        "id", times.stamp("sold_at").alias("stamp"), F.year("sold_at").alias("year"), F.month("sold_at").alias("month"),
        F.to_date("sold_at").alias("date"), F.hour("sold_at").alias("hour"),
        times.first_of_month("sold_at").alias("first_day"), times.last_of_month("sold_at").alias("last_day"),
        times.previous_month("sold_at").alias("month_before"), times.local_to_utc("sold_at").alias("utc"),
        times.utc_to_local("sold_at").alias("local"))


# -- change events ---------------------------------------------------------------------------------------------------

def change_feed(t: SampleTables) -> DataFrame:
    """A change event per row of the event table, spread over four partitions; every 50th is not JSON."""
    row = F.struct(F.col("event_id").alias("id_transaction"), "user_id", "event_type")
    envelope = F.to_json(F.struct(row.alias("before"), F.when(F.col("event_type") != "error", row).alias("after")))
    return t.table("events").select(
        F.when(F.col("event_id") % 50 == 49, "{broken").otherwise(envelope).alias("value"),
        (F.col("event_id") % 4).cast("int").alias("partition"), F.floor(F.col("event_id") / 4).alias("offset"))


@query
def cdc_decode(t: SampleTables) -> DataFrame:
    return changes.decode_changes(change_feed(t))


@query
def cdc_decode_with_keys(t: SampleTables) -> DataFrame:
    return changes.decode_changes(change_feed(t), extra=["user_id", "event_type"], as_text=True)


@query
def cdc_latest(t: SampleTables) -> DataFrame:
    """Users stand in for ids that change many times in one batch."""
    decoded = changes.decode_changes(change_feed(t), id_field="user_id").withColumn(
        "offset", F.col("offset") * 4 + F.col("partition"))
    return changes.latest_changes(decoded)


@query
def cdc_offsets(t: SampleTables) -> DataFrame:
    return changes.reached_offsets(change_feed(t))


@query
def cdc_resumed(t: SampleTables) -> DataFrame:
    """Events of a feed that is read in three overlapping stretches, the second one first: each event once."""
    feed, applied, taken = change_feed(t).select("partition", "offset"), {}, []
    feed = feed.join(changes.reached_offsets(feed).withColumnRenamed("offset", "last"), "partition")
    for low, high in ((0.3, 0.7), (0.0, 0.5), (0.6, 1.0)):
        some = feed.filter((F.col("offset") >= F.col("last") * low) & (F.col("offset") <= F.col("last") * high))
        new = changes.not_applied(some.select("partition", "offset"), applied)
        applied = changes.with_ranges(applied, [tuple(r) for r in changes.reached_ranges(new).collect()])
        taken.append(new)
    return taken[0].unionByName(taken[1]).unionByName(taken[2]).groupBy("partition", "offset").agg(F.count("*").alias("times"))


@query
def transactions_in_slices(t: SampleTables) -> DataFrame:
    """A table read by the planned slices of a skewed key, row by row.

    The cube of an id outgrows a bigint from 2,097,152 on, so slices are planned and read by its exact decimal; the result
    has the key as a bigint, null where no bigint holds it.
    """
    cube = F.expr("cast(id AS decimal(38,0)) * id * id").cast("decimal(38,0)")
    skewed = Scratch(t.spark).keep(t.transactions().select("id", cube.alias("key")), "skewed")
    low, high, rows = skewed.agg(F.min("key"), F.max("key"), F.count("*")).first()
    slices = plan_slices(counted_frame(skewed, "key"), "key", low, high, rows)
    parts = [skewed.filter(s) for s in slices]
    times = reduce(DataFrame.unionByName, parts).groupBy("id", "key").agg(F.count("*").alias("times"))
    return times.withColumn("key", F.expr("try_cast(key AS bigint)"))


# -- stored marts and streams ----------------------------------------------------------------------------------------

@query
def sales_daily_published(t: SampleTables) -> DataFrame:
    """Stored and read back under the published names."""
    store = _store(t)
    return SALES_DAILY.publish(store.append(SALES_DAILY, sales.sales_daily(sales.sales_raw(t.source()))))


@query
def reservation_summary_stored(t: SampleTables) -> DataFrame:
    """A stored mart taken over a batch by key replacement."""
    store, mart = _store(t), refresh.SUMMARY
    jobs.initial_load(store, mart, before_batch(t), EVENT_BATCH_START, NOW)
    jobs.run_increment(store, mart, t.source(), EVENT_BATCH_START, NOW, NOW)
    return store.load(SUMMARY_DAILY).select(*SUMMARY_DAILY.column_names)


def _stream(t: SampleTables, mart: refresh.Mart, table: MartTable) -> DataFrame:
    """Stored marts of the source before the batch, brought up to date by a stream of its change events.

    Every ninth changed transaction is deleted, so its event has no image and the source no longer has the row.
    """
    store, folder = _store(t), shared_dir(t.spark)
    jobs.initial_load(store, mart, before_batch(t), BATCH_START, NOW)
    gone = F.col("id") % 9 == 4
    changed = t.transactions().filter(rules.within("updated_at", BATCH_START, None))
    row = F.struct(F.col("id").alias("id_transaction"))
    events = changed.select(
        F.to_json(F.struct(row.alias("before"), F.when(~gone, row).alias("after"))).alias("value"),
        (F.col("id") % 2).cast("int").alias("partition"), F.col("id").alias("offset"))
    events.repartition(2, "partition").write.json(f"{folder}/feed")
    living = t.source().replacing(transactions=t.transactions().filter(
        ~(rules.within("updated_at", BATCH_START, None) & gone)))
    feed = read_feed(t.spark, "json", {"path": f"{folder}/feed", "maxFilesPerTrigger": "1"})
    stream = maintain(store, mart, lambda: living, feed, f"{folder}/checkpoint", clock=lambda: NOW)
    stream.awaitTermination()
    return store.load(table).select(*table.column_names)


@query
def tax_daily_streamed(t: SampleTables) -> DataFrame:
    return _stream(t, refresh.TAX, TAX_DAILY)


@query
def sales_hourly_streamed(t: SampleTables) -> DataFrame:
    return _stream(t, refresh.SALES, SALES_HOURLY)
