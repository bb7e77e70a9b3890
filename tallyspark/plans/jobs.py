"""Jobs on stored marts: increment, recovery, change batch, period closing."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tallyspark.functions import rules, times
from tallyspark.operators import progress
from tallyspark.operators.deltas import changed_by, merged, totals
from tallyspark.operators.keys import having_keys, lacking_keys
from tallyspark.plans.refresh import (
    Level, Mart, changed_ids, finished, in_period, ledger_rows, level_keys, level_rows, link_places, old_links, over, raw_delta, steer,
    stored_rows, touched_keys,
)
from tallyspark.schema import MartTable
from tallyspark.session import Scratch
from tallyspark.sinks.store import Batch as Changes, MartStore
from tallyspark.sources.tables import RESERVATION_CHILDREN, TRANSACTION_CHILDREN, Source, id_ranges, in_ranges


@dataclass(frozen=True)
class Batch:
    """What a run did: its watermark and the number of source rows."""

    ts_current: datetime | None
    ts_end: datetime | None
    num_row: int


def settle(store: MartStore, mart: Mart) -> None:
    """Finish what a run that died has left: a batch that was committed is put in place, any other is dropped."""
    store.settle(mart.name)


def stored_links(store: MartStore, mart: Mart, ids: DataFrame, also: Column | None = None) -> DataFrame | None:
    """The stored links of some ids, and of those that meet a condition."""
    if mart.links is None:
        return None
    links = store.load(mart.links).select(*mart.links.column_names)
    near = in_ranges(mart.links.key[0], id_ranges(ids))
    return old_links(mart, links.filter(near if also is None else near | F.coalesce(also, F.lit(False))), ids, also)


def located(store: MartStore, mart: Mart, ids: DataFrame) -> DataFrame:
    """What the ledger knows of some ids: only the partitions of their ranges are opened."""
    ledger = store.load(mart.ledger, store.places(mart.ledger, ids))
    return having_keys(ledger.select(*mart.ledger.column_names), ids, ["id"])


def raw_of(store: MartStore, mart: Mart, known: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored raw rows of some ids, from the partitions that the ledger names for them."""
    return stored_rows(store.load(mart.raw, store.places(mart.raw, known)), mart, ids)


def refresh_stored(store: MartStore, mart: Mart, source: Source, entity: DataFrame, ids: DataFrame, *, before: date | None = None,
                   by_day: bool = False, resum: bool = False, linked: DataFrame | None = None) -> int:
    """Bring the stored tables of a mart up to date for one batch of source rows; returns how many ids were changed.

    ``entity`` holds the source rows as they are now, ``ids`` everything that may have changed, deleted rows included. Ids
    whose raw rows are what the ledger knows of them are left out, so a window that overlaps the last one doesn't write
    again what that has written. Of the others the new raw rows are kept apart, so that all rows travel once to meet their ids,
    and the old ones are found by the ledger's places. Levels take the old rows off and add the new ones, key by key; ``resum`` sums the touched keys from the finer level instead, for levels that may
    be wrong themselves. ``by_day`` compares whole days before ids. All tables are put in place by one record.
    """
    batch, scratch = store.begin(mart.name), Scratch(store.spark)
    try:
        entity = scratch.keep(entity, "entity") if mart.widen else entity  # else the caller has kept it
        ids = scratch.keep(ids.select("id").distinct(), "ids")
        children = RESERVATION_CHILDREN if mart.entity == "reservations" else TRANSACTION_CHILDREN
        near = mart.bound(source, entity, scratch.keep) if mart.bound else nearby(source, entity, children, scratch)
        rows = scratch.keep(mart.raw_rows(near, entity), "rows")
        new, known = scratch.keep(ledger_rows(mart, rows), "new"), scratch.keep(located(store, mart, ids), "known")
        changed = ids if resum else scratch.keep(changed_ids(new, known, by_day, scratch.keep), "changed")
        count, low = changed.agg(F.count("*"), F.min("id")).first()
        if count:
            # All ids pass. As a filter it tells Spark that they may be few of the table's, so that their Bloom filter is asked.
            few = changed if low is None else changed.filter(F.coalesce("id", F.lit(low)) >= low)
            rows = stored_rows(rows, mart, few)
            rows = rows if resum else scratch.keep(rows, "fresh")
            doomed = scratch.keep(raw_of(store, mart, having_keys(known, few, ["id"]), few).select(*mart.raw.column_names), "doomed")
            places = [*mart.raw.key, *mart.raw.calendar]
            batch.replace(mart.raw, doomed.select(*places).union(rows.select(*places)).distinct(), rows)
            batch.replace(mart.ledger, changed, ledger_rows(mart, rows))
            carry_up(store, batch, mart, doomed, rows, scratch, before, resum)
        if mart.links:
            replace_links(store, batch, mart, ids if linked is None else linked.select(F.col(mart.links.key[0]).alias("id")).union(ids),
                          mart.link_rows(entity), scratch)
        batch.commit()
        return count
    finally:
        scratch.clean()


def nearby(source: Source, entity: DataFrame, children: Mapping[str, str], scratch: Scratch) -> Source:
    """The source limited to what a batch can need."""
    ranges = id_ranges(entity)
    return (source.narrowed(entity, ranges, scratch.keep) if children is TRANSACTION_CHILDREN else source).near_ids(ranges, children)


def carry_up(store: MartStore, batch: Changes, mart: Mart, doomed: DataFrame, rows: DataFrame, scratch: Scratch,
             before: date | None, resum: bool) -> None:
    """Stage every level after a batch.

    Hours and days are complete, so a delta is all they need. Months and years may not be published: with ``before``, those
    still running at that day get no new keys until they are closed, and keys that are new to the others are summed from
    the finer level, as the delta knows only this batch. What is published stays right.
    """
    if not mart.levels:
        return
    touched = scratch.keep(touched_keys(mart, doomed, rows), "touched") if resum else None
    delta = None if resum else scratch.keep(raw_delta(mart, doomed, rows), "delta")
    for level in mart.levels:
        table = level.table
        own = level_keys(touched, table) if resum else scratch.keep(changed_by(table, totals(table, delta)), table.name)
        absent = own if resum else None
        parts = store.places(table, own)
        stored = store.load(table, parts)
        if table.calendar != ("date",):
            known = having_keys(own, stored, table.key)
            fresh = lacking_keys(own, stored, table.key)
            fresh = fresh if before is None else fresh.filter(over(table, before))
            own, absent = (known, known.unionByName(fresh)) if resum else (known, fresh)
        content = lacking_keys(stored, own, table.key) if resum else merged(table, stored, own)
        if absent is not None and not absent.isEmpty():
            finer = level.by_key_from or level.parent
            found = having_keys(steer(store.near(finer, batch.load(finer), absent)), absent, table.key)
            content = content.select(*table.key, *table.sums, *table.tallies).unionByName(
                level_rows(mart, level, finer, found).select(*table.key, *table.sums, *table.tallies))
        batch.put(table, parts, finished(table, content))


def replace_links(store: MartStore, batch: Changes, mart: Mart, ids: DataFrame, new: DataFrame, scratch: Scratch) -> None:
    """Stage the links of a batch, as far as they aren't stored already."""
    columns = mart.links.column_names
    old = scratch.keep(stored_links(store, mart, ids.distinct()).select(*columns), "old_links")
    new = scratch.keep(mart.links.conform(new), "new_links")
    differ = scratch.keep(link_places(mart, lacking_keys(old, new, columns), lacking_keys(new, old, columns)), "differ")
    batch.replace(mart.links, differ, having_keys(new, differ, mart.links.key))


def run_increment(store: MartStore, mart: Mart, source: Source, start: datetime, end: datetime, now: datetime, *,
                  merchants: Sequence[int] | int | None = None, outlet: int | None = None) -> Batch:
    """One window on the change time. Months and years still running at its start wait for their closing.

    The changed rows are read once: a live source may answer a second question differently.
    """
    clock, scratch = mart.clocks["etl"], Scratch(store.spark)
    try:
        changed = scratch.keep(mart.source_rows(source).filter(
            rules.within(clock, start, end) & rules.merchant_scope(merchants, outlet)), "changed")
        mark = progress.batch_watermark(changed, start, end, now, clock).first()
        if mark["num_row"]:
            settle(store, mart)
            batch = mart.batch(source, changed, stored_links(store, mart, changed))
            refresh_stored(store, mart, source, batch, batch, before=start.date())
    finally:
        scratch.clean()
    return Batch(mark["ts_current"], mark["ts_end"], mark["num_row"])


def run_changes(store: MartStore, mart: Mart, source: Source, changes: DataFrame, now: datetime) -> Batch:
    """A batch of changed ids (columns ``id`` and ``deleted``). Deletions alone are a batch, too."""
    if changes.isEmpty():
        return Batch(None, None, 0)
    settle(store, mart)
    scratch = Scratch(store.spark)
    try:
        ids = changes.select("id").distinct()
        living = changes.filter(~F.col("deleted")).select("id").distinct()
        entity = scratch.keep(mart.source_rows(source).join(living, "id", "left_semi"), "living")
        clock = mart.clocks["etl"]
        first, last, count = entity.agg(F.min(clock), F.max(clock), F.count("*")).first()
        entity = mart.batch(source, entity, stored_links(store, mart, ids))
        refresh_stored(store, mart, source, entity, ids.union(entity.select("id")), before=(first or now).date())
    finally:
        scratch.clean()
    return Batch(first, last, count)


def in_range(table: MartTable, start: datetime, end: datetime, scope: Column) -> Column:
    """Stored rows of a recovered range: by their time where they have one, else by their day."""
    dated = rules.within("datetime", start, end) if "datetime" in table.column_names else F.lit(True)
    return dated & F.col("date").between(F.lit(start.date()), F.lit(end.date())) & scope


def run_recovery(store: MartStore, mart: Mart, source: Source, start: datetime, end: datetime, *,
                 merchants: Sequence[int] | int | None = None, outlet: int | None = None, resum: bool = False) -> Batch:
    """Compare a range with the source, for a merchant, an outlet or everything, and rebuild what differs.

    The range is taken on both sides: source rows whose recovery clock is in it, and raw rows that are stored in it. Rows
    that the source has elsewhere by now are stored there, and rows that it no longer has go. Days whose checksums agree
    are left alone; months and years that are published follow. ``resum`` sums all keys of the range anew, for a mart whose
    levels don't agree with its raw rows.
    """
    scope = rules.merchant_scope(merchants, outlet)
    settle(store, mart)
    scratch = Scratch(store.spark)
    try:
        clock, found = mart.clocks["recovery"], mart.source_rows(source)
        inside = scratch.keep(found.filter(rules.within(clock, start, end) & scope), "inside")
        there = store.load(mart.raw).filter(F.col("p_month").between(f"{start:%Y-%m}", f"{end:%Y-%m}"))
        stored = scratch.keep(there.filter(in_range(mart.raw, start, end, scope)).select(
            F.col(mart.raw.key[0]).alias("id")).distinct(), "stored")
        moved = scratch.keep(elsewhere(found, scratch.keep(lacking_keys(stored, inside, ["id"]), "gone")), "moved")
        entity = inside.unionByName(moved)
        linked = stored_links(store, mart, entity, None if mart.links is None else in_range(mart.links, start, end, scope))
        batch = mart.batch(source, entity, linked)
        refresh_stored(store, mart, source, batch, stored.union(batch.select("id")), by_day=True, resum=resum, linked=linked)
        return Batch(start, end, inside.count())
    finally:
        scratch.clean()


def elsewhere(found: DataFrame, gone: DataFrame) -> DataFrame:
    """Source rows of ids that have left the range. The source is asked for the ranges of these, and for nothing if there are none."""
    return having_keys(found.filter(in_ranges("id", id_ranges(gone.filter("id IS NOT NULL")))), gone, ["id"])


def covered_months(spark: SparkSession, start: date, end: date) -> list[Row]:
    """Year and month of every month in a range, oldest first; as long as the calendar says."""
    months = spark.range(1).select(F.explode(times.months_covered(F.lit(start), F.lit(end))).alias("first"))
    return months.select(F.year("first").alias("year"), F.month("first").alias("month")).orderBy("year", "month").collect()


def resum_period(store: MartStore, batch: Changes, mart: Mart, level: Level, year: int, month: int | None = None, merchants=None,
                 outlet: int | None = None) -> None:
    """Stage one month or year of a level, summed from a finer one, for everything or for a merchant and outlet."""
    finer = level.by_key_from or level.parent
    scope = rules.merchant_scope(merchants, outlet)
    found = steer(store.load(finer).filter(_partition_prefix(finer, year, month))).filter(in_period(year, month) & scope)
    part = Row(p_year=str(year)) if month is None else Row(p_month=f"{year:04d}-{month:02d}")
    batch.replace_where(level.table, [part], in_period(year, month) & scope, level_rows(mart, level, finer, found))


def _partition_prefix(table: MartTable, year: int, month: int | None) -> Column:
    """The storage months that a month or year is summed from."""
    if table.calendar == ("year",):
        return F.col("p_year") == str(year)
    if month is not None:
        return F.col("p_month") == f"{year:04d}-{month:02d}"
    return F.col("p_month").between(f"{year:04d}-01", f"{year:04d}-12")


def close_periods(store: MartStore, mart: Mart, batch: Batch, done_monthly: bool, done_yearly: bool,
                  since: datetime | None = None, merchants: Sequence[int] | int | str | None = None) -> tuple[bool, bool]:
    """Close every month and year that is over and still to do, for all merchants or some; returns the flags for the log.

    That is the period before the batch if its flag says so, and all those that began between ``since`` (the end of the
    run before) and the batch, or within the batch, except the last one before its end: the next run closes that.
    """
    run = store.spark.createDataFrame(
        [(batch.ts_current, batch.ts_end, done_monthly, done_yearly)],
        "ts_current timestamp_ntz, ts_end timestamp_ntz, done_monthly boolean, done_yearly boolean")
    todo = progress.period_closing(run).first()
    begin, end = batch.ts_current, batch.ts_end
    first = min(begin, since) if since else begin

    def month(day: datetime | date) -> int:
        return day.year * 12 + day.month - 1

    months = set(range(month(first), max(month(begin), month(end) - 1)))
    years = set(range(first.year, max(begin.year, end.year - 1)))
    months |= {month(todo["close_month"])} if todo["close_month"] else set()
    years |= {todo["close_year"]} if todo["close_year"] else set()
    closing = store.begin(mart.name)
    for level in mart.levels:
        if level.table.calendar == ("year", "month"):
            for m in sorted(months):
                resum_period(store, closing, mart, level, m // 12, m % 12 + 1, merchants)
        elif level.table.calendar == ("year",):
            for year in sorted(years):
                resum_period(store, closing, mart, level, year, None, merchants)
    closing.commit()
    return todo["done_monthly"], todo["done_yearly"]


def log_name(mart: Mart, merchants: Sequence[int] | int | str | None) -> str:
    """Runs for some merchants have a log of their own: they say nothing about how far the others are."""
    if merchants is None:
        return mart.name
    return f"{mart.name}_of_{'_'.join(map(str, sorted(set(rules.merchant_list(merchants)))))}"


def write_log(store: MartStore, job: str, batch: Batch, started: float, now: datetime, params: dict, **extra) -> None:
    """Add a run to the log of a job, which is told by its name."""
    if not isinstance(job, str):
        raise TypeError(f"a job is told by its name, not by a {type(job).__name__}")
    last = store.history(job).agg(F.max("id")).first()[0] or 0
    store.log(job, progress.log_row(
        store.spark, run_id=last + 1, actdate=now, ts_current=batch.ts_current, ts_end=batch.ts_end,
        num_row=batch.num_row, time_process=(time.time() - started) * 1000, params=params, **extra))


def run_sequence(store: MartStore, mart: Mart, source: Source, minutes: int, now: datetime, *,
                 delay: int = progress.OPEN_OVERLAP, merchants: Sequence[int] | int | str | None = None,
                 until: datetime | None = None) -> Batch:
    """The next window after the last logged run: refresh, close periods, log.

    ``until`` gives a window of fixed length that stops there, instead of one that widens while nothing arrives. A run for
    some merchants goes on from their own last run, the first one from the load of the whole mart. It keeps a log of its own,
    which says what is closed for these merchants, and closes months and years for them alone; the whole mart's log and
    closings don't depend on it.
    """
    started = time.time()
    settle(store, mart)
    job = log_name(mart, merchants)
    history = store.history(job)
    if merchants is not None and history.isEmpty():
        whole = store.history(mart.name)
        history = whole.join(whole.agg(F.min("id").alias("id")), "id").select(*whole.columns)
    window = progress.next_window(history, minutes) if until is None else progress.next_period(history, minutes, until)
    last = progress.last_run(history).first()
    if last is None or last["ts_end"] is None:
        raise ValueError(f"the log of {mart.name} is empty: write a first row that says where to start")
    span = progress.reach_back(window, progress.moment(now), delay).first()
    batch = run_increment(store, mart, source, span["window_start"], span["window_end"], now, merchants=merchants)
    monthly, yearly = close_periods(store, mart, batch, bool(last["done_monthly"]), bool(last["done_yearly"]), last["ts_end"], merchants)
    params = {"minutes": minutes, "start_time": span["window_start"], "end_time": span["window_end"]}
    write_log(store, job, batch, started, now, params, done_monthly=monthly, done_yearly=yearly)
    return batch


def initial_load(store: MartStore, mart: Mart, source: Source, up_to: datetime, now: datetime) -> None:
    """Build all tables once and log where the increments go on from.

    A mart that has been loaded (its log has rows) is refused; what a load that died has left is built again.
    """
    if not store.history(mart.name).isEmpty():
        raise ValueError(f"{mart.name} is loaded already: use an increment or a recovery")
    started = time.time()
    store.drop(*mart.stored_tables)
    after: dict[str, DataFrame] = {mart.raw.name: store.append(mart.raw, mart.raw_rows(source, None))}
    store.append(mart.ledger, ledger_rows(mart, after[mart.raw.name]))
    for level in mart.levels:
        after[level.table.name] = store.append(level.table, level_rows(mart, level, level.parent, after[level.parent.name]))
    if mart.links:
        store.append(mart.links, mart.link_rows(mart.source_rows(source)))
    batch = Batch(up_to - timedelta(minutes=1), up_to, after[mart.raw.name].count())
    write_log(store, mart.name, batch, started, now, {"load": "initial"}, done_monthly=True, done_yearly=True)


def owner_of(accounts: DataFrame, emails: DataFrame | str) -> DataFrame:
    """Merchant that an account belongs to; an unknown email yields no row."""
    owners = accounts.select("email", rules.account_owner().alias("merchant_id"))
    if isinstance(emails, str):
        return owners.filter(F.col("email") == emails)
    return emails.select("email").distinct().join(owners, "email")


def run_account_recovery(store: MartStore, mart: Mart, source: Source, email: str, start: datetime, end: datetime, *,
                         outlet: int | None = None) -> Batch | None:
    """Recovery for the merchant that an account belongs to; None if there is no such account."""
    owner = owner_of(source.accounts, email).first()
    return None if owner is None else run_recovery(store, mart, source, start, end, merchants=owner["merchant_id"], outlet=outlet)
