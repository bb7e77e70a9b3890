"""The marts, and what a batch changes of them: which ids really differ, which keys they touch, and by how much."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tallyspark.functions.times import before_month, before_year
from tallyspark.operators.aggregate import surrogate_key
from tallyspark.operators.deltas import changed_by, checksums, contributions, differing, settled, totals
from tallyspark.operators.keys import distinct_keys, having_keys
from tallyspark.plans import compliment, reservation, sales, sales_net, tax
from tallyspark.schema import (
    COMPLIMENT_RAW, MartTable, SALES_DAILY, SALES_HOURLY, SALES_MONTHLY, SALES_NET_LINKS, SALES_RAW, SALES_YEARLY,
    SUMMARY_DAILY, SUMMARY_RAW, TAX_DAILY, TAX_MONTHLY, TAX_RAW, TAX_YEARLY, UTILIZATION_DAILY, UTILIZATION_RAW, ledger_of,
)
from tallyspark.sources.tables import Keep, Source


@dataclass(frozen=True)
class Level:
    """An aggregate mart and the table it is summed from.

    A batch rebuilds single keys. Years take those from the days (``by_key_from``): the months of a running year may not
    be published yet, so their sum could be short.
    """

    table: MartTable
    parent: MartTable
    build: Callable[[DataFrame], DataFrame]
    by_key_from: MartTable | None = None


@dataclass(frozen=True)
class Mart:
    """A raw mart with the levels above it.

    ``raw_rows`` turns source rows into raw mart rows, keeping only what belongs there. ``clocks`` names the source
    column that each kind of window selects on; ``clears_range`` says whether a recovery selects on the time that the
    raw mart is dated by, so that stored rows of the range which the source no longer has can be recognised. ``widen``
    adds source rows whose raw rows depend on those of a batch, or did by the rows that the table ``links`` holds of the
    batch; ``link_rows`` makes those.
    """

    name: str
    entity: str
    raw: MartTable
    raw_rows: Callable[[Source, DataFrame], DataFrame]
    levels: tuple[Level, ...]
    clocks: Mapping[str, str]
    adds: Callable[[DataFrame], DataFrame] | None = None
    widen: Callable[[Source, DataFrame, DataFrame | None], DataFrame] | None = None
    links: MartTable | None = None
    link_rows: Callable[[DataFrame], DataFrame] | None = None
    bound: Callable[[Source, DataFrame, Keep], Source] | None = None

    @property
    def ledger(self) -> MartTable:
        return ledger_of(self.raw)

    @property
    def tables(self) -> list[MartTable]:
        return [self.raw, *(level.table for level in self.levels)]

    @property
    def stored_tables(self) -> list[MartTable]:
        return [*self.tables, self.ledger, *([self.links] if self.links else [])]

    def up_to(self, table: MartTable) -> Mart:
        """The mart without the levels above a table."""
        names = [t.name for t in self.tables]
        return replace(self, levels=self.levels[:names.index(table.name)])

    def source_rows(self, source: Source) -> DataFrame:
        return getattr(source, self.entity)

    def batch(self, source: Source, changed: DataFrame, stored_links: DataFrame | None = None) -> DataFrame:
        return self.widen(source, changed, stored_links) if self.widen else changed


SALES = Mart(
    "sales", "transactions", SALES_RAW, sales.sales_raw,
    (Level(SALES_HOURLY, SALES_RAW, sales.sales_hourly), Level(SALES_DAILY, SALES_HOURLY, sales.sales_daily_from_hourly),
     Level(SALES_MONTHLY, SALES_DAILY, sales.sales_monthly), Level(SALES_YEARLY, SALES_MONTHLY, sales.sales_yearly, SALES_DAILY)),
    {"etl": "updated_at", "recovery": "sold_at"}, sales.contributions,
)
# The net variant in the same tables; a store holds one of the two.
SALES_NET = Mart(
    "sales_net", "transactions", SALES_RAW, sales_net.stored_net_raw,
    (Level(SALES_HOURLY, SALES_RAW, sales_net.sales_net_hourly),
     Level(SALES_DAILY, SALES_HOURLY, sales.sales_daily_from_hourly),
     Level(SALES_MONTHLY, SALES_DAILY, sales.sales_monthly),
     Level(SALES_YEARLY, SALES_MONTHLY, sales.sales_yearly, SALES_DAILY)),
    {"etl": "updated_at", "recovery": "sold_at"}, sales_net.contributions, sales_net.with_parents,
    SALES_NET_LINKS, sales_net.bill_links, sales_net.bounded,
)
TAX = Mart(
    "tax", "transactions", TAX_RAW, tax.tax_raw,
    (Level(TAX_DAILY, TAX_RAW, tax.tax_daily), Level(TAX_MONTHLY, TAX_DAILY, tax.tax_monthly),
     Level(TAX_YEARLY, TAX_MONTHLY, tax.tax_yearly, TAX_DAILY)),
    {"etl": "updated_at", "recovery": "sold_at"}, tax.contributions,
)
COMPLIMENT = Mart(
    "compliment", "transactions", COMPLIMENT_RAW, compliment.compliment_raw, (),
    {"etl": "updated_at", "recovery": "updated_at"},
)
UTILIZATION = Mart(
    "utilization", "reservations", UTILIZATION_RAW, reservation.utilization_raw,
    (Level(UTILIZATION_DAILY, UTILIZATION_RAW, reservation.utilization_daily),),
    {"etl": "updated_at", "recovery": "reserved_on"}, reservation.utilization_contributions,
)
SUMMARY = Mart(
    "summary", "reservations", SUMMARY_RAW, reservation.summary_raw,
    (Level(SUMMARY_DAILY, SUMMARY_RAW, reservation.summary_daily),),
    {"etl": "updated_at", "recovery": "updated_at"}, reservation.summary_contributions,
)


def steer(df: DataFrame) -> DataFrame:
    """Add the calendar columns that level keys are made of, as far as the table can tell them."""
    extra: dict[str, Column] = {}
    if "datetime" in df.columns and "hour" not in df.columns:
        extra["hour"] = F.hour("datetime")
    if "date" in df.columns:
        extra |= {"year": F.year("date"), "month": F.month("date")}
    return df.withColumns(extra) if extra else df


def stored_rows(raw: DataFrame, mart: Mart, ids: DataFrame) -> DataFrame:
    """What the raw mart holds for the listed source ids (column ``id``): the places the rows were last seen at."""
    return having_keys(raw, ids.select(F.col("id").alias(mart.raw.key[0])), mart.raw.key)


def old_links(mart: Mart, links: DataFrame, ids: DataFrame, also: Column | None = None) -> DataFrame:
    """What is stored of the links of the listed source ids (column ``id``), and of those that meet a condition."""
    listed = F.lit(False) if also is None else F.coalesce(also, F.lit(False))
    named = having_keys(links.filter(~listed), ids.select(F.col("id").alias(mart.links.key[0])), mart.links.key)
    return named.unionByName(links.filter(listed))


def link_places(mart: Mart, *links: DataFrame) -> DataFrame:
    return distinct_keys(*links, key=[*mart.links.key, *mart.links.calendar])


def touched_keys(mart: Mart, *raw_rows: DataFrame) -> DataFrame:
    """Keys of all levels touched by raw rows, old and new ones, at the finest detail the levels need."""
    wanted = list(dict.fromkeys(c for level in mart.levels for c in (*level.table.key, *level.table.calendar)))
    return distinct_keys(*(steer(rows) for rows in raw_rows), key=wanted)


def level_keys(touched: DataFrame, table: MartTable) -> DataFrame:
    """Keys of one level."""
    return touched.select(*dict.fromkeys((*table.key, *table.calendar))).distinct()


def over(table: MartTable, before: date) -> Column:
    """Keys of months or years that are over at that day; the others wait until they are closed."""
    return before_month("year", "month", before) if "month" in table.calendar else before_year("year", before)


def full(mart: Mart, source: Source, keep: Keep | None = None) -> dict[str, DataFrame]:
    """All tables of a mart computed from scratch; ``keep`` stores the raw rows that all levels start from."""
    raw = mart.raw_rows(source, None)
    tables = {mart.raw.name: keep(raw, mart.raw.name) if keep else raw}
    for level in mart.levels:
        tables[level.table.name] = level.table.conform(level.build(tables[level.parent.name]))
    if mart.links:
        tables[mart.links.name] = mart.links.conform(mart.link_rows(mart.source_rows(source)))
    return tables


def in_period(year: int, month: int | None = None) -> Column:
    test = F.col("year") == year
    return test if month is None else test & (F.col("month") == month)


def ledger_rows(mart: Mart, raw: DataFrame) -> DataFrame:
    """What the ledger notes of raw rows: for each id and place their number and digest."""
    places = {"id": F.col(mart.raw.key[0]), **{c: F.col(c) for c in ("merchant_id", "outlet_id", "date")}}
    return checksums(raw.select(*mart.raw.column_names), places)


def changed_ids(new: DataFrame, known: DataFrame, by_day: bool, keep: Keep) -> DataFrame:
    """Ids whose raw rows aren't what the ledger knows of them.

    With ``by_day`` days are compared first, per merchant and outlet, and ids only within those that differ: over a long
    range most don't, and a checksum of each is far less than its ids. The days are kept, so that Spark knows how few they
    are before it shuffles all ids to meet them.
    """
    if by_day:
        days = keep(differing(new, known, ["merchant_id", "outlet_id", "date"]), "days")
        new, known = (having_keys(df, days, ["merchant_id", "outlet_id", "date"]) for df in (new, known))
    return differing(new, known, ["id", "merchant_id", "outlet_id", "date"]).select("id").distinct()


def finished(table: MartTable, rows: DataFrame) -> DataFrame:
    """Rows of a roll-up with the surrogate key that some tables have."""
    return rows.withColumn("no", surrogate_key(table.key)) if "no" in table.column_names else rows


def level_rows(mart: Mart, level: Level, finer: MartTable, rows: DataFrame) -> DataFrame:
    """A level, with its tallies, from rows of the raw mart or of a finer level."""
    adds = contributions(mart.levels[0].table, mart.adds(rows), 1) if finer.name == mart.raw.name else rows
    return finished(level.table, settled(level.table, totals(level.table, adds)))


def raw_delta(mart: Mart, doomed: DataFrame, rows: DataFrame) -> DataFrame:
    """What a batch changes of the finest level: old raw rows taken off, new ones added."""
    table = mart.levels[0].table
    both = contributions(table, mart.adds(doomed), -1).unionByName(contributions(table, mart.adds(rows), 1))
    return changed_by(table, totals(table, both))
