"""The set of source tables a mart job reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyspark.operators.keys import having_keys

# Stores an intermediate result under a name and returns it read back.
Keep = Callable[[DataFrame, str], DataFrame]
# Child table -> the column that points at the transaction.
TRANSACTION_CHILDREN = {"details": "transaction_id", "commissions": "transaction_id", "payments": "transaction_id",
                        "promos": "transaction_id"}
#: They name the line, and may name its transaction, too.
LINE_CHILDREN = ("addons", "detail_extends")
RESERVATION_CHILDREN = {"services": "reservation_id"}
#: Literal ranges that a batch's ids are summed up by at most.
ID_RANGES = 16


class Source:
    """Source tables by name, each built on first use so that a job only scans what it reads.

    Where several children are made of one table, ``shared`` builds them anew from its rows of some transactions, kept once.
    ``late`` names columns that are made of a row alone, by table: its builder gives the rows without them, but with
    their transaction, and they are made after the rows were limited or dealt, so that no value travels twice.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]],
                 shared: Callable[[DataFrame, Keep], Mapping[str, Callable[[], DataFrame]]] | None = None,
                 late: Mapping[str, Sequence[str]] | None = None):
        self._builders, self._shared, self._late = dict(builders), shared, dict(late or {})
        self._read: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._made(name, self._rows(name))
        return self._built[name]

    def _rows(self, table: str) -> DataFrame:
        """A table as its builder gives it."""
        if table not in self._read:
            self._read[table] = self._builders[table]()
        return self._read[table]

    def _made(self, table: str, rows: DataFrame) -> DataFrame:
        return rows.selectExpr(*self._late[table]) if table in self._late else rows

    def dealt(self, table: str) -> DataFrame:
        """A child table dealt by its transaction."""
        return self._made(table, self._rows(table).repartition("transaction_id"))

    def replacing(self, **frames: DataFrame) -> Source:
        """The same source with some tables swapped."""
        builders: dict[str, Callable[[], DataFrame]] = dict(self._builders)
        builders.update({name: (lambda frame=frame: frame) for name, frame in frames.items()})
        return Source(builders, late={t: c for t, c in self._late.items() if t not in frames})

    def narrowed(self, ids: DataFrame, ranges: Sequence[tuple[int, int]], keep: Keep) -> Source:
        """The same source, its children read once for a batch (column ``id``) where they share a table."""
        if self._shared is None or not ranges:
            return self
        made: dict[str, Callable[[], DataFrame]] = {}

        def child(table: str) -> Callable[[], DataFrame]:
            def build() -> DataFrame:
                # The ranges hold all ids. As a filter they tell Spark that the ids select something of the table.
                made.update(made or self._shared(ids.select("id").filter(in_ranges("id", ranges)), keep))
                return made[table]()
            return build

        # A mart that reads no child has none read for it.
        return Source(self._builders | {t: child(t) for t in (*TRANSACTION_CHILDREN, *LINE_CHILDREN) if t in self._builders}, late=self._late)

    def of_transactions(self, ids: DataFrame) -> Source:
        """Child tables limited to the listed transactions (column ``id``).

        A semi join: Spark broadcasts the ids while they are few and shuffles both sides when they are not.
        """
        def of(rows: DataFrame, column: str) -> DataFrame:
            # A child without a parent belongs to nothing, so a plain join does, and leaves the rows dealt by their parent.
            return rows.join(ids.select(F.col("id").alias("_id")), F.col(column) == F.col("_id"), "left_semi")

        def limited(table: str, column: str) -> Callable[[], DataFrame]:
            return lambda: again(table, of(self._rows(table), column))

        def again(table: str, rows: DataFrame) -> DataFrame:
            # Such rows may meet the ids before they meet the rest of what they are made of, and aren't dealt by them any more.
            return rows.repartition("transaction_id") if table in self._late else rows

        def of_lines(table: str) -> DataFrame:
            rows = self._rows(table)
            if "transaction_id" in rows.columns:
                return again(table, of(rows, "transaction_id"))
            return having_keys(rows, children.details.select("detail_id"), ["detail_id"])

        builders = dict(self._builders)
        builders.update({t: limited(t, c) for t, c in TRANSACTION_CHILDREN.items() if t in builders})
        children = Source(builders, late=self._late)
        # What hangs on the lines is limited to the lines of the batch before anything is summed.
        for table in LINE_CHILDREN:
            if table in builders:
                builders[table] = lambda table=table: of_lines(table)
        return Source(builders, late=self._late)

    def near_ids(self, ranges: Sequence[tuple[int, int]], columns: Mapping[str, str]) -> Source:
        """Tables limited to literal ranges of the column named for each, which reach the files' statistics or a database
        as a plain filter."""
        def limited(table: str, column: str) -> Callable[[], DataFrame]:
            def build() -> DataFrame:
                rows = self._rows(table)
                return rows.filter(in_ranges(column, ranges)) if column in rows.columns else rows
            return build

        builders = dict(self._builders)
        if "details" in columns:
            columns = {**columns, **dict.fromkeys(LINE_CHILDREN, columns["details"])}
        builders.update({t: limited(t, c) for t, c in columns.items() if t in builders})
        return Source(builders, late=self._late)


def in_ranges(column: str, ranges: Sequence[tuple[int, int]]) -> Column:
    return reduce(Column.__or__, (F.col(column).between(low, high) for low, high in ranges), F.lit(False))


def id_ranges(ids: DataFrame) -> list[tuple[int, int]]:
    """A few disjoint ranges that hold all ids, cut where they lie apart, so that one old id doesn't open everything."""
    low, high = ids.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return []
    width = (high - low) // ID_RANGES + 1
    found = ids.groupBy(F.floor((F.col("id") - low) / width)).agg(F.min("id").alias("low"), F.max("id").alias("high")).collect()
    return sorted((row["low"], row["high"]) for row in found)
