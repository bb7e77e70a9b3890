"""Roll-ups kept by signed deltas: what a batch takes from each key and what it adds, merged into the stored sums.

A roll-up stores how many raw rows each key stands for, so a key that loses its last row is known to be gone without a look at
any other row of it; and how many of them gave a value to each sum that is null without one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallyspark.functions.money import MONEY
from tallyspark.schema import INT, LONG, ROWS, MartTable, tally

# Columns that coarser keys are made of, where a table has only the finer ones.
COARSER = {"year": F.year, "month": F.month}


def contributions(table: MartTable, rows: DataFrame, sign: int) -> DataFrame:
    """What each row (keys and measures) adds to its key, or takes from it with ``sign`` -1."""
    def signed(value: Column) -> Column:
        return value if sign > 0 else -value

    one = F.lit(sign).cast("bigint")
    sums = {m: signed(F.col(m)) for m in table.sums}
    counts = {tally(m): F.when(F.col(m).isNotNull(), one).otherwise(0) for m in table.nullable}
    return rows.select(*table.key, *(c.alias(m) for m, c in sums.items()), one.alias(ROWS), *(c.alias(m) for m, c in counts.items()))


def totals(table: MartTable, rows: DataFrame) -> DataFrame:
    """Sums and tallies of finer rows, or of finer deltas, by the keys of a table."""
    kinds = dict(table.columns)
    keys = [F.col(k) if k in rows.columns else COARSER[k]("date").cast("int").alias(k) for k in table.key]
    sums = [F.sum(m).cast("bigint" if kinds[m] in (LONG, INT) else MONEY).alias(m) for m in table.sums]
    return rows.groupBy(*keys).agg(*sums, *(F.sum(t).alias(t) for t in table.tallies))


def settled(table: MartTable, found: DataFrame) -> DataFrame:
    """Totals as they are stored: a sum without any value is null, and a key that no raw row is left of is gone."""
    return found.filter(F.col(ROWS) != 0).withColumns({m: F.when(F.col(tally(m)) != 0, F.col(m)) for m in table.nullable})


def merged(table: MartTable, stored: DataFrame, delta: DataFrame) -> DataFrame:
    """The table after a delta."""
    columns = [*table.key, *table.sums, *table.tallies]
    return settled(table, totals(table, stored.select(*columns).unionByName(delta.select(*columns))))


def changed_by(table: MartTable, delta: DataFrame) -> DataFrame:
    """The keys of a delta that it changes at all."""
    return delta.filter(" OR ".join(f"coalesce({c}, 0) <> 0" for c in (*table.sums, *table.tallies)))


def checksums(rows: DataFrame, by: Mapping[str, Column]) -> DataFrame:
    """How many rows there are by some keys, and a digest of them that doesn't depend on their order.

    The hash of a row leaves nulls out, so it is told beside each value whether there is one.
    """
    row = F.xxhash64(*(part for c in sorted(rows.columns) for part in (F.col(c).isNull(), F.col(c))))
    return rows.groupBy(*(c.alias(k) for k, c in by.items())).agg(
        F.count("*").alias("rows"), F.sum(row.cast("decimal(38,0)")).cast("decimal(38,0)").alias("digest"))


def differing(one: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    """Keys whose ``rows`` and ``digest`` aren't the same on both sides, each summed over the key."""
    def total(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*key, *((F.col(c) if sign > 0 else -F.col(c)).alias(c) for c in ("rows", "digest")))

    both = total(one, 1).unionByName(total(other, -1)).groupBy(*key).agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest"))
    return both.filter("rows <> 0 OR digest <> 0").select(*key)
