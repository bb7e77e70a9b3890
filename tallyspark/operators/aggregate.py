"""Grouping helpers shared by the marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyspark.functions.money import MONEY


def aggregate(df: DataFrame, group: Sequence[str], agg: Mapping[str, str], *, only: Sequence[str] = (),
              rename: Mapping[str, str] | None = None, order: Sequence[str] = (),
              uuid_column: str | None = None) -> DataFrame:
    """Group by ``group`` and apply one named aggregate per column, keeping the column names.

    ``only`` restricts the input columns, ``rename`` and ``order`` shape the result, ``uuid_column`` adds a random
    surrogate key.
    """
    source = df.select(*only) if only else df
    apply = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "mean": F.mean}
    out = source.groupBy(*group).agg(*(apply[how](column).alias(column) for column, how in agg.items()))
    if rename:
        out = out.withColumnsRenamed(dict(rename))
    if order:
        out = out.select(*order)
    return out.withColumn(uuid_column, F.uuid()) if uuid_column else out


def roll_up(df: DataFrame, keys: Mapping[str, Column | str], measures: Sequence[str]) -> DataFrame:
    """Sum measures to a coarser key. Sums are distributive, so every level can be built from the one below."""
    kinds = dict(df.dtypes)
    group = [(F.col(source) if isinstance(source, str) else source).alias(name) for name, source in keys.items()]
    sums = [F.sum(m).cast("bigint" if kinds[m] in ("bigint", "int") else MONEY).alias(m) for m in measures]
    return df.groupBy(*group).agg(*sums)


def surrogate_key(parts: Sequence[str], random: bool = False) -> Column:
    """Row number text: random, or repeatable from the natural key so that a replay writes the same rows."""
    return F.uuid() if random else F.md5(F.concat_ws("|", *(F.col(p).cast("string") for p in parts)))
