"""Key sets as DataFrames: which rows a batch touches, and replacing rows by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyspark.functions.rules import merchant_scope


def distinct_keys(*frames: DataFrame, key: Sequence[str]) -> DataFrame:
    """All keys found in any of the frames, once each."""
    return reduce(DataFrame.unionByName, (f.select(*key) for f in frames)).distinct()


def _by_key(df: DataFrame, keys: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """A key with nulls in it is a key like any other, as it is to a grouping."""
    listed = keys.select(*(F.col(k).alias(f"_key_{k}") for k in key))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key))
    return df.join(listed, same, how).select(*df.columns)


def having_keys(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is listed."""
    return _by_key(df, keys, key, "left_semi")


def lacking_keys(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not listed."""
    return _by_key(df, keys, key, "left_anti")


def replace_keys(current: DataFrame, keys: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Delete the listed keys and put the new rows in. A listed key without new rows disappears."""
    return lacking_keys(current, keys, key).unionByName(rows.select(*current.columns))


def upsert(current: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Insert rows, replacing those that have the same key."""
    return replace_keys(current, rows.select(*key).distinct(), rows, key)


def delete_range(current: DataFrame, start, end, *, column: str = "date", merchants=None,
                 outlet: int | None = None) -> DataFrame:
    """Drop a date range, for one merchant (and outlet) or for all."""
    doomed = F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")) & merchant_scope(merchants, outlet)
    return current.filter(~F.coalesce(doomed, F.lit(False)))
