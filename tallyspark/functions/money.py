"""Exact money. Amounts are decimals inside the marts and doubles only at the output edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, DoubleType, StructField, StructType

# 18 digits still fit a machine word in Spark rows and parquet. A larger amount is an error in ANSI mode, never a wrap.
MONEY = DecimalType(18, 4)


def money(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(MONEY)


def money_or_zero(column: Column | str) -> Column:
    return F.coalesce(money(column), money(F.lit(0)))


def total(column: Column | str) -> Column:
    """Sum of an amount, null when there is nothing to add."""
    return F.sum(column).cast(MONEY)


def total_or_zero(column: Column | str) -> Column:
    return money_or_zero(F.sum(column))


def total_where(condition: Column, column: Column | str) -> Column:
    """Sum over the rows that meet the condition; the others add zero."""
    return total_or_zero(F.when(condition, F.col(column) if isinstance(column, str) else column))


def as_doubles(df: DataFrame) -> DataFrame:
    """Expose decimal columns as doubles, the type the mart tables are read back with."""
    return df.to(StructType([
        StructField(f.name, DoubleType() if isinstance(f.dataType, DecimalType) else f.dataType) for f in df.schema]))
