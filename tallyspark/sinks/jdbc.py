"""Mart rows to a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

# Fixed value: lets the database turn text into its own timestamp and uuid types.
UNTYPED_TEXT = "stringtype=unspecified"


def append(df: DataFrame, url: str, table: str, properties: Mapping[str, str], *, batch_size: int = 10_000,
           connections: int = 25, untyped_text: bool = False) -> None:
    """Append over at most ``connections`` parallel connections, in batches."""
    if untyped_text:
        url = f"{url}{'&' if '?' in url else '?'}{UNTYPED_TEXT}"
    (df.write.option("batchsize", str(batch_size)).option("numPartitions", str(connections))
     .jdbc(url=url, table=table, mode="append", properties=dict(properties)))


def bulk_append(df: DataFrame, url: str, table: str, properties: Mapping[str, str], *, lower_columns: bool = True,
                raise_if_empty: bool = False, **options: object) -> bool:
    """Append with lower-cased column names; returns whether there was anything to write."""
    if df.isEmpty():
        if raise_if_empty:
            raise ValueError("the frame is empty")
        return False
    named = df.select(*(F.col(c).alias(c.lower()) for c in df.columns)) if lower_columns else df
    append(named, url, table, properties, **options)
    return True
