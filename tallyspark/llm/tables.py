"""Reading the given tables, and helpers that several operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(text: Column | str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def is_held_out(doc_id: Column) -> Column:
    """The quarter of the documents whose labels no classifier may see. A null id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))
