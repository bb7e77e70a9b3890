"""Sharding by jump consistent hashing, after Lamping and Veach, "A Fast, Minimal Memory, Consistent Hash Algorithm".

The shard follows from the key and the number of shards alone: no ring table, no shuffle. When shards are appended, a row
either stays or moves to a new shard, and only the necessary fraction moves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.tables import table, whole_text

SHARDS = 40
#: Rows that one task numbers; a shard's rows are numbered in as many parts as that takes.
ROWS_PER_PART = 20_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key, from 0. All keys jump together until none is below the number of shards."""
    state = keys.astype(np.uint64)
    at = np.full(len(state), -1, dtype=np.int64)
    ahead = np.zeros(len(state), dtype=np.int64)
    going = np.arange(len(state))
    while len(going):
        at[going] = ahead[going]
        state[going] = state[going] * np.uint64(2862933555777941757) + np.uint64(1)
        part = (state[going] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[going] = ((at[going] + 1) * (float(1 << 31) / part)).astype(np.int64)
        going = going[ahead[going] < shards]
    return at


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a 64-bit key column."""
    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(dtype=np.int64).view(np.uint64), shards).astype(np.int32))

    return shard(key)


def stable_key(doc_id: Column) -> Column:
    """A well-mixed 64-bit key of the id alone; a null id has one as well (all such rows share a shard)."""
    return F.xxhash64(doc_id)


def numbered(rows: DataFrame, by: str, order: list[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Adds ``slot``: gapless from 0 within each value of ``by``.

    A value's rows are dealt into parts by the hash of ``order``, the parts are counted (combined on the map side), each
    part starts where the ones before it end, and rows are numbered within their part. No task sees a whole shard.
    """
    parts = max(1, -(-rows.count() // rows_per_part))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    counts = rows.groupBy(by, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(by, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(by, "_part").orderBy(*order)
    return (rows.withColumn("_at", F.row_number().over(within) - 1).join(starts, [by, "_part"])
            .withColumn("slot", F.col("_start") + F.col("_at")).drop("_part", "_start", "_at"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row; texts aren't shuffled.

    ``size`` is the text's UTF-8 bytes (null: none) plus 16. Slots follow the order of (hash part, doc_id, crc, size);
    repeated rows get a slot each. Rows with a null doc_id share one shard. Empty input gives no rows; other columns play
    no part.
    """
    text = whole_text(docs["text"])
    key = stable_key(docs["doc_id"])
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
                       jump_shard(key, shards).alias("shard"), jump_shard(key, shards + 1).alias("grown_shard"))
    return numbered(rows, "shard", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, files_per_shard: int = 1) -> None:
    """Write the documents into one folder per shard (``shard=0`` ...). Each shard's rows are dealt over
    ``files_per_shard`` tasks, so that a large shard isn't one task's work."""
    out = docs.withColumn("shard", jump_shard(stable_key(docs["doc_id"]), shards))
    deal = F.pmod(F.xxhash64("doc_id", "text"), F.lit(files_per_shard))
    out.repartition(shards * files_per_shard, F.col("shard"), deal).write.mode("overwrite").partitionBy("shard").parquet(path)


def op8_jump_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"))
