"""Labelled documents for fitting, and hashed character n-grams."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.tables import is_held_out

#: Bytes that one pass of numpy works on; longer texts go through in overlapping blocks.
BLOCK = 1 << 20


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``text, y`` of at most ``rows`` labelled documents that aren't held out, chosen by the hash of their id.

    Rows with a null id or label aren't labelled. An id that is labelled more than once counts by its largest label.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~is_held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y")


def grams(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hashes, of so many bits, of all runs of ``n`` values (uint8) in ``data``."""
    if len(data) < n:
        return np.empty(0, dtype=np.uint32)
    wide = data.astype(np.uint32)
    out = wide[: len(data) - n + 1] + np.uint32(n)
    for k in range(1, n):
        out *= np.uint32(0x01000193)
        out += wide[k: len(data) - n + 1 + k]
    out *= np.uint32(0x9E3779B1)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x85EBCA77)
    return out >> np.uint32(32 - bits)


def blocks(data: np.ndarray, overlap: int):
    """The data in blocks that share ``overlap`` values with the next one."""
    for at in range(0, max(len(data), 1), BLOCK):
        yield data[at: at + BLOCK + overlap]
