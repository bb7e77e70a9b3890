"""How quality filters interact: what every order of five filters keeps, loses and does twice, per source.

A document's failures are a set of filters, so a part of the corpus is a table of 32 cells: how many documents fail exactly
these filters. The 32 subsets of active filters are walked in Gray-code order: each step toggles one filter, moves the
active-failure counter of every cell that fails it, and adds to or takes from the running survivors the cells whose counter
leaves or reaches zero. With the 32 states stored, each step of each of the 120 orders is a difference of two of them.

Texts are read once and not shuffled: a document is its id, its digest, its source and five bits from then on. The cells are
summed on the map side, so a source that holds a third of all documents is no hot key. The walk runs over 32 numbers a part,
for many parts at once, wherever Spark has put the part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.tables import table, whole_text
from tallyspark.session import Scratch

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
SUBSETS = 1 << len(FILTERS)
#: Parts that one step of the walk takes at once; each gives 600 rows.
PARTS = 128
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)


def content_failures(text: Column, words: Column) -> dict[str, Column]:
    """The filters that look at one text: few words, few different words, many capitals, symbols."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": n < 200,
        "B": distinct * 100 < n * 50,
        "C": F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 2,
        "D": text.rlike("[#$%&*|]"),
    }


def failed(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, part, fails`` of every row; bit i of ``fails`` is set if the row fails filter i of ``FILTERS``.

    E fails where a row with a smaller doc_id has the same text. A null doc_id is neither smaller than another nor has any
    smaller than it, and of repeated rows none is.
    """
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       whole_text(docs["text"]).alias("text")).withColumn("words", words)
    bits = [F.when(test, 1 << FILTERS.index(f)).otherwise(0) for f, test in content_failures(F.col("text"), F.col("words")).items()]
    rows = scratch.keep(read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum(bits, F.lit(0)).alias("fails")),
                        "content_failures")
    copied = (rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).filter("n > 1")
              .select("digest", "first"))
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    copy = F.when(again, 1 << FILTERS.index("E")).otherwise(0)
    return rows.join(copied, "digest", "left").select("doc_id", "part", (F.col("fails") + copy).alias("fails"))


def cells(failures: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, cells``: up to 32 ``(fails, n, good, toxic)`` of each part."""
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    counted = failures.join(known, "doc_id", "left").groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic"))
    return counted.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))


def survivors(counts: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters, from ``counts[part, fails, measure]``, by the Gray-code walk."""
    fails = np.arange(SUBSETS)
    active = np.zeros(SUBSETS, dtype=np.int64)  # how many active filters a cell fails
    running, subset = counts.sum(axis=1), 0
    states = np.empty_like(counts)
    states[:, 0] = running
    for step in range(1, SUBSETS):
        f = (step & -step).bit_length() - 1  # the only filter in which this code and the one before differ
        subset ^= 1 << f
        hit = fails >> f & 1 == 1
        if subset >> f & 1:
            running = running - counts[:, hit & (active == 0)].sum(axis=1)
            active[hit] += 1
        else:
            active[hit] -= 1
            running = running + counts[:, hit & (active == 0)].sum(axis=1)
        states[:, subset] = running
    return states


def _steps() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the 600 steps of all orders: active filters before and after, and the filter that is added."""
    before, after, added = [], [], []
    for order in ORDERS:
        subset = 0
        for name in order:
            f = FILTERS.index(name)
            before.append(subset)
            subset |= 1 << f
            after.append(subset)
            added.append(f)
    return np.array(before), np.array(after), np.array(added)


def audited(parts: list[str], counts: np.ndarray) -> pd.DataFrame:
    """The report of some parts: one row per part, order and step."""
    before, after, added = _steps()
    states = survivors(counts)
    lost = states[:, before] - states[:, after]
    fails = np.stack([counts[:, np.arange(SUBSETS) >> f & 1 == 1, 0].sum(axis=1) for f in range(len(FILTERS))], axis=1)
    shapley = np.stack([lost[:, added == f, 0].sum(axis=1) for f in range(len(FILTERS))], axis=1)
    removed = lost[:, :, 0]
    columns = {
        "kept": states[:, after, 0], "removed": removed, "redundant": fails[:, added] - removed,
        "unique_fails": counts[:, 1 << added, 0], "good_lost": lost[:, :, 1], "toxic_lost": lost[:, :, 2],
        "shapley": shapley[:, added],
    }
    steps, n = len(FILTERS), len(parts)
    return pd.DataFrame({
        "part": np.repeat(np.array(parts, dtype=object), len(added)), "filter_order": np.tile(np.repeat(ORDERS, steps), n),
        "step": np.tile(np.arange(1, steps + 1, dtype=np.int32), len(ORDERS) * n),
        **{name: values.ravel() for name, values in columns.items()}})


def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), PARTS):
            some = batch.iloc[at:at + PARTS]
            counts = np.zeros((len(some), SUBSETS, 3), dtype=np.int64)
            for i, found in enumerate(some["cells"]):
                for cell in found:
                    counts[i, cell["fails"]] = cell["n"], cell["good"], cell["toxic"]
            yield audited(list(some["part"]), counts)


def audit(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per part (value of ``source``; null counts as the empty string), order of the five filters and step.

    ``kept`` counts the documents left after the step, ``removed`` those that its filter takes out there, ``redundant`` those
    that fail it but are out already, ``unique_fails`` those that fail it alone, ``good_lost`` and ``toxic_lost`` those of
    the removed that are labelled so, and ``shapley`` is what the filter removes summed over all orders.

    A null text counts as empty, and fails A. Repeated rows are documents each. A document that is labelled more than once
    counts by its largest label; null labels are none. Without documents there are no rows. Other columns play no part.
    """
    return cells(failed(docs, scratch), labels).mapInPandas(walk, SCHEMA)


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"), Scratch(spark))


SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
worded AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
known AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, quality, toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
  FROM worded LEFT JOIN known USING (doc_id)),
cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS bad
  FROM failing GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x) JOIN letters d ON d.x NOT IN (a.x, b.x, c.x)
  JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, filter_order[s] AS f, filter_order[1:s - 1] AS earlier
  FROM orders, generate_series(1, 5) AS g(s)),
met AS (
  SELECT part, filter_order, step, f, n, good, bad, contains(fails, f) AS hit, fails = f AS alone,
         earlier <> '' AND regexp_matches(fails, '[' || earlier || '-]') AS gone
  FROM cells, steps),
per_step AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND hit), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE gone AND hit), 0) AS redundant, coalesce(sum(n) FILTER (WHERE alone), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT gone AND hit), 0) AS good_lost,
         coalesce(sum(bad) FILTER (WHERE NOT gone AND hit), 0) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM per_step
"""
