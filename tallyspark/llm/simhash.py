"""SimHash near-duplicates by the generalised pigeonhole principle (after Qin et al., "GPH: Similarity Search in Hamming
Space").

The 64 bits are grouped into partitions, correlated bits together. If two fingerprints differ in at most r bits, then for
any thresholds t_i of -1 or more with sum(t_i + 1) = r + 1 there is a partition i in which they differ in at most t_i bits
(-1: the partition isn't searched). Which number of partitions and which thresholds cost least is found by dynamic
programming over estimated probes and candidates, from counts over all fingerprints. Fingerprints are probed within the
thresholds by equality joins, and every candidate is verified inside the join, so that only true links come out of it.

Links are searched at distance 1 first, where a fingerprint has at most 64 of them. At the full distance only links
between different components of the first search are wanted, so that a large group of near copies doesn't give all its
pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.components import components
from tallyspark.llm.tables import table
from tallyspark.session import Scratch

BITS, WORDS, DISTANCE, SEED = 64, 3, 3, 42
#: Cost of comparing one candidate pair within a join, where one shuffled probe row costs 1.
PAIR_COST = 0.05
#: Shingles whose bits are counted at once.
BLOCK = 32_768


def fingerprint(text: str | None) -> int:
    """SimHash of the text's word shingles, as an unsigned integer; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(WORDS, len(words))
    firsts, lasts = starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(firsts), BLOCK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(firsts[at:at + BLOCK], lasts[at:at + BLOCK])],
                          dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        for part in range(0, len(bits), 255):  # what fits an 8-bit sum
            ones += bits[part:part + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > len(firsts), bitorder="little").view(np.uint64)[0])


def fingerprints(text: str) -> Column:
    """Fingerprint of a text column as a signed long."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))

    return of(text)


@dataclass(frozen=True)
class Partition:
    bits: tuple[int, ...]
    threshold: int  # -1: not searched

    @property
    def mask(self) -> int:
        return signed(sum(1 << b for b in self.bits))

    def flips(self) -> list[int]:
        """Every change of the partition's bits within the threshold."""
        return [signed(sum(1 << b for b in some)) for n in range(self.threshold + 1) for some in combinations(self.bits, n)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many each pair of bits is set together: over all of them."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                values = batch["fp"].to_numpy()[at:at + BLOCK].view(np.uint8)
                bits = np.unpackbits(values, bitorder="little").reshape(-1, BITS).astype(np.float64)
                total += bits.T @ bits
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "n": total.ravel().astype(np.int64)})

    both = np.zeros((BITS, BITS))
    for i, j, n in fps.select("fp").mapInPandas(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n")).collect():
        both[i, j] = n
    return fps.count(), both


def grouped_bits(n: int, both: np.ndarray, groups: int) -> list[tuple[int, ...]]:
    """Bits in equally large groups: each starts with the lowest bit left and takes the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.clip(p * (1 - p), 1e-12, None))
    related = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, out = list(range(BITS)), []
    for g in range(groups):
        width = len(left) // (groups - g)
        own = [left.pop(0)]
        while len(own) < width:
            own.append(left.pop(int(np.argmax(related[np.ix_(left, own)].sum(axis=1)))))
        out.append(tuple(sorted(own)))
    return out


def same_key_pairs(fps: DataFrame, groups: list[tuple[int, ...]]) -> list[float]:
    """For each group of bits, how many pairs of all fingerprints agree in it."""
    keys = F.array(*[F.struct(F.lit(i).alias("g"), F.col("fp").bitwiseAND(F.lit(Partition(bits, 0).mask)).alias("key"))
                     for i, bits in enumerate(groups)])
    counts = fps.select(F.explode(keys).alias("k")).select("k.*").groupBy("g", "key").agg(F.count("*").cast("double").alias("n"))
    found = dict(counts.groupBy("g").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).collect())
    return [found.get(i, 0.0) for i in range(len(groups))]


def within(p: np.ndarray) -> np.ndarray:
    """Chance that two fingerprints with these shares of set bits differ in 0, 1, ... bits at most."""
    chances = np.zeros(len(p) + 1)
    chances[0] = 1.0
    for one in 2 * p * (1 - p):
        chances[1:] = chances[1:] * (1 - one) + chances[:-1] * one
        chances[0] *= 1 - one
    return np.cumsum(chances)


def costs(n: int, p: np.ndarray, bits: tuple[int, ...], same: float, distance: int) -> list[float]:
    """Estimated cost of searching one partition with threshold -1, 0, ... ``distance``.

    Candidates at threshold 0 are counted; those of larger ones are that count times the growth which the bits' own shares
    predict.
    """
    grow = within(p[list(bits)])
    out = [0.0]
    for t in range(distance + 1):
        probes = n * (1 + sum(math.comb(len(bits), k) for k in range(t + 1)))
        pairs = max(same * grow[t] / max(grow[0], 1e-300), n * n / 2 * grow[t]) if t else same
        out.append(probes + PAIR_COST * pairs)
    return out


def allocate(cost: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds of the partitions, with sum(t + 1) = distance + 1, of least total cost: by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in range(-1, distance - used + 1):
                new = (c + row[t + 1], [*ts, t])
                if used + t + 1 not in step or new < step[used + t + 1]:
                    step[used + t + 1] = new
        best = step
    return best[distance + 1]


def search_plan(fps: DataFrame, distance: int) -> list[Partition]:
    """Partitions and thresholds of least estimated cost for these fingerprints."""
    n, both = bit_counts(fps)
    p = np.diag(both) / max(n, 1)
    options = [grouped_bits(n, both, g) for g in range(2, distance + 2)]
    same = iter(same_key_pairs(fps, [bits for groups in options for bits in groups]))
    plans = []
    for groups in options:
        total, thresholds = allocate([costs(n, p, bits, next(same), distance) for bits in groups], distance)
        plans.append((total, [Partition(bits, t) for bits, t in zip(groups, thresholds)]))
    return min(plans, key=lambda x: x[0])[1]


def linked(fps: DataFrame, plan: list[Partition], distance: int) -> DataFrame:
    """``u, v`` of all fingerprints within the distance whose ``label`` differs; ``fps`` has ``fp, label``."""
    index, probes = [], []
    for i, part in enumerate(plan):
        if part.threshold < 0:
            continue
        own = fps.select(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(part.mask)).alias("key"), "fp", "label")
        index.append(own)
        flips = part.flips()
        probes.append(own if len(flips) == 1 else own.withColumn("flip", F.explode(F.array(*[F.lit(x) for x in flips]))).select(
            "part", F.col("key").bitwiseXOR(F.col("flip")).alias("key"), "fp", "label"))
    a, b = _union(index).alias("a"), _union(probes).alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    return (a.join(b, (F.col("a.part") == F.col("b.part")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp"))
                   & (F.col("a.label") != F.col("b.label")) & near)
            .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).distinct())


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.union(x)
    return out


def near_duplicates(docs: DataFrame, scratch: Scratch, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fp, component_id, label`` of every row.

    ``label`` names the group, also where ids are null or stand for several texts: its smallest fingerprint. ``fp`` is the fingerprint as a signed long, ``component_id`` the smallest doc_id that can be reached over fingerprints
    that differ in at most ``distance`` bits, the row's own included. A null or empty text has fingerprint 0, linked like
    any other. A null doc_id takes part but is never smallest; the id is null where a component has none. Repeated rows
    are returned each. Empty input gives no rows; other columns play no part.
    """
    rows = scratch.keep(docs.select("doc_id", fingerprints("text").alias("fp")), "fingerprints")
    fps = scratch.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")).withColumn("label", F.col("fp")), "distinct")
    found = None
    for d in sorted({min(1, distance), distance}):
        links = linked(fps, search_plan(fps, d), d)
        # Links of fingerprints, carried over to the components found so far.
        labels = fps.select(F.col("fp"), F.col("label"))
        links = (links.join(labels.toDF("u", "lu"), "u").join(labels.toDF("v", "lv"), "v")
                 .select(F.col("lu").alias("u"), F.col("lv").alias("v")))
        found = components(links, scratch, f"within_{d}")
        joined = fps.join(found, fps["label"] == found["node"], "left").select(
            "fp", "first", F.coalesce(found["label"], fps["label"]).alias("label"))
        fps = scratch.keep(joined, f"labelled_{d}")
    smallest = fps.groupBy("label").agg(F.min("first").alias("component_id"))
    return rows.join(fps.select("fp", "label").join(smallest, "label"), "fp").select("doc_id", "fp", "component_id", "label")


def one_of_each(docs: DataFrame, scratch: Scratch, distance: int = DISTANCE) -> DataFrame:
    """The documents with the smallest doc_id of their group, with their own columns.

    Rows of a group without any doc_id are no group to choose from: one of them stays. Of repeated rows with the smallest
    id, one stays. An id that stands for several texts is chosen in each of their groups on its own.
    """
    groups = near_duplicates(docs, scratch, distance)
    # An id of one row is told by the id; for the others the fingerprint tells which row stays.
    single = (groups.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("component_id"))
              .filter("n = 1 AND doc_id = component_id").select("doc_id"))
    smallest = F.col("doc_id").eqNullSafe(F.col("component_id"))
    rest = (groups.filter(smallest).groupBy("doc_id", "label").agg(F.min("fp").alias("fp")).join(single, "doc_id", "left_anti")
            .select(F.col("doc_id").alias("_id"), F.col("fp").alias("_kept")))
    kept = docs.join(single, "doc_id", "left_semi").select(docs.columns)
    if rest.isEmpty():
        return kept
    same_id = docs["doc_id"].eqNullSafe(F.col("_id"))
    marked = docs.join(rest.select("_id").distinct(), same_id, "left_semi").withColumn("_fp", fingerprints("text"))
    again = (marked.join(rest, marked["doc_id"].eqNullSafe(rest["_id"]) & (marked["_fp"] == rest["_kept"]), "left_semi")
             .dropDuplicates(["doc_id", "_fp"]))
    return kept.union(again.select(docs.columns))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"), Scratch(spark))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
