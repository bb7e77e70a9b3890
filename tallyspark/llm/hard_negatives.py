"""Hard negatives by segment summaries.

A vector is cut into segments, and each segment is summed up by its mean and its deviation. For two segments of length n the
inner product is n times (product of the means plus at most the product of the deviations, minus at least that), by the
Cauchy-Schwarz inequality. Summed over the segments that bounds a score from both sides. Pairs are bounded with a few long
segments first; those that may still matter are bounded again with shorter ones, level by level, and only what is left is
scored exactly.

Anchors and rows meet in a grid of cells, a shard of rows by a block of anchors, both of bounded size, so that each row is sent
once per block of anchors and no task holds more than a cell. The first grid has the rows of the anchors' own label and finds
the positives, the second has all rows and finds the negatives: there the positives' scores say which scores matter at all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.tables import table
from tallyspark.session import Scratch


@dataclass(frozen=True)
class Mining:
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50                           # percent of the positive's score
    high: int = 95
    segments: tuple[int, ...] = (32, 8, 2)  # lengths, coarse to fine
    shard_rows: int = 8192
    block_rows: int = 2048
    tile: int = 512                         # anchors, and rows, that are bounded at once


@dataclass
class Level:
    """Means and deviations of all segments of one length, both times the root of the length: products add up to scores."""
    means: np.ndarray
    deviations: np.ndarray


class Vectors:
    """Whole-numbered vectors with their summaries. Sums stay exact: in doubles while they can't leave 2^53, else in longs."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray, segments: Sequence[int], exact: type):
        self.ids, self.labels, self.values, self.levels = ids, labels, values.astype(exact), []
        x = values.astype(np.float64)
        self.norms = np.sqrt((x ** 2).sum(axis=1))
        for length in segments if x.shape[1] else ():
            cuts = np.arange(0, x.shape[1], length)
            n = np.diff(np.append(cuts, x.shape[1]))
            total, squares = np.add.reduceat(x, cuts, axis=1), np.add.reduceat(x ** 2, cuts, axis=1)
            self.levels.append(Level(total / np.sqrt(n), np.sqrt(np.maximum(squares - total ** 2 / n, 0.0))))


def vectors(group: pd.DataFrame, how: Mining, exact: type) -> Vectors:
    dim = int(group["dim"].iloc[0]) if len(group) else 0
    values = np.stack(group["q"].to_numpy()).reshape(len(group), dim) if len(group) else np.empty((0, 0), dtype=np.int64)
    return Vectors(group["vec_id"].to_numpy(np.int64), group["label"].to_numpy(np.int64), values.astype(np.int64), how.segments, exact)


def exact_type(a: pd.DataFrame, b: pd.DataFrame) -> type:
    """Doubles hold every partial sum of a score while the product of the norms is below 2^53."""
    return np.float64 if a["square"].max() * b["square"].max() < 2.0 ** 104 else np.int64


@dataclass
class Pairs:
    row: np.ndarray
    column: np.ndarray
    score: np.ndarray


class Scorer:
    """Scores of the pairs of anchors and rows that bounds can't rule out. ``bounded`` counts pairs per level, ``scored`` the rest."""

    def __init__(self, anchors: Vectors, rows: Vectors):
        self.anchors, self.rows = anchors, rows
        self.bounded, self.scored = [0] * len(anchors.levels), 0

    def pairs(self, a: np.ndarray, b: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> Pairs:
        """Of the pairs of anchors ``a`` and rows ``b`` that are ``wanted``, all whose score is within ``low`` .. ``high``."""
        slack = 1e-9 * self.anchors.norms[a] * (self.rows.norms[b].max() if len(b) else 0.0) + 1e-3
        least, most = low - slack, high + slack
        for i, (mine, theirs) in enumerate(zip(self.anchors.levels, self.rows.levels)):
            self.bounded[i] += wanted.size
            middle = mine.means[a] @ theirs.means[b].T
            spread = mine.deviations[a] @ theirs.deviations[b].T
            wanted = wanted & (middle + spread >= least[:, None]) & (middle - spread <= most[:, None])
            on_a, on_b = wanted.any(axis=1), wanted.any(axis=0)
            a, least, most, low, high, b = a[on_a], least[on_a], most[on_a], low[on_a], high[on_a], b[on_b]
            wanted = wanted[np.ix_(on_a, on_b)]
        self.scored += int(wanted.sum())
        r, c = np.nonzero(wanted)
        if 8 * len(r) > wanted.size:
            score = (self.anchors.values[a] @ self.rows.values[b].T)[r, c]
        else:
            score = np.einsum("ij,ij->i", self.anchors.values[a[r]], self.rows.values[b[c]])
        score = score.astype(np.int64)
        keep = (score >= low[r]) & (score <= high[r])
        return Pairs(a[r[keep]], b[c[keep]], score[keep])


def best(key: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the first ``k`` of their key: higher scores first, ties by smaller id; in that order."""
    order = np.lexsort((ids, -score, key))
    sorted_key = key[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    start = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order
    return order[np.arange(len(order)) - start < k]


def tiles(n: int, size: int) -> list[np.ndarray]:
    return [np.arange(at, min(at + size, n)) for at in range(0, n, size)]


def growing_tiles(n: int, size: int) -> list[np.ndarray]:
    """Small tiles first: what they find tells how much the later ones need."""
    ends = [0]
    while ends[-1] < n:
        ends.append(min(n, ends[-1] + min(size, max(16, ends[-1]))))
    return [np.arange(a, b) for a, b in zip(ends, ends[1:])]


class Kept:
    """The best rows found so far for each of some searches, and the score that a row needs to be among them."""

    def __init__(self, low: np.ndarray, k: int):
        self.k, self.low = k, low.copy()
        self.key, self.score, self.row, self.ids = (np.empty(0, dtype=np.int64) for _ in range(4))

    def add(self, key: np.ndarray, score: np.ndarray, row: np.ndarray, ids: np.ndarray) -> None:
        key, score = np.concatenate([self.key, key]), np.concatenate([self.score, score])
        row, ids = np.concatenate([self.row, row]), np.concatenate([self.ids, ids])
        top = best(key, score, ids, self.k)
        self.key, self.score, self.row, self.ids = key[top], score[top], row[top], ids[top]
        full = np.bincount(self.key, minlength=len(self.low)) >= self.k
        last = np.full(len(self.low), np.iinfo(np.int64).max)
        np.minimum.at(last, self.key, self.score)
        self.low[full] = np.maximum(self.low[full], last[full])


def nearest_same(anchors: Vectors, rows: Vectors, how: Mining) -> tuple[Kept, Scorer]:
    """The best rows of one cell for each anchor, its own row left out."""
    scorer = Scorer(anchors, rows)
    lowest, highest = np.iinfo(np.int64).min // 2, np.iinfo(np.int64).max // 2
    kept = Kept(np.full(len(anchors.ids), lowest), how.positives)
    for a in tiles(len(anchors.ids), how.tile):
        for b in growing_tiles(len(rows.ids), how.tile):
            wanted = anchors.ids[a][:, None] != rows.ids[b][None, :]
            found = scorer.pairs(a, b, wanted, kept.low[a], np.full(len(a), highest))
            kept.add(found.row, found.score, found.column, rows.ids[found.column])
    return kept, scorer


def limits(positive: np.ndarray, how: Mining) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score s with low * positive <= 100 * s <= high * positive, without leaving a long."""
    whole, rest = positive // 100, positive % 100
    return whole * how.low - (-rest * how.low // 100), whole * how.high + rest * how.high // 100


def negatives_of(anchors: Vectors, rows: Vectors, owner: np.ndarray, positive: np.ndarray, how: Mining) -> tuple[Kept, Scorer]:
    """The best rows of one cell for each positive: ``owner`` is the place of its anchor, ``positive`` its score."""
    scorer = Scorer(anchors, rows)
    low, high = limits(positive, how)
    kept = Kept(low, how.negatives)
    top = np.full(len(anchors.ids), np.iinfo(np.int64).min // 2)
    np.maximum.at(top, owner, high)
    first = np.searchsorted(owner, np.arange(len(anchors.ids) + 1))
    for a in tiles(len(anchors.ids), how.tile):
        for b in growing_tiles(len(rows.ids), how.tile):
            need = np.full(len(anchors.ids), np.iinfo(np.int64).max // 2)
            np.minimum.at(need, owner, kept.low)
            wanted = anchors.labels[a][:, None] != rows.labels[b][None, :]
            found = scorer.pairs(a, b, wanted, need[a], top[a])
            # Every pair is tried on each positive of its anchor.
            count = first[found.row + 1] - first[found.row]
            pair = np.repeat(np.arange(len(found.row)), count)
            key = np.repeat(first[found.row], count) + np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
            score = found.score[pair]
            fits = (score >= kept.low[key]) & (score <= high[key])
            pair, key = pair[fits], key[fits]
            kept.add(key, found.score[pair], found.column[pair], rows.ids[found.column[pair]])
    return kept, scorer


def usable(rows: DataFrame, how: Mining) -> DataFrame:
    """``vec_id, label, q, dim, square``: one whole-numbered vector for each id that takes part."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * how.scale))
    fine = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < 2.0 ** 31 / how.scale))
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    read = (rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), scaled.cast("array<int>").alias("q")))
    single = read.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")
    return single.withColumns({"dim": F.size("q"), "square": square}).filter(F.col("square") < 2.0 ** 62)


def grid(rows: DataFrame, anchors: DataFrame, by: Sequence[str], how: Mining, cell: Callable, schema: str) -> DataFrame:
    """Run ``cell`` on every meeting of a shard of rows with a block of anchors that agree in ``by``."""
    n = rows.groupBy(*by).agg(F.count("*").alias("n"))
    sizes = anchors.groupBy(*by).agg(F.count("*").alias("n_anchors")).join(n, list(by)).select(
        *by, F.ceil(F.col("n") / how.shard_rows).cast("int").alias("shards"),
        F.ceil(F.col("n_anchors") / how.block_rows).cast("int").alias("blocks"))

    def dealt(df: DataFrame, own: str, other: str, seed: int) -> DataFrame:
        placed = df.join(sizes, list(by)).withColumns({
            own[:-1]: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(own)).cast("int"),
            other[:-1]: F.explode(F.sequence(F.lit(0), F.col(other) - 1))})
        placed = placed.drop("shards", "blocks")
        return placed.toDF(*placed.columns).groupBy(*by, "shard", "block")  # both sides may stem from one table

    return dealt(anchors, "blocks", "shards", 1).cogroup(dealt(rows, "shards", "blocks", 2)).applyInPandas(cell, schema)


def positives(rows: DataFrame, anchors: DataFrame, how: Mining) -> DataFrame:
    """``anchor_id, positive_id, positive_score``: the best rows of the anchors' own labels."""
    def cell(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"anchor_id": [], "positive_id": [], "positive_score": []}, dtype=np.int64)
        exact = exact_type(a, b)
        mine = vectors(a, how, exact)
        kept, _ = nearest_same(mine, vectors(b, how, exact), how)
        return pd.DataFrame({"anchor_id": mine.ids[kept.key], "positive_id": kept.ids, "positive_score": kept.score})

    found = grid(rows, anchors, ["dim", "label"], how, cell, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= how.positives).drop("r")


def mine(embeddings: DataFrame, anchors: DataFrame, scratch: Scratch, how: Mining = Mining()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows whose vec_id is in
    ``anchors``.

    Each component x counts as floor(scale * x). Rows without a vec_id or label, and vectors that are null or hold a null or
    non-finite component, take no part, nor do vectors so long that a score could leave a long (a norm of 2^31 or more after
    scaling). Of rows that share a vec_id the one with the smallest label, then the smallest vector, takes part. Vectors of
    different lengths aren't compared. Where fewer rows fit than asked for, all are returned; ties go to the smaller vec_id.
    Empty input gives no rows; other columns play no part.
    """
    rows = scratch.keep(usable(embeddings, how), "vectors")
    chosen = rows.join(anchors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")
    found = scratch.keep(positives(rows, chosen, how), "positives")
    # Positives whose interval is empty (a negative score) can have no negatives.
    asked = found.filter("positive_score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))

    def cell(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        columns = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        if not len(a) or not len(b):
            return pd.DataFrame({c: [] for c in columns}, dtype=np.int64)
        exact = exact_type(a, b)
        own, their = vectors(a, how, exact), vectors(b, how, exact)
        owner = np.repeat(np.arange(len(a)), [len(p) for p in a["positives"]])
        ids = np.array([p["positive_id"] for some in a["positives"] for p in some], dtype=np.int64)
        scores = np.array([p["positive_score"] for some in a["positives"] for p in some], dtype=np.int64)
        kept, _ = negatives_of(own, their, owner, scores, how)
        return pd.DataFrame({"anchor_id": own.ids[owner[kept.key]], "positive_id": ids[kept.key], "positive_score": scores[kept.key],
                             "negative_id": kept.ids, "negative_score": kept.score})

    near = grid(rows, rows.join(asked, "vec_id"), ["dim"], how, cell,
                "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= how.negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return mine(rows, rows.filter("vec_id % 50 = 0"), Scratch(spark))


SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(coalesce(list_sum(list_transform(generate_series(1, len(a.q)), lambda i: a.q[i] * c.q[i])), 0) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id AND len(a.q) = len(c.q)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, n.vec_id AS negative_id, positive_score,
       n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) QUALIFY row_number() OVER best <= 3
"""
