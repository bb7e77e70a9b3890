"""Nearest neighbours by Euclidean distance over vantage-point trees, one per shard.

A small vantage-point tree over a bounded sample cuts space into cells; a cell's rows, split by hash where they are many, are
shards of bounded size. Each shard's tree is built once, in one task, and written as one row. A query first searches the cell
it lies in. The distance of its k-th neighbour there decides which other cells it has to visit. In a shard the queries
walk down the tree together, block by block. A cell or branch is left out if the triangle inequality rules it out for
the distance of the k-th neighbour so far, times a factor: at factor 1 the search is exact, below 1 it leaves out more and may
miss some.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.tables import table
from tallyspark.session import Scratch


@dataclass(frozen=True)
class Search:
    k: int = 10
    factor: float = 0.9
    shard_rows: int = 8192
    block_rows: int = 1024
    chunk_rows: int = 16384  # queries that meet a shard in one task
    cells: int = 1024        # at most
    sample: int = 8192       # rows that the cells are made of, at most
    leaf: int = 64
    seed: int = 11


@dataclass
class Tree:
    """Rows sorted so that each node is a range. ``nodes`` has, per node: start, end, row of the vantage point, largest
    distance from it in the inner child, smallest in the outer one, inner child, outer child (-1: a leaf)."""
    ids: np.ndarray
    vectors: np.ndarray
    nodes: np.ndarray


def distances(a: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, components summed from first to last."""
    return np.sqrt(np.cumsum((a - point) ** 2, axis=1)[:, -1]) if a.shape[1] else np.zeros(len(a))


@dataclass
class Top:
    """The tree of cells: per node the vantage point, the largest distance inside, and both children (a cell c as ~c)."""
    points: np.ndarray
    cuts: list[float]
    children: list[list[int]]
    cells: int

    def cells_of(self, vectors: np.ndarray) -> np.ndarray:
        return self.within(vectors, np.zeros(len(vectors)), 0.0).argmax(axis=1)

    def within(self, vectors: np.ndarray, kth: np.ndarray, factor: float) -> np.ndarray:
        """Which cells may hold something nearer than each vector's bound; the vector's own one always counts."""
        out = np.zeros((len(vectors), self.cells), dtype=bool)
        slack = np.where(np.isinf(kth), np.inf, factor * kth)
        waiting = [(0 if self.cuts else ~0, np.arange(len(vectors)))]
        while waiting:
            n, active = waiting.pop()
            if n < 0:
                out[active, ~n] = True
                continue
            gap = distances(vectors[active], self.points[n]) - self.cuts[n]
            reach = np.where(slack[active] > 0, slack[active] + 1e-9 * (1 + np.abs(self.cuts[n])), 0)
            inner, outer = self.children[n]
            waiting += [(inner, active[gap <= reach]), (outer, active[(gap > 0) | (-gap <= reach) & (reach > 0)])]
        return out


def top(vectors: np.ndarray, cells: int) -> Top:
    """Cells, at most so many, that hold about equal parts of the vectors."""
    points, cuts, children, n_cells = [], [], [], 0
    waiting = [(np.arange(len(vectors)), cells, -1, 0)]
    while waiting:
        rows, wanted, parent, side = waiting.pop()
        away = distances(vectors[rows], vectors[rows[0]]) if wanted > 1 and len(rows) > 1 else np.zeros(len(rows))
        cut = float(np.quantile(away, 0.5, method="lower")) if len(away) else 0.0
        inside = away <= cut
        here = len(cuts)
        if inside.all():
            here, n_cells = ~n_cells, n_cells + 1
        else:
            points.append(vectors[rows[0]])
            cuts.append(cut)
            children.append([0, 0])
            waiting += [(rows[inside], wanted // 2, here, 0), (rows[~inside], wanted // 2, here, 1)]
        if parent >= 0:
            children[parent][side] = here
    return Top(np.array(points), cuts, children, n_cells)


def build(ids: np.ndarray, vectors: np.ndarray, how: Search) -> Tree:
    order, nodes = np.argsort(ids, kind="stable"), []
    rng = np.random.Generator(np.random.PCG64(how.seed))
    waiting = [(0, len(ids), -1, 0)]
    while waiting:
        start, end, parent, side = waiting.pop()
        if parent >= 0:
            nodes[parent][5 + side] = len(nodes)
        node = [start, end, order[start], 0.0, 0.0, -1, -1]
        nodes.append(node)
        if end - start <= how.leaf:
            continue
        rows = order[start:end]
        point = rows[rng.integers(len(rows))]
        away = distances(vectors[rows], vectors[point])
        by = np.argsort(away, kind="stable")
        cut = np.searchsorted(away[by], away[by][len(rows) // 2], side="left")  # equal distances stay together
        cut = cut if cut else np.searchsorted(away[by], away[by][0], side="right")
        if cut == len(rows):
            continue  # all equally far: a leaf, however large
        order[start:end] = rows[by]
        node[2:5] = point, away[by][cut - 1], away[by][cut]
        waiting += [(start, start + cut, len(nodes) - 1, 0), (start + cut, end, len(nodes) - 1, 1)]
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    table_of_nodes = np.array(nodes, dtype=np.float64).reshape(-1, 7)
    table_of_nodes[:, 2] = place[table_of_nodes[:, 2].astype(np.int64)]
    return Tree(ids[order], vectors[order], table_of_nodes)


class Walk:
    """The search of one block of queries in one tree."""

    def __init__(self, tree: Tree, ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, how: Search):
        self.tree, self.own, self.queries, self.how = tree, ids, queries, how
        self.squares = (tree.vectors ** 2).sum(axis=1)
        self.best = [(np.empty(0), np.empty(0, dtype=np.int64)) for _ in ids]
        self.kth = kth.copy()
        self.compared = np.zeros(len(ids), dtype=np.int64)
        if len(ids):
            self.visit(0, np.arange(len(ids)))

    def visit(self, n: int, active: np.ndarray) -> None:
        start, end, point, inner_most, outer_least, inner, outer = self.tree.nodes[n]
        if inner < 0:
            self.scan(int(start), int(end), active)
            return
        away = np.sqrt(((self.queries[active] - self.tree.vectors[int(point)]) ** 2).sum(axis=1))
        nearer = away <= (inner_most + outer_least) / 2
        for first, second, some in ((inner, outer, nearer), (outer, inner, ~nearer)):
            if some.any():
                self.visit(int(first), active[some])
                gap = away[some] - inner_most if second == inner else outer_least - away[some]
                left = active[some][gap <= self.how.factor * self.kth[active[some]] + 1e-9]
                if len(left):
                    self.visit(int(second), left)

    def scan(self, start: int, end: int, active: np.ndarray) -> None:
        vectors, ids = self.tree.vectors[start:end], self.tree.ids[start:end]
        q = self.queries[active]
        square = (q ** 2).sum(axis=1)[:, None] + self.squares[None, start:end]
        near = square - 2 * (q @ vectors.T) <= self.kth[active][:, None] ** 2 + 1e-9 * (1 + square)
        self.compared[active] += end - start
        for row in np.flatnonzero(near.any(axis=1)):
            i = active[row]
            hits = np.flatnonzero(near[row] & (ids != self.own[i]))
            d = np.concatenate([self.best[i][0], distances(vectors[hits], self.queries[i])])
            v = np.concatenate([self.best[i][1], ids[hits]])
            top = np.lexsort((v, d))[: self.how.k]
            self.best[i] = d[top], v[top]
            if len(top) == self.how.k:
                self.kth[i] = min(self.kth[i], d[top[-1]])

    def found(self) -> pd.DataFrame:
        """What was found, and a row for each query with the number of vectors it was compared with."""
        sizes = [len(d) for d, _ in self.best]
        none = np.full(len(self.own), np.nan)
        return pd.DataFrame({
            "query_id": np.concatenate([np.repeat(self.own, sizes), self.own]),
            "vec_id": np.concatenate([v for _, v in self.best] + [self.own]),
            "score": np.concatenate([d for d, _ in self.best] + [none]),
            "compared": np.concatenate([np.zeros(sum(sizes), dtype=np.int64), self.compared])})


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, v, dim``: rows with an id and a vector that isn't null, empty or zero and has only finite components."""
    v = F.col("embedding").cast("array<double>")
    return (rows.select("vec_id", v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is above infinity here
        & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v")))


def trees(dealt: DataFrame, how: Search) -> DataFrame:
    """One row per shard with its tree."""
    def of(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = build(group["vec_id"].to_numpy(np.int64), np.stack(group["v"].to_numpy()).astype(np.float64), how)
        return pd.DataFrame({"dim": [key[0]], "cell": [key[1]], "shard": [key[2]], "ids": [tree.ids.tobytes()],
                             "vectors": [tree.vectors.tobytes()], "nodes": [tree.nodes.tobytes()]})

    return dealt.groupBy("dim", "cell", "shard").applyInPandas(
        of, "dim int, cell int, shard int, ids binary, vectors binary, nodes binary")


def tops(rows: DataFrame, n_rows: int, how: Search) -> dict[int, Top]:
    """A tree of cells for each vector length in a sample of bounded size; other lengths have one cell."""
    wanted = min(how.cells, -(-n_rows // how.shard_rows))
    if wanted < 2:
        return {}
    some = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(min(how.sample, 64 * wanted)).select("dim", "v").collect()
    lengths = {row["dim"] for row in some}
    return {dim: top(np.array([r["v"] for r in some if r["dim"] == dim]), wanted) for dim in sorted(lengths)}


def _of_each_length(vectors: pd.Series):
    lengths = vectors.map(len).to_numpy()
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        yield int(dim), at, np.stack(vectors.iloc[at].to_numpy()).astype(np.float64)


def found(rows: DataFrame, queries: DataFrame, scratch: Scratch, how: Search) -> DataFrame:
    """``query_id, vec_id, score, compared``: the nearest of every shard that a query visits, and one row per query and
    shard without a score that tells with how many vectors it was compared."""
    rows, queries = usable(rows), usable(queries)
    n_rows, n_queries = rows.count(), queries.count()
    shared = rows.sparkSession.sparkContext.broadcast(tops(rows, n_rows, how))  # how.cells vectors at most per length

    @F.pandas_udf("int")
    def home(vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), dtype=np.int32)
        for dim, at, v in _of_each_length(vectors):
            if dim in shared.value:
                out[at] = shared.value[dim].cells_of(v)
        return pd.Series(out)

    @F.pandas_udf("array<int>")
    def others(vectors: pd.Series, cell: pd.Series, kth: pd.Series) -> pd.Series:
        out = pd.Series([[]] * len(vectors))
        for dim, at, v in _of_each_length(vectors):
            if dim in shared.value:
                within = shared.value[dim].within(v, kth.to_numpy()[at], how.factor)
                within[np.arange(len(at)), cell.to_numpy()[at]] = False
                for i, mask in zip(at, within):
                    out.iat[i] = np.flatnonzero(mask).tolist()
        return out

    celled = scratch.keep(rows.withColumn("cell", home("v")), "cells")
    sizes = celled.groupBy("dim", "cell").agg(F.ceil(F.count("*") / how.shard_rows).cast("int").alias("shards"))
    place = F.xxhash64("vec_id", "v")
    dealt = celled.join(sizes, ["dim", "cell"]).withColumn("shard", F.pmod(place, F.col("shards")).cast("int"))
    planted = scratch.keep(trees(dealt.drop("shards"), how), "trees")
    chunks = max(1, -(-n_queries // how.chunk_rows))
    copies = planted.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def search(asked: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for row in tree.itertuples():
            dim = int(row.dim)
            grown = Tree(np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.vectors).reshape(-1, dim),
                         np.frombuffer(row.nodes).reshape(-1, 7))
            for at in range(0, len(asked), how.block_rows):
                block = asked.iloc[at:at + how.block_rows]
                parts.append(Walk(grown, block["vec_id"].to_numpy(np.int64), np.stack(block["v"].to_numpy()).astype(np.float64),
                                  block["kth"].to_numpy(np.float64), how).found())
        return pd.concat(parts) if parts else pd.DataFrame(
            {"query_id": [], "vec_id": [], "score": [], "compared": []}).astype({"query_id": "int64", "vec_id": "int64", "compared": "int64"})

    def searched(asked: DataFrame) -> DataFrame:
        """Queries with a cell to search and a bound meet the trees of the cell's shards."""
        met = (asked.join(sizes, ["dim", "cell"]).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
               .withColumn("chunk", F.pmod(place, F.lit(chunks)).cast("int")))
        keys = ("dim", "cell", "shard", "chunk")
        return met.select(*keys, "vec_id", "v", "kth").groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(
            search, "query_id long, vec_id long, score double, compared long")

    asked = queries.withColumn("cell", home("v"))
    first = scratch.keep(searched(asked.withColumn("kth", F.lit(float("inf")))), "at_home")
    bound = (best_of(first, how).groupBy("query_id")
             .agg(F.when(F.count("*") == how.k, F.max("score")).alias("kth")).withColumnRenamed("query_id", "vec_id"))
    rest = (asked.join(bound, "vec_id", "left").withColumn("kth", F.coalesce("kth", F.lit(float("inf"))))
            .withColumn("cell", F.explode(others("v", "cell", "kth"))))
    return first.unionByName(searched(rest))


def best_of(hits: DataFrame, how: Search) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (hits.filter(F.col("score").isNotNull() & ~F.isnan("score")).withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= how.k).select("query_id", "rank", "vec_id", "score"))


def nearest(rows: DataFrame, queries: DataFrame, scratch: Scratch, how: Search = Search()) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` nearest rows found, ties to the smaller vec_id.

    Both inputs have ``vec_id`` and ``embedding``. Rows with the query's own vec_id are no candidates; repeated rows of
    other ids count each. Vectors that are null, empty or zero, or hold null or non-finite components, and rows without a
    vec_id take no part. Vectors of different lengths aren't compared. With fewer candidates than ``k`` all are returned;
    empty input gives no rows. Other columns play no part.
    """
    return best_of(found(rows, queries, scratch, how), how)


def op6_vp_trees(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return nearest(rows, rows.filter("vec_id % 100 = 0"), Scratch(spark))


SQL = """
WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_reduce(list_transform(generate_series(1, len(q.v)), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])),
                          lambda a, b: a + b)) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v))
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score, vec_id) QUALIFY row_number() OVER best <= 10
"""
