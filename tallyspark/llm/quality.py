"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are of four kinds: its words; the letter triples within and around them; n-grams of its shape (letters, digits
and spaces reduced to their class, runs collapsed, punctuation kept) together with how much its words repeat; and what stands
on both sides of each gap between words. Terms are hashed, and weighted by damped count and inverse document frequency; every
kind has its share of a text's vector. A truncated singular value decomposition of the labelled sample gives the latent space.
The labelled vectors, of proven size, are broadcast; every document is compared with all of them by exact cosine products,
block by block, and its nearest neighbours vote with weights that grow with their similarity. The part of a text that the
latent space can't express lowers its similarity to everything, and a text that is much less like its neighbours than
labelled ones are like theirs gets a lower score: what resembles nothing known isn't accepted.
"""

from __future__ import annotations

import pickle
import string
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import labelled
from tallyspark.llm.tables import is_held_out, table

SHAPE_BITS, GAP_BITS, LETTER_BITS, WORD_BITS = 11, 8, 12, 13
#: Dimensions beside the hashed shapes: repeated words, repeated word pairs, a word right after itself.
REPEATS = 3
#: Dimensions of each kind of term and its share of a text's vector.
KINDS = {"shape": ((1 << SHAPE_BITS) + REPEATS, 1.0), "gaps": (1 << GAP_BITS, 0.8), "letters": (1 << LETTER_BITS, 1.2),
         "words": (1 << WORD_BITS, 0.8)}
ENDS = np.cumsum([size for size, _ in KINDS.values()])
TERMS = int(ENDS[-1])


@dataclass(frozen=True)
class Voting:
    sample: int = 3000      # labelled rows, at most
    rank: int = 32          # latent dimensions
    neighbours: int = 25
    sharpness: float = 8.0  # a neighbour's weight is its cosine to this power
    accept: float = 0.7
    unlike: float = 0.02    # share of the accepted labelled rows that may be less like their neighbours than the others
    slack: float = 0.8      # what other texts need of their likeness
    few_words: float = 10.0  # at this many words half that likeness is enough
    block: int = 256        # documents compared at once


def _shape_classes() -> np.ndarray:
    classes = np.arange(256, dtype=np.uint8)
    classes[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = ord("a")
    classes[ord("A"):ord("Z") + 1] = ord("A")
    classes[ord("0"):ord("9") + 1] = ord("0")
    classes[[*b"\t\x0b\x0c\r"]] = ord(" ")
    return classes


def _letters() -> np.ndarray:
    """Lower case; all that isn't a letter becomes a space."""
    out = np.full(256, ord(" "), dtype=np.uint8)
    out[128:] = np.arange(128, 256)
    for lower in range(ord("a"), ord("z") + 1):
        out[[lower, lower - 32]] = lower
    return out


_CLASSES, _LETTERS = _shape_classes(), _letters()


def _collapsed(values: np.ndarray) -> np.ndarray:
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def term_vector(text: str | None) -> np.ndarray:
    """Term counts of a whole text, logs for its shape, roots for all else; null counts as empty."""
    out = np.zeros(TERMS, dtype=np.float32)
    shapes, gaps, letters, hashed_words = np.split(out, ENDS[:-1])
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    for part in labelled.blocks(raw, 0):
        shape = _collapsed(_CLASSES[part])
        for n in (1, 2, 3, 4):
            shapes[:-REPEATS] += np.bincount(labelled.grams(shape, n, SHAPE_BITS), minlength=1 << SHAPE_BITS)
        gap = np.isin(shape[1:-1], (ord(" "), ord("\n")))
        gaps += np.bincount(labelled.grams(shape, 3, GAP_BITS)[gap], minlength=len(gaps))
        plain = _LETTERS[part]
        plain = plain[np.concatenate(([True], (plain[1:] != ord(" ")) | (plain[:-1] != ord(" "))))] if len(plain) else plain
        letters += np.bincount(labelled.grams(plain, 3, LETTER_BITS), minlength=len(letters))
    words = (text or "").split()
    for word, times in Counter(words).items():
        plain_word = word.strip(string.punctuation).lower().encode("utf-8", "surrogatepass")
        hashed_words[zlib.crc32(plain_word) >> (32 - WORD_BITS)] += times
    np.log1p(shapes, out=shapes)
    np.sqrt(out[ENDS[0]:], out=out[ENDS[0]:])
    if len(words) > 1:
        pairs = len(words) - 1
        shapes[-REPEATS:] = (4 * (1 - len(set(words)) / len(words)) ** 2, 12 * (1 - len(set(zip(words, words[1:]))) / pairs),
                             12 * sum(a == b for a, b in zip(words, words[1:])) / pairs)
    return out


@dataclass
class Space:
    weights: np.ndarray   # inverse document frequency of each term
    axes: np.ndarray      # terms x rank
    vectors: np.ndarray   # labelled rows x rank, of length 1 or 0
    labels: np.ndarray
    likeness: float = 0.0  # mean similarity to the neighbours that a full score takes of a long text

    def project(self, terms: np.ndarray) -> np.ndarray:
        """Places in the latent space: the shorter, the less of a text the space expresses."""
        return balanced(terms * self.weights) @ self.axes

    def neighbours(self, near: np.ndarray, how: Voting) -> tuple[np.ndarray, np.ndarray]:
        """Weights and labels of the nearest labelled rows, given the similarity to all."""
        top = np.argpartition(-near, min(how.neighbours, near.shape[1]) - 1, axis=1)[:, :how.neighbours]
        weight = np.clip(np.take_along_axis(near, top, axis=1), 0, None).astype(np.float64) ** how.sharpness
        return weight, self.labels[top]

    def vote(self, terms: np.ndarray, how: Voting) -> np.ndarray:
        """Share of label 1 among the weighted neighbours, less where they are unlike; without any, the labelled rows' share."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(terms), prior)
        weight, labels = self.neighbours(self.project(terms) @ self.vectors.T, how)
        total, words = weight.sum(axis=1), n_words(terms)
        least = weight.shape[1] * (self.likeness * words / (words + how.few_words)) ** how.sharpness
        return np.where(total > 1e-12, (weight * labels).sum(axis=1) / np.maximum(np.maximum(total, least), 1e-12), prior)


def n_words(terms: np.ndarray) -> np.ndarray:
    """The number of words: their terms hold the roots of their counts."""
    return (terms[:, ENDS[-2]:].astype(np.float64) ** 2).sum(axis=1)


def balanced(rows: np.ndarray) -> np.ndarray:
    """Every kind of term scaled to its share, each row to length 1."""
    kinds = np.split(rows, ENDS[:-1], axis=1)
    return unit(np.concatenate([unit(part) * np.float32(share) for part, (_, share) in zip(kinds, KINDS.values())], axis=1))


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def fit(docs: DataFrame, labels: DataFrame, how: Voting) -> Space:
    """The latent space of a bounded labelled sample. One task fits it; the driver gets the space (about 3 MB) and nothing else."""
    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, y in batch.itertuples(index=False):
                vector = term_vector(text)
                at = np.flatnonzero(vector)
                yield pd.DataFrame({"y": [y], "at": [at.astype(np.int32).tobytes()], "value": [vector[at].tobytes()]})

    def spaces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [row for batch in batches for row in batch.itertuples(index=False, name=None)]
        if rows:
            yield pd.DataFrame({"space": [pickle.dumps(space_of_rows(rows, how))]})

    sample = labelled.sample(docs, labels, "quality", how.sample).mapInPandas(terms, "y int, at binary, value binary")
    found = sample.repartition(1).mapInPandas(spaces, "space binary").collect()
    return pickle.loads(found[0]["space"]) if found else space_of_rows([], how)


def space_of_rows(rows: list[tuple[int, bytes, bytes]], how: Voting) -> Space:
    """The space of labels with the places and values of their texts' terms."""
    rows = sorted(rows)  # the same space whatever order the rows come in
    packed = PackedRows([np.frombuffer(at, dtype=np.int32) for _, at, _ in rows],
                        [np.frombuffer(value, dtype=np.float32) for _, _, value in rows], how.block)
    return space_of(packed, np.array([y for y, _, _ in rows], dtype=np.float64), how)


class PackedRows:
    """Term vectors by their places and values; only a block of rows at a time is laid out whole."""

    def __init__(self, at: list[np.ndarray], values: list[np.ndarray], block: int):
        self.at, self.values, self.block = at, values, block

    @classmethod
    def of(cls, rows: np.ndarray, block: int) -> PackedRows:
        at = [np.flatnonzero(row).astype(np.int32) for row in rows]
        return cls(at, [row[where] for row, where in zip(rows, at)], block)

    def __len__(self) -> int:
        return len(self.at)

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        """First row and whole vectors of each block."""
        for first in range(0, len(self), self.block):
            out = np.zeros((min(self.block, len(self) - first), TERMS), dtype=np.float32)
            for row, at, values in zip(out, self.at[first:], self.values[first:]):
                row[at] = values
            yield first, out

    def times(self, right: np.ndarray) -> np.ndarray:
        return np.concatenate([rows @ right for _, rows in self.blocks()] or [np.zeros((0, right.shape[1]), dtype=np.float32)])

    def each(self, change: Callable[[np.ndarray], np.ndarray]) -> PackedRows:
        """The rows changed block by block; what is 0 stays 0."""
        values = [row[self.at[first + i]] for first, rows in self.blocks() for i, row in enumerate(change(rows))]
        return PackedRows(self.at, values, self.block)


def space_of(terms: PackedRows | np.ndarray, y: np.ndarray, how: Voting) -> Space:
    """The latent space of labelled rows given by their term vectors."""
    terms = PackedRows.of(terms, how.block) if isinstance(terms, np.ndarray) else terms
    words = np.concatenate([n_words(rows) for _, rows in terms.blocks()] or [np.zeros(0)])
    found = np.bincount(np.concatenate([*terms.at, np.zeros(0, dtype=np.int32)]), minlength=TERMS)
    weights = np.log((1 + len(y)) / (1 + found)).astype(np.float32) + 1
    terms = terms.each(lambda rows: balanced(rows * weights))
    axes = principal_axes(terms, min(how.rank, max(len(y), 1)))
    latent = terms.times(axes)
    space = Space(weights, axes, unit(latent).astype(np.float32), y)
    good = np.flatnonzero((y > 0) & (words > 0))
    if len(good) > how.neighbours:
        means = []
        for at in range(0, len(good), how.block):
            some = good[at:at + how.block]
            near = latent[some] @ space.vectors.T
            near[np.arange(len(some)), some] = -1  # no row is its own neighbour
            means.append(space.neighbours(near, how)[0].mean(axis=1))
        likeness = np.concatenate(means) ** (1 / how.sharpness) * (1 + how.few_words / words[good])
        space.likeness = how.slack * float(np.quantile(likeness, how.unlike))
    return space


def principal_axes(rows: PackedRows, rank: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration: neither the rows nor a square matrix of the terms is built whole."""
    axes = np.random.Generator(np.random.PCG64(5)).normal(size=(TERMS, 2 * rank)).astype(np.float32)
    for _ in range(12):
        moved = np.zeros_like(axes)
        for _, some in rows.blocks():
            moved += some.T @ (some @ axes)
        axes, _ = np.linalg.qr(moved)
    _, _, turn = np.linalg.svd(rows.times(axes), full_matrices=False)
    return np.ascontiguousarray((axes @ turn.T)[:, :rank])


def score(docs: DataFrame, space: Space, how: Voting) -> DataFrame:
    """``docs`` with ``score``; a pass over the documents without any shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(space)  # rows and dimensions are bounded: about 3 MB

    @F.pandas_udf("double")
    def vote(texts: pd.Series) -> pd.Series:
        out = np.empty(len(texts))
        for at in range(0, len(texts), how.block):
            terms = np.stack([term_vector(t) for t in texts.iloc[at:at + how.block]])
            out[at:at + how.block] = shared.value.vote(terms, how)
        return pd.Series(np.clip(out, 0.0, 1.0))

    return docs.withColumn("score", vote("text"))


def rate(docs: DataFrame, labels: DataFrame, how: Voting = Voting()) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher is better) and ``predicted`` (1 if accepted).

    Null and empty texts are scored like any other, from a vector without terms: they get the labelled rows' share of
    label 1. Without labelled rows every score is 0.5. Repeated rows get the same score each, empty input gives no rows.
    A column that is named score or predicted already is replaced.
    """
    scored = score(docs, fit(docs, labels, how), how)
    return scored.withColumn("predicted", (F.col("score") >= how.accept).cast("int"))


def op5_quality_voting(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return rate(docs, table(spark, folder, "labels")).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
