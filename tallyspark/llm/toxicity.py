"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios (after Wang and Manning,
"Baselines and Bigrams").

A text's features are the n-grams it holds at all, within and around its words. Their document counts by class are summed by
Spark over the labelled sample; those whose share differs most between the classes are kept, each scaled by its log-count
ratio, and a logistic regression is fitted over them. Scoring is one pass over the documents without a shuffle: a text is
scored in overlapping windows of about the length of the texts that the model was fitted on, and its score is that of its
most toxic window, so that what surrounds a passage doesn't outweigh it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import labelled
from tallyspark.llm.tables import is_held_out, table
from tallyspark.session import Scratch

SIZES = (4, 5, 6)
#: Bytes of a window at least.
LEAST_WINDOW = 256
#: N-grams of texts that a task sums up at once.
COUNTED = 4_000_000


@dataclass(frozen=True)
class Model:
    sample: int = 8000     # labelled rows, at most
    window: float = 0.5    # share of the labelled texts that fit a window whole
    features: int = 1024   # kept, at most
    least_docs: int = 5    # that hold a feature
    penalty: float = 1.0
    rounds: int = 400
    accept: float = 0.3


def _letters() -> np.ndarray:
    """Lower case; all that is neither a letter nor a digit becomes a space."""
    out = np.full(256, ord(" "), dtype=np.uint8)
    for c in range(256):
        if c >= 128 or chr(c).isalnum():
            out[c] = ord(chr(c).lower()) if c < 128 else c
    return out


_LETTERS = _letters()


def codes(plain: np.ndarray) -> Iterator[np.ndarray]:
    """The n-grams of each size as numbers: their bytes, none of which is 0, so no two of them share a number."""
    wide = plain.astype(np.uint64)
    code = wide
    for k in range(1, min(max(SIZES), len(wide))):
        code = code[:-1] | wide[k:] << np.uint64(8 * k)
        if k + 1 in SIZES:
            yield code


def bytes_of(text: str | None) -> np.ndarray:
    return np.frombuffer(b" " + (text or "").encode("utf-8", "surrogatepass") + b" ", dtype=np.uint8)


def present(text: str | None) -> np.ndarray:
    """Numbers of the n-grams in a whole text, each once."""
    found = [np.empty(0, dtype=np.uint64)]
    for part in labelled.blocks(bytes_of(text), max(SIZES) - 1):
        found += [np.unique(code) for code in codes(_LETTERS[part])]
    return np.unique(np.concatenate(found))


@dataclass
class Kept:
    """The features, in order of their numbers, and which slots of a small table their hashes fall into."""
    codes: np.ndarray
    slots: np.ndarray

    @staticmethod
    def of(codes: np.ndarray) -> Kept:
        slots = np.zeros(1 << 16, dtype=bool)
        slots[_slot(codes)] = True
        return Kept(codes, slots)

    def find(self, text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Position (in bytes) and number of every feature found in a whole text, and the text's length."""
        raw, at, which = bytes_of(text), [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        if len(self.codes):
            for b, part in enumerate(labelled.blocks(raw, max(SIZES) - 1)):
                for code in codes(_LETTERS[part]):
                    maybe = np.flatnonzero(self.slots[_slot(code)])
                    place = np.searchsorted(self.codes, code[maybe])
                    same = self.codes[np.minimum(place, len(self.codes) - 1)] == code[maybe]
                    at.append(maybe[same] + b * labelled.BLOCK)
                    which.append(place[same])
        return np.concatenate(at), np.concatenate(which), len(raw)


def _slot(codes: np.ndarray) -> np.ndarray:
    return codes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)


@dataclass
class Classifier:
    kept: Kept
    weights: np.ndarray   # ratio times coefficient of each feature
    bias: float
    window: int           # bytes

    def score(self, text: str | None) -> float:
        """Of the most toxic window. Windows start every half of their length; the last one ends with the text."""
        at, which, length = self.kept.find(text)
        half, n = max(self.window // 2, 1), len(self.weights)
        windows = max(-(-(length - self.window) // half), 0)  # that start before the last one
        first = at // half
        inside = [(first, which), (first - 1, which)]
        pairs = [w[(0 <= w) & (w < windows)] * n + f[(0 <= w) & (w < windows)] for w, f in inside]
        pairs = np.unique(np.concatenate([*pairs, windows * n + which[at >= length - self.window]]))
        sums = np.bincount(pairs // max(n, 1), self.weights[pairs % max(n, 1)], windows + 1) if n else np.zeros(1)
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + float(sums.max()), -30, 30)))


def counted(rows: DataFrame, how: Model) -> DataFrame:
    """``feature, toxic, clean``: in how many labelled texts of each class a feature occurs."""
    def summed(found: list[tuple[np.ndarray, bool]]) -> pd.DataFrame:
        every, place = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
        toxic = np.bincount(place, np.concatenate([np.full(len(c), y) for c, y in found]), len(every)).astype(np.int64)
        return pd.DataFrame({"feature": every.view(np.int64), "toxic": toxic,
                             "clean": np.bincount(place, minlength=len(every)) - toxic})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, size = [], 0
        for batch in batches:
            for text, y in batch.itertuples(index=False):
                found.append((present(text), y > 0))
                size += len(found[-1][0])
                if size > COUNTED:
                    yield summed(found)
                    found, size = [], 0
        if found:
            yield summed(found)

    return rows.mapInPandas(count, "feature long, toxic long, clean long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def chosen(rows: DataFrame, how: Model) -> tuple[np.ndarray, np.ndarray]:
    """Features by how surely their share differs between the classes, and their log-count ratios."""
    sizes = dict(rows.groupBy((F.col("y") > 0).cast("int").alias("y")).count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return np.empty(0, dtype=np.int64), np.empty(0)
    a, b, n = F.col("toxic"), F.col("clean"), toxic + clean
    chi2 = n * F.pow(a * clean - b * toxic, F.lit(2)) / ((a + b) * (n - a - b + 1) * F.lit(float(toxic) * clean))
    ratio = F.log((a + 1) / F.lit(toxic + 2.0)) - F.log((b + 1) / F.lit(clean + 2.0))
    best = (counted(rows, how).filter(a + b >= how.least_docs).select("feature", chi2.alias("chi2"), ratio.alias("ratio"))
            .orderBy(F.desc("chi2"), "feature").limit(how.features).toPandas())
    return best["feature"].to_numpy(np.int64), best["ratio"].to_numpy(np.float64)


def fit(docs: DataFrame, labels: DataFrame, how: Model, scratch: Scratch) -> Classifier:
    """The driver gets the kept features and, for each row of the bounded sample, which of them it holds."""
    rows = scratch.keep(labelled.sample(docs, labels, "toxic", how.sample), "sample")
    features, ratios = chosen(rows, how)
    order = np.argsort(features)
    features, ratios = features[order], ratios[order]
    kept = Kept.of(features.view(np.uint64))
    window = rows.agg(F.percentile(F.octet_length("text"), how.window)).first()[0]
    window = max(int(window or 0) + 2, LEAST_WINDOW)

    def hold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"y": batch["y"], "at": [np.unique(kept.find(t)[1]) for t in batch["text"]]})

    found = rows.mapInPandas(hold, "y int, at array<int>").collect() if len(features) else []
    found.sort(key=lambda r: (r["y"], r["at"]))  # the same fit whatever order the rows come in
    x = np.zeros((len(found), len(features)), dtype=np.float32)
    for i, row in enumerate(found):
        x[i, row["at"]] = ratios[row["at"]]
    if not len(found):
        share = rows.agg(F.avg((F.col("y") > 0).cast("int"))).first()[0]
        share = 0.5 if share is None else min(max(share, 1e-6), 1 - 1e-6)
        return Classifier(kept, np.zeros(0), float(np.log(share / (1 - share))), window)
    coefficients, bias = regression(x, np.array([r["y"] > 0 for r in found], dtype=np.float32), how)
    return Classifier(kept, coefficients * ratios, bias, window)


def regression(x: np.ndarray, y: np.ndarray, how: Model) -> tuple[np.ndarray, float]:
    """Logistic regression with a squared penalty, by accelerated gradient steps of a safe length."""
    n = len(y)
    w, b = np.zeros(x.shape[1]), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    v = np.ones(x.shape[1], dtype=np.float32)
    for _ in range(20):
        v = x.T @ (x @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1 / (0.25 * (np.linalg.norm(x @ v) ** 2 + n) / n + how.penalty / n)
    u, c, before_w, before_b = w, b, w, b
    for k in range(how.rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ u.astype(np.float32) + c, -30, 30)))
        w, b = u - step * (x.T @ (p - y) / n + how.penalty / n * u), c - step * float((p - y).mean())
        fast = k / (k + 3)
        u, c = w + fast * (w - before_w), b + fast * (b - before_b)
        before_w, before_b = w, b
    return w, b


def score(docs: DataFrame, model: Classifier, how: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most how.features features: under 1 MB

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    return docs.withColumn("score", of("text"))


def rate(docs: DataFrame, labels: DataFrame, scratch: Scratch, how: Model = Model()) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher is more toxic) and ``predicted`` (1 if toxic).

    Null and empty texts are scored like any other, by the bias alone. If the labelled rows have one class or none, every
    score is that class's share (0.5 without rows). Repeated rows get the same score each, empty input gives no rows. A
    column that is named score or predicted already is replaced.
    """
    scored = score(docs, fit(docs, labels, how, scratch), how)
    return scored.withColumn("predicted", (F.col("score") >= how.accept).cast("int"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return rate(docs, table(spark, folder, "labels"), Scratch(spark)).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
