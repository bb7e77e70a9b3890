"""Removal of repeated word windows, found by difference-cover anchors.

A difference cover D modulo v holds, for every shift, two residues that far apart. So two equal windows of ``words`` words,
wherever they start in their documents, share a place within their first v words that falls on a cover position in both.
Anchors of ``words - v + 1`` words at cover positions alone (4 of 13) therefore meet for every repeated window: a window none
of whose anchors occurs twice in the corpus is unique, and is never hashed. From an anchor that does occur twice the search
extends to all windows around it, which are told apart by 96 bits of their whole word sequence; the first of each kind stays.

Documents are packed, many to a row, and compressed. A pack's hashes travel by bucket: packed, each once per pack, so that a
passage which very many documents share is a few entries in its bucket and no hot key. A bucket answers each pack with one bit
per hash, in the order it was asked, and the answers meet the packs in a join. No pair of documents is ever formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.tables import table
from tallyspark.session import Scratch

#: Sorts after every id: rows without one come last.
NO_ID = np.iinfo(np.int64).max
KEY = 6    # bytes of an anchor's hash that travel; a chance match costs work, never a result
PACK = "pack long, ids array<long>, sizes array<int>, texts binary"
ANSWER = "pack long, bucket int, bits binary"
RESULT = "doc_id long, n_words long, n_removed long, removed array<struct<first: int, end: int>>, kept string"


@dataclass(frozen=True)
class Windows:
    words: int = 20
    period: int = 13
    pack_bytes: int = 4 << 20       # of text in one pack; a longer text is a pack of its own
    bucket_bytes: int = 16 << 20    # of text whose hashes fill one bucket; raise it with the executors' memory
    rows_out: int = 256

    @property
    def anchor(self) -> int:
        return self.words - self.period + 1


def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set of residues whose differences give every residue."""
    for size in range(1, period + 1):
        for cover in combinations(range(period), size):
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError("the period must be positive")


def chained(words: np.ndarray, at: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words that start at the given places, from the words' own hashes."""
    out = np.full(len(at), seed, dtype=np.uint64)
    for k in range(n):
        out ^= words[at + k]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class Pack:
    """The words of some documents, one after the other."""

    def __init__(self, ids: list[int | None], texts: list[bytes], how: Windows):
        self.how, self.ids = how, ids
        self.words = [text.split() for text in texts]  # of bytes: at ASCII white space only
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.hashes = np.frombuffer(b"".join(xxhash.xxh3_64_digest(x) for w in self.words for x in w), dtype=">u8").astype(np.uint64)
        self.doc = np.repeat(np.arange(len(ids)), self.sizes)
        self.order = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)

    def local(self, at: np.ndarray) -> np.ndarray:
        return at - self.starts[self.doc[at]]

    def anchors(self) -> np.ndarray:
        """Cover positions at which an anchor starts, in documents that are long enough for a window."""
        place = np.arange(len(self.hashes)) - self.starts[self.doc]
        covered = np.isin(np.arange(self.how.period), difference_cover(self.how.period))
        fits = (place + self.how.anchor <= self.sizes[self.doc]) & (self.sizes[self.doc] >= self.how.words)
        return np.flatnonzero(covered[place % self.how.period] & fits)

    def windows_at(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of all windows that one of these anchors lies in, within the first ``period`` words."""
        change = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        start = self.starts[self.doc[anchors]]
        last = start + self.sizes[self.doc[anchors]] - self.how.words
        np.add.at(change, np.maximum(anchors - self.how.period + 1, start), 1)
        np.add.at(change, np.minimum(anchors, last) + 1, -1)
        return np.flatnonzero(np.cumsum(change[:-1]) > 0)


class Anchors:
    """A pack's anchors, each distinct one once, in order of bucket and hash."""

    def __init__(self, pack: Pack, buckets: int):
        self.at = pack.anchors()
        self.distinct, self.which, self.n = np.unique(chained(pack.hashes, self.at, pack.how.anchor, 1), return_inverse=True,
                                                      return_counts=True)
        self.bucket = (self.distinct >> np.uint64(40)) % np.uint64(buckets)
        self.order = np.argsort(self.bucket, kind="stable")

    def asked(self) -> Iterator[tuple[int, bytes]]:
        """Bucket by bucket, the hashes to look for elsewhere."""
        for bucket, rows in by_bucket(self.bucket, self.order):
            yield bucket, self.distinct[rows].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY].tobytes()

    def repeated(self, answers: dict[int, bytes]) -> np.ndarray:
        """Positions of the anchors that occur twice in the corpus, in this pack or by the buckets' answers."""
        again = self.n > 1
        for bucket, rows in by_bucket(self.bucket, self.order):
            again[rows] |= unpacked(answers[bucket], len(rows))
        return self.at[again[self.which]]


class Found:
    """The windows around repeated anchors: of each kind the first in this pack, and those known not to be the first."""

    def __init__(self, pack: Pack, anchors: np.ndarray, buckets: int):
        self.at = pack.windows_at(anchors)
        high = chained(pack.hashes, self.at, pack.how.words, 2)
        low = (chained(pack.hashes, self.at, pack.how.words, 3) >> np.uint64(32)).astype(np.uint32)
        ids, starts = pack.order[pack.doc[self.at]], pack.local(self.at).astype(np.int32)
        order = np.lexsort((starts, ids, low, high))
        self.at, high, low, ids, starts = self.at[order], high[order], low[order], ids[order], starts[order]
        first = runs(high, low)
        self.head = np.cumsum(first) - 1  # of each window, which kind it is
        self.late = (ids != ids[first][self.head]) | (starts != starts[first][self.head])
        self.high, self.low, self.ids, self.starts = high[first], low[first], ids[first], starts[first]
        self.bucket = (self.high >> np.uint64(40)) % np.uint64(buckets)
        self.order = np.argsort(self.bucket, kind="stable")

    def asked(self) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        for bucket, rows in by_bucket(self.bucket, self.order):
            rows = rows[np.lexsort((self.starts[rows], self.ids[rows]))]  # neighbours compress well
            yield (bucket, self.high[rows].astype("<u8").tobytes(), self.low[rows].astype("<u4").tobytes(),
                   self.ids[rows].astype("<i8").tobytes(), self.starts[rows].astype("<i4").tobytes())

    def repeats(self, answers: dict[int, bytes]) -> np.ndarray:
        """Starts of the windows whose words also start earlier, here or by the buckets' answers."""
        later = np.zeros(len(self.high), dtype=bool)
        for bucket, rows in by_bucket(self.bucket, self.order):
            rows = rows[np.lexsort((self.starts[rows], self.ids[rows]))]
            later[rows] = unpacked(answers[bucket], len(rows))
        return self.at[self.late | later[self.head]]


def by_bucket(bucket: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if len(order):
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for rows in np.split(order, cuts):
            yield int(bucket[rows[0]]), rows


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys change: the first of each run of equal ones."""
    out = np.ones(len(keys[0]), dtype=bool)
    out[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return out


def packed(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpacked(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n).astype(bool)


def packs(docs: DataFrame, how: Windows) -> DataFrame:
    """Documents packed in the order and partitions they come in; the text is compressed, its bytes untouched."""
    def row(number: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        joined = zstandard.ZstdCompressor(level=3).compress(b"".join(texts[i] for i in order))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
             pa.array([[len(texts[i]) for i in order]], pa.list_(pa.int32())), pa.array([joined], pa.binary())],
            ["pack", "ids", "sizes", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
                held += len(texts[-1])
                if held >= how.pack_bytes:
                    yield row(number, ids, texts)
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield row(number, ids, texts)

    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"))
    return read.mapInArrow(run, PACK)


def opened(row: dict, how: Windows) -> Pack:
    data, ends = zstandard.ZstdDecompressor().decompress(row["texts"]), np.cumsum([0, *row["sizes"]])
    return Pack(row["ids"], [data[a:b] for a, b in zip(ends[:-1], ends[1:])], how)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def replies(found: list[dict] | None) -> dict[int, bytes]:
    return {a["bucket"]: a["bits"] for a in found or ()}


def anchor_answers(packed_docs: DataFrame, buckets: int, how: Windows) -> DataFrame:
    """For every pack and bucket, one bit per anchor asked about: does another pack have it too?"""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            asked = list(Anchors(opened(row, how), buckets).asked())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["pack"]] * len(asked), pa.int64()), pa.array([b for b, _ in asked], pa.int32()),
                 pa.array([k for _, k in asked], pa.binary())], ["pack", "bucket", "keys"])

    def answer(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, dtype=np.uint8).reshape(-1, KEY) for k in group["keys"]]
        wide = np.zeros((sum(map(len, keys)), 8), dtype=np.uint8)
        wide[:, :KEY] = np.concatenate(keys)
        _, which, n = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
        return replied(key[0], group, n[which] > 1, [len(k) for k in keys])

    asked = packed_docs.mapInArrow(ask, "pack long, bucket int, keys binary")
    return asked.groupBy("bucket").applyInPandas(answer, ANSWER)


def window_answers(met: DataFrame, buckets: int, how: Windows) -> DataFrame:
    """For every pack and bucket, one bit per window asked about: does the same start earlier elsewhere?"""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            pack = opened(row, how)
            anchors = Anchors(pack, buckets).repeated(replies(row["anchors"]))
            asked = list(zip(*Found(pack, anchors, buckets).asked())) or [()] * 5
            names = ["bucket", "high", "low", "ids", "starts"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["pack"]] * len(asked[0]), pa.int64()), pa.array(asked[0], pa.int32()),
                 *(pa.array(column, pa.binary()) for column in asked[1:])], ["pack", *names])

    def answer(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        high, low, ids, starts = (np.frombuffer(b"".join(group[c]), dtype=t)
                                  for c, t in (("high", "<u8"), ("low", "<u4"), ("ids", "<i8"), ("starts", "<i4")))
        order = np.lexsort((starts, ids, low, high))
        first = runs(high[order], low[order])
        kind = np.cumsum(first) - 1
        later = np.empty(len(order), dtype=bool)
        later[order] = (ids[order] != ids[order][first][kind]) | (starts[order] != starts[order][first][kind])
        return replied(key[0], group, later, [len(x) // 8 for x in group["high"]])

    asked = met.mapInArrow(ask, "pack long, bucket int, high binary, low binary, ids binary, starts binary")
    return asked.groupBy("bucket").applyInPandas(answer, ANSWER)


def replied(bucket: int, group: pd.DataFrame, flags: np.ndarray, sizes: list[int]) -> pd.DataFrame:
    parts = np.split(flags, np.cumsum(sizes)[:-1])
    return pd.DataFrame({"pack": group["pack"].to_numpy(), "bucket": np.int32(bucket), "bits": [packed(p) for p in parts]})


def gathered(answers: DataFrame, name: str) -> DataFrame:
    """The answers of each pack in one row: a bit for each of its hashes."""
    return answers.groupBy("pack").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))


def without_repeats(docs: DataFrame, scratch: Scratch, how: Windows = Windows()) -> DataFrame:
    """``doc_id, n_words, n_removed, removed, kept`` of every row.

    Words are runs of other characters than ASCII white space. A window is ``how.words`` consecutive words of one document;
    each word that is covered by a window whose words also start earlier goes. Earlier is in a smaller doc_id, or at an
    earlier word of the same one; windows are judged on the input. ``removed`` has the stretches of removed words (0-based,
    end exclusive), ``kept`` the other words joined by single spaces.

    A null text has no words. A null doc_id comes after all others, and rows without one, like rows that share one, count
    as one document: of equal windows at the same word of both, none is earlier. Texts shorter than a window lose nothing.
    Empty input gives no rows; other columns play no part.
    """
    packed_docs = scratch.keep(packs(docs, how), "packs")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = -(-size // how.bucket_bytes) or 1
    anchors = gathered(scratch.keep(anchor_answers(packed_docs, buckets, how), "anchor_answers"), "anchors")
    met = packed_docs.join(anchors, "pack", "left")
    windows = gathered(scratch.keep(window_answers(met, buckets, how), "window_answers"), "windows")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            pack = opened(row, how)
            found = Found(pack, Anchors(pack, buckets).repeated(replies(row["anchors"])), buckets)
            change = np.zeros(len(pack.hashes) + 1, dtype=np.int64)
            starts = found.repeats(replies(row["windows"]))
            np.add.at(change, starts, 1)
            np.add.at(change, starts + how.words, -1)
            gone = np.cumsum(change[:-1]) > 0
            for at in range(0, len(pack.ids), how.rows_out):
                yield results(pack, gone, range(at, min(at + how.rows_out, len(pack.ids))))

    return met.join(windows, "pack", "left").mapInArrow(clean, RESULT)


def results(pack: Pack, gone: np.ndarray, docs: range) -> pa.RecordBatch:
    removed, kept, lost = [], [], []
    for d in docs:
        flags = gone[pack.starts[d]:pack.starts[d] + pack.sizes[d]]
        edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
        removed.append([{"first": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
        words = [w for w, f in zip(pack.words[d], flags) if not f] if len(edges) else pack.words[d]
        kept.append(b" ".join(words).decode("utf-8", "replace"))
        lost.append(int(flags.sum()))
    stretch = pa.struct([("first", pa.int32()), ("end", pa.int32())])
    return pa.RecordBatch.from_arrays(
        [pa.array([pack.ids[d] for d in docs], pa.int64()), pa.array(pack.sizes[docs.start:docs.stop], pa.int64()),
         pa.array(lost, pa.int64()), pa.array(removed, pa.list_(stretch)), pa.array(kept, pa.string())],
        ["doc_id", "n_words", "n_removed", "removed", "kept"])


def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = without_repeats(table(spark, folder, "documents"), Scratch(spark))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
windows AS (
  SELECT doc_id, i, min(struct_pack(d := doc_id, i := i)) OVER (PARTITION BY win) <> struct_pack(d := doc_id, i := i) AS again
  FROM (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS win
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM texts))),
judged AS (
  SELECT doc_id, i, word, coalesce(max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
  FROM words LEFT JOIN windows USING (doc_id, i)),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM judged GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""
