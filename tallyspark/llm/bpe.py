"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over a text's bytes cuts it into chunks, so a passage that many documents share gives the same chunks in all
of them. One pass over the corpus counts chunks; the most shared ones are encoded once and broadcast as a dictionary of
bounded size. Every other chunk is encoded once per task, in a cache of bounded size. Cuts fall anywhere, also inside words,
so the ends of neighbouring chunks are encoded again, as one piece, from the last sure break of the one to the first of the
other; a chunk's own ends are widened to the next sure break until what is re-encoded agrees with the chunk's encoding.

A sure break is a single space between two characters that aren't white space. The vocabulary's splitting pattern starts a
new piece there whatever stands around it, so the encodings on both sides are independent. The pattern, the merges and the
special token are those of the vocabulary file, which is a parameter and never copied.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from tallyspark.llm.tables import table, whole_text
from tallyspark.session import Scratch


@dataclass(frozen=True)
class Bpe:
    ranks: str = public_tokenizers.path("byte_bpe_50k.tiktoken")  # on every executor
    special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),)
    least: int = 256             # bytes of a chunk
    bits: int = 8                # a cut is found every 2^bits bytes on average
    most: int = 4096
    dictionary: int = 4096       # chunks broadcast
    cache_chars: int = 4_000_000  # of a task
    rows_out: int = 500


@functools.lru_cache(maxsize=4)
def _encoding(how: Bpe) -> tiktoken.Encoding:
    with open(how.ranks, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=dict(how.special))


def encode_piece(text: str, how: Bpe) -> np.ndarray:
    """Ids of a text as a whole; special tokens' strings become their ids."""
    return _encoding(how).encode_to_numpy(text, allowed_special="all")


@functools.lru_cache(maxsize=1)
def _gears() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(17)).integers(0, 1 << 32, size=256, dtype=np.uint32)


def chunks(text: str, how: Bpe) -> list[str]:
    """A text's content-defined chunks. A cut depends on the 16 bytes before it, and on where the last cut was as far as
    the least and largest length want it; it never splits a character."""
    raw = text.encode("utf-8")
    if len(raw) <= how.least:
        return [text] if text else []
    data = np.frombuffer(raw, dtype=np.uint8)
    rolled = _gears()[data]
    for k in (1, 2, 4, 8):  # sum of the last 2, 4, 8, 16 gears, each shifted by its age
        rolled[k:] = rolled[k:] + (rolled[:-k] << np.uint32(k))
    whole = np.append((data[1:] & 0xC0) != 0x80, True)  # the next byte begins a character
    cuts = (np.flatnonzero((rolled >> np.uint32(32 - how.bits) == 0) & whole) + 1).tolist()
    out, at = [], 0
    for cut in [*cuts, len(raw)]:
        while cut - at > how.most:
            end = at + how.most
            while not whole[end - 1]:
                end -= 1
            out.append(raw[at:end].decode())
            at = end
        if cut - at >= how.least or cut == len(raw) and cut > at:
            out.append(raw[at:cut].decode())
            at = cut
    return out


def next_break(text: str, start: int) -> int:
    """Position of the first sure break at ``start`` or after it, or -1."""
    at = text.find(" ", max(start, 1))
    while 0 < at < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
        at = text.find(" ", at + 1)
    return at if 0 < at < len(text) - 1 else -1


def last_break(text: str, end: int) -> int:
    """Position of the last sure break before ``end``, or -1."""
    at = text.rfind(" ", 1, min(end, len(text) - 1))
    while at > 0 and (text[at - 1].isspace() or text[at + 1].isspace()):
        at = text.rfind(" ", 1, at)
    return at


@dataclass(frozen=True)
class Encoded:
    """A chunk's ids; ``first`` and ``last`` are its outermost breaks (-1: none), ``head`` and ``tail`` the numbers of
    ids before and after them."""
    ids: np.ndarray
    first: int
    head: int
    last: int
    tail: int


def encode_chunk(text: str, how: Bpe) -> Encoded:
    ids = encode_piece(text, how)
    first, last = next_break(text, 1), last_break(text, len(text))
    while first >= 0:
        head = encode_piece(text[:first], how)
        if np.array_equal(ids[:len(head)], head):
            break
        first = next_break(text, first + 1)
    while last >= 0:
        tail = encode_piece(text[last:], how)
        if np.array_equal(ids[len(ids) - len(tail):], tail):
            break
        last = last_break(text, last)
    if first < 0 or last < first:
        return Encoded(ids, -1, 0, -1, 0)
    return Encoded(ids, first, len(head), last, len(tail))


def encode(text: str, how: Bpe, chunk: Callable[[str], Encoded]) -> np.ndarray:
    """Ids of a whole text from its chunks' encodings."""
    out, open_text = [], []  # what has been read since the last break, still to be encoded
    for part in chunks(text, how):
        found = chunk(part)
        if found.first < 0:
            open_text.append(part)
            continue
        begin = 0
        if open_text:
            out.append(encode_piece("".join(open_text) + part[:found.first], how))
            begin = found.head
        out.append(found.ids[begin:len(found.ids) - found.tail])
        open_text = [part[found.last:]]
    if open_text:
        out.append(encode_piece("".join(open_text), how))
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint32)


class Chunks:
    """Looks chunks up in the dictionary, then in a cache that forgets its oldest entries, and encodes what neither has."""

    def __init__(self, dictionary: dict[str, Encoded], how: Bpe):
        self.dictionary, self.how, self.cache, self.chars = dictionary, how, {}, 0

    def __call__(self, text: str) -> Encoded:
        found = self.dictionary.get(text) or self.cache.get(text)
        if found is None:
            found = self.cache[text] = encode_chunk(text, self.how)
            self.chars += len(text)
            while self.chars > self.how.cache_chars:
                oldest = next(iter(self.cache))
                del self.cache[oldest]
                self.chars -= len(oldest)
        return found


def shared_chunks(docs: DataFrame, how: Bpe, scratch: Scratch) -> dict[str, Encoded]:
    """The chunks of all documents whose reuse saves most bytes, encoded once: at most ``how.dictionary`` of them.

    Every chunk of every document is counted, by digest. A task adds the text of those that it meets again, so that only
    repeated texts are shuffled.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen, again = Counter(), {}
            for text in batch["text"]:
                for part in chunks(text, how):
                    digest = xxhash.xxh3_128_digest(part.encode())
                    seen[digest] += 1
                    if seen[digest] == 2:
                        again[digest] = part
            if seen:
                yield pd.DataFrame({"digest": list(seen), "n": list(seen.values()), "text": [again.get(d) for d in seen]})

    counted = docs.select(whole_text("text").alias("text")).mapInPandas(count, "digest binary, n long, text string")
    shared = scratch.keep(counted.groupBy("digest").agg(F.sum("n").alias("n"), F.max("text").alias("text"))
                          .filter("n > 1 AND text IS NOT NULL"), "shared_chunks")
    best = (shared.select("digest", ((F.col("n") - 1) * F.octet_length("text")).alias("saved"))
            .orderBy(F.desc("saved"), "digest").limit(how.dictionary))

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [encode_chunk(t, how) for t in batch["text"]]
            yield pd.DataFrame({"text": batch["text"], "ids": [x.ids.astype("<u4").tobytes() for x in found],
                                "first": [x.first for x in found], "head": [x.head for x in found],
                                "last": [x.last for x in found], "tail": [x.tail for x in found]})

    rows = shared.join(F.broadcast(best), "digest").select("text").mapInPandas(
        entries, "text string, ids binary, first int, head int, last int, tail int").collect()
    return {r["text"]: Encoded(np.frombuffer(r["ids"], dtype="<u4"), r["first"], r["head"], r["last"], r["tail"])
            for r in rows}


def ids_of(text: Column, dictionary: dict[str, Encoded], how: Bpe) -> Column:
    """Ids (array of int) of a text column; null counts as empty."""
    shared = SparkSession.active().sparkContext.broadcast(dictionary)  # at most how.dictionary chunks of how.most bytes
    held: list[Chunks] = []  # of the task: filled when its first batch comes

    @F.pandas_udf("array<int>")
    def of(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(Chunks(shared.value, how))
        return pd.Series([encode(t or "", how, held[0]).astype(np.int32) for t in texts], index=texts.index)

    return of(text)


def decode(ids: np.ndarray, how: Bpe) -> str:
    """The text of ids, special tokens included; bytes that are no UTF-8 become the replacement character."""
    return _encoding(how).decode_bytes(ids.tolist()).decode("utf-8", "replace")


def text_of(ids: Column, how: Bpe) -> Column:
    """The text that a column of ids decodes to; a null decodes to the empty text."""
    @F.pandas_udf("string")
    def of(rows: pd.Series) -> pd.Series:
        return pd.Series([decode(np.asarray([] if r is None else r, dtype=np.int64), how) for r in rows])

    return of(ids)


def digests(ids: Column, how: Bpe) -> Column:
    """``n_tokens, ids_sha256, decoded_sha256`` of a column of ids. Applied to ``ids_of`` directly, both run in one worker and
    the ids never leave it."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def of(rows: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"n_tokens": [len(r) for r in rows],
                             "ids_sha256": [hashlib.sha256(np.asarray(r).astype("<u4").tobytes()).hexdigest() for r in rows],
                             "decoded_sha256": [hashlib.sha256(decode(np.asarray(r), how).encode()).hexdigest() for r in rows]},
                            index=rows.index)

    return of(ids)


def encode_documents(docs: DataFrame, scratch: Scratch, how: Bpe = Bpe()) -> DataFrame:
    """``docs`` with ``ids`` and ``exact`` (whether the ids decode to the text): one row per row, its other columns
    untouched (columns of these names are replaced).

    Null and empty texts give an empty list. Repeated rows are encoded each. Empty input gives no rows. Rows go out in
    small batches, so that a task holds few id lists at once.
    """
    docs = docs.drop("ids", "exact")
    shared = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, how, scratch))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Chunks(shared.value, how)
        for batch in batches:
            for at in range(0, batch.num_rows, how.rows_out):
                part = batch.slice(at, how.rows_out)
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = [encode(t, how, lookup).astype(np.int32) for t in texts]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                exact = pa.array([decode(i, how) == t for i, t in zip(found, texts)])
                yield pa.RecordBatch.from_arrays([*part.columns, ids, exact], [*part.schema.names, "ids", "exact"])

    schema = StructType([*docs.schema.fields, StructField("ids", ArrayType(IntegerType())), StructField("exact", BooleanType())])
    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, scratch: Scratch, how: Bpe = Bpe()) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    ids = ids_of(docs["text"], shared_chunks(docs, how, scratch), how)
    return docs.select("doc_id", digests(ids, how).alias("d")).select("doc_id", "d.*")


def op9_bpe_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"), Scratch(spark))
