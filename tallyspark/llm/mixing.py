"""Mixing sources to target weights by fixed-length token blocks.

Each source's words, document after document, are packed into blocks of a fixed length. The mix is a row of output shards;
each draws from a seeded multinomial how many of its slots each source fills. A source's n-th slot takes block number
perm(n) of its current pass, where perm is a pseudorandom index permutation, so a pass takes every block once before any is
taken again. Slots and blocks meet in a join by (source, block).

What is taken of a source equals its target to the word: whole passes, then whole blocks of one more pass, then the head of
one block. Draws beyond a source's need are dropped, and what the draws left out fills closing shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.tables import WORD, n_words, table
from tallyspark.session import Scratch


SLOT = "shard long, rank int, pass long, block long, words long, cut boolean"


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (1.0, 2.0, 3.0)  # by the sources' order, repeating
    share: float = 1.0                            # of all words, what the mix takes
    most_passes: int = 3                          # target over size, at most
    block: int = 1024                             # words
    slots_per_shard: int = 1024
    rows_per_part: int = 20_000                   # rows of one source that one task lays out
    slots_per_part: int = 16_384                  # slots that one task lays out
    seed: int = 20240601


def targets(sizes: list[int], mix: Mix) -> list[float]:
    """Target of each source, in the sources' order. What a cap cuts off is shared again by weight among the rest, until
    no target is above its cap. Without any room left the targets add up to less than the share asked for."""
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(sizes))]
    total, goal, capped = mix.share * sum(sizes), [0.0] * len(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        room = total - sum(goal[i] for i in capped)
        weight = sum(weights[i] for i in free)
        for i in free:
            goal[i] = room * weights[i] / weight
        over = [i for i in free if goal[i] > mix.most_passes * sizes[i]]
        if not over:
            return goal
        for i in over:
            goal[i] = float(mix.most_passes * sizes[i])
        capped.update(over)


def source_table(sized: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: rank, sizes, target, and how much of it the mix takes.

    The number of sources is the driver's only concern here (one row each). ``passes`` whole passes, then ``extra`` whole
    blocks, then ``head`` words of one block more.
    """
    spark = sized.sparkSession
    found = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))  # by code point, null last
    rows = []
    for rank, (row, target) in enumerate(zip(found, targets([r["size"] for r in found], mix), strict=True)):
        size, take = row["size"], round(target)
        passes, rest = divmod(take, size) if size else (0, 0)
        rows.append((rank, row["source"], size, target, passes, rest // mix.block, rest % mix.block, size // mix.block,
                     -(-size // mix.block)))
    return spark.createDataFrame(rows, "rank int, source string, source_size long, target double, passes long, extra long,"
                                       " head long, full_blocks long, blocks long")


def permuted(index: np.ndarray, n: int, key: tuple[int, ...]) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n-1 at the given positions: a four-round Feistel network over the next even
    number of bits, walked along its cycles until it falls inside. Nothing of length n is built."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rounds = np.random.Generator(np.random.PCG64(key)).integers(1, 1 << 63, size=(4, 2), dtype=np.uint64) | np.uint64(1)
    out, going = index.astype(np.uint64), np.arange(len(index))
    while len(going):
        left, right = out[going] >> np.uint64(half), out[going] & mask
        for a, b in rounds:
            mixed = (right + b) * a
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(7) & mask)
        out[going] = left << np.uint64(half) | right
        going = going[out[going] >= n]
    return out.astype(np.int64)


#: Places that one task of a running sum has.
STEP = 8192


def with_sum_before(rows: DataFrame, by: str, place: str, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the earlier places (0, 1, ... within each ``by``), in two steps: within stretches of
    places, and over the stretches' totals, so that no task has all places of one ``by``."""
    spans = rows.withColumn("_span", F.expr(f"{place} div {STEP}"))
    totals = spans.groupBy(by, "_span").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(by, "_span", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy(by, "_span").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return (spans.withColumn("_before", F.coalesce(F.sum(value).over(within), F.lit(0))).join(starts, [by, "_span"])
            .withColumn(name, F.col("_start") + F.col("_before")).drop("_span", "_start", "_before"))


def slot_table(sources: DataFrame, mix: Mix) -> DataFrame:
    """The mix itself: ``shard, rank`` (of the source), ``pass, block, words, cut`` of every slot.

    ``words`` is the block's length, or less where ``cut`` is set: for the last slot of a source. The short block at a source's end closes each
    pass, so that whole passes add up to the source's size.
    """
    spark = sources.sparkSession
    plan = [r.asDict() for r in sources.orderBy("rank").collect()]
    need = np.array([r["passes"] * r["blocks"] + r["extra"] + (r["head"] > 0) for r in plan], dtype=np.int64)
    total = int(need.sum())
    shards = -(-total // mix.slots_per_shard)
    schema = "shard long, rank int, n long"
    if not total:
        return spark.createDataFrame([], SLOT)
    share = need / total

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                rng = np.random.Generator(np.random.PCG64((mix.seed, int(shard))))
                n = rng.multinomial(mix.slots_per_shard, share)
                hit = np.flatnonzero(n)
                yield pd.DataFrame({"shard": shard, "rank": hit.astype(np.int32), "n": n[hit]})

    drawn = spark.range(shards).mapInPandas(draw, schema)
    wanted = spark.createDataFrame([(i, int(n)) for i, n in enumerate(need)], "rank int, need long")
    # A source's draws start where those of the shards before end; what goes beyond its need is dropped.
    placed = (with_sum_before(drawn, "rank", "shard", "n", "first").join(F.broadcast(wanted), "rank")
              .withColumn("n", F.least(F.col("n"), F.col("need") - F.col("first"))).filter("n > 0"))
    placed = placed.select("shard", "rank", "first", "n")
    done = placed.groupBy("rank").agg(F.sum("n").alias("first"))
    left = (wanted.join(done, "rank", "left").select("rank", F.coalesce("first", F.lit(0)).alias("first"), "need")
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.expr(f"(need - first) div {mix.slots_per_shard}"))))
            .withColumn("first", F.col("first") + F.col("part") * mix.slots_per_shard)
            .withColumn("n", F.least(F.lit(mix.slots_per_shard), F.col("need") - F.col("first"))).filter("n > 0")
            .select((F.lit(shards) + F.col("part")).alias("shard"), "rank", "first", "n"))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, rank, first, n in batch.itertuples(index=False):
                yield slots_of(int(shard), plan[rank], int(first), int(n), mix)

    # A row becomes up to a thousand slots, so the number of tasks follows the slots, not the rows' few bytes.
    spread = placed.unionByName(left).repartition(-(-total // mix.slots_per_part), "shard", "rank")
    return spread.mapInPandas(fill, SLOT)


def slots_of(shard: int, source: dict, first: int, n: int, mix: Mix) -> pd.DataFrame:
    """Slots ``first`` .. ``first + n - 1`` of a source."""
    slots = np.arange(first, first + n, dtype=np.int64)
    passes, at = slots // source["blocks"], slots % source["blocks"]
    full = source["full_blocks"]
    block = np.full(n, full, dtype=np.int64)  # the short block
    for one in np.unique(passes):
        mine = (passes == one) & (at < full)
        block[mine] = permuted(at[mine], full, (mix.seed, source["rank"], int(one)))
    words = np.where(block < full, mix.block, source["source_size"] - full * mix.block)
    cut = (slots == source["passes"] * source["blocks"] + source["extra"]) & (source["head"] > 0)
    words[cut] = source["head"]
    return pd.DataFrame({"shard": shard, "rank": np.int32(source["rank"]), "pass": passes, "block": block, "words": words,
                         "cut": cut})


def laid_out(docs: DataFrame, sources: DataFrame, mix: Mix, parts: int) -> DataFrame:
    """Adds ``rank`` and ``start``: the place of each row's first word in its source.

    A source's rows are dealt into parts by hash and laid out part by part, so that a source that holds a third of all
    rows is numbered by many tasks. Identical rows follow each other in any order.
    """
    ranks = sources.select("rank", F.col("source").alias("_source"))
    rows = (docs.join(F.broadcast(ranks), docs["source"].eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("_part", F.pmod(F.xxhash64("doc_id", "size"), F.lit(parts)).cast("int")))
    sums = rows.groupBy("rank", "_part").agg(F.sum("size").alias("_sum"))
    starts = with_sum_before(sums, "rank", "_part", "_sum", "_start_of_part").select(
        "rank", "_part", F.col("_start_of_part").alias("_start"))
    within = (Window.partitionBy("rank", "_part").orderBy("doc_id", "size", "text_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, ["rank", "_part"])
            .withColumn("start", F.col("_start") + F.col("_before")).drop("_part", "_start", "_before"))


def taken_of_blocks(sources: DataFrame, mix: Mix) -> DataFrame:
    """``rank, block, whole, head``: how often the mix takes each block as a whole, and how many of its first words once more
    (null: none)."""
    return slot_table(sources, mix).groupBy("rank", "block").agg(
        F.count_if(~F.col("cut")).alias("whole"), F.max(F.when(F.col("cut"), F.col("words"))).alias("head"))


def sized(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``uid, doc_id, source, size, text_hash`` of every row, written once; ``uid`` tells rows apart."""
    return scratch.keep(docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "source",
                                    n_words(docs["text"]).alias("size"), F.xxhash64("text").alias("text_hash")), "sized")


def pieces(narrow: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """The sources, and for every row of ``sized`` and block that it lies in: ``uid, doc_id, size, text_hash, rank, lo, hi,
    whole, head``.

    ``lo`` and ``hi`` are the row's words in that block (0-based within the row, end exclusive), ``whole`` counts the
    slots that take the whole block, and ``head`` is how many of these words from ``lo`` on one more slot takes.
    """
    sources = source_table(narrow, mix)
    parts = max(1, -(-narrow.count() // mix.rows_per_part))
    laid = laid_out(narrow, sources, mix, parts)
    last = F.greatest(F.col("start") + F.col("size") - 1, F.col("start"))
    spread = laid.withColumn("block", F.explode(F.sequence(F.expr(f"start div {mix.block}"), (last / mix.block).cast("long"))))
    at = F.col("block") * mix.block - F.col("start")  # of the block's first word, within the row
    # The blocks grow with the corpus, so they aren't broadcast, however well they compress.
    return sources, (spread.join(taken_of_blocks(sources, mix).hint("merge"), ["rank", "block"], "left")
                     .withColumn("lo", F.greatest(at, F.lit(0)))
                     .withColumn("hi", F.least(at + mix.block, F.col("size")))
                     .withColumn("head", F.least(F.greatest(F.coalesce("head", F.lit(0)) + at - F.col("lo"), F.lit(0)),
                                                 F.col("hi") - F.col("lo")))
                     .select("uid", "doc_id", "size", "text_hash", "rank", "lo", "hi", F.coalesce("whole", F.lit(0)).alias("whole"),
                             "head"))


def mix_documents(docs: DataFrame, mix: Mix, scratch: Scratch) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row.

    ``size`` counts the words of the text (null: none), ``taken`` those that the mix takes, repeats counted; no row
    exceeds ``most_passes`` times its size. A null source is a source, the last one. Rows without words are returned with
    0. The result depends on the rows alone, not on their order or partitions; identical rows may swap. Empty input gives
    no rows; other columns play no part.
    """
    sources, parts = pieces(sized(docs, scratch), mix)
    words = F.col("whole") * (F.col("hi") - F.col("lo")) + F.col("head")
    rows = parts.groupBy("uid", "doc_id", "size", "rank").agg(F.sum(words).alias("taken"))
    return rows.join(F.broadcast(sources.select("rank", "source_size", "target")), "rank").select(
        "doc_id", "size", "source_size", "target", "taken")


def adjoining(stretches: Column) -> Column:
    """Sorted stretches ``(first, n)`` with those that adjoin made one."""
    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (last["first"] + last["n"] == s["first"])
        longer = F.struct(last["first"].alias("first"), (last["n"] + s["n"]).alias("n"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(stretches, F.array().cast("array<struct<first: int, n: int>>"), add)


def stretch_of(text: str, stretch: Column) -> Column:
    """The text from one word to another, with the white space between them as it is."""
    words, gaps = F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.split(text, WORD)
    first, n = stretch["first"], stretch["n"]
    led = F.zip_with(F.slice(words, first, n - 1), F.slice(gaps, first + 1, n - 1), lambda w, g: F.concat(w, g))
    return F.concat(F.array_join(led, ""), F.element_at(words, first + n - 1))


def mixed_documents(docs: DataFrame, mix: Mix, scratch: Scratch) -> DataFrame:
    """The mix as documents: for every row, one row for each time that words of it are taken, with its own columns.

    Passes that take the whole row repeat it unchanged. A pass that takes a part gives one row for each stretch of adjoining
    words taken, with ``text`` cut out of the row's at these words, white space and all; ``n_chars``, where there is such a
    column, counts it. Rows that the mix doesn't touch are left out, rows without words too. Rows that are alike in doc_id
    and text share one choice, made for one of them, and are repeated each.
    """
    _, parts = pieces(sized(docs, scratch), mix)
    # Per row: the passes that take all of it, and its stretches with what one more pass takes of each.
    rows = parts.filter("size > 0").groupBy("uid", "doc_id", "text_hash").agg(
        F.min("whole").alias("passes"), F.collect_list(F.struct("lo", "hi", "whole", "head")).alias("stretches"))
    more = F.transform(F.array_sort("stretches"), lambda s: F.struct(
        (s["lo"] + 1).cast("int").alias("first"),
        F.when(s["whole"] > F.col("passes"), s["hi"] - s["lo"]).otherwise(s["head"]).cast("int").alias("n")))
    rows = rows.select("doc_id", "text_hash", "passes", adjoining(F.filter(more, lambda s: s["n"] > 0)).alias("more"))
    chosen = scratch.keep(rows.groupBy("doc_id", "text_hash").agg(F.min(F.struct("passes", "more")).alias("c"))
                          .select(F.col("doc_id").alias("_id"), "text_hash", "c.*").filter("passes > 0 OR size(more) > 0"), "chosen")
    marked = docs.withColumn("_hash", F.xxhash64("text"))
    met = marked.join(chosen, marked["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("text_hash")))
    # One row for every whole pass (no stretch), whose text is left as it is, then one for each stretch.
    none = F.lit(None).cast("struct<first: int, n: int>")
    takes = F.concat(F.array_repeat(none, F.col("passes").cast("int")), F.col("more"))
    out = met.withColumn("_part", F.explode(takes)).withColumn(
        "text", F.when(F.col("_part").isNull(), F.col("text")).otherwise(stretch_of("text", F.col("_part"))))
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("_part").isNull(), F.col("n_chars")).otherwise(counted))
    return out.select(docs.columns)


def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_documents(table(spark, folder, "documents"), Mix(), Scratch(spark))
