"""Exact deduplication against a persistent digest index.

The index holds one row per distinct text ever seen, in runs: tables bucketed and sorted by digest, one file per bucket. A batch
is reduced to one row per digest first (combined on the map side, so a text with very many copies is no hot key), anti-joined to
each run bucket by bucket, and what is new becomes a run of its own. The index side of those joins is neither shuffled nor
sorted again. When there are many runs they are merged into one, so that a batch meets few.

Every row of the index knows the batch that brought it. A batch that comes again finds its own digests as new as the first time,
and adds none twice, so a consumer that died before it wrote its documents can repeat the batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.tables import table, whole_text
from tallyspark.session import Scratch

#: Lets a scan of a bucket that is one sorted file count as sorted.
SORTED_BUCKETS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


class DigestIndex:
    """Bucketed tables ``(digest binary, keep_id long, batch string)`` in the session's catalog and warehouse.

    The number of buckets is fixed when the index is created; choose it for the index's final size (a bucket should stay
    under a few GB). ``most_runs`` says how many runs there may be before they are merged.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int = 256, most_runs: int = 8):
        self.spark, self.name, self.buckets, self.most_runs = spark, name, buckets, most_runs

    def runs(self) -> list[str]:
        names = [t.name for t in self.spark.catalog.listTables(pattern=f"{self.name}_run_*")]
        return sorted(names, key=lambda n: int(n.rsplit("_", 1)[1]))

    def rows(self) -> DataFrame | None:
        """All that the index holds; None before the first batch."""
        frames = [self.spark.table(name) for name in self.runs()]
        return reduce(DataFrame.unionByName, frames) if frames else None

    @contextmanager
    def sorted_scans(self) -> Iterator[None]:
        before = self.spark.conf.get(SORTED_BUCKETS, "false")
        self.spark.conf.set(SORTED_BUCKETS, "true")
        try:
            yield
        finally:
            self.spark.conf.set(SORTED_BUCKETS, before)

    def unseen(self, groups: DataFrame, batch: str) -> DataFrame:
        """The digests that no other batch has brought: a merge anti-join over the buckets of each run."""
        for name in self.runs():
            others = self.spark.table(name).filter(F.col("batch") != batch).select("digest")
            groups = groups.join(others.hint("merge"), "digest", "left_anti")
        return groups

    def holders(self, groups: DataFrame) -> DataFrame:
        """Digests that the index holds, with the row that stays and the batch that brought it."""
        found = [groups.join(self.spark.table(name).select("digest", F.col("keep_id").alias("stays"), "batch").hint("merge"), "digest")
                 for name in self.runs()]
        return reduce(DataFrame.unionByName, found).withColumnRenamed("stays", "keep_id")

    def append(self, groups: DataFrame, batch: str, again: bool = True) -> None:
        """Add unseen digests, as a run with one sorted file per bucket; ``again`` says that the batch may have been here before:
        then those that it brought are left out."""
        for name in self.runs() if again else []:
            own = self.spark.table(name).filter(F.col("batch") == batch).select("digest")
            groups = groups.join(own.hint("merge"), "digest", "left_anti")
        self._write(groups.select("digest", "keep_id", F.lit(batch).alias("batch")))
        runs = self.runs()
        if len(runs) > self.most_runs:
            self._write(self.rows())
            for name in runs:
                self.spark.sql(f"DROP TABLE {name}")

    def _write(self, rows: DataFrame) -> None:
        runs = self.runs()
        number = int(runs[-1].rsplit("_", 1)[1]) + 1 if runs else 0
        (rows.repartition(self.buckets, "digest").write.mode("overwrite").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(f"{self.name}_run_{number}"))

    def drop(self) -> None:
        for name in self.runs():
            self.spark.sql(f"DROP TABLE {name}")


def text_digests(docs: DataFrame, scratch: Scratch, id_column: str = "doc_id") -> DataFrame:
    """``(doc_id, digest)`` of every row, written once: the text itself is read a single time and never shuffled."""
    digests = docs.select(F.col(id_column).alias("doc_id"),
                          F.unhex(F.sha2(whole_text(docs["text"]), 256)).alias("digest"))
    return scratch.keep(digests, "digests")


def deduplicate(docs: DataFrame, index: DigestIndex, scratch: Scratch, batch: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, digest``, and the index takes in what is new.

    Texts are equal when identical byte for byte; null counts as empty. Of equal texts in one batch the row with the
    largest doc_id stays; if another batch brought the text, that batch's row stays and all of these go. A batch that is
    repeated under its own name decides as it did before. A null doc_id stays only if its whole group has none. Of repeated
    rows with the same largest doc_id, all are marked kept (their ids can't tell them apart); ``kept_documents`` leaves one.
    Empty input gives no rows. Other columns play no part.
    """
    return deduplicate_all(docs, index, scratch, 1, batch)


def deduplicate_all(docs: DataFrame, index: DigestIndex, scratch: Scratch, batches: int = 4, batch: str | None = None) -> DataFrame:
    """As ``deduplicate``, for a whole corpus that passes the index in several batches, larger doc_ids first.

    The batches are ranges of the doc_id of about equal size, rows without one are in the last; each meets the digests of
    those before it in the index. ``group_size`` counts all rows of a text.
    """
    rows, name = text_digests(docs, scratch), batch or uuid.uuid4().hex
    cuts = rows.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000)).first()[0] if batches > 1 else None
    above = None
    with index.sorted_scans():
        for edge in [*sorted(set(cuts or []), reverse=True), None]:
            part = rows if above is None else rows.filter(F.coalesce(F.col("doc_id") <= above, F.lit(True)))
            part = part if edge is None else part.filter(F.col("doc_id") > edge)
            own = f"{name} above {edge}"
            index.append(index.unseen(part.groupBy("digest").agg(F.max("doc_id").alias("keep_id")), own), own, batch is not None)
            above = edge
        sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
        decided = scratch.keep(index.holders(sizes), "decided")
    # A plain join by exchange on both sides, so that a digest that holds a third of the rows is split at run time.
    kept = F.startswith("batch", F.lit(f"{name} above ")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return rows.join(decided, "digest").select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")


def kept_documents(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns; of repeated rows with one id and text, one."""
    keep = decisions.filter("kept").groupBy("doc_id", "digest").agg(F.count("*").alias("copies"))
    marked = docs.withColumn("digest", F.unhex(F.sha2(whole_text(docs["text"]), 256)))
    joined = marked.alias("d").join(
        keep.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.digest") == F.col("k.digest")))
    single = joined.filter("k.copies = 1").select("d.*")
    repeated = joined.filter("k.copies > 1").select("d.*").dropDuplicates(["doc_id", "digest"])
    return single.unionByName(repeated).select(docs.columns)


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")
    decisions = deduplicate_all(table(spark, folder, "documents"), index, scratch)
    index.drop()  # The query starts from an empty index each time; its result doesn't read the tables.
    return decisions.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
