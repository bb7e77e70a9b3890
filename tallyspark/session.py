"""Session set-up and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session options every plan here relies on. Skewed shuffle partitions are split even where that costs one more
# exchange, so that a key holding a large share of the rows never lands in a single task. A table that is shuffled to meet
# a few keys (the lines of a batch) is cut down by a Bloom filter of those keys while it is scanned; a filter has at most
# 8 MB, whatever the number of keys, and the join behind it stays. Where each shuffled part of one side is small, the other
# side meets it in a hash table and isn't sorted. Rows dealt by some columns of a join's key lie together already and aren't dealt
# again by all of them.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "32m",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64m",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "67108864",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options on a session that somebody else has built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def session(app: str = "tallyspark", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session. Cluster size, memory and shuffle width stay with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    options = {"spark.sql.session.timeZone": "UTC", **RUNTIME_CONF, **conf}
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, or under the session's warehouse where that is unset.

    The warehouse is a folder beside the driver unless the session says otherwise. Executors on other machines don't see
    that, so on a cluster it is refused; ``spark.checkpoint.dir`` is taken as it is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        on_disk = base.split(":")[0] in ("file", base)
        if on_disk and spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"{base} may be local to one machine: set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/tallyspark-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_of_one_write(spark: SparkSession) -> Iterator[None]:
    """What a write within shuffles is deleted as soon as it ends, not when the driver happens to collect its garbage.

    The plan of a write is run once, so nothing reads these files again.
    """
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class Scratch:
    """Intermediate results as tables in the shared folder.

    A result that several steps need is written once and read back, which also cuts its lineage. The tables outlive lost
    executors; ``clean`` removes them.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self._folder = spark, None

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self._folder = self._folder or shared_dir(self.spark)
        path = f"{self._folder}/{name}"
        with shuffles_of_one_write(self.spark):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clean(self) -> None:
        if self._folder:
            delete_path(self.spark, self._folder)
            self._folder = None


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def move_path(spark: SparkSession, old: str, new: str) -> None:
    """Put a folder in the place of another one."""
    fs, source = _file_system(spark, old)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{old} could not be moved to {new}")


def folders(spark: SparkSession, root: str, depth: int) -> list[str]:
    """The folders so many levels below a root, by their paths from there; names that start with _ or . don't count."""
    fs, target = _file_system(spark, root)
    found = [("", target)] if fs.exists(target) else []
    for _ in range(depth):
        found = [(f"{at}/{child.getPath().getName()}", child.getPath()) for at, path in found for child in fs.listStatus(path)
                 if child.isDirectory() and child.getPath().getName()[0] not in "_."]
    return sorted(at[1:] for at, _ in found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    fs, draft = _file_system(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str | None:
    if not path_exists(spark, path):
        return None
    return "\n".join(row[0] for row in spark.read.text(path).collect())
