"""Mart tables as partitioned parquet. All tables that a batch changes are changed together."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyspark.operators.keys import lacking_keys
from tallyspark.schema import HISTORY, MartTable
from tallyspark.session import delete_path, folders, move_path, path_exists, read_text, shuffles_of_one_write, write_text


class MartStore:
    """A folder of mart tables.

    ``grain`` is the storage partition of dated tables: ``day`` keeps the part that one change rewrites small,
    ``month`` suits little data. One writer at a time.

    A batch writes the new content of every partition it touches, of all tables, to a folder of its own, and then one
    record that names them. From the record on readers see the new content, wherever it lies, and the folders are moved to
    their places; nothing is written twice. Without the record a batch that died has changed nothing.
    """

    def __init__(self, spark: SparkSession, root: str, grain: str = "day"):
        self.spark, self.root, self.grain = spark, root.rstrip("/"), grain

    # -- reading ---------------------------------------------------------------------------------------------------

    def path(self, table: MartTable) -> str:
        return f"{self.root}/{table.name}"

    def load(self, table: MartTable, parts: Sequence[Row] | None = None) -> DataFrame:
        """The table with its partition columns, limited to some partitions if given; empty before the first write."""
        moved: dict[str, str | None] = {}
        for job in folders(self.spark, f"{self.root}/_batches", 1):
            moved |= self.committed(job).get(table.name, {})
        return self.read(table, parts, moved)

    def read(self, table: MartTable, parts: Sequence[Row] | None, elsewhere: dict[str, str | None]) -> DataFrame:
        """Partitions in their places, except those that lie ``elsewhere`` (None: nowhere)."""
        home, wanted = self.path(table), None if parts is None else {folder_of(p) for p in parts}
        frames = []
        if path_exists(self.spark, home):
            if wanted is None:
                live = self._reader(table).parquet(home)
                frames.append(live.filter(~_in_folders(list(elsewhere), table.partitions(self.grain))) if elsewhere else live)
            else:
                # Only these folders are listed and read.
                here = [f"{home}/{f}" for f in sorted(wanted - elsewhere.keys()) if path_exists(self.spark, f"{home}/{f}")]
                frames += [self._reader(table).option("basePath", home).parquet(*here)] if here else []
        roots: dict[str, list[str]] = {}
        for folder, root in elsewhere.items():
            if root is not None and (wanted is None or folder in wanted):
                roots.setdefault(root, []).append(f"{root}/{folder}")
        frames += [self._reader(table).option("basePath", root).parquet(*sorted(paths)) for root, paths in roots.items()]
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], self._stored_schema(table))

    def _reader(self, table: MartTable):
        return self.spark.read.schema(self._stored_schema(table))

    def _stored_schema(self, table: MartTable) -> StructType:
        return StructType(table.stored_schema.fields + [StructField(p, StringType()) for p in table.partitions(self.grain)])

    def places(self, table: MartTable, keys: DataFrame) -> list[Row]:
        """Storage partitions of some keys: one per calendar period or range of ids, however many keys there are."""
        columns = table.partitions(self.grain)
        return keys.select(*(e.alias(p) for p, e in columns.items())).distinct().collect()

    def near(self, table: MartTable, stored: DataFrame, keys: DataFrame) -> DataFrame:
        """A loaded table limited to the storage partitions that rows of the keys' days, months or years can be in."""
        if "date" in keys.columns:
            return stored.filter(_in_partitions(self.places(table, keys)))
        if "month" in keys.columns:
            months = keys.select(F.format_string("%04d-%02d", "year", "month").alias("p_month")).distinct().collect()
            return stored.filter(_in_partitions(months))
        years = [str(row["year"]) for row in keys.select("year").distinct().collect()]
        return stored.filter(F.substring("p_month", 1, 4).isin(*years) if years else F.lit(False))

    # -- writing ---------------------------------------------------------------------------------------------------

    def append(self, table: MartTable, rows: DataFrame) -> DataFrame:
        self.write(table, rows, self.path(table), mode="append")
        return self.load(table)

    def drop(self, *tables: MartTable) -> None:
        for table in tables:
            delete_path(self.spark, self.path(table))

    def write(self, table: MartTable, rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
        """Write by partition. A rebalance splits hot partitions and merges tiny ones."""
        places = table.partitions(self.grain)
        within = [c for c in ("merchant_id", "outlet_id") if c in table.column_names]
        placed = rows.to(table.stored_schema).withColumns(places).hint("rebalance", *(F.col(p) for p in places))
        with shuffles_of_one_write(self.spark):
            placed.sortWithinPartitions(*places, *within).write.mode(mode).partitionBy(*places).parquet(path)

    # -- batches ---------------------------------------------------------------------------------------------------

    def begin(self, job: str) -> Batch:
        """A batch of changes; what an earlier one of this job has left is finished or thrown away first."""
        self.settle(job)
        return Batch(self, job)

    def batch_path(self, job: str) -> str:
        return f"{self.root}/_batches/{job}"

    def committed(self, job: str) -> dict[str, dict[str, str | None]]:
        """Of a batch that is committed but not all in place: by table, its partitions and where their content still lies
        (None: they have none). Partitions that were moved already aren't among them."""
        record = read_text(self.spark, f"{self.batch_path(job)}/commit")
        out: dict[str, dict[str, str | None]] = {}
        for table, folder, has_rows in json.loads(record) if record else []:
            root = f"{self.batch_path(job)}/{table}"
            if not has_rows:
                out.setdefault(table, {})[folder] = None
            elif path_exists(self.spark, f"{root}/{folder}"):
                out.setdefault(table, {})[folder] = root
        return out

    def settle(self, job: str) -> None:
        """Put a committed batch in place; a batch without its record is dropped."""
        for table, moved in self.committed(job).items():
            for folder, root in moved.items():
                self.put_in_place(table, folder, root)
        delete_path(self.spark, self.batch_path(job))

    def put_in_place(self, table: str, folder: str, root: str | None) -> None:
        if root is None:
            delete_path(self.spark, f"{self.root}/{table}/{folder}")
        else:
            move_path(self.spark, f"{root}/{folder}", f"{self.root}/{table}/{folder}")

    # -- the run log -----------------------------------------------------------------------------------------------

    def history(self, job: str) -> DataFrame:
        path = f"{self.root}/history_{job}"
        return (self.spark.read.schema(HISTORY).parquet(path) if path_exists(self.spark, path)
                else self.spark.createDataFrame([], HISTORY))

    def log(self, job: str, row: DataFrame) -> None:
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/history_{job}")


class Batch:
    """The new content of some partitions of some tables, put in place together by ``commit``."""

    def __init__(self, store: MartStore, job: str):
        self.store, self.job = store, job
        self.staged: dict[str, dict[str, str | None]] = {}

    def load(self, table: MartTable, parts: Sequence[Row] | None = None) -> DataFrame:
        """A table as it will be."""
        return self.store.read(table, parts, self.staged.get(table.name, {}))

    def replace(self, table: MartTable, keys: DataFrame, rows: DataFrame) -> None:
        """Delete ``keys`` and add ``rows``; ``keys`` must carry the calendar columns that tell where the rows are, the
        new ones included."""
        parts = self.store.places(table, keys)
        if parts:
            kept = lacking_keys(self.store.load(table, parts), keys, table.key)
            self.put(table, parts, self._content(table, kept, rows))

    def replace_where(self, table: MartTable, parts: Sequence[Row], doomed: Column, rows: DataFrame) -> None:
        """Within some partitions, delete the rows that meet a condition and add ``rows``."""
        kept = self.load(table, parts).filter(~F.coalesce(doomed, F.lit(False)))
        self.put(table, parts, self._content(table, kept, rows))

    def _content(self, table: MartTable, kept: DataFrame, rows: DataFrame) -> DataFrame:
        return kept.to(table.stored_schema).unionByName(rows.to(table.stored_schema))

    def put(self, table: MartTable, parts: Sequence[Row], content: DataFrame) -> None:
        """Stage all that these partitions will hold. A table may be put several times, but a partition only once."""
        root = f"{self.store.batch_path(self.job)}/{table.name}"
        again = self.staged.setdefault(table.name, {})
        if taken := again.keys() & {folder_of(p) for p in parts}:
            raise ValueError(f"{table.name}: {sorted(taken)} are staged already")
        if parts:
            self.store.write(table, content, root, mode="append")
            found = set(folders(self.store.spark, root, len(table.partitions(self.store.grain))))
            again |= {f: root if f in found else None for f in map(folder_of, parts)}

    def commit(self) -> None:
        """From the record on the batch counts, whether or not this run lives to move its folders."""
        record = [(table, folder, root is not None) for table, moved in self.staged.items() for folder, root in moved.items()]
        if record:
            write_text(self.store.spark, f"{self.store.batch_path(self.job)}/commit", json.dumps(record))
        self.store.settle(self.job)


def folder_of(part: Row) -> str:
    return "/".join(f"{name}={value}" for name, value in part.asDict().items())


def _in_folders(paths: Sequence[str], columns: Sequence[str]) -> Column:
    """Rows of partitions named by their paths."""
    return F.concat_ws("/", *(F.concat(F.lit(f"{c}="), F.col(c)) for c in columns)).isin(*paths)


def _in_partitions(parts: Sequence[Row]) -> Column:
    """Literal partition filter, so that only those folders are listed and read."""
    if not parts:
        return F.lit(False)
    names = list(parts[0].asDict())
    return reduce(Column.__and__, (F.col(n).isin(*sorted({p[n] for p in parts})) for n in names))
