"""Source and mart tables from a database over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

#: Cells that a range of ids is counted in at once, and that one slice is made of at least.
CELLS, CELLS_PER_SLICE = 1024, 8
# Rows of the ids low .. high - 1, by cells of a width: (cell, rows), cell 0 first; empty cells may be left out.
Count = Callable[[int, int, int], Iterable[tuple[int, int]]]


def read_query(spark: SparkSession, url: str, query: str, options: Mapping[str, str] | None = None, *,
               split_by: str | None = None, bounds: tuple[object, object] | None = None, partitions: int = 25,
               custom_schema: str | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Read a pushed-down query, over several connections if ``split_by`` and its ``bounds`` are given.

    Wall-clock timestamps stay wall-clock. ``custom_schema`` overrides column types, e.g. ``"refund DOUBLE"``.
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) source_rows")
              .option("fetchsize", str(fetch_size)).option("preferTimestampNTZ", "true"))
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if custom_schema:
        reader = reader.option("customSchema", custom_schema)
    if split_by and bounds:
        reader = (reader.option("partitionColumn", split_by).option("lowerBound", str(bounds[0]))
                  .option("upperBound", str(bounds[1])).option("numPartitions", str(partitions)))
    return reader.load()


def read_slices(spark: SparkSession, url: str, table: str, predicates: Sequence[str],
                properties: Mapping[str, str]) -> DataFrame:
    """Read a table as one slice per predicate (for instance one per day), each on its own connection."""
    if not predicates:
        raise ValueError("at least one predicate is needed")
    return spark.read.jdbc(url=url, table=table, predicates=list(predicates), properties=dict(properties))


def counted_frame(df: DataFrame, column: str) -> Count:
    """Counts of a table that Spark reads. Ids may be whole decimals, too; cells are cut exactly at any size."""
    def count(low: int, high: int, width: int) -> list[Row]:
        cell = f"(cast({column} AS decimal(38,0)) - ({low})) div {width}"
        return df.filter(f"{column} >= {low} AND {column} < {high}").groupBy(F.expr(cell).alias("cell")).agg(
            F.count("*").alias("rows")).collect()

    return count


def counted_table(spark: SparkSession, url: str, table: str, column: str, options: Mapping[str, str] | None = None) -> Count:
    """Counts that the database makes itself: what travels are the cells."""
    def count(low: int, high: int, width: int) -> list[Row]:
        cell = f"FLOOR(({column} - {low}) / {width})"
        return read_query(spark, url, f"SELECT {cell} AS cell, COUNT(*) AS n FROM {table} "
                                      f"WHERE {column} >= {low} AND {column} < {high} GROUP BY {cell}", options).collect()

    return count


def histogram(count: Count, low: int, high: int, most: int) -> list[tuple[int, int, int]]:
    """Ranges of the ids low .. high - 1 with their rows, in order, none with more than ``most`` rows unless it is one id.

    A range is counted in cells of equal width; a cell that holds too many is counted again in narrower ones. So the driver
    gets a few thousand numbers, wherever the ids crowd.
    """
    width = max(1, -(-(high - low) // CELLS))
    out = []
    for cell, rows in sorted((int(cell), int(rows)) for cell, rows in count(low, high, width)):
        start, end = low + cell * width, min(low + (cell + 1) * width, high)
        out += histogram(count, start, end, most) if rows > most and end - start > 1 else [(start, end, rows)]
    return out


def plan_slices(count: Count, column: str, low: int | None, high: int | None, rows: int, slices: int = 25) -> list[str]:
    """Disjoint predicates that cover a table, nulls and ids outside ``low`` .. ``high`` included, with nearly equal numbers of rows.

    ``rows`` is about how many rows there are. A slice has at most ``rows / slices`` rows, and an eighth of that, more, unless a
    single id has them.
    """
    nulls = f"{column} IS NULL"
    if low is None or high is None:
        return [nulls, f"{column} IS NOT NULL"]
    low, high = int(low), int(high)  # a database may answer in decimals
    share = max(1, -(-rows // slices))
    cuts, held = [], 0
    for start, _, n in histogram(count, low, high + 1, max(1, share // CELLS_PER_SLICE)):
        if held and held + n > share + share // CELLS_PER_SLICE:
            cuts.append(start)
            held = 0
        held += n
    if not cuts:
        return [nulls, f"{column} IS NOT NULL"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [nulls, f"{column} < {cuts[0]}", *between, f"{column} >= {cuts[-1]}"]
