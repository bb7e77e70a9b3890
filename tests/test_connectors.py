"""JDBC options, checked on stand-ins for Spark's reader and writer (no database is started), and table mapping."""

from datetime import datetime

import pytest

from checks.queries import QUERIES
from tallyspark.functions.times import seconds_of_day
from tallyspark.operators.aggregate import aggregate, surrogate_key
from tallyspark.operators.keys import delete_range
from tallyspark.session import shared_dir
from tallyspark.sinks import jdbc as sink
from tallyspark.sources import jdbc
from tallyspark.sources.pos_tables import POS_COLUMNS, from_pos_tables
from tallyspark.sources.sample_tables import FILES
from tests.shop import DEFAULTS, frame, rows


class Recorder:
    """Remembers option and method calls."""

    def __init__(self):
        self.options, self.calls = {}, []

    def format(self, name):
        self.options["format"] = name
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self.options

    def jdbc(self, **arguments):
        self.calls.append(arguments)
        return arguments


class Spark:
    def __init__(self):
        self.read = Recorder()


class Frame:
    def __init__(self, empty=False, columns=("Id", "Note")):
        self.write, self.columns, self.empty = Recorder(), list(columns), empty

    def isEmpty(self):
        return self.empty

    def select(self, *columns):
        self.selected = columns
        return self


def test_read_options():
    plain = jdbc.read_query(Spark(), "jdbc:x", "SELECT 1", {"user": "u"}, custom_schema="a DOUBLE")
    assert plain["dbtable"] == "(SELECT 1) source_rows" and plain["customSchema"] == "a DOUBLE" and plain["user"] == "u"
    assert plain["preferTimestampNTZ"] == "true" and "partitionColumn" not in plain
    split = jdbc.read_query(Spark(), "jdbc:x", "SELECT 1", split_by="id", bounds=(1, 9), partitions=4)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "1", "9", "4")


def test_read_slices():
    assert jdbc.read_slices(Spark(), "jdbc:x", "t", ["d = 1", "d = 2"], {})["predicates"] == ["d = 1", "d = 2"]
    with pytest.raises(ValueError):
        jdbc.read_slices(Spark(), "jdbc:x", "t", [], {})


@pytest.mark.parametrize("ids", [
    "id", "id * id", "id * 1000003 - 5000000", "cast(pow(1.01, id) AS bigint)", "if(id % 10 = 0, NULL, if(id < 1800, id % 5 + 7, id * 100))"])
def test_slices_cover_a_table_once_and_evenly(spark, ids):
    df = spark.range(2000).selectExpr(f"{ids} AS id")
    low, high, rows_in = df.selectExpr("min(id)", "max(id)", "count(*)").first()
    slices = jdbc.plan_slices(jdbc.counted_frame(df, "id"), "id", low, high, rows_in, slices=10)
    parts = [df.filter(p) for p in slices]
    counts = [p.count() for p in parts]
    assert sum(counts) == rows_in and sum(bool(c) for c in counts) <= 22
    largest = max(r["count"] for r in df.groupBy("id").count().collect())
    assert max(counts[1:]) <= max(2 * rows_in / 10, largest)
    for p, n in zip(parts, counts):
        assert p.exceptAll(df).count() == 0 and n == p.count()


def test_slices_of_tables_without_ids(spark):
    df = spark.range(3).selectExpr("cast(NULL AS bigint) AS id")
    assert [df.filter(p).count() for p in jdbc.plan_slices(jdbc.counted_frame(df, "id"), "id", None, None, 3)] == [3, 0]


def test_slices_of_ids_beyond_a_bigint(spark):
    df = spark.range(9_000_000, 9_002_000).selectExpr("id", "cast(id AS decimal(38,0)) * id * id AS key")
    low, high, rows = df.selectExpr("min(key)", "max(key)", "count(*)").first()
    slices = jdbc.plan_slices(jdbc.counted_frame(df, "key"), "key", low, high, rows, slices=10)
    counts = [df.filter(p).count() for p in slices]
    assert sum(counts) == 2000 and max(counts) <= 400


def test_cells_of_huge_ids_are_cut_exactly(spark):
    low, width = 2 ** 62, 3
    df = spark.range(low, low + 300).toDF("id")
    cells = jdbc.counted_frame(df, "id")(low, low + 300, width)
    assert sorted((r["cell"], r["rows"]) for r in cells) == [(i, 3) for i in range(100)]


def test_query_of_slices_holds_large_ids(spark, tmp_path):
    ids = [7, 2_097_151, 2_097_152, 9_000_000]
    moment = datetime(1998, 2, 6)
    for name, rows in {"nation": [(2, "n", 1)], "customer": [(5, "c", 2, 1.0, "m")],
                       "orders": [(i, 5, "F", 10.0, moment, "5-LOW") for i in ids]}.items():
        spark.createDataFrame(rows, FILES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    found = {r["id"]: (r["key"], r["times"]) for r in QUERIES["transactions_in_slices"](spark, str(tmp_path)).collect()}
    assert found == {i: (i ** 3 if i < 2 ** 21 else None, 1) for i in ids}


def test_append_options():
    df = Frame()
    sink.append(df, "jdbc:x?a=1", "t", {"user": "u"}, untyped_text=True, connections=3)
    assert df.write.calls == [dict(url="jdbc:x?a=1&stringtype=unspecified", table="t", mode="append",
                                   properties={"user": "u"})]
    assert df.write.options == {"batchsize": "10000", "numPartitions": "3"}


def test_bulk_append(spark):
    empty = Frame(empty=True)
    assert sink.bulk_append(empty, "jdbc:x", "t", {}) is False and empty.write.calls == []
    with pytest.raises(ValueError):
        sink.bulk_append(empty, "jdbc:x", "t", {}, raise_if_empty=True)
    df = Frame()
    assert sink.bulk_append(df, "jdbc:x", "t", {}) is True
    assert ["id", "note"] == [c._jc.toString().split(" AS ")[-1] for c in df.selected]


def test_source_columns_are_mapped(spark):
    """Every table goes through its own column names and comes back under the names used here."""
    originals = {}
    for name, (table, columns) in POS_COLUMNS.items():
        df = frame(spark, name, [{**DEFAULTS[name]}])
        originals[table] = df.withColumnsRenamed({new: old for old, new in columns.items()})
    source = from_pos_tables(originals.__getitem__)
    for name in POS_COLUMNS:
        assert rows(getattr(source, name)) == rows(frame(spark, name, [{**DEFAULTS[name]}])), name


def test_aggregate_helper(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (2, "a", 4)], "k int, t string, v int")
    out = aggregate(df, ["k"], {"v": "sum", "t": "count"}, only=["k", "v", "t"], rename={"t": "n"}, order=["n", "k", "v"],
                    uuid_column="no")
    assert out.columns == ["n", "k", "v", "no"]
    assert rows(out, "k", "v", "n") == [(1, 5, 2), (2, 4, 1)]
    assert out.select("no").distinct().count() == 2
    assert df.select(surrogate_key(["k", "t"])).distinct().count() == 3


def test_delete_range_keeps_undated_rows(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 1, "2023-05-02"), (2, 1, "2023-05-02"), (1, 2, "2023-05-02")],
                               "merchant_id int, outlet_id int, d string").selectExpr(
        "merchant_id", "outlet_id", "to_date(d) AS date")
    assert rows(delete_range(df, "2023-05-01", "2023-05-03", merchants=1, outlet=1), "merchant_id", "outlet_id") == [
        (1, 1), (1, 2), (2, 1)]
    assert delete_range(df, "2023-05-01", "2023-05-03").count() == 1


def test_clock_text(spark):
    df = spark.createDataFrame([("00:00:00",), ("23:59:59",), ("25:00:01",)], "c string")
    assert [r[0] for r in df.select(seconds_of_day("c")).collect()] == [0, 86399, 90001]


class Settings:
    """A session as far as the shared folder looks at it."""

    def __init__(self, master="spark://host:7077", **conf):
        self.conf, self.sparkContext = conf, type("Context", (), {"master": master})


def test_shared_folder_comes_from_the_session():
    warehouse = {"spark.sql.warehouse.dir": "hdfs://warehouse"}
    assert shared_dir(Settings(**warehouse, **{"spark.checkpoint.dir": "hdfs://shared/"})).startswith("hdfs://shared/tallyspark-")
    assert shared_dir(Settings(**warehouse)).startswith("hdfs://warehouse/tallyspark-")


@pytest.mark.parametrize("warehouse", ["file:/home/spark-warehouse", "/home/spark-warehouse"])
def test_a_folder_of_one_machine_is_refused_on_a_cluster(warehouse):
    conf = {"spark.sql.warehouse.dir": warehouse}
    with pytest.raises(ValueError):
        shared_dir(Settings(**conf))
    assert shared_dir(Settings("local[4]", **conf)).startswith(warehouse)
    assert shared_dir(Settings(**conf, **{"spark.checkpoint.dir": "file:///mnt/shared"})).startswith("file:///mnt/shared")
