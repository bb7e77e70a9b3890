"""The parquet store: partitions, crashes, and what a read touches."""

import time
from datetime import date

import pytest
from pyspark.sql import Row, functions as F

from tallyspark.schema import SALES_DAILY, SALES_MONTHLY, TAX_DAILY
from tallyspark.session import CLEANUP, Scratch, path_exists
from tallyspark.sinks.store import MartStore
from tests.shop import rows


def daily(spark, *days):
    return TAX_DAILY.conform(spark.createDataFrame(
        [(1, 10, 1, date.fromisoformat(d), float(v), 0.0, 0.0) for d, v in days],
        "merchant_id bigint, outlet_id bigint, base_type int, date date, transaction_value double, tax_value double, "
        "tax_product double"))


def held(store):
    return [(str(d), v) for d, v in rows(store.load(TAX_DAILY), "date", "transaction_value")]


def replace(store, keys, new, job="job"):
    batch = store.begin(job)
    batch.replace(TAX_DAILY, keys, new)
    batch.commit()


def test_reading_before_the_first_write(spark, folder):
    assert MartStore(spark, folder).load(TAX_DAILY).count() == 0


@pytest.mark.parametrize("grain", ["day", "month"])
def test_replacing_keys(spark, folder, grain):
    store = MartStore(spark, folder, grain)
    store.append(TAX_DAILY, daily(spark, ("2023-05-01", 1), ("2023-05-02", 2), ("2023-06-01", 3)))
    replace(store, daily(spark, ("2023-05-02", 0), ("2023-06-01", 0), ("2023-07-01", 0)), daily(spark, ("2023-07-01", 7)))
    assert held(store) == [("2023-05-01", 1.0), ("2023-07-01", 7.0)]
    emptied = "/p_month=2023-06" + ("/p_day=2023-06-01" if grain == "day" else "")
    assert not path_exists(spark, f"{folder}/{TAX_DAILY.name}{emptied}")
    assert not path_exists(spark, store.batch_path("job"))


def test_untouched_partitions_are_not_rewritten(spark, folder):
    import glob

    store = MartStore(spark, folder, "month")
    store.append(TAX_DAILY, daily(spark, ("2023-05-01", 1), ("2023-06-01", 3)))
    before = glob.glob(f"{folder}/{TAX_DAILY.name}/p_month=2023-05/*.parquet")
    replace(store, daily(spark, ("2023-06-01", 0)), daily(spark, ("2023-06-02", 4)))
    assert glob.glob(f"{folder}/{TAX_DAILY.name}/p_month=2023-05/*.parquet") == before
    assert held(store) == [("2023-05-01", 1.0), ("2023-06-02", 4.0)]


def die_after(monkeypatch, name, calls):
    """The driver is lost at one of the calls of a function of the store."""
    real, count = getattr(MartStore, name), [0]

    def failing(self, *args, **more):
        count[0] += 1
        if count[0] > calls:
            raise RuntimeError("driver lost")
        return real(self, *args, **more)

    monkeypatch.setattr(MartStore, name, failing)


OLD = [("2023-05-01", 1.0), ("2023-05-02", 2.0), ("2023-06-01", 3.0)]
NEW = [("2023-05-02", 2.0), ("2023-05-09", 9.0)]


@pytest.mark.parametrize("name, calls, seen", [("write", 0, OLD), ("settle", 1, NEW), ("put_in_place", 0, NEW), ("put_in_place", 1, NEW)])
def test_readers_find_all_old_or_all_new(spark, folder, monkeypatch, name, calls, seen):
    store = MartStore(spark, folder, "month")
    store.append(TAX_DAILY, daily(spark, ("2023-05-01", 1), ("2023-05-02", 2), ("2023-06-01", 3)))
    with monkeypatch.context() as patch:
        die_after(patch, name, calls)
        with pytest.raises(RuntimeError):
            replace(store, daily(spark, ("2023-05-01", 0), ("2023-06-01", 0)), daily(spark, ("2023-05-09", 9)))
    fresh = MartStore(spark, folder, "month")
    assert held(fresh) == seen
    fresh.settle("job")
    assert held(fresh) == seen and not path_exists(spark, fresh.batch_path("job"))
    fresh.settle("job")
    assert held(fresh) == seen


def test_a_partition_is_written_once_and_moved(spark, folder, monkeypatch):
    from glob import glob
    from os.path import basename

    from tallyspark.sinks import store as module

    store, moved = MartStore(spark, folder, "month"), []
    store.append(TAX_DAILY, daily(spark, ("2023-05-01", 1), ("2023-06-01", 3)))
    real = module.move_path

    def noted(spark, old, new):
        moved.extend(basename(f) for f in glob(f"{old}/*.parquet"))
        real(spark, old, new)

    monkeypatch.setattr(module, "move_path", noted)
    replace(store, daily(spark, ("2023-05-02", 0)), daily(spark, ("2023-05-02", 2)))
    assert moved == [basename(f) for f in glob(f"{folder}/{TAX_DAILY.name}/p_month=2023-05/*.parquet")]


def test_a_partition_is_staged_once(spark, folder):
    store = MartStore(spark, folder, "month")
    batch = store.begin("job")
    batch.put(TAX_DAILY, [Row(p_month="2023-05")], daily(spark, ("2023-05-01", 1)))
    assert rows(batch.load(TAX_DAILY), "transaction_value") == [(1.0,)] and held(store) == []
    with pytest.raises(ValueError):
        batch.put(TAX_DAILY, [Row(p_month="2023-05")], daily(spark, ("2023-05-02", 1)))


def test_period_overwrite_keeps_other_merchants(spark, folder):
    from pyspark.sql import functions as F

    store = MartStore(spark, folder)
    month = SALES_MONTHLY.conform(spark.createDataFrame(
        [(m, 10, 1, 2023, 5, *([float(m)] * 5), 1, 0.0, 0.0) for m in (1, 2)],
        ", ".join(f"{n} {'double' if 'decimal' in t.simpleString() else t.simpleString()}" for n, t in SALES_MONTHLY.columns)))
    store.append(SALES_MONTHLY, month)
    batch = store.begin("closing")
    batch.replace_where(SALES_MONTHLY, [Row(p_month="2023-05")], F.col("merchant_id") == 1, month.limit(0))
    batch.commit()
    assert rows(store.load(SALES_MONTHLY), "merchant_id") == [(2,)]


def test_reads_are_limited_to_partitions(spark, folder):
    store = MartStore(spark, folder, "day")
    store.append(TAX_DAILY, daily(spark, ("2023-05-01", 1), ("2023-05-02", 2), ("2023-06-01", 3)))
    part = store.load(TAX_DAILY, [Row(p_month="2023-05", p_day="2023-05-02")])
    # Only the folder of that day is listed.
    assert len(part.inputFiles()) == 1 and part.count() == 1


def test_searches_are_limited_to_the_periods_of_the_keys(spark, folder):
    store = MartStore(spark, folder, "day")
    stored = store.append(TAX_DAILY, daily(spark, ("2023-05-01", 1), ("2023-05-02", 2), ("2023-06-01", 3), ("2022-05-02", 4)))
    by_day = store.near(TAX_DAILY, stored, daily(spark, ("2023-05-02", 0)))
    by_month = store.near(TAX_DAILY, stored, spark.createDataFrame([(2023, 5)], "year int, month int"))
    by_year = store.near(TAX_DAILY, stored, spark.createDataFrame([(2023,)], "year int"))
    none = store.near(TAX_DAILY, stored, spark.createDataFrame([], "year int"))
    assert [df.count() for df in (by_day, by_month, by_year, none)] == [1, 2, 3, 0]
    for df in (by_day, by_month, by_year):
        scan = df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1]
        assert scan.startswith("[") and not scan.startswith("[]")


def test_published_layout_round_trip(spark):
    df = daily(spark, ("2023-05-01", 1))
    published = TAX_DAILY.publish(df)
    assert published.columns == ["m_user_id_user", "m_cabang_id_cabang", *(
        f"mart_tax_report_{c}" for c in ("base_type", "date", "transaction_value", "tax_value", "tax_product"))]
    assert rows(TAX_DAILY.adopt(published)) == rows(df)
    assert SALES_DAILY.published_name("order_type") == "mart_sales_dashboard_daily_order_type"


def test_what_a_write_shuffles_goes_as_it_ends(spark, folder):
    """The driver need not collect its garbage first; the session's own setting stays."""
    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(";")
        return {f for f in files.split(";") if f.rsplit("/", 1)[-1].startswith("shuffle_")}

    def left(since):
        for _ in range(50):
            if not shuffled() - since:
                break
            time.sleep(0.2)
        return shuffled() - since

    since, setting = shuffled(), spark.conf.get(CLEANUP)
    scratch = Scratch(spark)
    many = spark.range(1000).repartition(4, F.col("id") % 7)
    kept = scratch.keep(many, "many")
    MartStore(spark, folder).append(TAX_DAILY, daily(spark, ("2023-05-01", 1), ("2023-05-02", 2)))
    assert left(since) == set() and spark.conf.get(CLEANUP) == setting
    assert kept.count() == scratch.keep(many, "again").count() == 1000
    scratch.clean()
