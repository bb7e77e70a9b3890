"""Windows, watermarks, period closing and the run log."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import times
from tallyspark.operators import progress
from tallyspark.plans import jobs, refresh
from tallyspark.schema import HISTORY
from tallyspark.sinks.store import MartStore
from tests.shop import at, rows, shop

END = datetime(2023, 5, 10, 9)


def log(spark, *ends, flags=(True, False)):
    return spark.createDataFrame(
        [(i, e, e, e, 0, 1.0, "{}", *flags, None) for i, e in enumerate(ends, start=1)], HISTORY)


@pytest.mark.parametrize("stalled", [1, 2, 3])
def test_a_stalled_window_widens(spark, stalled):
    history = log(spark, END - timedelta(hours=1), *[END] * stalled)
    window = progress.next_window(history, 5).first()
    assert (window["window_start"], window["window_end"]) == (END, END + timedelta(minutes=5 * stalled))
    assert (window["done_monthly"], window["done_yearly"]) == (True, False)


def test_latest_run_by_id_or_by_end(spark):
    history = log(spark, END, END - timedelta(hours=1))
    assert progress.last_run(history).first()["ts_end"] == END - timedelta(hours=1)
    assert progress.last_run(history, by="ts_end").first()["ts_end"] == END


def test_period_window_stops_at_the_given_end(spark):
    limit = END + timedelta(minutes=7)
    assert [progress.next_period(log(spark, END), m, limit).first()["window_end"] for m in (5, 10)] == [
        END + timedelta(minutes=5), limit]


def test_reach_back(spark):
    window = progress.next_window(log(spark, END), 5)
    past, open_ = (progress.reach_back(window, progress.moment(now)).first()["window_start"]
                   for now in (END + timedelta(hours=1), END))
    assert (past, open_) == (END - timedelta(seconds=5), END - timedelta(seconds=300))


@pytest.mark.parametrize("now, end", [(at("2023-06-01"), at("2023-05-20")), (at("2023-05-15"), at("2023-05-10"))])
def test_empty_window_advances_only_in_the_past(spark, now, end):
    batch = shop(spark).transactions
    mark = progress.batch_watermark(batch, at("2023-05-10"), at("2023-05-20"), now).first()
    assert (mark["ts_current"], mark["ts_end"], mark["num_row"]) == (at("2023-05-10"), end, 0)


@pytest.mark.parametrize("begin, end, flags, closes, left", [
    ("2023-05-10", "2023-05-11", (True, True), (None, None), (True, True)),
    ("2023-05-10", "2023-05-11", (False, True), (date(2023, 4, 1), None), (True, True)),
    ("2023-01-10", "2023-01-11", (False, False), (date(2022, 12, 1), 2022), (True, True)),
    ("2023-05-31", "2023-06-01", (True, True), (None, None), (False, True)),
    ("2022-12-31", "2023-01-01", (True, True), (None, None), (False, False)),
    ("2022-12-31", "2023-01-01", (False, False), (date(2022, 11, 1), 2021), (False, False)),
])
def test_period_closing(spark, begin, end, flags, closes, left):
    run = spark.createDataFrame([(at(begin), at(end), *flags)],
                                "ts_current timestamp_ntz, ts_end timestamp_ntz, done_monthly boolean, done_yearly boolean")
    todo = progress.period_closing(run).first()
    assert (todo["close_month"], todo["close_year"]) == closes
    assert (todo["done_monthly"], todo["done_yearly"]) == left


def test_calendar(spark):
    df = spark.createDataFrame([(datetime(2023, 1, 2, 3, 4, 5),)], "t timestamp_ntz")
    got = df.select(times.stamp("t"), times.previous_month("t"), times.last_of_month("t"), times.local_to_utc("t"),
                    F.size(times.months_covered(F.lit(date(2022, 11, 20)), F.to_date("t")))).first()
    assert tuple(got) == ("2023-01-02 3:4:5 +07:00", date(2022, 12, 1), date(2023, 1, 31),
                          datetime(2023, 1, 1, 20, 4, 5), 3)


def test_log_rows_refuse_unknown_columns(spark):
    with pytest.raises(ValueError):
        progress.log_row(spark, run_id=1, actdate=END, ts_current=END, ts_end=END, num_row=0, time_process=1, params={},
                         colour="red")


def test_a_log_is_told_by_a_name(spark, folder):
    with pytest.raises(TypeError):
        jobs.write_log(MartStore(spark, folder), refresh.TAX, jobs.Batch(END, END, 0), 0, END, {})


def test_sequence_of_runs(spark, folder):
    """Three runs: one with changes over a month's end, one empty, and the one after it with a wider window."""
    mart, store = refresh.SUMMARY, MartStore(spark, folder, "month")
    reservations = [dict(id=1), dict(id=2, updated_at=datetime(2023, 6, 1, 0, 3), reserved_on=date(2023, 6, 2))]
    source = shop(spark, reservations=reservations)
    with pytest.raises(ValueError):
        jobs.run_sequence(store, mart, source, 5, now=at("2023-06-10"))
    start = datetime(2023, 5, 31, 23, 59)
    jobs.write_log(store, mart.name, jobs.Batch(start, start, 0), 0, start, {}, done_monthly=True, done_yearly=True)
    first = jobs.run_sequence(store, mart, source, 5, now=at("2023-06-10"))
    assert (first.num_row, first.ts_end) == (1, datetime(2023, 6, 1, 0, 3))
    second = jobs.run_sequence(store, mart, source, 5, now=at("2023-06-10"), until=datetime(2023, 6, 1, 0, 4))
    assert second.num_row == 1 and rows(store.load(mart.raw), "id_reservation") == [(2,)]
    third = jobs.run_sequence(store, mart, source, 5, now=at("2023-06-10"))
    assert third.ts_end == datetime(2023, 6, 1, 0, 3)
    history = store.history(mart.name)
    assert [r[0] for r in rows(history, "id")] == [1, 2, 3, 4]
    widened = progress.next_window(history, 5).first()
    assert widened["runs"] == 3 and widened["window_end"] == datetime(2023, 6, 1, 0, 18)
