"""Change events and the stream that maintains a mart from them."""

import json
from pathlib import Path

import pytest

from tallyspark.operators.changes import (
    decode_changes, holes, latest_changes, not_applied, reached_offsets, reached_ranges, with_ranges,
)
from tallyspark.plans import jobs, refresh
from tallyspark.schema import TAX_DAILY
from tallyspark.sinks.store import MartStore
from tallyspark.streaming.change_stream import maintain, read_feed
from tests.shop import at, rows, shop

NOW = at("2023-08-01")


def events(spark, *values):
    return spark.createDataFrame(
        [(v if isinstance(v, str) or v is None else json.dumps(v), i % 2, i) for i, v in enumerate(values)],
        "value string, partition int, offset bigint")


def test_decoding(spark):
    df = events(
        spark, {"before": None, "after": {"id_transaction": 1, "k": "x"}}, {"before": {"id_transaction": 2}, "after": None},
        "{bad", None, "[]", {"before": {"id_transaction": 3}, "after": {}}, {"before": None, "after": None},
        {"before": {"id_transaction": 1}})
    assert rows(decode_changes(df), "id", "deleted") == [(1, False), (1, True), (2, True), (3, True)]
    assert rows(latest_changes(decode_changes(df)), "id", "deleted") == [(1, True), (2, True), (3, True)]
    keyed = decode_changes(df, extra=["k"], as_text=True)
    assert rows(keyed.filter("not deleted"), "id", "k") == [("1", "x")]
    assert rows(reached_offsets(df), "partition", "offset") == [(0, 6), (1, 7)]


def feed_file(folder, name, *changes, first=0):
    target = Path(folder) / "feed"
    target.mkdir(exist_ok=True)
    lines = [json.dumps({"value": json.dumps(c) if isinstance(c, dict) else c, "partition": 0, "offset": first + i})
             for i, c in enumerate(changes)]
    (target / name).write_text("\n".join(lines) + "\n")


def upsert(id):
    return {"before": None, "after": {"id_transaction": id}}


def delete(id):
    return {"before": {"id_transaction": id}, "after": None}


def test_stream_of_changes_with_replay(spark, folder):
    def sale(id, day="2023-05-10", **more):
        return dict(id=id, sold_at=at(day), updated_at=at(day), **more)

    before = shop(spark, transactions=[sale(1), sale(2), sale(3, "2023-05-11")])
    after = shop(spark, transactions=[sale(1, "2023-05-12", total=7), sale(3, "2023-05-11"), sale(4, "2023-04-02")])
    store, mart = MartStore(spark, f"{folder}/marts", "month"), refresh.TAX
    jobs.initial_load(store, mart, before, at("2023-06-01"), NOW)

    def run(checkpoint):
        feed = read_feed(spark, "json", {"path": f"{folder}/feed", "maxFilesPerTrigger": "1"})
        maintain(store, mart, lambda: after, feed, f"{folder}/{checkpoint}", clock=lambda: NOW).awaitTermination()

    feed_file(folder, "1.json", upsert(1), "{bad", delete(2))
    run("checkpoint")
    feed_file(folder, "2.json", delete(2), upsert(4), upsert(4), first=3)
    run("checkpoint")
    expected = rows(refresh.full(mart, after)[TAX_DAILY.name], *TAX_DAILY.column_names)
    assert rows(store.load(TAX_DAILY), *TAX_DAILY.column_names) == expected
    logged = rows(store.history(mart.name).filter("mart_param is not null"), "mart_param", "num_row")
    assert [n for _, n in logged] == [1, 1]
    # A lost checkpoint replays everything: same marts, no second log rows.
    run("other")
    assert rows(store.load(TAX_DAILY), *TAX_DAILY.column_names) == expected
    assert rows(store.history(mart.name).filter("mart_param is not null"), "mart_param", "num_row") == logged
    # New events under a new checkpoint are logged, although its batches are numbered from 0 again.
    feed_file(folder, "3.json", upsert(3), first=6)
    run("third")
    assert store.history(mart.name).filter("mart_param is not null").count() == 3


@pytest.mark.parametrize("batches, left", [
    ([(0, 9)], []), ([(0, 4), (5, 9)], []), ([(0, 6), (3, 9)], []), ([(0, 2), (7, 9)], [[3, 6]]), ([(7, 9), (0, 2), (3, 6)], []),
    ([(0, 9), (2, 5)], []), ([(5, 5), (1, 1)], [[2, 4]])])
def test_applied_ranges(spark, batches, left):
    """However the feed is cut, each event is new once."""
    feed = spark.range(10).selectExpr("'v' AS value", "0 AS partition", "id AS offset").union(
        spark.range(3).selectExpr("'v' AS value", "1 AS partition", "id AS offset"))
    applied, seen = {}, []
    for low, high in batches:
        new = not_applied(feed.filter(f"partition = 1 OR offset BETWEEN {low} AND {high}"), applied)
        seen += [(r["partition"], r["offset"]) for r in new.collect()]
        applied = with_ranges(applied, [tuple(r) for r in reached_ranges(new).collect()])
    wanted = {(0, i) for low, high in batches for i in range(low, high + 1)} | {(1, i) for i in range(3)}
    assert len(seen) == len(set(seen)) and set(seen) == wanted
    assert holes(applied) == ({0: left} if left else {})


def test_the_oldest_hole_closes_first():
    applied = {}
    for n in range(6):
        applied = with_ranges(applied, [(0, 10 * n, 10 * n + 1)], most=3)
    assert applied == {0: [[0, 31], [40, 41], [50, 51]]}
