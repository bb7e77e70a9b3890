"""Marts driven by a stream of change events."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspark.functions.times import LOCAL_ZONE
from tallyspark.operators.changes import decode_changes, holes, latest_changes, not_applied, reached_ranges, with_ranges
from tallyspark.plans.jobs import close_periods, run_changes, settle, write_log
from tallyspark.plans.refresh import Mart
from tallyspark.session import Scratch
from tallyspark.sinks.store import MartStore
from tallyspark.sources.tables import Source


def read_feed(spark: SparkSession, kind: str, options: Mapping[str, str], max_events: int = 20_000) -> DataFrame:
    """Raw change events with ``value``, ``partition`` and ``offset``.

    ``kafka`` reads a topic; any file format reads a folder of exported events with the same three columns.
    """
    reader = spark.readStream.format(kind).options(**options)
    if kind == "kafka":
        events = reader.option("maxOffsetsPerTrigger", str(max_events)).load()
        return events.select(F.col("value").cast("string").alias("value"), "partition", "offset")
    return reader.schema("value string, partition int, offset bigint").load()


def local_now() -> datetime:
    """The time on the clocks that the source writes."""
    return datetime.now(ZoneInfo(LOCAL_ZONE)).replace(tzinfo=None)


def applied_offsets(history: DataFrame) -> dict[int, list[list[int]]]:
    """The ranges of offsets that the last run of a stream has logged, by partition of the feed."""
    noted = history.filter(F.get_json_object("mart_param", "$.applied").isNotNull()).agg(F.max_by("mart_param", "id")).first()[0]
    return {int(p): ranges for p, ranges in json.loads(noted)["applied"].items()} if noted else {}


def maintain(store: MartStore, mart: Mart, load_source: Callable[[], Source], feed: DataFrame, checkpoint: str, *,
             id_field: str = "id_transaction", clock: Callable[[], datetime] = local_now,
             trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Start a query that refreshes a mart from each micro-batch of changes.

    The rows of changed ids are read from the source again. The log keeps which offsets of each feed partition were applied,
    so events that come again are left out however they are cut into batches, and events that were passed over are told in
    its ``params`` and taken when they come. Spark commits the offsets after the marts and the log are written; a batch that
    died before its log row is applied again, and leaves the same rows.
    """
    def on_batch(events: DataFrame, batch_id: int) -> None:
        started = time.time()
        settle(store, mart)
        history = store.history(mart.name)
        applied = applied_offsets(history)
        scratch = Scratch(store.spark)
        try:
            new = scratch.keep(not_applied(events, applied), "new")
            reached = [tuple(row) for row in reached_ranges(new).collect()]
            if not reached:
                return
            changes = scratch.keep(latest_changes(decode_changes(new, id_field)), "changes")
            batch = run_changes(store, mart, load_source(), changes, clock())
        finally:
            scratch.clean()
        finish(batch, with_ranges(applied, reached), started)

    def finish(batch, applied: dict, started: float) -> None:
        history = store.history(mart.name)
        last = history.agg(F.max_by(F.struct("done_monthly", "done_yearly", "ts_end"), "id").alias("flags")).first()["flags"]
        flags = (bool(last["done_monthly"]), bool(last["done_yearly"])) if last else (True, True)
        if batch.ts_current is not None:
            flags = close_periods(store, mart, batch, *flags, last["ts_end"] if last else None)
        write_log(store, mart.name, batch, started, clock(), {"method": "stream", "holes": holes(applied)}, done_monthly=flags[0],
                  done_yearly=flags[1], mart_param=json.dumps({"applied": applied}))

    writer = feed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
