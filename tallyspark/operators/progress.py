"""Progress of a job: next window, batch watermark, period closing, run log.

The control state is one row per run, so everything here works on DataFrames of log rows and yields one small row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyspark.functions.times import previous_month
from tallyspark.schema import HISTORY

# How far a window reaches back to catch late commits, in seconds.
CLOSED_OVERLAP = 5
OPEN_OVERLAP = 300


def moment(value: datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def _minutes(value: int | Column) -> Column:
    return F.make_dt_interval(mins=(value if isinstance(value, Column) else F.lit(value)).cast("int"))


def last_run(history: DataFrame, by: str = "id") -> DataFrame:
    """End and flags of the latest run, with the number of runs that stopped at the same end.

    ``by`` is ``id`` for the last row written or ``ts_end`` for the furthest window. The log is counted per end first,
    so one pass answers both questions.
    """
    per_end = history.groupBy("ts_end").agg(
        F.count("*").alias("runs"), F.max("id").alias("last_id"),
        F.max_by(F.struct("done_monthly", "done_yearly"), "id").alias("flags"))
    rank = "last_id" if by == "id" else "ts_end"
    latest = per_end.filter(F.col("ts_end").isNotNull()).agg(
        F.max_by(F.struct("ts_end", "runs", "flags"), rank).alias("last"))
    return latest.select("last.ts_end", "last.runs", "last.flags.done_monthly", "last.flags.done_yearly")


def next_window(history: DataFrame, minutes: int, by: str = "id") -> DataFrame:
    """Window of the next run. Each run that found nothing new widens it by another ``minutes``."""
    return last_run(history, by).select(
        F.col("ts_end").alias("window_start"),
        (F.col("ts_end") + _minutes(F.col("runs") * minutes)).alias("window_end"),
        "runs", "done_monthly", "done_yearly")


def next_period(history: DataFrame, minutes: int, end_time: datetime | str) -> DataFrame:
    """Window of fixed length that stops at a given end."""
    return last_run(history, by="ts_end").select(
        F.col("ts_end").alias("window_start"),
        F.least(F.col("ts_end") + _minutes(minutes), moment(end_time)).alias("window_end"))


def reach_back(window: DataFrame, now: Column, delay: int = OPEN_OVERLAP) -> DataFrame:
    """Move the start back, further while the window still reaches into the present."""
    seconds = F.when(F.col("window_end") < now, CLOSED_OVERLAP).otherwise(delay)
    return window.withColumn("window_start", F.col("window_start") - F.make_dt_interval(secs=seconds))


def batch_watermark(batch: DataFrame, start: datetime | str, end: datetime | str, now: datetime | str,
                    clock: str = "updated_at") -> DataFrame:
    """How far a batch got: the change times seen, or the window itself when nothing was.

    An empty window that reaches beyond the present does not advance.
    """
    stop = F.when(moment(end) > moment(now), moment(start)).otherwise(moment(end))
    return batch.agg(F.min(clock).alias("first"), F.max(clock).alias("last"), F.count("*").alias("num_row")).select(
        F.coalesce("first", moment(start)).alias("ts_current"), F.coalesce("last", stop).alias("ts_end"), "num_row")


def period_closing(runs: DataFrame) -> DataFrame:
    """Which month and year a run has to close, and the flags it leaves.

    Expects ``ts_current``, ``ts_end``, ``done_monthly``, ``done_yearly``. A period is closed once; the flag drops when
    the batch itself crosses into the next period.
    """
    begin, end = F.col("ts_current"), F.col("ts_end")
    next_year = F.year(end) > F.year(begin)
    next_month = next_year | ((F.year(end) == F.year(begin)) & (F.month(end) > F.month(begin)))
    return runs.withColumns({
        "close_month": F.when(~F.coalesce("done_monthly", F.lit(False)), previous_month(F.to_date(begin))),
        "close_year": F.when(~F.coalesce("done_yearly", F.lit(False)), F.year(begin) - 1),
        "done_monthly": ~next_month,
        "done_yearly": ~next_year,
    })


def log_row(spark: SparkSession, *, run_id: int, actdate: datetime, ts_current: datetime, ts_end: datetime,
            num_row: int, time_process: float, params: Mapping[str, object], **extra: object) -> DataFrame:
    """One row of the run log; ``extra`` fills the optional columns."""
    unknown = set(extra) - {"done_monthly", "done_yearly", "mart_param"}
    if unknown:
        raise ValueError(f"unknown log columns: {sorted(unknown)}")
    row = (run_id, actdate, ts_current, ts_end, num_row, float(time_process), json.dumps(dict(params), default=str),
           extra.get("done_monthly"), extra.get("done_yearly"), extra.get("mart_param"))
    return spark.createDataFrame([row], HISTORY)
