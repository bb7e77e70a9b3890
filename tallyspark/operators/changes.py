"""Change events: JSON envelopes with the row before and after a change."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def decode_changes(events: DataFrame, id_field: str = "id_transaction", extra: Sequence[str] = (), *,
                   as_text: bool = False, value: str = "value") -> DataFrame:
    """Id, extra fields and kind of each event; text that is not such an event is skipped.

    An event without ``after`` is a deletion and is identified by ``before``. Other columns (offset, partition ...)
    pass through.
    """
    kind = "string" if as_text else "bigint"
    row = ", ".join([f"`{id_field}`: {kind}", *(f"`{e}`: string" for e in extra)])
    event = F.from_json(F.col(value).cast("string"), f"before struct<{row}>, after struct<{row}>")
    kept = [c for c in events.columns if c != value]
    gone = F.col(f"event.after.{id_field}").isNull()
    image = F.when(gone, F.col("event.before")).otherwise(F.col("event.after"))
    return (
        events.select(*kept, event.alias("event"))
        .select(*kept, image.alias("image"), gone.alias("deleted"))
        .filter(F.col(f"image.{id_field}").isNotNull())
        .select(*kept, F.col(f"image.{id_field}").alias("id"), *(F.col(f"image.{e}").alias(e) for e in extra), "deleted")
    )


def latest_changes(changes: DataFrame, order: str = "offset") -> DataFrame:
    """The last state of every id in a batch."""
    return changes.groupBy("id").agg(F.max_by("deleted", order).alias("deleted"))


def reached_offsets(events: DataFrame) -> DataFrame:
    """Highest offset read from each partition of the feed."""
    return events.groupBy("partition").agg(F.max("offset").alias("offset"))


def reached_ranges(events: DataFrame) -> DataFrame:
    """Lowest and highest offset read from each partition of the feed."""
    return events.groupBy("partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))


def not_applied(events: DataFrame, applied: Mapping[int, Sequence[Sequence[int]]]) -> DataFrame:
    """Events whose offset isn't in the ranges that were applied before, by partition of the feed."""
    done = F.lit(False)
    for partition, ranges in applied.items():
        inside = reduce(Column.__or__, (F.col("offset").between(low, high) for low, high in ranges), F.lit(False))
        done = done | ((F.col("partition") == int(partition)) & inside)
    return events.filter(~F.coalesce(done, F.lit(False)))


def with_ranges(applied: Mapping[int, Sequence[Sequence[int]]], reached: Sequence[Sequence[int]],
                most: int = 100) -> dict[int, list[list[int]]]:
    """The applied ranges after a batch that reached ``(partition, low, high)``.

    What a batch reads of a partition is taken to be all that the feed has between its lowest and highest offset. Ranges that
    meet become one. A hole between ranges stays open for events that come late, but at most ``most - 1`` of them: the oldest
    one closes first.
    """
    out = {int(p): [list(r) for r in ranges] for p, ranges in applied.items()}
    for partition, low, high in reached:
        merged: list[list[int]] = []
        for a, b in sorted([*out.get(partition, []), [low, high]]):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        while len(merged) > most:
            merged[:2] = [[merged[0][0], merged[1][1]]]
        out[partition] = merged
    return out


def holes(applied: Mapping[int, Sequence[Sequence[int]]]) -> dict[int, list[list[int]]]:
    """Offsets that were passed over, by partition of the feed."""
    return {p: found for p, ranges in applied.items() if (found := [[a[1] + 1, b[0] - 1] for a, b in zip(ranges, ranges[1:])])}
