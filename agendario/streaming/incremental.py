"""Incremental scans as Structured Streaming: first sight of a link, running change capture."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def first_sight(stream: DataFrame, key: str, time: str, remember: str = "31 days") -> DataFrame:
    """Each key once while it is remembered: rows of a key seen within the watermark are dropped."""
    return stream.withWatermark(time, remember).dropDuplicatesWithinWatermark([key])


def hourly(stream: DataFrame, time: str, source: str, late: str = "2 hours") -> DataFrame:
    """Announcements per source and hour; late rows are taken up to ``late``."""
    return stream.withWatermark(time, late).groupBy(F.window(time, "1 hour"), source).agg(F.count("*").alias("n"))


def value_changes(stream: DataFrame, key: str, time: str, value: str, late: str = "2 hours", forget_ms: int = 31 * 86_400_000) -> DataFrame:
    """A row whenever the value of a key differs from the one before it, by event time.

    Rows wait in the key's state until the watermark (``late``) has passed them and are then taken in order of time, so
    a late row makes no false change; rows later than that are dropped. A key's state holds the rows of ``late`` and its last value, and
    goes when the watermark is ``forget_ms`` past its last row.
    """

    def step(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, times, values = state.get if state.exists else (None, [], [])
        waiting = list(zip(times, values))
        mark = state.getCurrentWatermarkMs()
        if state.hasTimedOut and not waiting:
            state.remove()
            return
        for rows in batches:
            waiting += [(int(t.value // 1_000_000), v) for t, v in zip(pd.to_datetime(rows[time]), rows[value]) if t.value // 1_000_000 >= mark]
        waiting.sort(key=lambda x: (x[0], x[1] is None, x[1] or ""))
        out = []
        while waiting and waiting[0][0] <= mark:
            t, v = waiting.pop(0)
            if v != last:
                out.append((name[0], pd.Timestamp(t, unit="ms"), last, v))
                last = v
        state.update((last, [t for t, _ in waiting], [v for _, v in waiting]))
        state.setTimeoutTimestamp(max(mark + 1, waiting[0][0] if waiting else mark + forget_ms))
        if out:
            yield pd.DataFrame(out, columns=["key", "at", "was", "now"])

    flat = stream.withWatermark(time, late).select(F.col(key).cast("string").alias(key), time, F.col(value).cast("string").alias(value))
    return flat.groupBy(key).applyInPandasWithState(step, "key string, at timestamp, was string, now string", "last string, times array<bigint>, values array<string>", "append", GroupStateTimeout.EventTimeTimeout)
