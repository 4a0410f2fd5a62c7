"""Change history as a stream: one state per record, the same rules as ``operators.history``."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.history import Watched

_DAY_MS = 86_400_000


class _History(StatefulProcessor):
    """State: the last snapshot and the changes of a record. A timer forgets it ``forget`` days after its last snapshot."""

    def __init__(self, w: Watched, forget: int):
        self.w, self.forget = w, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("record", StructType([StructField("said", StringType())]))

    def _changes(self, was: dict, now: dict) -> list[dict]:
        w = self.w
        out = [{"field": f, "was": was[f], "now": now[f]} for f in w.always if was[f] != now[f]]
        if was["sources"] == now["sources"]:
            out += [{"field": f, "was": was[f], "now": now[f]} for f in w.compared if None not in (was[f], now[f]) and was[f] != now[f]]
        out += [{"field": f, "was": None, "now": now[f]} for f in w.once if now[f] is not None and was[f] != now[f]]
        left, there = was["state"] == w.missing, now["state"] == w.missing
        if left != there:
            out.append({"field": "gone" if there else "back", "was": None, "now": None})
        return [{"day": now["day"], **c} for c in out]

    def _after(self, past: list[dict], found: list[dict]) -> list[dict]:
        w, past = self.w, list(past)
        for h in found:
            same = [i for i, c in enumerate(past) if c["field"] == ("gone" if h["field"] == "back" else h["field"])]
            last = past[same[-1]] if same else None
            recent = last is not None and (pd.Timestamp(h["day"]) - pd.Timestamp(last["day"])).days <= w.within
            if recent and (h["field"] == "back" or (h["field"] in w.always + w.compared and last["was"] == h["now"])):
                del past[same[-1]]
            elif not (h["field"] in w.once and any(past[i]["now"] == h["now"] for i in same)):
                past.append(h)
        return past[-w.most :]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = json.loads(self.state.get()[0]) if self.state.exists() else {"last": None, "changes": []}
        before = held["changes"]
        for now in sorted((json.loads(s) for df in rows for s in df["said"]), key=lambda s: s["day"]):
            if held["last"] is None or now["day"] > held["last"]["day"]:
                if held["last"] is not None:
                    if found := self._changes(held["last"], now):
                        held["changes"] = self._after(held["changes"], found)
                held["last"] = now
        self.state.update((json.dumps(held),))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(pd.Timestamp(held["last"]["day"]).value // 1_000_000) + self.forget * _DAY_MS)
        if held["changes"] != before:
            yield pd.DataFrame({"key": [str(key[0])], "day": [pd.Timestamp(held["last"]["day"])], "changes": [json.dumps(held["changes"])]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def change_history(snapshots: DataFrame, w: Watched, late: str = "1 day", forget: int = 31) -> DataFrame:
    """(key, day, changes as JSON) whenever a record's history has changed; the last row of a key is its history.

    ``snapshots`` is a stream of runs, each run's rows in one trigger or several; a snapshot that isn't later than the record's last is left
    out. Needs the RocksDB state store.
    """
    fields = [F.col(f).cast("string").alias(f) for f in (*w.always, *w.compared, *w.once)]
    said = F.to_json(F.struct(F.date_format(w.day, "yyyy-MM-dd").alias("day"), F.col(w.state).alias("state"), F.array_sort(F.array_distinct(F.col(w.sources))).alias("sources"), *fields), {"ignoreNullFields": "false"})
    flat = snapshots.select(F.col(w.key).cast("string").alias("key"), F.col(w.day).cast("timestamp").alias("at"), said.alias("said")).withWatermark("at", late)
    return flat.groupBy("key").transformWithStateInPandas(_History(w, forget), "key string, day timestamp, changes string", "Append", "EventTime")
