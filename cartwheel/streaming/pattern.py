"""Patterns of consecutive rows per key on streams.

The same pattern as ``operators.visits.pattern``: a row that meets the first
condition, directly followed by rows that meet the next ones, all less than
``within_ms`` after the first.  Conditions are evaluated by Spark before the
state step; a key's state is the list of its rows that are not decided yet, in
the state store.

A row is settled once the watermark has reached it, since nothing can come
before it any more.  A first row is decided when the rows behind it are settled
as far as the automaton has to look, or when ``within_ms`` has passed.  Each key
has one event-time timer, at the next moment that can decide something, so a
key costs nothing in batches in which it neither receives a row nor is due.
Followers are kept as time and conditions only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.visits import PATTERN_COLUMNS
from ..session import ship_package


def decide(rows: list[tuple], watermark: int, within_ms: int, steps: int) -> tuple[list[tuple], int, int | None]:
    """What the settled part of one key's rows decides.

    ``rows``: (time, order, conditions as '0' and '1', ...), sorted.  Returns the
    outcomes (number of the first row, kind, matched conditions, time of the last
    matched row), how many rows are done with, and when to look again."""
    out = []
    for i, (ts, _, met, *_) in enumerate(rows):
        if ts > watermark:
            return out, i, ts
        if met[0] != "1":
            continue
        kind, k = None, 1
        while True:
            if k == steps:
                kind = "match"
                break
            j = i + k
            if j < len(rows) and rows[j][0] <= watermark:
                if rows[j][0] - ts >= within_ms:
                    kind = "timeout"
                elif rows[j][2][k] == "1":
                    k += 1
                    continue
                break
            if ts + within_ms <= watermark:
                kind = "timeout"
                break
            # a later first row cannot be decided before this one
            return out, i, min(ts + within_ms, rows[j][0] if j < len(rows) else ts + within_ms)
        if kind:
            out.append((i, kind, k, rows[i + k - 1][0]))
    return out, len(rows), None


def _plain(v: Any) -> Any:
    """Rows as tuples, which the state store takes back."""
    if isinstance(v, tuple):
        return tuple(_plain(x) for x in v)
    if isinstance(v, list):
        return [_plain(x) for x in v]
    return {k: _plain(x) for k, x in v.items()} if isinstance(v, dict) else v


class PatternProcessor(StatefulProcessor):
    """State of a key: its undecided rows (time, order, conditions, row if it can be a first one) and its timer."""

    def __init__(self, columns: list[str], ts: str, seq: str, within_ms: int, steps: int, row_schema: T.StructType):
        self.columns, self.ts, self.seq, self.within_ms, self.steps = columns, ts, seq, within_ms, steps
        self.state_schema = T.StructType([T.StructField("ts", T.LongType()), T.StructField("seq", T.LongType()),
                                          T.StructField("met", T.StringType()), T.StructField("row", row_schema)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.made = Row(*self.columns, *PATTERN_COLUMNS.names)
        self.open = handle.getListState("open", self.state_schema)
        self.due = handle.getValueState("due", "at bigint")

    def _wake(self, at: int | None) -> None:
        set_ = self.due.get()[0] if self.due.exists() else None
        if set_ == at:
            return
        if set_ is not None:
            self.handle.deleteTimer(set_)
        if at is None:
            self.due.clear()
        else:
            self.handle.registerTimer(at)
            self.due.update((at,))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new, first = [], math.inf
        for r in rows:
            met = r["_met"]
            new.append((r[self.ts], r[self.seq], met, tuple(_plain(r[c]) for c in self.columns) if met[0] == "1" else None))
            first = min(first, r[self.ts])
        self.open.appendList(new)
        if not self.due.exists() or first < self.due.get()[0]:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.due.clear()  # this timer is gone
        rows = sorted((_plain(r) for r in self.open.get()), key=lambda r: r[:2])
        out, done, at = decide(rows, timerValues.getCurrentWatermarkInMs(), self.within_ms, self.steps)
        if done:
            if done < len(rows):
                self.open.put(rows[done:])
            else:
                self.open.clear()
        if at is not None:
            self._wake(at)
        for i, kind, matched, last in out:
            yield self.made(*rows[i][3], kind, matched, last)

    def close(self) -> None:
        pass


def pattern_stream(df: DataFrame, steps: list[Column], within_ms: int, key: str = "mid", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """X8 on a stream: the first rows with ``kind``, ``matched`` and ``last_ts``, as ``visits.pattern`` gives them.

    ``df`` carries a watermark on an event-time column (``jobs.with_event_time``), which is not returned."""
    ship_package(df.sparkSession)
    timed = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    columns = [c for c in df.columns if c not in timed]
    met = F.concat(*[F.when(F.coalesce(s, F.lit(False)), F.lit("1")).otherwise(F.lit("0")) for s in steps])
    row_schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name in columns])
    out = T.StructType(row_schema.fields + PATTERN_COLUMNS.fields)
    return (df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn("_met", met).groupBy(key)
            .transformWithState(PatternProcessor(columns, ts, seq, within_ms, len(steps), row_schema), out, "Append", "EventTime"))
