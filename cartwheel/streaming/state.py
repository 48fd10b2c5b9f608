"""Per-device state machines for streams.

``OVER`` windows are rejected on streams, so the sequence operators keep state
by device: Spark hash-partitions devices over tasks and keeps one small state
per device in the state store (RocksDB, which time to live and timers need),
checkpointed with the query.  Rows of a device inside one micro-batch arrive
unordered and are sorted by (ts, seq) first.  Each state holds a flag, a day,
or the device's still-undecided rows - never its history.  Rows without a
device belong to no sequence.
"""

from __future__ import annotations

import datetime as dt
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupStateTimeout

from ..session import ship_package
from .pattern import pattern_stream

PAGE_SCHEMA = ("mid string, ar string, ch string, vc string, is_new string, page_id string, "
               "last_page_id string, item string, item_type string, during_time bigint, ts bigint, seq bigint")
PAGE_COLS = [c.split()[0] for c in PAGE_SCHEMA.split(", ")]
_DAY_ZERO = dt.datetime(1970, 1, 1)


def _sorted(pdfs: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return pd.DataFrame(columns=PAGE_COLS)
    return pd.concat(frames, ignore_index=True).sort_values(["ts", "seq"], kind="stable")


# ------------------------------------------------------------------ T1

def _repaired(pdf: pd.DataFrame, state) -> pd.DataFrame:
    """Only the first flag of the device stays '1'; the state says whether there was one."""
    seen = state.exists and state.get[0] == "1"
    flag = pdf["is_new"].to_numpy(dtype=object).copy()
    for i, (mid, v) in enumerate(zip(pdf["mid"], flag)):
        if mid is not None and v == "1":
            if seen:
                flag[i] = "0"
            seen = True
    if seen:
        state.update(("1",))
    return pdf.assign(is_new=flag)


def _device(spread_by: Column) -> Column:
    """The key of a row's state; rows without a device get keys of their own, by a hash, and pass unchanged."""
    return F.coalesce(F.concat(F.lit("d"), F.col("mid")), F.concat(F.lit("-"), F.pmod(F.xxhash64(spread_by), F.lit(1024)).cast("string")))


def _repair_fn(key, pdfs, state):
    pdf = _sorted(pdfs)
    if len(pdf):
        pdf = _repaired(pdf, state)
    yield pdf[PAGE_COLS]


def repair_new_visitor_stream(page: DataFrame) -> DataFrame:
    """T1 on a stream: the state is one flag per device (never expires, as in
    the reference)."""
    ship_package(page.sparkSession)
    return page.withColumn("device", _device(F.col("seq"))).groupBy("device").applyInPandasWithState(
        _repair_fn, PAGE_SCHEMA, "seen string", "append", GroupStateTimeout.NoTimeout)


LINE_SCHEMA = "value string, mid string, is_new string, ts bigint"


def _repair_lines_fn(key, pdfs, state):
    frames = [p for p in pdfs if len(p)]
    if frames:
        pdf = pd.concat(frames, ignore_index=True)
        pdf = pdf.sort_values([c for c in ("ts", "pos") if c in pdf], kind="stable")
        yield _repaired(pdf, state)[["value", "mid", "is_new", "ts"]]


def repair_lines_stream(lines: DataFrame) -> DataFrame:
    """T1 on raw lines (``value``, ``mid``, ``is_new``, ``ts``), for the log split.

    Lines of a batch with equal times are in the order of ``pos``, such as a
    topic's offset, or without that column in the order they arrive in."""
    ship_package(lines.sparkSession)
    return lines.withColumn("device", _device(F.col("value"))).groupBy("device").applyInPandasWithState(
        _repair_lines_fn, LINE_SCHEMA, "seen string", "append", GroupStateTimeout.NoTimeout)


# ------------------------------------------------------------------ S4

class AfterSnapshotProcessor(StatefulProcessor):
    """The version up to which a key's changes are known: at first the one its snapshot row holds."""

    def __init__(self, columns: list[str], version: str):
        self.columns, self.version = columns, version

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", "version bigint")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        if not self.mark.exists() or self.mark.get()[0] < initialState["_mark"]:
            self.mark.update((initialState["_mark"],))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = first = self.mark.get()[0] if self.mark.exists() else None
        for r in sorted(rows, key=lambda r: r[self.version]):
            if mark is None or r[self.version] > mark:
                mark = r[self.version]
                yield Row(*self.columns)(*[r[c] for c in self.columns])
        if mark != first:
            self.mark.update((mark,))

    def close(self) -> None:
        pass


def changes_after_snapshot(changes: DataFrame, marks: DataFrame, key: str = "key", version: str = "version") -> DataFrame:
    """S4 on a stream: the changes that a snapshot does not hold yet.

    ``marks`` (``key`` and ``version``) says up to which version each snapshot
    row goes; it is the state store's initial state.  A change up to its key's
    mark is dropped, and so is one that comes again, since the mark moves on."""
    ship_package(changes.sparkSession)
    known = marks.select(F.col(key).cast(changes.schema[key].dataType).alias(key), F.col(version).cast("bigint").alias("_mark")).filter(
        F.col(key).isNotNull() & F.col("_mark").isNotNull())
    rows = changes.filter(F.col(key).isNotNull() & F.col(version).isNotNull())
    return rows.groupBy(key).transformWithState(AfterSnapshotProcessor(changes.columns, version), changes.schema, "Append", "None",
                                                known.groupBy(key))


# ------------------------------------------------------------------ T2 (+ T5)

class UniqueVisitProcessor(StatefulProcessor):
    """The day of a device's last visit and when to forget it, with a timer of the state store for that moment."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.day = handle.getValueState("day", "day string, until bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = sorted(rows, key=lambda r: (r["ts"], r["seq"]))
        now = rows[0]["_clock_ms"]
        day, until = self.day.get() if self.day.exists() else (None, None)
        found = day if until is None or now < until else None  # expired, though its timer has not fired yet
        visit = False
        for r in rows:
            if not r["last_page_id"]:
                own = (_DAY_ZERO + dt.timedelta(milliseconds=r["ts"])).strftime("%Y-%m-%d")
                if own != found:
                    found, visit = own, True
                    yield Row(*PAGE_COLS)(*[r[c] for c in PAGE_COLS])
        if visit:
            if until is not None:
                self.handle.deleteTimer(until)
            until = now + self.ttl_ms if self.ttl_ms else None
            self.day.update((found, until))
            if until is not None:
                self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.day.exists() and self.day.get()[1] == expiredTimerInfo.getExpiryTimeInMs():
            self.day.clear()
        return iter(())

    def close(self) -> None:
        pass


def unique_visit_stream(page: DataFrame, ttl_ms: int | None = 86_400_000) -> DataFrame:
    """T2 on a stream: keep an entry page whose day differs from the device's
    remembered day.  The day is forgotten ``ttl_ms`` of processing time after it
    was written (T5, the reference's one-day state TTL).

    The clock is the time of the batch, as a column with a watermark, so that
    timers of the state store remove expired days, and a run over what is
    available ends.  (In processing-time mode, which Spark's own TTL needs, it
    starts batch after batch and does not.)  Rows without a device or a time
    are no visits."""
    ship_package(page.sparkSession)
    rows = page.filter(F.col("mid").isNotNull() & F.col("ts").isNotNull()).select(*PAGE_COLS)
    rows = (rows.withColumn("_clock", F.current_timestamp()).withColumn("_clock_ms", F.unix_millis("_clock"))
            .withWatermark("_clock", "0 seconds"))
    return rows.groupBy("mid").transformWithState(UniqueVisitProcessor(ttl_ms), PAGE_SCHEMA, "Append", "EventTime")


# ------------------------------------------------------------------ T3

def user_jump_stream(page: DataFrame, within_ms: int) -> DataFrame:
    """T3 on a stream: the pattern entry page, entry page (``pattern_stream``), with both outputs.

    ``page`` carries a watermark on an event-time column (``with_event_time``)."""
    entry = F.col("last_page_id").isNull()
    return pattern_stream(page, [entry, entry], within_ms).select(*PAGE_COLS, "kind")
