"""State with timers: events folded in order of event time across batches, and watermarks that gaps hold back.

Both need the RocksDB state store (``STORE``), which keeps state on disk and in the
checkpoint rather than in the executors' memory.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pubmill.operators.state import CONCLUDED, evidence_valid

# The setting that these streams need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_ROW = "status string, found long, expected long, print string, attempts long, rejected long, last long"
_EVENT = "valid boolean, status string, found long, expected long, print string"
_DAY_MS = 86_400_000


def _whole(x) -> int | None:
    return None if x is None or pd.isna(x) else int(x)


def _text(x) -> str | None:
    return None if x is None or x is pd.NA or (isinstance(x, float) and x != x) else x


def fold_event(row: tuple, event: tuple) -> tuple:
    """A key's row (status, found, expected, print, attempts, rejected) after one event (valid, status, found, expected, print), by the rules of ``upsert``."""
    status, found, expected, printed, attempts, rejected = row
    valid, now, n, wanted, own = event
    if valid and own == printed:
        return row
    if not valid or (status in CONCLUDED and (wanted or 0) <= (expected or 0)):
        return status, found, expected, printed, attempts, rejected + 1
    return now, n, wanted, own, attempts + 1, rejected


class OrderedUpsert(StatefulProcessor):
    """Holds events until the watermark has passed them, folds them in order, and forgets a key ``keep_days`` after its last event."""

    def __init__(self, keep_days: int):
        self.keep = keep_days * _DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", _ROW)
        self.waiting = handle.getMapState("waiting", "at long, ord long", _EVENT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for frame in rows:
            for e in frame.itertuples(index=False):
                at = int(e.at_ms)
                # the same event again, before or in the batch, is the same entry
                self.waiting.updateValue((at, int(e.ord)), (bool(e.valid), _text(e.status), _whole(e.found), _whole(e.expected), _text(e.print)))
                self.handle.registerTimer(at)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        until = expiredTimerInfo.getExpiryTimeInMs()
        due = sorted((tuple(k), tuple(v)) for k, v in self.waiting.iterator() if k[0] <= until)
        held = self.row.get() if self.row.exists() else None
        row, last = (tuple(held[:6]), held[6]) if held else ((None, None, None, None, 0, 0), None)
        if not due:
            if held and last + self.keep <= until:
                self.row.clear()
            yield pd.DataFrame()
            return
        for (at, ord_), event in due:
            row, last = fold_event(row, event), at
            self.waiting.removeKey((at, ord_))
        self.row.update((*row, last))
        self.handle.registerTimer(last + self.keep)
        status, found, expected, _, attempts, rejected = row
        yield pd.DataFrame({"key": [key[0]], "status": [status], "found": pd.array([found], "Int64"), "expected": pd.array([expected], "Int64"), "attempts": [attempts], "rejected": [rejected]})

    def close(self) -> None:
        pass


def ordered_upsert(events: DataFrame, late: str = "1 day", keep_days: int = 400) -> DataFrame:
    """``upsert`` of a stream (key, ord, at, status, found, origin, reference, error, expected) in order of event time, whatever batch an event comes in.

    A key's row is given when the watermark, ``late`` behind the newest event, has passed its events. An
    event that comes twice counts once; one older than the watermark is dropped.
    """
    valid = evidence_valid(F.col("status"), F.col("found"), F.col("origin"), F.col("reference"), F.col("error"))
    own = F.to_json(F.struct("status", "found", "origin", "reference", "error", "expected"), {"ignoreNullFields": "false"})
    rows = events.withWatermark("at", late).select("key", F.col("ord").cast("long").alias("ord"), "at", F.unix_millis("at").alias("at_ms"), valid.alias("valid"), "status", F.col("found").cast("long").alias("found"), F.col("expected").cast("long").alias("expected"), own.alias("print"))
    out = "key long, status string, found long, expected long, attempts long, rejected long"
    return rows.groupBy("key").transformWithStateInPandas(OrderedUpsert(keep_days), out, "Update", "EventTime")


def next_business_day(day: int) -> int:
    """The next day from Monday to Friday, as days since 1970."""
    day += 1
    while (datetime.date(1970, 1, 1) + datetime.timedelta(day)).weekday() > 4:
        day += 1
    return day


class GapBlock(StatefulProcessor):
    """The last day up to which a source is covered without a gap, and the covered days beyond the first gap."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "day int")
        self.ahead = handle.getMapState("ahead", "day int", "covered boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last = self.last.get()[0] if self.last.exists() else None
        for frame in rows:
            for e in frame.itertuples(index=False):
                if last is None:
                    last = int(e.begin)
                if int(e.day) > last:
                    self.ahead.updateValue((int(e.day),), (True,))
        while self.ahead.containsKey((next_business_day(last),)):
            last = next_business_day(last)
            self.ahead.removeKey((last,))
        # what lies on weekends before the mark holds nothing back
        for (day,), _ in list(self.ahead.iterator()):
            if day <= last:
                self.ahead.removeKey((day,))
        self.last.update((last,))
        blocked = sum(1 for _ in self.ahead.iterator())
        yield pd.DataFrame({"key": [key[0]], "last": pd.array([last], "Int32"), "missing": pd.array([next_business_day(last) if blocked else None], "Int32"), "ahead": [blocked]})

    def close(self) -> None:
        pass


def gap_block(days: DataFrame) -> DataFrame:
    """(key, last, missing, ahead) of a stream (key, begin, day) of covered days, in any order and repeated: the mark goes on from ``begin`` while no business day is missing.

    missing is the day that holds it back where later ones are covered.
    """
    number = lambda c: F.unix_date(c).alias(c)
    out = days.select("key", number("begin"), number("day")).groupBy("key").transformWithStateInPandas(GapBlock(), "key long, last int, missing int, ahead long", "Update", "None")
    return out.select("key", F.date_from_unix_date("last").alias("last"), F.date_from_unix_date("missing").alias("missing"), "ahead")
