"""State that changes when time passes, whether rows come or not: give-ups, leases and time limits with timers.

Each key's state has a timer for what comes next; the engine wakes it when the stream's time is past. mode says whose time
that is: "EventTime", the times in the rows less their allowed lateness (a replay gives the same result), or
"ProcessingTime", the clock, which goes on while nothing arrives. State is cleared when nothing can come any more.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.state import GIVE_UP_HOURS

#: Timers need the state store that can be read by prefix.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
HOUR, MINUTE, DAY = 3_600_000, 60_000, 86_400_000

DOMAIN = "domain string, ever_succeeded boolean, first_failure_at timestamp, consecutive_403_count int, given_up boolean, given_up_at timestamp, changed_at timestamp"
REQUEST = "id long, status string, reason string, changed_at timestamp"


def stamp(ms: int) -> pd.Timestamp:
    return pd.NaT if ms < 0 else pd.Timestamp(ms, unit="ms")


def in_order(batches: Iterator[pd.DataFrame]) -> list[tuple[int, pd.DataFrame]]:
    """The rows of a key by their times in milliseconds."""
    rows = pd.concat(list(batches), ignore_index=True)
    rows = rows.assign(at=rows["at"].astype("datetime64[ms]").astype("int64"))
    return [(int(at), part) for at, part in rows.groupby("at", sort=True)]


class GiveUps(StatefulProcessor):
    """Fetches (domain, ok, http_status, at): a domain that has never succeeded is given up so many hours after its first
    failure, at that very time, even if nobody asks for it any more. A success is remembered for ever."""

    def __init__(self, mode: str, hours: float = GIVE_UP_HOURS):
        self.mode, self.wait = mode, int(hours * HOUR)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("domain", "ever boolean, first long, refused int, given long")

    def row(self, key, state, at: int) -> pd.DataFrame:
        ever, first, refused, given = state
        return pd.DataFrame({"domain": [key[0]], "ever_succeeded": [ever], "first_failure_at": [stamp(first)], "consecutive_403_count": [refused], "given_up": [given >= 0], "given_up_at": [stamp(given)], "changed_at": [stamp(at)]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ever, first, refused, given = self.state.get() or (False, -1, 0, -1)
        for at, part in in_order(rows):
            now = at if self.mode == "EventTime" else timerValues.getCurrentProcessingTimeInMs()
            if not ever and given < 0 <= first and now >= first + self.wait:  # its time came before these rows
                given = first + self.wait
                yield self.row(key, (ever, first, refused, given), given)
            if part["ok"].any():
                ever, refused = True, 0
            else:
                refused += int((part["http_status"] == 403).sum())
                if first < 0:
                    first = now
                    if not ever:
                        self.handle.registerTimer(first + self.wait)
        if ever and first >= 0 and given < 0:
            self.handle.deleteTimer(first + self.wait)
        self.state.update((ever, first, refused, given))
        yield self.row(key, (ever, first, refused, given), at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ever, first, refused, given = self.state.get()
        if not ever and given < 0:
            given = expiredTimerInfo.getExpiryTimeInMs()
            self.state.update((ever, first, refused, given))
            yield self.row(key, (ever, first, refused, given), given)

    def close(self) -> None:
        pass


class Requests(StatefulProcessor):
    """What happens to requests (id, event, at), event one of found, claimed, finished. A claimed one that isn't finished
    within its lease is pending again; one that is pending when its time limit has passed fails. A finished one is
    forgotten; what comes for it later is as for one never seen."""

    def __init__(self, mode: str, lease_ms: int = 10 * MINUTE, limit_ms: int = 14 * DAY):
        self.mode, self.lease, self.limit = mode, lease_ms, limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("request", "status string, found long, claimed long")

    def forget(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.state.clear()

    def out(self, key, status: str, reason: str | None, at: int) -> pd.DataFrame:
        return pd.DataFrame({"id": [key[0]], "status": [status], "reason": [reason], "changed_at": [stamp(at)]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for at, part in in_order(rows):
            now = at if self.mode == "EventTime" else timerValues.getCurrentProcessingTimeInMs()
            for event in sorted(part["event"], key=("found", "claimed", "finished").index):
                yield from self.due(key, now)  # what its time came for before this event
                status, found, claimed = self.state.get() or (None, -1, -1)
                if event == "finished":
                    if status:
                        self.forget()
                    yield self.out(key, "done", None, now)
                    continue
                if found < 0:
                    found, status = now, "pending"
                    self.handle.registerTimer(found + self.limit)
                if event == "claimed":
                    status, claimed = "processing", now
                    self.handle.registerTimer(claimed + self.lease)
                self.state.update((status, found, claimed))
                yield self.out(key, status, None, now)

    def due(self, key, now: int) -> Iterator[pd.DataFrame]:
        """What time alone has changed until now: an older lease's timer says nothing of the present one."""
        if not self.state.exists():
            return
        status, found, claimed = self.state.get()
        since = found
        if status == "processing" and now >= claimed + self.lease:
            status, since = "pending", claimed + self.lease
            self.state.update((status, found, claimed))
            yield self.out(key, status, "lease_lost", since)
        if status == "pending" and now >= found + self.limit:
            self.forget()
            yield self.out(key, "failed", "stale_ttl_exceeded", max(since, found + self.limit))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.due(key, expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass


def timed(stream: DataFrame, key: str, processor: StatefulProcessor, schema: str, late: str) -> DataFrame:
    stream.sparkSession.conf.set(*next(iter(STORE.items())))
    rows = stream.withWatermark("at", late) if processor.mode == "EventTime" else stream
    return rows.groupBy(key).transformWithStateInPandas(processor, schema, "Update", processor.mode)


def give_ups(fetches: DataFrame, mode: str = "EventTime", late: str = "0 seconds", hours: float = GIVE_UP_HOURS) -> DataFrame:
    """The state of a domain each time it changes: by its fetches, or by time alone."""
    return timed(fetches.select("domain", "ok", "http_status", "at"), "domain", GiveUps(mode, hours), DOMAIN, late)


def requests(events: DataFrame, mode: str = "EventTime", late: str = "0 seconds", lease_ms: int = 10 * MINUTE, limit_ms: int = 14 * DAY) -> DataFrame:
    """The status of a request each time it changes: by an event, a lost lease or its time limit."""
    return timed(events.select("id", "event", "at"), "id", Requests(mode, lease_ms, limit_ms), REQUEST, late)
