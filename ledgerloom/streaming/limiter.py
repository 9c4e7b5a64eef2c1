"""Sliding-window limiter: at most so many accepted requests of a client within a window; over a table, and over a stream."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def take(recent: deque, t: int, window: int, most: int) -> bool:
    """Whether a request at ``t`` passes; ``recent`` holds the accepted times of the window, ``most`` at most."""
    while recent and t - recent[0] >= window:
        recent.popleft()
    if len(recent) < most:
        recent.append(t)
        return True
    return False


def accepted(requests: DataFrame, window_seconds: float = 60, most: int = 5) -> DataFrame:
    """``requests`` (event_id, client, ts and others) with ``accepted``; a rejected request does not count against later ones.

    Whether a request passes depends on those that passed before it, so a client's requests are taken in the order of time and event_id. They come
    to a task sorted, a batch at a time, and only the last accepted times are remembered: no client is held whole. A null time is rejected and counts for nothing.
    """
    window = int(window_seconds * 1_000_000)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, recent = object(), deque()
        for frame in frames:
            out = []
            for c, t in zip(frame["client"], frame["_t"], strict=True):
                if c != client and not (c is None and client is None):
                    client, recent = c, deque()
                out.append(t == t and t is not None and take(recent, int(t), window, most))
            yield frame.drop(columns="_t").assign(accepted=out)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
    ordered = requests.withColumn("_t", F.unix_micros("ts")).repartition("client").sortWithinPartitions("client", "ts", "event_id")
    return ordered.mapInPandas(run, f"{fields}, accepted boolean")


class Window(StatefulProcessor):
    """A client's requests wait until the watermark has passed them, and are then taken in the order of time and event_id.

    The state is what waits, and the last accepted times, ``most`` at most.
    """

    def __init__(self, window: int, most: int):
        self.window, self.most = window, most

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t long, event_id long")
        self.recent = handle.getListState("recent", "t long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            new = [(int(t), int(e)) for t, e in zip(frame["t"], frame["event_id"], strict=True)]
            if new:
                self.waiting.appendList(new)
                first = min([x[0] for x in new] + ([first] if first is not None else []))
        if first is not None:
            self.handle.registerTimer(-(-first // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(tuple(x) for x in self.waiting.get())
        due = [x for x in waiting if x[0] <= now]
        left = waiting[len(due) :]
        recent = deque(x[0] for x in self.recent.get())
        out = [(key[0], e, t, take(recent, t, self.window, self.most)) for t, e in due]
        for state, rows in ((self.waiting, left), (self.recent, [(t,) for t in recent])):
            state.put(rows) if rows else state.clear()
        if left:
            self.handle.registerTimer(-(-left[0][0] // 1000))
        if out:
            yield pd.DataFrame(out, columns=["client", "event_id", "t", "accepted"])

    def close(self) -> None:
        pass


def accepted_stream(requests: DataFrame, window_seconds: float = 60, most: int = 5, late: str = "10 minutes") -> DataFrame:
    """(client, event_id, ts, accepted) of a stream of (event_id, client, ts): as over a table, whatever the order in which rows come, but for rows later than ``late``, which go.

    A decision comes when the watermark has passed its request. The session's state store must be RocksDB.
    """
    rows = requests.where("ts is not null").withWatermark("ts", late).select("client", "event_id", "ts", F.unix_micros("ts").alias("t"))
    out = rows.groupBy("client").transformWithStateInPandas(Window(int(window_seconds * 1_000_000), most), "client string, event_id long, t long, accepted boolean", outputMode="Append", timeMode="EventTime")
    return out.select("client", "event_id", F.timestamp_micros("t").alias("ts"), "accepted")
