"""Requests in batches of a number or an age, and exact progress, with keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from nucleispark.operators.batches import deal

_WAITING = "event_id long, ts timestamp, tile_col long, tile_row long"
_BATCHED = "slide_id long, batch long, place int, event_id long, ts timestamp, tile_col long, tile_row long"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_NAMES = ["event_id", "ts", "tile_col", "tile_row"]


def _cut(ts: pd.Series, size: int, latency: pd.Timedelta, first: pd.Timestamp | None = None, n: int = 0) -> tuple[list[int], pd.Timestamp | None, int]:
    """For times in order, how many batches were begun up to each since the one that was open (first, n); and what is open then."""
    out, begun = [], 0
    for t in ts:
        if first is None or n >= size or t >= first + latency:
            begun, first, n = begun + 1, t, 0
        n += 1
        out.append(begun)
    return out, first, n


def batched_requests(requests: DataFrame, size: int = 32, latency: str = "1 second") -> DataFrame:
    """Requests with their slide's batch, from 1 on, and place in it: a batch goes when it has `size` requests, or `latency` after its first.

    A bounded table replayed in order of time and event_id. Slides are streams sorted within partitions; only the open batch's
    first time and number are carried, so a slide may have any number of requests. Requests without a time are left out.
    """
    wait = pd.Timedelta(latency)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slide, first, n, number = object(), None, 0, 0
        for pdf in batches:
            for key, part in pdf.groupby("slide_id", sort=False, dropna=False):
                if key != slide and not (pd.isna(key) and pd.isna(slide)):
                    slide, first, n, number = key, None, 0, 0
                before = n
                begun, first, n = _cut(part["ts"], size, wait, first, n)
                steps = pd.Series(begun, index=part.index)
                place = part.groupby(steps).cumcount() + 1
                place[steps == 0] += before
                yield part.assign(batch=steps + number, place=place)[["slide_id", "batch", "place", *_NAMES]]
                number += begun[-1]

    own = requests.filter("ts is not null").selectExpr("slide_id", "event_id", "ts", "cast(tile_col as long) as tile_col", "cast(tile_row as long) as tile_row")
    return deal(own, "slide_id").sortWithinPartitions("slide_id", "ts", "event_id").mapInPandas(run, _BATCHED)


class _Batcher(StatefulProcessor):
    """A slide's open batch as list state; a timer lets it go."""

    def __init__(self, size: int, latency: str, event_time: bool):
        self.size, self.latency, self.event_time = size, pd.Timedelta(latency), event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING)
        self.number = handle.getValueState("number", "n long")

    def _open(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.waiting.get()), columns=_NAMES)

    def _emit(self, key: tuple, rows: pd.DataFrame, number: int) -> pd.DataFrame:
        out = rows[_NAMES].astype({"event_id": "int64", "tile_col": "int64", "tile_row": "int64"})
        return out.assign(slide_id=key[0], batch=number, place=range(1, len(out) + 1))[["slide_id", "batch", "place", *_NAMES]]

    def _drop_timers(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)

    def _keep(self, rows: pd.DataFrame, timers) -> None:
        """What waits on, with a timer for when its first request is too old."""
        self._drop_timers()
        if not len(rows):
            self.waiting.clear()
            return
        self.waiting.put([(int(e), pd.Timestamp(t).to_pydatetime(), int(c), int(r)) for e, t, c, r in rows[_NAMES].itertuples(index=False)])
        begin = pd.Timestamp(rows["ts"].iloc[0]).value / 1e6 if self.event_time else timers.getCurrentProcessingTimeInMs()
        self.handle.registerTimer(ceil(begin + self.latency.total_seconds() * 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [p for p in rows if len(p)]
        held = self._open()
        since = min(self.handle.listTimers(), default=None)
        every = pd.concat([held, pd.concat(parts)[_NAMES].sort_values(["ts", "event_id"])] if len(held) else [pd.concat(parts)[_NAMES].sort_values(["ts", "event_id"])], ignore_index=True)
        wait = self.latency if self.event_time else pd.Timedelta(days=36500)  # by the clock, ages are the timers' affair
        begun, _, _ = _cut(every["ts"], self.size, wait)
        number = self.number.get()[0] if self.number.exists() else 0
        groups = [g for _, g in every.groupby(begun, sort=True)]
        last = groups[-1]
        done, rest = (groups, last.iloc[:0]) if len(last) >= self.size else (groups[:-1], last)
        for g in done:
            number += 1
            yield self._emit(key, g, number)
        self.number.update((number,))
        if not self.event_time and since is not None and not done and len(rest):  # the first request has waited since its own arrival
            self.waiting.put([(int(e), pd.Timestamp(t).to_pydatetime(), int(c), int(r)) for e, t, c, r in rest[_NAMES].itertuples(index=False)])
        else:
            self._keep(rest, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._open()
        if len(held):
            number = (self.number.get()[0] if self.number.exists() else 0) + 1
            self.number.update((number,))
            self.waiting.clear()
            yield self._emit(key, held, number)

    def close(self) -> None:
        pass


def stream_batches(requests: DataFrame, size: int = 32, latency: str = "1 second", event_time: bool = False, watermark: str = "0 seconds") -> DataFrame:
    """The same over a stream: a slide's requests wait in keyed state and go as a batch when there are `size` of them or when the first has
    waited for `latency`, by the clock or, with event_time, by the requests' own times and the watermark. Append mode."""
    _with_rocks(requests)
    rows = requests.withWatermark("ts", watermark) if event_time else requests
    return rows.groupBy("slide_id").transformWithStateInPandas(_Batcher(size, latency, event_time), _BATCHED, "Append", "EventTime" if event_time else "ProcessingTime")


def _with_rocks(rows: DataFrame) -> None:
    """Keyed state of several kinds needs this state store, for the session's streams that begin from now on."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)


class _Progress(StatefulProcessor):
    """A slide's requested tiles as map state."""

    def __init__(self, tiles: int, forget: str | None):
        self.tiles, self.forget = tiles, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        age = None if self.forget is None else int(pd.Timedelta(self.forget).total_seconds() * 1000)
        self.done = handle.getMapState("done", "tile_col long, tile_row long", "n long", ttlDurationMs=age)
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0] if self.count.exists() else 0
        for part in rows:
            for tile in part[["tile_col", "tile_row"]].dropna().drop_duplicates().astype("int64").itertuples(index=False, name=None):
                if not self.done.containsKey(tile):
                    self.done.updateValue(tile, (1,))
                    n += 1
        self.count.update((n,))
        yield pd.DataFrame({"slide_id": [key[0]], "finished": [n], "share": [min(1.0, n / self.tiles)]})

    def close(self) -> None:
        pass


def exact_progress(requests: DataFrame, tiles_per_slide: int, forget: str | None = None) -> DataFrame:
    """(slide_id, finished, share) of a stream, each time that a slide has requests; exact, with one entry of state for each tile of an
    open slide. forget: a time by the clock after which a tile's entry goes; it counts once more if it is asked for after that, and the stream has a
    clock to watch, so it doesn't end by itself. Update mode."""
    _with_rocks(requests)
    return requests.groupBy("slide_id").transformWithStateInPandas(_Progress(tiles_per_slide, forget), "slide_id long, finished long, share double", "Update", "None" if forget is None else "ProcessingTime")
