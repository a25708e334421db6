"""Keyed state functions. They see one key's rows of one micro-batch at a time."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_TIMES = T.StructType([T.StructField("ms", T.ArrayType(T.LongType(), False))])


def count_arrivals(kept: list[int], arriving: list[int], window_ms: int) -> tuple[list[int], list[int]]:
    """Counts for ``arriving`` times, in that order, given the sorted times ``kept`` so far.

    Each arrival joins the kept times, drops what is older than its own window, and counts
    everything left, also times later than its own. Returns the counts and the times kept.
    """
    kept, counts = list(kept), []
    for t in arriving:
        at = bisect_left(kept, t)
        if at == len(kept) or kept[at] != t:
            kept.insert(at, t)
        del kept[: bisect_left(kept, t - window_ms)]
        counts.append(len(kept))
    return counts, kept


def _nulls_last(value) -> tuple:
    missing = value is None or value != value
    return missing, None if missing else value


class TrailingCounter(StatefulProcessor):
    """Distinct event times per key in the trailing window, in order of arrival.

    Rows hold the key, ``event_ms``, the columns ``order0``, ``order1``, ... that give the order
    (no name may start with an underscore: Spark's worker renames those), and ``row``, which is
    passed through next to the count ``n``. Rows at or below ``threshold`` are not emitted. A call of the state costs more than a row, so a key's times are one value: one
    call reads them and one writes them, however many came.
    """

    def __init__(self, window_ms: int, threshold: int, ttl_ms: int | None, timers: bool):
        self.window_ms, self.threshold = window_ms, threshold
        self.ttl_ms, self.timers = ttl_ms, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getValueState("times", _TIMES, self.ttl_ms)

    def _kept(self) -> list[int]:
        found = self.times.get()
        return [] if found is None else list(found[0])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times, passed, places = [], [], []
        for some in rows:
            order = sorted(name for name in some.columns if name.startswith("order"))
            times += some["event_ms"].tolist()
            passed += some["row"].tolist()
            places += zip(*[map(_nulls_last, some[name].tolist()) for name in order])
        at = sorted(range(len(places)), key=places.__getitem__)
        before = self._kept()
        counts, kept = count_arrivals(before, [times[i] for i in at], self.window_ms)
        if kept != before or self.ttl_ms is not None:  # a write also puts the expiry off
            self.times.update((kept,))
        if self.timers:
            for t in sorted(set(kept) - set(before)):
                self.handle.registerTimer(t + self.window_ms)
        hit = [place for place, n in enumerate(counts) if n > self.threshold]
        if hit:
            yield pd.DataFrame({"row": [passed[at[place]] for place in hit], "n": [counts[place] for place in hit]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """A time's timer removes it and what is older."""
        edge = expiredTimerInfo.getExpiryTimeInMs() - self.window_ms
        before = self._kept()
        kept = before[bisect_right(before, edge) :]
        if kept:
            if kept != before:
                self.times.update((kept,))
        elif before:
            self.times.clear()
        yield from ()

    def close(self) -> None:
        pass
