"""Running alerts per key: state that follows counts in event time and expires by itself."""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakeops.streaming.windows import with_watermark

EPOCH = datetime.datetime(1970, 1, 1)


class _Sweep(StatefulProcessor):
    """Follows the sum of the counts of the last ``span`` milliseconds of one key.

    State per key: the counts that are still within the span, by the end of their time window,
    and whether the alert is raised. A timer is set for the moment the oldest count leaves; when
    nothing is left the key has no state.
    """

    def __init__(self, span: int, threshold: int, keys: Sequence[str]):
        self.span, self.threshold = span, threshold
        self.row = Row(*keys, "time", "hits", "raised")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "end long", "n long")
        self.raised = handle.getValueState("raised", "raised boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fresh: dict[int, int] = {}
        for row in rows:
            fresh[row.end] = fresh.get(row.end, 0) + row.n
        yield from self._advance(key, fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, {}, timerValues.getCurrentWatermarkInMs())

    def _advance(self, key, fresh: dict[int, int], until: int) -> Iterator[Row]:
        """Changes of the alert up to the watermark, which no count still to come precedes."""
        held = {end[0]: n[0] for end, n in self.counts.iterator()} if self.counts.exists() else {}
        raised = bool(self.raised.get()[0]) if self.raised.exists() else False
        steps = dict(fresh)
        for end, n in [*held.items(), *fresh.items()]:
            if end + self.span <= until:
                steps[end + self.span] = steps.get(end + self.span, 0) - n
        total = sum(held.values())
        for at in sorted(steps):
            total += steps[at]
            if (total >= self.threshold) != raised:
                raised = not raised
                time = EPOCH + datetime.timedelta(milliseconds=at)
                yield self.row(*key, time, total, raised)
        for end in held:
            if end + self.span <= until:
                self.counts.removeKey((end,))
        for end, n in fresh.items():
            if end + self.span > until:
                self.counts.updateValue((end,), (n,))
        left = [end for end in [*held, *fresh] if end + self.span > until]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if left:
            self.raised.update((raised,))
            self.handle.registerTimer(min(left) + self.span)
        else:
            self.raised.clear()

    def close(self) -> None:
        pass


def running_alerts(
    events: DataFrame,
    keys: Sequence[str],
    time: str,
    hit: Column,
    step: str,
    span: str,
    threshold: int,
    delay: str,
) -> DataFrame:
    """Moments at which a key's hits within ``span`` reach ``threshold`` (raised) or fall below it.

    Hits are rows that meet ``hit``, counted in time windows of ``step`` (which should divide
    ``span``) and known at the window's end. Columns: the keys, ``time``, ``hits`` (within the span
    at that time) and ``raised``. A stream, in ``append`` mode; a moment comes out once the
    watermark, ``delay`` behind the latest time, has passed it, so the result depends neither on the
    order of rows nor on micro-batches. Later rows are left out, as are hits without a time. A null
    key is a key.

    Counting is a built-in aggregate, combined before it is shuffled: of a key held by a third of all rows
    one row per time window reaches the stateful operator. Its state holds the counts of one span,
    in the state store, and is dropped by a timer when the last of them leaves. Needs the RocksDB state
    store. Results come out in UTC.
    """
    timed = with_watermark(events.where(hit), time, delay)
    counts = timed.groupBy(F.window(time, step).alias("window"), *keys).agg(F.count("*").alias("n"))
    ended = counts.select(*keys, F.window_time("window").alias("closed"), (F.unix_millis(F.col("window.end"))).alias("end"), "n")
    out = ended.select(*keys).schema.add("time", "timestamp_ntz").add("hits", "long").add("raised", "boolean")
    milliseconds = events.sparkSession.range(1).select(F.expr(f"cast(cast(interval {span} AS interval second) AS long) * 1000"))
    return ended.groupBy(*keys).transformWithState(
        _Sweep(milliseconds.first()[0], threshold, keys), out, "Append", "EventTime"
    )
