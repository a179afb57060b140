"""Sessions on streams in two steps: time slices counted where they arrive, then neighbouring slices merged."""

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from convocases.operators.messages import drop_untimed

_SESSION = "channel_url string, start_t long, end_t long, n_messages long"
_HOUR = 3_600_000_000


class SliceMerger(StatefulProcessor):
    """State of a channel: its open session, which a later slice prolongs if it begins within the gap."""

    def __init__(self, gap: int, slice_length: int):
        self.gap, self.slice = gap, slice_length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "start_t long, end_t long, n_messages long, timer long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = tuple(self.open.get()) if self.open.exists() else None
        out = []
        for r in sorted(rows, key=lambda r: r.start_t):
            if held and r.start_t - held[1] <= self.gap:
                held = (held[0], max(held[1], r.end_t), held[2] + r.n_messages, held[3])
                continue
            if held:
                out.append(self._session(key, held))
            held = (r.start_t, r.end_t, r.n_messages, held[3] if held else None)
        # By then every slice that could still prolong the session has come.
        due = (held[1] + self.gap + self.slice) // 1000 + 1
        if held[3] is not None:
            self.handle.deleteTimer(held[3])
        self.handle.registerTimer(due)
        self.open.update((*held[:3], due))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = tuple(self.open.get())
        self.open.clear()
        return iter([self._session(key, held)])

    @staticmethod
    def _session(key, held: tuple) -> Row:
        return Row(channel_url=key[0], start_t=held[0], end_t=held[1], n_messages=held[2])


def stream_sessions_in_slices(messages: DataFrame, gap_hours: float = 4, late: str = "1 day", slice_minutes: int = 60) -> DataFrame:
    """Sessions per channel on a stream, for channels of any size; the same as `live.sessions` gives on a table.

    Messages of a slice no longer than the gap are of one session. So a slice is one row (first, last, number), which
    every task counts for itself before anything moves: a channel that holds half of the feed is as many tasks as it was
    read by, and what meets by channel is one row for each slice. Neighbouring slices are then merged in keyed state. A
    session is out once the watermark is a gap and a slice behind its end. Messages without a time are dropped; later
    ones than the watermark are dropped by Spark. The session needs the settings in `queue.STATE_STORE`.
    """
    gap = int(gap_hours * _HOUR)
    if slice_minutes * _HOUR // 60 > gap:
        raise ValueError("a slice must not be longer than the gap")
    timed = drop_untimed(messages).withWatermark("created_time", late)
    t = F.unix_micros("created_time")
    slices = timed.groupBy("channel_url", F.window("created_time", f"{slice_minutes} minutes").alias("_w")).agg(
        F.min(t).alias("start_t"), F.max(t).alias("end_t"), F.count(F.lit(1)).alias("n_messages"),
    ).select("channel_url", F.window_time("_w").alias("created_time"), "start_t", "end_t", "n_messages")
    merged = slices.groupBy("channel_url").transformWithState(SliceMerger(gap, slice_minutes * _HOUR // 60), _SESSION, "Append", "EventTime")
    return merged.select(
        "channel_url", F.timestamp_micros("start_t").alias("start_time"), F.timestamp_micros("end_t").alias("end_time"), "n_messages")
