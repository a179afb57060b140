"""The case queue of a live feed as keyed state: messages wait for the watermark, silent channels are closed by timers."""

import json
from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from convocases.operators.messages import drop_untimed
from convocases.operators.segment import Rules, first_match

#: The state store that keyed state with timers needs.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

#: Channels that a key of the state holds are those of a bucket, dealt by hash.
BUCKETS = 4096
#: The channels as JSON: each with the time it is due, the values of CASE_STATE, and its waiting messages; then the timer.
BUCKET_STATE = "channels string, at long"
CASE_STATE = "open case_index start_pos end_pos segment_start start_t end_t end_day ref confidence forced_starting"
_NAMES = CASE_STATE.split()
_CASE = (
    "channel_url string, case_index long, start_pos long, end_pos long, start_t long, end_t long, confidence double, "
    "forced_starting boolean, forced_ending boolean, idle boolean"
)
_HOUR = 3_600_000_000


def opened_by(message: tuple, state: dict | None, rules: Rules) -> float | None:
    """Confidence of the boundary that a message opens after what its channel has had so far; None if it opens none."""
    t, day, _, _, ref, cue = message
    if state is None:
        return 0.9
    both = ref is not None and state["ref"] is not None
    if both and ref != state["ref"]:
        return 0.9
    gap, same = t - state["end_t"], both
    if same:
        return None
    if gap > rules.day_hours * _HOUR:
        return 0.8
    if gap > rules.session_hours * _HOUR:
        return 0.6 if cue or day != state["end_day"] else None
    return 0.5 if cue else None


def _order(message: tuple) -> tuple:
    return tuple(x for v in (message[0], message[2], message[3]) for x in (v is not None, v if v is not None else 0))


class CaseQueue(StatefulProcessor):
    """State of a bucket of channels: of each the messages ahead of the watermark, its open or last case, and when it is due.

    Every call to the state is a message to Spark and an answer, and each key has several in every batch; for a key of one
    channel they took most of the time. So a bucket's channels are one value, read and written once for each batch that
    has rows of any of them or finds the bucket's one timer due.
    """

    def __init__(self, rules: Rules, max_queue_size: int, idle: int | None, forget: int | None):
        self.rules, self.size, self.idle, self.forget = rules, max_queue_size, idle, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", BUCKET_STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = {}
        for r in rows:
            m = json.loads(r.place)
            new.setdefault(r.channel_url, []).append((r.t, m["day"], m.get("ingest_seq"), m.get("message_id"), m.get("ref"), m["cue"]))
        return iter(self._advance(new, timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return iter(self._advance({}, timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()))

    def _advance(self, new: dict, watermark: int, expired: int | None = None) -> list[Row]:
        """Every channel that has new messages or is due; the others stay as they are."""
        channels, timer = self.bucket.get() or ("[]", None)
        kept = {channel: rest for channel, *rest in json.loads(channels)}
        out = []
        for channel in [*new, *(c for c, (at, _, _) in kept.items() if c not in new and at is not None and at < watermark)]:
            _, state, held = kept.get(channel, (None, None, []))
            state = dict(zip(_NAMES, state)) if state else None
            after = self._pass(channel, [*held, *new.get(channel, ())], state, watermark * 1000, out)
            if after:
                kept[channel] = after
            else:
                kept.pop(channel, None)
        at = min((at for at, _, _ in kept.values() if at is not None), default=None)
        if at != timer:
            if timer is not None and timer != expired:  # Spark takes away the one that has expired
                self.handle.deleteTimer(timer)
            if at is not None:
                self.handle.registerTimer(at)
        if kept:
            self.bucket.update((json.dumps([(channel, *rest) for channel, rest in kept.items()]), at))
        else:
            self.bucket.clear()
        return out

    def _pass(self, channel, held: list, state: dict | None, now: int, out: list[Row]) -> tuple | None:
        """All messages the watermark has passed, in time order; then the open case, if it has been silent for long.

        Gives when the channel is due next, its case and what still waits; None if nothing of it is kept.
        """
        for message in sorted((m for m in held if m[0] < now), key=_order):
            if state and state["open"] and self.idle is not None and message[0] - state["end_t"] >= self.idle:
                out.append(self._close(channel, state, idle=True))
            state = self._take(channel, message, state, out)
        later = [m for m in held if m[0] >= now]
        if state and state["open"] and self.idle is not None and state["end_t"] + self.idle < now:
            out.append(self._close(channel, state, idle=True))
        if state and not later and not state["open"] and self.forget is not None and state["end_t"] + self.forget < now:
            return None
        wait = None if state is None else self.idle if state["open"] else self.forget
        times = [m[0] for m in later] + ([state["end_t"] + wait] if wait is not None else [])
        return max(min(times), now) // 1000 if times else None, state and [state[n] for n in _NAMES], later

    def _take(self, channel, message: tuple, state: dict | None, out: list[Row]) -> dict:
        t, day, _, _, ref, _ = message
        confidence = opened_by(message, state, self.rules)
        pos = state["end_pos"] + 1 if state else 1
        silent = state is not None and not state["open"]
        full = state is not None and confidence is None and (silent or (pos - state["segment_start"]) % self.size == 0)
        if state and not full and confidence is None:
            return {**state, "end_pos": pos, "end_t": t, "end_day": day, "ref": ref if ref is not None else state["ref"]}
        if state and state["open"]:
            out.append(self._close(channel, state, forced=full))
        return {
            "open": True, "case_index": state["case_index"] + 1 if state else 0, "start_pos": pos, "end_pos": pos,
            "segment_start": state["segment_start"] if full and not silent else pos, "start_t": t, "end_t": t, "end_day": day,
            "ref": ref if ref is not None or state is None else state["ref"],
            "confidence": state["confidence"] if full else confidence, "forced_starting": full,
        }

    @staticmethod
    def _close(channel, state: dict, forced: bool = False, idle: bool = False) -> Row:
        state["open"] = False
        return Row(
            channel_url=channel, **{n: state[n] for n in ("case_index", "start_pos", "end_pos", "start_t", "end_t", "confidence", "forced_starting")},
            forced_ending=forced, idle=idle)


def _micros(span: str | timedelta | None) -> int | None:
    if span is None or isinstance(span, timedelta):
        return None if span is None else span // timedelta(microseconds=1)
    number, unit = span.split()
    return timedelta(**{unit if unit.endswith("s") else unit + "s": float(number)}) // timedelta(microseconds=1)


def stream_cases(
    messages: DataFrame, rules: Rules = Rules(), max_queue_size: int = 128, late: str = "1 hour",
    idle: str | timedelta | None = "24 hours", forget: str | timedelta | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """Finished cases of a message stream, each once, as soon as the watermark lets them be known.

    A message waits in its channel's state until the watermark (`late` behind the newest message) has passed it, so the
    cases do not depend on the order of arrival or on the batches; what comes later than that is dropped by Spark, as on
    every stream with a watermark. A case is out when the next one opens, when it has `max_queue_size` messages
    (forced_ending), or when its channel has been silent for `idle` (column `idle`); the next message then opens a case
    in any case, with forced_starting where no rule asks for it. After a silence of `forget` nothing of a channel is
    kept, and it starts again at position 1. `idle` and `forget` are like "90 minutes"; None: never.

    State is kept by `buckets` of channels: a batch reads and writes the buckets of channels that it holds messages of, or
    that are due, each once and whole, and no others. More channels to a bucket mean fewer calls to the state store; feeds of
    many millions of channels, of which a batch has few, want more buckets. The number holds for the life of a checkpoint.
    State and shuffle hold a message's time, place, reference and cue, not its text. Messages without a time are dropped;
    a null channel is a channel. The session needs the settings in STATE_STORE.
    """
    place = F.struct(
        F.unix_date(F.to_date("created_time")).alias("day"), "ingest_seq", "message_id",
        first_match(F.col("message"), rules.ref_pattern).alias("ref"),
        F.coalesce(F.col("message").rlike(rules.cue_pattern), F.lit(False)).alias("cue"),
    )
    rows = drop_untimed(messages).withWatermark("created_time", late).select(
        F.pmod(F.xxhash64("channel_url"), F.lit(buckets)).alias("bucket"), "channel_url", "created_time",
        F.unix_micros("created_time").alias("t"), F.to_json(place).alias("place"),
    )
    queue = CaseQueue(rules, max_queue_size, _micros(idle), _micros(forget))
    cases = rows.groupBy("bucket").transformWithState(queue, _CASE, "Append", "EventTime")
    return cases.select(
        "channel_url", "case_index", "start_pos", "end_pos", F.timestamp_micros("start_t").alias("start_time"), F.timestamp_micros("end_t").alias("end_time"),
        (F.col("end_pos") - F.col("start_pos") + 1).alias("n_messages"), "confidence", "forced_starting", "forced_ending", "idle",
    )
