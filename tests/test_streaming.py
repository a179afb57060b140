"""Streams give what the batch operators give on ordered input."""

import random
import time

import pytest
from pyspark.sql import functions as F

from checks import streams
from convocases.operators.cases import cases_of_segments
from convocases.operators.segment import Rules, force_boundaries, segment_by_rules
from convocases.sources.scratch import new_path
from convocases.streaming import live, queue, slices

MINUTES = [0, 5, 9, 400, 405, 3000, 3001, 3002, 3003, 3004, 3005, 9000, 9100]


def feed(spark, df, cuts):
    """One file per slice of the ingest order, written one after the other."""
    path = new_path(spark, "feed")
    for low, high in zip(cuts, cuts[1:]):
        df.where(f"ingest_seq >= {low} and ingest_seq < {high}").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(spark, stream):
    path = new_path(spark, "out")
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", new_path(spark, "progress"))
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def test_queue_over_several_batches(spark, chat):
    texts = ["order #1", "x", "order #2", "x", "signup", "x", "x", "x", "x", "x", "x", "order #2", "y"]
    messages = chat(sorted([(ch, m, t) for ch in ("a", "b") for m, t in zip(MINUTES, texts)], key=lambda r: r[1]))
    rules = Rules(cue_pattern="^signup$")
    folder = new_path(spark, "queue")
    writer = live.stream_sliding_queue(feed(spark, messages, [0, 3, 8, 9, 20, 26]), folder, rules, 4)
    writer.option("checkpointLocation", new_path(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    got = live.finished_cases(spark, folder).collect()
    batch = cases_of_segments(force_boundaries(segment_by_rules(messages, rules=rules), 4)).collect()
    last = {}
    for r in batch:
        last[r.channel_url] = max(last.get(r.channel_url, 0), r.case_index)

    def key(r):
        return (r.channel_url, r.case_index, r.start_pos, r.end_pos, r.start_time, r.end_time, r.n_messages, r.confidence, r.forced_starting, r.forced_ending)
    assert sorted(map(key, got)) == sorted(key(r) for r in batch if r.case_index < last[r.channel_url])
    assert any(r.forced_ending for r in got) and len(got) >= 8


def test_a_hot_channel_in_one_batch(spark, chat):
    """The open case carries over, and the result does not depend on how the batch is cut into blocks."""
    messages = chat([("hot", m * 3 + i * 0.01, t) for i, (m, t) in enumerate((m, t) for m in range(30) for t in ("x", "order #%d" % (m // 4)))])
    rules = Rules(cue_pattern="^signup$")
    first = live.advance_cases(spark.createDataFrame([], live.OPEN_CASE), messages.where("ingest_seq < 17"), rules, 4)
    still_open = first.where("open").select(*(part.split()[0] for part in live.OPEN_CASE.split(", ")))
    def after(**options):
        cases = live.advance_cases(still_open, messages.where("ingest_seq >= 17"), rules, 4, **options)
        return sorted(map(tuple, cases.select(sorted(cases.columns)).collect()))
    assert after() == after(rows_per_block=5) and len(after()) > 8
    batch = cases_of_segments(force_boundaries(segment_by_rules(messages, rules=rules), 4))
    whole = sorted(map(tuple, batch.select("case_index", "start_pos", "end_pos", "confidence", "forced_starting", "forced_ending").collect()))
    parts = first.where("not open").unionByName(live.advance_cases(still_open, messages.where("ingest_seq >= 17"), rules, 4))
    assert sorted(map(tuple, parts.select("case_index", "start_pos", "end_pos", "confidence", "forced_starting", "forced_ending").collect())) == whole


def test_sessions(spark, chat):
    rows = [(ch, m, "x") for ch in ("a", "b") for m in MINUTES] + [("ahead", 600_000, "x")]
    messages = chat(rows)
    streamed = drain(spark, live.stream_sessions(feed(spark, messages, [0, len(rows)]))).collect()
    batch = live.sessions(messages).where("channel_url <> 'ahead'").collect()
    assert sorted(map(tuple, streamed)) == sorted(map(tuple, batch)) and len(batch) == 8


@pytest.fixture
def keyed(spark):
    before = {k: spark.conf.get(k, None) for k in queue.STATE_STORE}
    for k, v in queue.STATE_STORE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v else spark.conf.unset(k)


class Feed:
    """Micro-batches of two files each, read with one checkpoint, so that every run goes on where the last one ended."""

    def __init__(self, spark, **options):
        self.spark, self.options = spark, options
        self.path, self.out, self.progress = (new_path(spark, n) for n in ("feed", "out", "progress"))
        self.seen = []

    def run(self, *batches):
        for df in batches:
            df.repartition(2, "message_id").write.mode("append").parquet(self.path)
            time.sleep(1.1)
        stream = self.spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 2).parquet(self.path)
        cases = queue.stream_cases(stream, **self.options)
        q = cases.writeStream.format("parquet").option("path", self.out).option("checkpointLocation", self.progress)
        q = q.trigger(availableNow=True).start()
        q.awaitTermination()
        self.seen += [p for p in q.recentProgress if p.stateOperators]
        return sorted(map(tuple, self.spark.read.schema(cases.schema).parquet(self.out).drop("idle").collect()), key=lambda c: (c[0] or "", *c[1:]))


def batch_cases(messages, rules, size):
    cases = cases_of_segments(force_boundaries(segment_by_rules(messages, rules=rules), size))
    return sorted(map(tuple, cases.select("channel_url", "case_index", "start_pos", "end_pos", "start_time", "end_time", "n_messages", "confidence",
                                          "forced_starting", "forced_ending").where("channel_url <> 'ahead'").collect()))


RULES = Rules(cue_pattern="^signup$")
TEXTS = ["order #1", "x", "order #2", "x", "signup", "x", "x", "x", "x", "x", "x", "order #2", "y"]


def test_keyed_queue_does_not_depend_on_arrival(keyed, chat):
    """Messages out of order within the lateness, files and batches cut anyhow, one restart: what the table gives."""
    r = random.Random(4)
    rows = [(ch, m + i * 0.01, t) for i, ch in enumerate("abcd") for m, t in zip(MINUTES, TEXTS)] + [("ahead", 600_000, "x")]
    messages = chat(sorted(rows, key=lambda x: x[1]))
    want = batch_cases(messages, RULES, 4)
    feed = Feed(keyed, rules=RULES, max_queue_size=4, late="200 hours", idle="100 days")
    order = list(range(len(rows) - 1))
    r.shuffle(order)
    parts = [messages.where(F.col("ingest_seq").isin(order[i::3])) for i in range(3)]
    first = feed.run(parts[0], parts[1])
    assert first == []  # all may still change
    assert feed.run(parts[2], messages.where("channel_url = 'ahead'")) == want and len(want) >= 20


def test_keyed_queue_drops_late_messages_and_closes_silent_channels(keyed, chat):
    rows = [("a", 0, "x"), ("a", 5, "x"), ("b", 10, "x"), ("tick", 2_000, "x"), ("a", 7, "late"), ("tick", 2_001, "x"), ("a", 2_100, "x"),
            ("tick", 9_000, "x"), ("a", 9_100, "x"), ("tick", 20_000, "x"), ("tick", 20_001, "x")]
    messages = chat(rows)
    feed = Feed(keyed, rules=RULES, late="1 minute", idle="10 hours", forget="40 hours")
    cut = [messages.where(f"ingest_seq >= {low} and ingest_seq < {high}") for low, high in ((0, 4), (4, 6), (6, 8), (8, 9), (9, 11))]
    got = [[c[:4] for c in feed.run(part) if c[0] != "tick"] for part in cut]
    assert got[0] == [("a", 0, 1, 2), ("b", 0, 1, 1)]  # silent for ten hours
    assert got[1] == got[0]  # the late message is gone
    assert got[2] == [*got[1][:1], ("a", 1, 3, 3), got[1][1]]
    assert got[4] == sorted([*got[2], ("a", 0, 1, 1)])  # forgotten after 40 hours: from the start again


def test_keyed_queue_touches_only_its_channels(keyed, chat):
    many = [(f"c{i}", i * 0.01, "x") for i in range(300)]
    messages = chat([*many, *[("c7", 10 + i, "order #%d" % i) for i in range(20)]])
    feed = Feed(keyed, rules=RULES, late="1 minute", idle=None)
    feed.run(messages.where("ingest_seq < 300"))
    feed.seen.clear()
    feed.run(messages.where("ingest_seq >= 300"))
    updated = [sum(s["numRowsUpdated"] for s in p.stateOperators) for p in feed.seen]
    assert max(updated) < 330 and updated[0] < 60  # the first batch holds one channel; then the watermark wakes the others once
    feed.seen.clear()
    feed.run(messages.where("ingest_seq = 319").withColumns({"message_id": F.lit("z"), "created_time": F.expr("created_time + interval 1 hour")}))
    assert all(sum(s["numRowsUpdated"] for s in p.stateOperators) < 60 for p in feed.seen)


def test_keyed_queue_touches_the_state_by_bucket(keyed, chat):
    """A batch updates no more of the state than buckets, however many channels it holds; cases do not depend on the dealing."""
    rows = [(f"c{i}", m + i * 0.001, t) for i in range(40) for m, t in zip(MINUTES, TEXTS)] + [(None, 3, "x"), (None, 4000, "x")]
    messages = chat(sorted(rows, key=lambda r: r[1]) + [("ahead", 600_000, "x")])
    got = []
    for options in ({}, {"buckets": 3}):
        feed = Feed(keyed, rules=RULES, max_queue_size=4, late="1 hour", idle="100 days", **options)
        feed.run(messages.where("ingest_seq < 200"))
        got.append(feed.run(messages.where("ingest_seq >= 200")))
    assert got[0] == got[1] and [c[1:4] for c in got[1] if c[0] is None] == [(0, 1, 1), (1, 2, 2)]
    assert [c for c in got[1] if c[0]] == batch_cases(messages.where("channel_url is not null"), RULES, 4)
    assert max(sum(s["numRowsUpdated"] for s in p.stateOperators) for p in feed.seen) <= 3


def test_keyed_queue_forced_cuts_and_nothing_to_read(keyed, chat):
    messages = chat([("hot", i, "x") for i in range(50)] + [(None, 3, "x"), ("ahead", 600_000, "x")])
    feed = Feed(keyed, rules=RULES, max_queue_size=8, late="1 hour", idle="1 day")
    want = batch_cases(messages, RULES, 8)
    got = feed.run(messages.where("false"), messages)
    assert sorted(c for c in got if c[0]) == want and sum(c[9] for c in got) == 6
    assert [c[1:4] for c in got if c[0] is None] == [(0, 1, 1)]


def test_sessions_in_slices(keyed, chat):
    """A channel with most of the feed, sessions over many slices, out of order within the lateness, several batches."""
    r = random.Random(9)
    minutes = sorted(r.choice([r.uniform(0, 3_000), r.uniform(5_000, 5_100), 240 * r.randint(0, 30)]) for _ in range(400))
    rows = [("hot", m, "x") for m in minutes] + [(ch, m, "x") for ch in ("a", "b") for m in MINUTES] + [("ahead", 600_000, "x")]
    messages = chat(rows)
    timed = messages.where("channel_url <> 'ahead'")
    parts = [timed.where(f"pmod(hash(message_id), 3) = {i}") for i in range(3)] + [messages.where("channel_url = 'ahead'")]
    path = new_path(keyed, "feed")
    for part in parts:
        part.repartition(2, "message_id").write.mode("append").parquet(path)
        time.sleep(1.1)
    stream = keyed.readStream.schema(messages.schema).option("maxFilesPerTrigger", 2).parquet(path)
    got = drain(keyed, slices.stream_sessions_in_slices(stream, late="10 days", slice_minutes=45)).collect()
    want = live.sessions(timed).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 8
    with pytest.raises(ValueError):
        slices.stream_sessions_in_slices(stream, gap_hours=0.5)


def test_a_large_feed_of_sessions_is_many_files(spark, monkeypatch):
    """A task that reads a file groups its rows, so files hold a bounded number of rows; all still come in one batch."""
    asked, feed_of = [], streams.as_stream

    def seen(spark, df, files=1, per_batch=1):
        asked.append((files, per_batch))
        return feed_of(spark, df, files, per_batch)

    monkeypatch.setattr(streams, "as_stream", seen)
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 300, raising=False)
    rows = streams.stream_sessions(spark, "/root/testdata/sf0.001")
    assert asked == [(4, 4)]  # 1,000 events
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, streams.sessions(spark, "/root/testdata/sf0.001").select(*rows.columns).collect()))
