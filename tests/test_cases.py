"""Boundaries, cases and labels on messages; rules; invariants."""

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from convocases.sources.scratch import checkpointed
from convocases.operators import cases as c, context, segment
from convocases.operators.messages import message_cuts, message_positions
from convocases.operators.replies import valid_ranges
from convocases.plans import pipeline

BOUNDS = "channel_url string, case_index long, start_pos long, end_pos long, summary string, confidence double, channel_seq long"


def bounds(spark, *rows):
    return spark.createDataFrame([(ch, i, s, e, f"sum {ch}{i}", conf, 0 if ch == "a" else 100) for ch, i, s, e, conf in rows], BOUNDS)


def labels(df):
    return {(r.channel_url, r.message_id): r.case_number for r in df.collect()}


def test_last_case_wins_and_gaps_stay_empty(spark, chat):
    messages = chat([("a", i, "x") for i in range(6)])
    done = pipeline.segment_with_boundaries(messages, bounds(spark, ("a", 0, 1, 3, 0.9), ("a", 1, 3, 4, 0.4)), message_positions(messages))
    assert labels(done.messages) == {
        ("a", "m0"): "CASE_0001", ("a", "m1"): "CASE_0001", ("a", "m2"): "CASE_0002", ("a", "m3"): "CASE_0002",
        ("a", "m4"): "", ("a", "m5"): ""}
    gap = done.messages.where("case_number = ''").first()
    assert (gap.case_summary, gap.case_confidence, gap.case_start_time, gap.case_forced_ending) == ("", 0.0, None, False)
    assert [r.n_messages for r in done.cases.orderBy("case_number").collect()] == [3, 2]


def test_repeated_ids_count_per_channel(spark, chat):
    messages = chat([("a", 0, "x", "u", "id"), ("a", 1, "x", "u", "other"), ("a", 2, "x", "u", "id"), ("b", 0, "x", "u", "id")])
    given = bounds(spark, ("a", 0, 1, 1, 0.9), ("a", 1, 2, 3, 0.9), ("b", 0, 1, 1, 0.9))
    done = pipeline.segment_with_boundaries(messages, given, message_positions(messages))
    rows = sorted((r.channel_url, r.ingest_seq, r.case_number) for r in done.messages.collect())
    assert rows == [("a", 0, "CASE_0002"), ("a", 1, "CASE_0002"), ("a", 2, "CASE_0002"), ("b", 3, "CASE_0003")]


def test_one_giant_case(spark):
    """A case beyond one piece of positions reaches every message and no other."""
    n = c.PIECE * 2 + 5_000
    positioned = spark.range(1, n + 101).selectExpr("'a' as channel_url", "id as pos")
    ranges = spark.createDataFrame([("a", 0, 101, n)], "channel_url string, case_index long, start_pos long, end_pos long")
    got = c.cases_to_messages_range(ranges, positioned).agg(F.count("*"), F.count_distinct("pos"), F.min("pos"), F.max("pos")).first()
    assert tuple(got) == (n - 100, n - 100, 101, n)


def test_numbers_are_dense_in_ingest_order(spark, chat):
    rows = [(f"ch{9 - k}", i * 600, "x") for k in range(10) for i in range(4)]
    cases = pipeline.segment_with_rules(chat(rows)).cases
    numbered = sorted((r.case_number, r.channel_url, r.case_index) for r in cases.collect())
    assert [n for n, _, _ in numbered] == [f"CASE_{i:04d}" for i in range(1, len(numbered) + 1)]
    assert [ch for _, ch, _ in numbered] == sorted((ch for _, ch, _ in numbered), reverse=True)


CHAT = [
    ("a", 0, "hello about order #11"), ("a", 10, "any news on order #11?"), ("a", 20, "and order #12"), ("a", 3000, "order #12 again"),
    ("a", 3010, "by the way, thanks"), ("a", 3020, "Separately, my account"), ("a", 3020 + 240, "ok"), ("a", 3020 + 481, "quiet"),
    ("a", 9000, "long after"), ("b", 100, "hi"), ("b", 100 + 300, "same day, no cue"), ("b", 1500, "next day"),
]


def test_rules(spark, chat):
    rows = segment.segment_by_rules(chat(CHAT)).orderBy("channel_url", "pos").collect()
    assert [r.rule for r in rows] == [1, None, 2, None, 5, 5, None, None, 3, 1, None, 4]
    assert [r.case_index for r in rows] == [0, 0, 1, 1, 2, 3, 3, 3, 4, 0, 0, 1]


def test_a_gap_of_exactly_the_limit_stays_together(spark, chat):
    rows = segment.time_gaps(chat([("a", 0, "x"), ("a", 240, "x"), ("a", 480.001, "x"), ("a", 480.001 + 1440, "x")])).orderBy("created_time").collect()
    assert [r.gap_class for r in rows] == ["first", "session", "same_day_range", "same_day_range"]


@pytest.mark.parametrize("rows_per_block", [1, 2, 3])
def test_rules_do_not_depend_on_blocks(spark, chat, rows_per_block):
    messages = chat(CHAT + [("a", 9001 + i, "more") for i in range(20)])
    cuts = message_cuts(messages, rows_per_block)
    assert cuts.rows
    plain = pipeline.segment_with_rules(messages, max_queue_size=3)
    cut = pipeline.segment_with_rules(messages.repartition(7), max_queue_size=3, cuts=cuts)
    for a, b in ((plain.messages, cut.messages), (plain.cases, cut.cases)):
        columns = a.columns
        assert sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def test_forced_cuts(spark, chat):
    done = pipeline.segment_with_rules(chat([("a", i, "x") for i in range(7)] + [("a", 5000, "x")]), max_queue_size=3)
    rows = done.cases.orderBy("case_index").collect()
    assert [(r.n_messages, r.forced_starting, r.forced_ending, r.confidence) for r in rows] == [
        (3, False, True, 0.9), (3, True, True, 0.9), (1, True, False, 0.9), (1, False, False, 0.8)]
    assert done.messages.where("case_number = ''").count() == 0


def test_rule_cases_cover_every_timed_message_once(spark, chat):
    done = pipeline.segment_with_rules(chat(CHAT))
    assert done.messages.count() == len(CHAT) and done.messages.where("case_number = ''").count() == 0
    assert done.cases.agg(F.sum("n_messages")).first()[0] == len(CHAT)


def test_budget_and_context(spark, chat):
    messages = chat([("a", i, "x" * 40) for i in range(10)] + [("b", 0, "x" * 40)])
    kept = context.fit_token_budget(messages, max_context=45, reserve=10)
    assert sorted((r.channel_url, r.pos, r.case_truncated) for r in kept.collect()) == [("a", 1, True), ("a", 2, True), ("a", 3, True), ("b", 1, False)]
    parts = context.sink_and_recent(messages, 2, 5).where("channel_url = 'a'").orderBy("pos").collect()
    assert [(r.pos, r.context_part) for r in parts] == [(1, "sink"), (2, "sink"), (8, "recent"), (9, "recent"), (10, "recent")]


@pytest.mark.parametrize("size, overlap", [(4, 0), (4, 1), (5, 4), (20, 3)])
def test_overlap_windows(spark, chat, size, overlap):
    rows = context.overlap_windows(chat([("a", i, "x") for i in range(10)]), size, overlap).collect()
    chunks = {}
    for r in rows:
        chunks.setdefault(r.chunk, []).append(r.pos)
    expected, start = {}, 1
    while True:
        expected[len(expected)] = list(range(start, min(start + size, 11)))
        if start + size > 10:
            break
        start += size - overlap
    assert {k: sorted(v) for k, v in chunks.items()} == expected


def test_case_head_counts_the_rest(spark, chat):
    labelled = chat([(ch, i, f"t{i}") for ch in ("a", "b") for i in range(13)]).withColumn("case_number", F.col("channel_url"))
    head = c.case_head(labelled)
    assert head.count() == 20 and {r.remaining for r in head.collect()} == {3}
    assert "WindowGroupLimit" in head._jdf.queryExecution().toString()


def test_compare_segmentations_with_no_cuts(spark):
    whole = spark.createDataFrame([("a", 1, 9, 0.5)], "channel_url string, start_pos long, end_pos long, confidence double")
    halves = spark.createDataFrame([("a", 1, 4, 0.5), ("a", 5, 9, 1.0)], whole.schema)
    row = segment.compare_segmentations(halves, whole).first()
    assert (row.cases_a, row.cases_b, row.cuts_a, row.cuts_b, row.cuts_both, row.precision, row.recall) == (2, 1, 1, 0, 0, None, 0.0)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    ids=st.lists(st.sampled_from(["i1", "i2", "i3", "i4", "i5", "i6", "i7", "i8"]), min_size=1, max_size=12),
    ranges=st.lists(st.tuples(st.integers(-1, 13), st.integers(0, 14)), max_size=5),
)
def test_assignment_equals_brute_force(spark, chat, ids, ranges):
    """Overlapping, invalid and repeated ranges over messages with repeated ids."""
    messages = chat([("a", i, "x", f"u{i % 3}", mid) for i, mid in enumerate(ids)])
    proposed = bounds(spark, *[("a", k, s, e, 0.5) for k, (s, e) in enumerate(ranges)]) if ranges else spark.createDataFrame([], BOUNDS)
    valid = valid_ranges(proposed.withColumn("channel_messages", F.lit(len(ids))))
    done = pipeline.segment_with_boundaries(messages, valid, message_positions(messages))
    expected, n = {}, 0
    for s, e in ranges:
        if 1 <= s <= e <= len(ids):
            n += 1
            for mid in ids[s - 1:e]:
                expected[mid] = f"CASE_{n:04d}"
    got = sorted((r.ingest_seq, r.case_number) for r in done.messages.collect())
    assert got == [(i, expected.get(mid, "")) for i, mid in enumerate(ids)]
    assert done.cases.count() == n


def test_small_ranges_are_few(spark, monkeypatch):
    """Each range is a task and a file of its own: small ones stay few, and the numbers are the same."""
    written = []
    monkeypatch.setattr(c, "checkpointed", lambda df: written.append(checkpointed(df)) or written[-1])
    monkeypatch.setattr(c, "SMALL_RANGES", 5)
    rows = spark.range(3000).selectExpr("id as channel_seq", "'c' || id as channel_url", "0L as case_index")
    numbered = c.number_cases(rows, rows_per_block=3)
    assert len(written[0].inputFiles()) <= 5
    assert numbered.where("cast(substring(case_number, 6) as int) <> channel_seq + 1").count() == 0
    monkeypatch.setattr(c, "CASES_PER_BLOCK", 100)  # as many ranges as full ones ask for
    c.number_cases(rows, rows_per_block=3)
    assert written[1].select("_range").distinct().count() == 30


def test_cases_move_once_to_be_built_and_numbered(spark, chat, monkeypatch):
    """A task hands on one row for each of its cases, and ranges of the order are numbered where they are sorted."""
    messages = chat([("a", i, "x", f"u{i % 3}") for i in range(6)] + [("b", 1, "x", None)])
    rows = messages.selectExpr("*", "0L as case_index", "ingest_seq + 1 as pos")
    built = c.build_cases(rows, {"last": (F.max, "message_id")})
    assert len(re.findall(r"Exchange hashpartitioning\(", plan(built))) == 1
    found = {r.channel_url: (r.start_pos, r.end_pos, r.n_messages, r.participants, r.last) for r in built.collect()}
    assert found == {"a": (1, 6, 6, ["u0", "u1", "u2"], "m5"), "b": (7, 7, 1, [], "m6")}
    wide = spark.range(300).selectExpr("id % 7 as channel_seq", "'c' || id % 7 as channel_url", "id div 7 as case_index")
    numbered = c.number_cases(wide, rows_per_block=40)
    assert "Window" not in plan(numbered).split("BroadcastExchange")[0]
    got = [(r.channel_seq, r.case_index) for r in numbered.orderBy("case_number").collect()]
    assert got == sorted((i % 7, i // 7) for i in range(300))
    assert [r.case_number for r in c.number_cases(wide).orderBy("channel_seq", "case_index").collect()] == [f"CASE_{i:04d}" for i in range(1, 301)]


def test_labels_of_segments_are_merged(spark, chat):
    """The table of cases grows with the messages, so it is not broadcast to them."""
    done = pipeline.segment_with_rules(chat([("a", 0, "x"), ("a", 9999, "y")]))
    assert "SortMergeJoin" in plan(done.messages) and "BroadcastHashJoin" not in plan(done.messages)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows_per_block", [3, 10**6])
def test_disjoint_ranges_meet_their_messages_in_order(spark, monkeypatch, rows_per_block):
    """The same cases as by the join, gaps, borders of blocks and ranges without messages included, in one exchange."""
    positioned = checkpointed(spark.range(120).selectExpr(
        "'c' || id div 60 as channel_url", "id % 60 + 1 as pos", "timestamp_seconds(id * 60) as created_time", "'u' || id % 3 as sender_id"))
    bounds = [("c0", 0, 1, 1), ("c0", 1, 2, 30), ("c0", 2, 33, 60), ("c1", 0, 5, 64), ("c1", 1, 70, 80), ("c1", 2, 90, 85), ("none", 0, 1, 9)]
    bounds = checkpointed(spark.createDataFrame(
        [(*b, 7, f"s{i}" if i else None, 0.5 + i / 10, i == 2) for i, b in enumerate(bounds)],
        "channel_url string, case_index long, start_pos long, end_pos long, channel_seq long, summary string, confidence double, forced_ending boolean"))
    apart = c.cases_in_order
    monkeypatch.setattr(c, "cases_in_order", lambda *given: apart(*given, rows_per_block))
    scanned = c.cases_of_boundaries(bounds, positioned)
    if rows_per_block > 120:
        assert scanned._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    monkeypatch.setattr(c.intervals, "reached_over", lambda ranges: ranges)
    joined = c.cases_of_boundaries(bounds, positioned)
    assert scanned.columns == joined.columns and scanned.count() == 4
    assert sorted(map(str, scanned.collect())) == sorted(map(str, joined.collect()))
