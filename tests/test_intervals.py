"""Disjoint intervals of overlapping ranges against a loop over all positions."""

import random

from convocases.operators import blocks, cases, intervals

SCHEMA = "channel_url string, start_pos long, end_pos long, v long"


def by_hand(ranges):
    best = {}
    for channel, start, end, v in ranges:
        for p in range(start, end + 1):
            best[channel, p] = max(v, best.get((channel, p), v))
    return best


def positions(found):
    out = {}
    for r in found:
        for p in range(r.start_pos, r.end_pos + 1):
            assert (r.channel_url, p) not in out
            out[r.channel_url, p] = r.v
    return out


def test_random_ranges(spark, monkeypatch):
    r = random.Random(6)
    ranges, v = [], 0
    for channel in ["flat", None, "a", "b", "c", "nested"]:
        for i in range(60):
            v += 1
            start = 1 + 20 * i if channel == "flat" else i + 1 if channel == "nested" else r.randint(1, 400)
            end = start + 9 if channel == "flat" else 200 - i if channel == "nested" else start + r.choice([0, 1, 5, 60, 300])
            ranges.append((channel, start, end, r.randint(1, 50) if channel == "c" else v))
    df = spark.createDataFrame(ranges, SCHEMA)
    want = by_hand(ranges)
    assert positions(intervals.disjoint(df, "v").collect()) == want
    for low in (1, 3):
        monkeypatch.setattr(intervals, "LOW", low)
        assert positions(intervals.disjoint(df, "v").collect()) == want
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", 16)
    assert positions(intervals.disjoint(df, "v").collect()) == want


def test_nested_ranges_make_a_row_for_each_message(spark):
    """300 ranges over 600 messages, each inside the one before: 600 rows meet their interval, not 90,000."""
    k, n = 300, 600
    ranges = spark.createDataFrame([("a", 1 + i, n - i, i) for i in range(k)], SCHEMA)
    places = spark.range(1, n + 1).selectExpr("'a' as channel_url", "id as pos")
    found = intervals.disjoint(ranges, "v")
    assert found.count() == 2 * k - 1
    rows = cases.cases_to_messages_range(found, places)
    assert rows.count() == n and {(r.pos, r.v) for r in rows.collect()} == {(p, min(p - 1, n - p)) for p in range(1, n + 1)}


def test_no_ranges(spark):
    assert intervals.disjoint(spark.createDataFrame([], SCHEMA), "v").collect() == []
    empty = spark.createDataFrame([("a", 5, 4, 1), ("a", 2, 3, 2)], SCHEMA)
    assert [tuple(r) for r in intervals.disjoint(empty, "v").collect()] == [("a", 2, 3, 2)]


def test_nothing_that_grows_is_broadcast(spark):
    """Nested ranges compress to almost nothing, so a plan by the size of their files would send all of them to the driver."""
    nested = spark.range(1, 3001).selectExpr("'a' as channel_url", "id as start_pos", "6001 - id as end_pos", "id as v")
    found = intervals.disjoint(cases.checkpointed(nested), "v")
    rows = cases.cases_to_messages_range(found, cases.checkpointed(spark.range(1, 6001).selectExpr("'a' as channel_url", "id as pos")))
    last = blocks.join_spread(rows, cases.checkpointed(nested.selectExpr("v", "start_pos as w")), ["v"], hot=[])
    assert last.count() == 6000 and last.where("w <> least(pos, 6001 - pos)").count() == 0
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
