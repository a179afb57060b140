"""Splits and the review loop."""

import json

import pytest

from convocases.operators import review

BOUNDS = "channel_url string, case_index long, start_pos long, end_pos long, summary string, confidence double"
REPLIES = "request_id string, channel_url string, case_index long, content string, error string"


def reply(spark, *rows):
    full = []
    for channel, index, needs, points, confidence in rows:
        content = json.dumps({"needs_split": needs, "confidence": confidence, "reasoning": "r", "suggested_split_points": points})
        full.append((f"{channel}:{index}", channel, index, content, None))
    return spark.createDataFrame(full, REPLIES)


def ranges(df):
    return [(r.channel_url, r.case_index, r.start_pos, r.end_pos) for r in df.orderBy("channel_url", "case_index", "start_pos").collect()]


def test_split_before_and_after(spark):
    cases = spark.createDataFrame([("a", 0, 1, 10, "long talk", 0.9)], BOUNDS)
    reviews = review.read_reviews(reply(spark, ("a", 0, True, [4, 7, 7, 99, 0, -1], 0.6)))
    before = review.apply_splits(cases, reviews).orderBy("piece").collect()
    assert [(r.start_pos, r.end_pos) for r in before] == [(1, 3), (4, 6), (7, 10)]
    assert before[1].summary == "Reviewed case split 2 from original case 0: long talk..." and before[1].confidence == 0.6
    after = review.apply_splits(cases, reviews, "after").orderBy("piece").collect()
    assert [(r.start_pos, r.end_pos) for r in after] == [(1, 4), (5, 7), (8, 10)]
    with pytest.raises(ValueError):
        review.apply_splits(cases, reviews, "inside")


def test_point_one_rewrites_only_the_text(spark):
    cases = spark.createDataFrame([("a", 3, 5, 8, "s", 0.9)], BOUNDS)
    row = review.apply_splits(cases, review.read_reviews(reply(spark, ("a", 3, True, [1], 0.95)))).collect()
    assert [(r.start_pos, r.end_pos, r.summary, r.confidence) for r in row] == [(5, 8, "Reviewed case split 1 from original case 3: s...", 0.9)]


def test_parts_of_a_long_case_are_put_together(spark):
    one = json.dumps({"needs_split": False, "confidence": 0.9, "reasoning": "r0", "suggested_split_points": [3]})
    two = json.dumps({"needs_split": True, "confidence": 0.7, "reasoning": "r1", "suggested_split_points": [8]})
    replies = spark.createDataFrame([("a:0:0", "a", 0, one, None), ("a:0:1", "a", 0, two, None), ("b", "b", 0, None, "timeout")], REPLIES)
    row, = review.read_reviews(replies).collect()
    assert (row.needs_split, row.review_confidence, row.reasoning, row.points) == (True, 0.7, "r0", [8])


def test_loop_stops_per_channel(spark):
    cases = spark.createDataFrame([("a", 0, 1, 8, "s", 0.9), ("b", 0, 1, 4, "s", 0.9), ("c", 0, 1, 4, "s", 0.9), ("c", 1, 5, 6, "t", 0.9)], BOUNDS)
    asked = []

    def ask(open_cases, round_no):
        asked.append(ranges(open_cases))
        if round_no == 0:
            return reply(spark, ("a", 0, True, [5], 0.8), ("b", 0, False, [], 0.8), ("c", 0, True, [], 0.8), ("c", 1, False, [], 0.8))
        if round_no == 1:
            return reply(spark, ("a", 0, False, [], 0.8), ("a", 1, True, [2], 0.8), ("c", 0, False, [], 0.8))
        return reply(spark, ("a", 2, True, [2], 0.8))

    done, counters = review.review_loop(cases, ask)
    assert asked == [
        [("a", 0, 1, 8), ("b", 0, 1, 4), ("c", 0, 1, 4), ("c", 1, 5, 6)],
        [("a", 0, 1, 4), ("a", 1, 5, 8), ("c", 0, 1, 4), ("c", 1, 5, 6)],
        [("a", 0, 1, 4), ("a", 1, 5, 5), ("a", 2, 6, 8)],
    ]
    assert ranges(done) == [
        ("a", 0, 1, 4), ("a", 1, 5, 5), ("a", 2, 6, 6), ("a", 3, 7, 8), ("b", 0, 1, 4), ("c", 0, 1, 4), ("c", 1, 5, 6)]
    got = {r.channel_url: (r.review_iterations, r.cases_reviewed, r.cases_split) for r in counters.collect()}
    assert got == {"a": (3, 4, 3), "b": (0, 0, 0), "c": (1, 2, 1)}
