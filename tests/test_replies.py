"""Replies: where the JSON is, what is accepted, what falls back."""

import json

from pyspark.sql import functions as F

from convocases.operators import classify, replies as r
from convocases.operators.taxonomy import taxonomy_table


def case(start=1, end=2, summary="s", confidence=0.5, **more):
    return dict(start_message=start, end_message=end, summary=summary, confidence=confidence, **more)


def body(*cases):
    return json.dumps({"complete_cases": list(cases), "analysis": "x"})


def table(spark, contents):
    rows = [(f"r{i}", f"c{i}", 0, 1, 5, 5, i, c) for i, c in enumerate(contents)]
    return spark.createDataFrame(
        rows, "request_id string, channel_url string, part int, first_pos long, last_pos long, channel_messages long, "
        "channel_seq long, content string",
    )


def branches(spark, fn, contents):
    out = table(spark, contents).withColumns(fn(F.col("content"))).orderBy("channel_seq").collect()
    return [(x.branch, x.json) for x in out]


def test_extract_json(spark):
    good = body(case())
    got = branches(spark, r.extract_json, [
        good, f"a <OUTPUT>\n{good}\n</OUTPUT> b", f"x ```json\n{good}\n``` y", f"x ```\n{good}\n```", f"pre {good} post",
        "no json at all", "", None, "[1, 2]", "5", f"one {{}} brace {good} and }} more", body(case(summary="a } b { c")),
    ])
    assert [b for b, _ in got] == [
        "whole", "tag", "fence", "fence", "braces", None, None, None, None, None, "object", "whole",
    ]
    assert all(json.loads(j) for b, j in got if b and b != "object")


def test_many_objects_do_not_overflow(spark):
    """Thousands of flat objects in a broken reply are scanned without deep recursion."""
    broken = "{" + ",".join('{"a": 1}' for _ in range(20_000))
    (branch, found), = branches(spark, r.extract_json, [broken])
    assert branch == "object" and found == '{"a": 1}'


def test_extract_json_classification(spark):
    got = branches(spark, r.extract_json_classification, [
        'a <output> {"x": {"y": 1}} </output> {"z": 2}', 'bad {x} then {"z": 2} then {"zz": 33}', "none",
        '<output>{broken}</output> {"z": 2}',
    ])
    assert got == [("tag", '{"x": {"y": 1}}'), ("object", '{"z": 2}'), (None, None), ("tag", "{broken}")]


def test_validate_segmentation(spark):
    missing = {k: v for k, v in case().items() if k != "summary"}
    contents = [body(case()), body(), body(case(), missing), '{"complete_cases": {"a": 1}}', '{"other": []}', "nothing", body(case(summary=None))]
    out = r.validate_segmentation(table(spark, contents)).orderBy("channel_seq").collect()
    assert [x.reason for x in out] == [None, None, "missing_key", "no_case_list", "no_case_list", "no_json", None]


def test_wrong_types_reject_only_that_boundary(spark):
    content = body(case(1, 2), case("3", 4), case(3.5, 4), case(5, 5, confidence="high"), case(4, 9), case(0, 2), case(3, 2), case(5, 5, confidence=1))
    rows = r.mark_ranges(r.explode_cases(r.validate_segmentation(table(spark, [content])))).orderBy("case_index").collect()
    assert [x.reject_reason for x in rows] == [None, "bad_type", "bad_type", "bad_type", "out_of_range", "out_of_range", "out_of_range", None]
    assert rows[-1].confidence == 1.0


def test_empty_list_means_no_case_and_bad_reply_means_fallback(spark):
    requests = table(spark, [None] * 5).drop("content")
    replies = spark.createDataFrame(
        [("r0", body(), None), ("r1", "junk", None), ("r2", None, "timeout"), ("r3", body(case(1, 5)), None), ("r3", None, "late copy")],
        "request_id string, content string, error string",
    )
    rows = r.boundaries_of_replies(requests, replies).orderBy("channel_url").collect()
    assert [(x.channel_url, x.start_pos, x.end_pos, x.confidence) for x in rows] == [
        ("c1", 1, 5, 0.1), ("c2", 1, 5, 0.1), ("c3", 1, 5, 0.5), ("c4", 1, 5, 0.3)]


def test_validate_review(spark):
    base = {"needs_split": True, "confidence": 0.5, "reasoning": "x"}
    contents = [
        base, {**base, "suggested_split_points": [2, 3.5, "4"]}, {**base, "needs_split": "yes"}, {**base, "confidence": "0.5"},
        {**base, "reasoning": 3}, {**base, "suggested_split_points": 3}, {"needs_split": True}, {**base, "confidence": 1},
    ]
    out = r.validate_review(table(spark, [json.dumps(c) for c in contents])).orderBy("channel_seq").collect()
    assert [x.reason for x in out] == [None, None, "bad_needs_split", "bad_confidence", "bad_reasoning", "bad_points", "missing_key", None]
    assert out[0].points == [] and out[1].points == [2]


def test_validate_classification(spark):
    base = {"primary_category": "Tax and Fee", "secondary_category": "Form 1099", "confidence": 0.5, "reasoning": "x"}
    contents = [
        base, {**base, "confidence": 1.7}, {**base, "confidence": "0.25"}, {**base, "confidence": "much"},
        {**base, "primary_category": "Weather"}, {**base, "secondary_category": "Login"}, {**base, "primary_category": ["Order"]},
        {k: v for k, v in base.items() if k != "reasoning"}, {**base, "confidence": -3},
    ]
    texts = [json.dumps(c) for c in contents] + ["no", "<output>{broken}</output>"]
    out = classify.validate_classification(table(spark, texts), taxonomy_table(spark)).orderBy("channel_seq").collect()
    assert [x.reason for x in out] == [
        None, None, None, "bad_confidence", "bad_primary", "bad_secondary", "bad_primary", "missing_key", None, "no_json", "bad_json"]
    assert [x.confidence for x in out[:3]] == [0.5, 1.0, 0.25] and out[8].confidence == 0.0
    assert out[0].category == "Tax and Fee_Form_1099" and out[4].category is None


def test_taxonomy_is_complete(spark):
    names = taxonomy_table(spark)
    assert (names.count(), names.select("primary").distinct().count()) == (89, 9)
    last = names.groupBy("primary").agg(F.max_by("secondary", "leaf_no").alias("s")).select("s").distinct().collect()
    assert [x.s for x in last] == ["Other"]
