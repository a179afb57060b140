"""Requests, the model seam, and whole runs."""

import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from convocases.operators import replies, stats
from convocases.operators.messages import message_cuts
from convocases.operators.taxonomy import taxonomy_table
from convocases.plans import pipeline, requests


def test_parts_keep_every_message(spark, chat):
    messages = chat([("a", i, "y" * 100) for i in range(30)] + [("b", 0, "z")])
    rows = requests.segmentation_requests(messages, budget=200)
    parts = rows.where("channel_url = 'a'").orderBy("part").collect()
    assert len(parts) > 3 and parts[0].first_pos == 1 and parts[-1].last_pos == 30
    assert all(x.last_pos + 1 == y.first_pos for x, y in zip(parts, parts[1:]))
    assert sum(p.prompt.count("<message id=") for p in parts) == 30
    one, = rows.where("channel_url = 'b'").collect()
    assert (one.part, one.request_id, one.channel_messages) == (0, "segment:b:0", 1)
    cut = requests.segmentation_requests(messages, budget=200, overflow="truncate").orderBy("channel_url").collect()
    assert [(r.channel_url, r.part, r.case_truncated) for r in cut] == [("a", 0, True), ("b", 0, False)]
    blocked = requests.segmentation_requests(messages, message_cuts(messages, 4), budget=200)
    assert sorted(r.prompt for r in blocked.collect()) == sorted(r.prompt for r in rows.collect())


def ask(spark, n=6):
    return spark.range(n).selectExpr("'r' || id as request_id", "'p' || id as prompt")


def test_a_failed_call_is_a_row(spark):
    def fn(batch):
        if (batch["request_id"] == "r3").any():
            raise RuntimeError("no line")
        return pd.DataFrame({"request_id": batch["request_id"], "content": batch["prompt"].str.upper(), "input_tokens": 7})

    rows = {r.request_id: r for r in requests.map_requests(ask(spark).repartition(6, "request_id"), fn, 6).collect()}
    assert len(rows) == 6 and rows["r3"].error == "RuntimeError: no line" and rows["r3"].content is None
    good = [r for r in rows.values() if r.error is None]
    assert good and all(r.content == r.request_id.upper().replace("R", "P") and r.input_tokens == 7 for r in good)


def test_retry_takes_the_first_good_reply(spark):
    def fails(batch):
        raise ValueError("down")

    def half(batch):
        out = pd.DataFrame({"request_id": batch["request_id"], "content": "half"})
        return out[out["request_id"].isin(["r0", "r1"])]

    def full(batch):
        return pd.DataFrame({"request_id": batch["request_id"], "content": "full"})

    none = spark.createDataFrame([("r5", "given", None)], "request_id string, content string, error string").selectExpr(
        "request_id", "content", "cast(null as bigint) as input_tokens", "cast(null as bigint) as output_tokens",
        "'m' as model", "'p' as provider", "0.0D as seconds", "error")
    rows = {r.request_id: r.content for r in requests.retry_failed_requests(ask(spark), none, [fails, half, full]).collect()}
    assert rows == {"r0": "half", "r1": "half", "r2": "full", "r3": "full", "r4": "full", "r5": "given"}
    stuck = requests.retry_failed_requests(ask(spark), none, [fails]).where("error is not null")
    assert stuck.count() == 5


RAW = [
    ("c1", "1", 0, "2024-01-01T10:00:00Z", "u1", "", "MESG", "My refund status?"),
    ("c1", "2", 1, "2024-01-01T10:05:00Z", "psops1", "", "MESG", "We look into it"),
    ("c1", "3", 2, "2024-01-03T10:00:00Z", "u1", "", "MESG", "hello again"),
    ("c2", "4", 3, "bad time", "u2", "", "MESG", "lost"),
    ("c2", "5", 4, "2024-01-01T10:00:00Z", "u2", "", "MESG", "tracking invalid"),
    ("", "6", 5, "2024-01-01T10:00:00Z", "u2", "", "MESG", "no channel"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        RAW, "channel_url string, message_id string, ingest_seq long, created_time string, sender_id string, "
        "sender_type string, type string, message string")


def test_run_without_a_model(raw):
    run = pipeline.run_pipeline(raw)
    rows = {r.message_id: r for r in run.messages.collect()}
    assert {k: r.case_number for k, r in rows.items()} == {"1": "CASE_0001", "2": "CASE_0001", "3": "CASE_0002", "4": "", "5": "CASE_0003"}
    assert rows["1"].category == "Order_Refund_Status" and rows["1"].classification_confidence == 0.667
    assert rows["5"].category == "Shipment_Tracking_Invalid" and rows["3"].category == "Other_Other"
    assert rows["4"].category == "" and rows["4"].case_summary == ""
    summary = stats.pipeline_summary(raw, run.messages).first()
    assert (summary.input_rows, summary.output_rows, summary.unique_cases, summary.classified_cases, summary.coverage) == (6, 5, 3, 3, 1.0)
    legacy = stats.pipeline_summary(raw, run.messages, legacy_counts=True).first()
    assert (legacy.unique_cases, legacy.unique_categories, legacy.coverage) == (4, 4, 0.75)


def test_other_columns_come_through(raw, spark):
    wide = raw.withColumns({"round 1": F.concat(F.lit("r"), "message_id"), "review": F.lit("5")})
    none = spark.createDataFrame([], "request_id string, content string, error string")
    by_rules = pipeline.run_pipeline(wide).messages
    by_reply = pipeline.run_pipeline(wide, segmentation_replies=none, skip_classify=True).messages
    assert by_rules.drop("classification_confidence", "classification_reasoning", "classified_at").columns == by_reply.columns
    assert {r.message_id: (r["round 1"], r.review) for r in by_rules.collect()} == {i: (f"r{i}", "5") for i in "12345"}
    assert {r.message_id: (r.case_confidence, r.case_number) for r in by_reply.collect()} == {
        "1": (0.3, "CASE_0001"), "2": (0.3, "CASE_0001"), "3": (0.3, "CASE_0001"), "4": (0.0, ""), "5": (0.3, "CASE_0002")}


def test_skipped_stages(raw):
    with pytest.raises(ValueError):
        pipeline.run_pipeline(raw, skip_clean=True, skip_segment=True, skip_classify=True)
    only_clean = pipeline.run_pipeline(raw, skip_segment=True, skip_classify=True)
    row = only_clean.messages.first()
    assert (row.case_number, row.category, only_clean.cases) == ("", "", None)
    given = only_clean.messages.withColumn("case_number", F.lit("CASE_0007"))
    again = pipeline.run_pipeline(given, skip_clean=True, skip_segment=True)
    assert {r.category for r in again.messages.collect()} == {"Order_Refund_Status"}  # a tie: first by name


def test_result_does_not_depend_on_partitions(raw):
    def rows(df):
        run = pipeline.run_pipeline(df, classified_at=F.lit("2024-01-01").cast("timestamp"))
        return sorted(map(str, run.messages.collect()))
    assert rows(raw) == rows(raw.repartition(6))


def test_classification_request_text(raw, spark):
    run = pipeline.run_pipeline(raw, skip_classify=True)
    text = {r.case_number: r.prompt for r in requests.classification_requests(run.messages, taxonomy_table(spark)).collect()}
    assert set(text) == {"CASE_0001", "CASE_0002", "CASE_0003"}
    assert "**Message 2** [customer_service] (psops1) (2024-01-01 10:05:00): We look into it" in text["CASE_0001"]
    assert "**Tax and Fee:**\n  - Sales Fee" in text["CASE_0001"] and "Duration: 5.0 minutes" in text["CASE_0001"]


def test_empty_input_gives_null_safe_statistics(spark, raw):
    cases = pipeline.segment_with_rules(pipeline.drop_untimed(pipeline.clean_messages(raw.where("false")))).cases
    assert cases.count() == 0 and stats.confidence_distribution(cases).count() == 0
    verdict = stats.confidence_verdicts(cases).first()
    assert (verdict.total_cases, verdict.low_warning, verdict.quality) == (0, False, "poor")


def test_review_requests_of_a_case_beyond_a_block(spark, chat, monkeypatch):
    from convocases.operators import blocks
    from convocases.operators.messages import message_positions
    positioned = message_positions(chat([("a", i, "y" * 60) for i in range(40)]))
    bounds = spark.createDataFrame([("a", 0, 1, 37), ("a", 1, 38, 40)], "channel_url string, case_index long, start_pos long, end_pos long")
    whole = requests.review_requests(bounds, positioned, budget=150).select("request_id", "prompt", "first_pos", "last_pos").collect()
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", 5)
    cut = requests.review_requests(bounds, positioned, budget=150).select("request_id", "prompt", "first_pos", "last_pos").collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, cut)) and len(whole) > 5
    assert sum(r.prompt.count("<message id=") for r in cut) == 40


def test_parts_of_a_channel_do_not_change_its_cases(spark, chat):
    """Case numbers are dense over the parts; without any usable reply a channel is one case at every budget."""
    rows = chat([("a", i, "some words in a message") for i in range(30)])
    empty = spark.createDataFrame([], requests.REPLY_SCHEMA)
    for budget in (10_000, 200):
        asked = requests.segmentation_requests(rows, budget=budget)
        cases = pipeline.segment_with_replies(rows, empty, requests=asked).cases.collect()
        assert [(c.start_pos, c.end_pos, c.confidence, c.case_number) for c in cases] == [(1, 30, 0.3, "CASE_0001")]
    parts = {r.part: r for r in asked.collect()}
    assert len(parts) > 2
    first = '{"complete_cases": [' + ", ".join(
        f'{{"start_message": {i}, "end_message": {i}, "summary": "s", "confidence": 0.5}}' for i in (1, 2)) + "]}"
    answered = spark.createDataFrame(
        [(parts[0].request_id, first, None), (parts[1].request_id, None, "timeout")], "request_id string, content string, error string")
    found = replies.boundaries_of_replies(asked, answered).orderBy("case_index").collect()
    assert [c.case_index for c in found] == list(range(2 + len(parts) - 1))
    assert [(c.start_pos, c.end_pos) for c in found[2:]] == [(parts[p].first_pos, parts[p].last_pos) for p in sorted(parts)[1:]]
    assert [c.confidence for c in found[2:]] == [0.1] + [0.3] * (len(parts) - 2)


def test_truncation_shows_on_the_rows(spark, chat):
    rows = chat([("a", i, "some words in a message") for i in range(30)] + [("b", 0, "x")])
    asked = requests.segmentation_requests(rows, overflow="truncate", budget=200)
    done = pipeline.segment_with_replies(rows, spark.createDataFrame([], requests.REPLY_SCHEMA), requests=asked).messages
    flags = {(r.channel_url, r.case_number != "", r.case_truncated) for r in done.collect()}
    assert flags == {("a", True, True), ("a", False, False), ("b", True, False)}


def test_an_error_stays_with_its_request(spark):
    asked = spark.range(500, numPartitions=2).selectExpr("'r' || id as request_id", "'p' as prompt")

    def fn(batch):
        if (batch["request_id"] == "r77").any():
            raise ValueError("no")
        return batch[["request_id"]].assign(content="fine")

    rows = requests.map_requests(asked, fn).collect()
    assert len(rows) == 500 and [(r.request_id, r.error) for r in rows if r.error] == [("r77", "ValueError: no")]


def test_run_on_a_labelled_table_and_without_columns(spark):
    raw = spark.createDataFrame(
        [("2024-01-01T10:00:00Z", "m1", "c1", "hello", None, 1), ("2024-01-01T10:01:00Z", "m2", "c1", "Order #1", None, 2),
         ("bad", "m3", "c2", "x", None, 3), ("2024-01-01T10:02:00Z", "m4", "c2", "x", "a,b,c,d", 4)],
        "`Created Time` string, `Message ID` string, `Channel URL` string, Message string, _malformed string, ingest_seq long")
    run = pipeline.run_pipeline(raw)
    first = run.messages
    assert "_malformed" not in first.columns and "created_time_raw" not in first.columns and first.count() == 3
    again = pipeline.run_pipeline(first, skip_clean=True).messages
    assert sorted(again.columns) == sorted(first.columns)
    names = ["message_id", "case_number", "case_summary", "category"]
    assert sorted(map(tuple, again.select(*names).collect())) == sorted(map(tuple, first.select(*names).collect()))
    assert {r.channel_url for r in pipeline.run_pipeline(raw, skip_classify=True, channels=["c1"]).messages.collect()} == {"c1"}


def most_at_once(spans):
    edges = sorted([(start, 1) for start, _ in spans] + [(end, -1) for _, end in spans])
    at, most = 0, 0
    for _, step in edges:
        at += step
        most = max(most, at)
    return most


def test_calls_in_flight(spark):
    """50 ms a call, 16 at once in each of two tasks, one slow call, some errors: one row each, soon and within bounds."""
    asked = spark.range(320).selectExpr("'r' || id as request_id", "'p' as prompt", "id", "10L as prompt_tokens")

    def fn(request):
        start = time.time()
        time.sleep(1.0 if request["id"] == 3 else 0.05)
        if request["id"] % 40 == 7:
            raise ValueError(f"no {request['id']}")
        return None if request["id"] == 100 else f"{os.getpid()} {start} {time.time()}"

    rows = requests.call_requests(asked, fn, tasks=2, in_flight=16).collect()
    assert len(rows) == 320 and len({r.request_id for r in rows}) == 320
    assert {r.request_id: r.error for r in rows if r.error} == {**{f"r{i}": f"ValueError: no {i}" for i in range(7, 320, 40)}, "r100": "no reply"}
    tasks = {}
    for r in rows:
        if r.content:
            pid, start, end = r.content.split()
            tasks.setdefault(pid, []).append((float(start), float(end)))
    for spans in tasks.values():
        assert 8 <= most_at_once(spans) <= 16
        assert max(e for _, e in spans) - min(s for s, _ in spans) < 0.05 * len(spans) / 3 + 1  # not one after the other


def test_calls_share_a_rate(spark):
    asked = spark.range(60).selectExpr("'r' || id as request_id", "'p' as prompt", "100L as prompt_tokens")
    rows = requests.call_requests(asked, lambda request: {"content": str(time.time())}, tasks=3, tokens_per_minute=180_000).collect()
    times = sorted(float(r.content) for r in rows)
    assert len(times) == 60 and times[-1] - times[0] > 1.0  # 6,000 tokens at 3,000 a second, the tasks being of about the same size
    assert requests.call_requests(asked.where("false"), lambda request: "x", tasks=2).count() == 0
